import zlib

from strata.llm import language_id as L
from strata.llm.common import table
from tests.llm.helpers import SF, collected, edge_rows, frame


def test_held_out_accuracy(spark):
    docs = table(spark, "/root/testdata/sf0.01", "documents")
    got = {r[0]: r for r in collected(L.identify(docs, L.train(docs)))}
    truth = [(r["doc_id"], r["lang"]) for r in docs.select("doc_id", "lang").collect()]
    assert all(got[i][1] == (zlib.crc32(str(i).encode()) % 4 == 2) for i, _ in truth)
    held = [(i, lang) for i, lang in truth if got[i][1]]
    assert sum(got[i][2] == lang for i, lang in held) / len(held) > 0.97
    assert all(0 <= r[3] <= 1 for r in got.values())


def test_edge_cases(spark):
    docs = table(spark, SF, "documents")
    model = L.train(docs)
    rows = edge_rows()
    got = collected(L.identify(frame(spark, rows), model))
    assert len(got) == len(rows)
    assert {r[2] for r in got if r[0] == 0} == {"und"}                     # NULL
    assert {r[2] for r in got if r[0] in (1, 2, 15)} == {"und"}            # no letter
    assert {r[2] for r in got if r[0] == 3} <= set(model.languages) and len({r[2:] for r in got if r[0] == 3}) == 1
    assert collected(L.identify(frame(spark, []), model)) == []


def test_without_training_rows_nothing_is_known(spark):
    df = frame(spark, [(1, "some words")])
    assert [r[2:] for r in collected(L.identify(df, L.train(df)))] == [("und", 0.0)]


def test_masks_name_all_languages_of_an_ngram_and_more_than_eight_fit():
    import numpy as np
    members = [np.array([i, 1000]) for i in range(11)]
    model = L.Model.of([f"l{i:02}" for i in range(11)], members, "l00")
    assert len(model.slices) == 2
    first, second = (model.masks(np.array([1000, 3, 9]), plane) for plane in model.slices)
    assert first.tolist() == [255, 8, 0] and (second & 7).tolist() == [7, 0, 2]
