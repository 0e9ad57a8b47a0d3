import zlib

import numpy as np

from strata.llm import quality_fm as Q
from strata.llm.common import table
from tests.llm.helpers import collected, edge_rows, frame

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_clean_documents_stay(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    model = Q.train(docs, labels)
    got = {r["doc_id"]: r for r in Q.score(docs, model).collect()}
    truth = [(r["doc_id"], r["quality"]) for r in labels.collect()]
    held = [(i, q) for i, q in truth if got[i]["held_out"]]
    assert all(got[i]["held_out"] == (zlib.crc32(str(i).encode()) % 3 == 1) for i, _ in truth)
    assert np.mean([got[i]["predicted"] == q for i, q in held]) > 0.93
    assert np.mean([got[i]["predicted"] == 1 for i, q in held if q == 1]) > 0.95
    left = {r["doc_id"] for r in Q.accepted(docs, model).select("doc_id").collect()}
    assert left == {i for i, r in got.items() if r["predicted"] == 1}


def test_scores_are_the_pairwise_sum(spark):
    """The sum-of-squares identity against the sum over all pairs."""
    rng = np.random.default_rng(0)
    model = Q.blank()
    model.w, model.v, model.w0 = rng.normal(size=model.w.shape), rng.normal(size=model.v.shape), 0.3
    texts = [b"", b"one two two three\nfour", b"x"]
    parts = [Q.features(t) for t in texts]
    idx, val, at = Q.flat(parts, np.array([float(len(t)) for t in texts]), model)
    got, _ = model.margin(idx, val, at)
    for z, a, b in zip(got, at, np.append(at[1:], len(idx))):
        i, x = idx[a:b], val[a:b].astype(float)
        pairs = sum(model.v[i[p]] @ model.v[i[q]] * x[p] * x[q] for p in range(len(i)) for q in range(p))
        assert abs(z - (model.w0 + model.w[i] @ x + pairs)) < 1e-5


def test_edge_cases(spark):
    rows = edge_rows()
    df = frame(spark, rows)
    labels = spark.createDataFrame([(3, 1, 0), (5, 0, None), (None, 1, 1), (7, None, 0), (3, 0, 0), (999, 1, 0)],
                                   "doc_id long, quality int, toxic int")
    model = Q.train(df, labels)
    got = collected(Q.score(df, model))
    assert len(got) == len(rows) and all(0 <= r[2] <= 1 and r[3] == int(r[2] >= 0.5) for r in got)
    assert Q.accepted(df, model).columns == df.columns
    assert collected(Q.score(frame(spark, []), model)) == []


def test_without_labels_all_is_accepted(spark):
    df = frame(spark, edge_rows())
    model = Q.train(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    assert {r[2:] for r in collected(Q.score(df, model))} == {(0.5, 1)}
    assert Q.accepted(df, model).count() == df.count()
