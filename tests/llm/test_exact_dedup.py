import hashlib

import pytest

from strata.llm import exact_dedup as X
from tests.llm.helpers import SF, by_text, collected, edge_rows, frame, lower


def brute(rows, largest=True):
    groups = {}
    for i, t in rows:
        groups.setdefault(lower(t or ""), []).append(i)
    out = []
    for i, t in rows:
        own = groups[lower(t or "")]
        known = [x for x in own if x is not None]
        keep = (max if largest else min)(known) if known else None
        out.append((i, keep, len(own), i == keep, hashlib.sha256(lower(t or "").encode()).hexdigest()))
    return out


@pytest.mark.parametrize("keep", ["largest", "smallest"])
def test_matches_brute_force(spark, keep):
    rows = edge_rows()
    got = collected(X.exact_dedup(frame(spark, rows).repartition(7), keep=keep, fan_in=2))
    assert by_text(got) == by_text(brute(rows, keep == "largest"))


def test_rounds_do_not_change_the_result(spark):
    rows = [(i, f"text {i % 13}") for i in range(400)]
    df = frame(spark, rows).repartition(23)
    assert by_text(collected(X.exact_dedup(df, fan_in=2))) == by_text(collected(X.exact_dedup(df, fan_in=64)))


def test_keep_rows_keeps_all_columns_and_one_row_a_text(spark):
    rows = [(1, "a"), (2, "A"), (3, "b"), (5, "a")]
    df = frame(spark, rows)
    left = X.keep_rows(df, X.exact_dedup(df))
    assert left.columns == df.columns
    assert sorted(r["doc_id"] for r in left.collect()) == [3, 5]


def test_an_id_is_judged_text_by_text(spark):
    df = frame(spark, [(1, "a"), (1, "other"), (2, "a")])
    assert sorted((r["doc_id"], r["text"]) for r in X.keep_rows(df, X.exact_dedup(df)).collect()) == [(1, "other"), (2, "a")]


def test_columns_of_any_name_and_type_travel_along(spark):
    df = spark.sql("""SELECT * FROM VALUES (1, 'a', map('k', 1), parse_json('{"x": 1}'), array(2), 'w', 's', 1, 'd', true),
                                           (1, 'a', map('k', 2), parse_json('3'), null, 'w', 's', 1, 'd', true),
                                           (4, 'A', null, null, null, null, null, null, null, null)
                      t(doc_id, text, m, v, arr, who, sha, tie, row, first)""")
    left = X.keep_rows(df, X.exact_dedup(df, keep="smallest"))
    assert left.columns == df.columns
    got = left.select("doc_id", "text", "who", "row").collect()
    assert [tuple(r) for r in got] == [(1, "a", "w", "d")]


def test_the_pipeline_keeps_one_row_a_text_where_ids_are_repeated(spark):
    import corpus_pipeline
    rows = [(5, "A text"), (5, "b"), (9, "B"), (7, "c"), (7, "c"), (7, "C"), (None, "d"), (None, "d"), (3, None), (3, ""), (4, "é")]
    left = corpus_pipeline.exact(spark, frame(spark, rows).repartition(3), SF)
    assert left.columns == frame(spark, []).columns
    assert by_text((r["doc_id"], lower(r["text"] or "")) for r in left.collect()) == by_text(
        [(5, "a text"), (9, "b"), (7, "c"), (None, "d"), (3, ""), (4, "é")])


def test_empty_table(spark):
    assert collected(X.exact_dedup(frame(spark, []))) == []


def test_merge_collapses_over_batches_and_tells_digests_with_other_sizes_apart():
    import pyarrow as pa
    d = b"d" * 32
    batch = lambda *rows: pa.RecordBatch.from_pylist(
        [dict(zip(("run", "digest", "n_bytes", "crc", "best_id", "n"), r)) for r in rows], schema=X.RUN_SCHEMA)
    got = X._Merge(True)([batch((0, d, 1, 9, 4, 1), (0, d, 1, 9, 7, 2)), batch((0, d, 1, 9, None, 1), (0, d, 2, 9, 1, 1))])
    assert [tuple(r.values()) for b in got for r in b.to_pylist()] == [(0, d, 1, 9, 7, 4), (0, d, 2, 9, 1, 1)]
