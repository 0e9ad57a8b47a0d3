"""Rows per day kept by a stream: parts, late rows, rows without a stamp, a batch done again."""

import datetime as dt

import pytest
from pyspark.errors import StreamingQueryException

import strata.streaming.monitors as M
from strata.operators.monitor import rows_per_day
from strata.sources.events import file_events
from strata.streaming.jobs import trigger_options
from strata.streaming.monitors import read_rows_per_day, run_rows_per_day, uncounted
from strata.streaming.progress import ProgressTable

SCHEMA = "n long, ts timestamp"


def rows(spark, *days_and_counts):
    out = [(i, None if day is None else dt.datetime(2031, 1, day, i % 24)) for day, n in days_and_counts for i in range(n)]
    return spark.createDataFrame(out, SCHEMA)


def run(spark, work, table=None, lateness="1 day"):
    stream = file_events(spark, f"{work}/in", spark.createDataFrame([], SCHEMA).schema)
    run_rows_per_day(stream, "ts", f"{work}/out", f"{work}/chk", lateness, trigger_options(available_now=True),
                     progress=table).awaitTermination(180)


def counts(spark, work):
    return {r.day.day: r.row_count for r in read_rows_per_day(spark, f"{work}/out").collect()}


def test_parts_late_rows_and_rows_without_a_stamp(spark, work):
    table = ProgressTable(spark, f"{work}/progress")
    assert counts_of_nothing(spark, work)
    parts = [rows(spark, (1, 30), (2, 20)), rows(spark, (2, 5), (3, 40), (5, 24)), rows(spark, (1, 7), (5, 3), (6, 2), (None, 4))]
    for part in parts:
        part.write.mode("append").parquet(f"{work}/in")
        run(spark, work, table)
    table.close()
    got = counts(spark, work)
    assert got == {1: 30, 2: 25, 3: 40, 5: 27, 6: 2}            # the watermark had passed day 1 when its last rows came
    assert uncounted(spark, f"{work}/out", f"{work}/progress") == 7 + 4
    batch = {r.day.day: r.row_count for r in rows_per_day(spark.read.parquet(f"{work}/in").where("ts IS NOT NULL"), "ts").collect()}
    assert {d: n for d, n in batch.items() if d != 1} == {d: n for d, n in got.items() if d != 1} and batch[1] == got[1] + 7


def counts_of_nothing(spark, work):
    return read_rows_per_day(spark, f"{work}/out").count() == 0


def test_a_batch_that_is_done_again_changes_nothing(spark, work, monkeypatch):
    rows(spark, (1, 10), (2, 3)).write.parquet(f"{work}/in")
    run(spark, work)
    rows(spark, (2, 4)).write.mode("append").parquet(f"{work}/in")
    real = M.upsert_main

    def lost(*a, **k):
        real(*a, **k)
        raise RuntimeError("driver lost after the write")

    with monkeypatch.context() as m:
        m.setattr(M, "upsert_main", lost)
        with pytest.raises(StreamingQueryException):
            run(spark, work)
    run(spark, work)
    assert counts(spark, work) == {1: 10, 2: 7}
