"""The progress table: counts, times, failures and batches that are done again."""

import pytest
from pyspark.errors import StreamingQueryException

import strata.streaming.jobs as jobs
from strata import inputs as I
from strata.sources.events import event_stream, file_events
from strata.streaming.jobs import run_raw, trigger_options
from strata.streaming.progress import ProgressTable, read_progress

SF = "/root/testdata/sf0.001"


def test_batches_and_a_failure_are_entered(spark, work, monkeypatch):
    msgs = I.event_messages(I.table(spark, SF, "events"))
    msgs.repartition(2).write.parquet(f"{work}/hub")
    table = ProgressTable(spark, f"{work}/progress")
    assert read_progress(spark, f"{work}/progress").count() == 0

    def run():
        src = event_stream(file_events(spark, f"{work}/hub", msgs.schema, max_files_per_trigger=1))
        run_raw(src, f"{work}/raw", f"{work}/chk", trigger_options(available_now=True), name=None, progress=table).awaitTermination(120)

    real = jobs.write_raw
    monkeypatch.setattr(jobs, "write_raw", lambda *a: (_ for _ in ()).throw(RuntimeError("disk gone")))
    with pytest.raises(StreamingQueryException):
        run()
    monkeypatch.setattr(jobs, "write_raw", real)
    run()
    table.close()
    rows = read_progress(spark, f"{work}/progress").collect()
    done = {r.batch: r for r in rows if r.failure is None}
    assert sorted(done) == [0, 1] and sum(r.rows for r in done.values()) == msgs.count()
    assert all(r.millis > 0 and r.input_rows > 0 and r.name == "raw" and r.started for r in done.values())
    failed = [r for r in rows if r.failure is not None]
    assert [(r.batch, r.rows, r.name) for r in failed] == [(0, None, "raw")]
