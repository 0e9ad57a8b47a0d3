"""Streams: the three layers end to end, and a failed serving batch replayed
from the checkpoint."""

import pytest

import strata.streaming.jobs as jobs
from strata import inputs as I
from strata.operators.latest import latest_per_key
from strata.operators.upsert import read_main
from strata.pipeline import EVENT_SPEC, run_event_streams
from strata.streaming.jobs import conformed_schema, run_serving, stop_all, trigger_options

SF = "/root/testdata/sf0.001"


def expected_latest(spark):
    ev = I.table(spark, SF, "events")
    return sorted((r.user_id, r.event_id) for r in
                  latest_per_key(ev, "user_id", ["ts"], ["event_id"]).collect())


def test_raw_to_serving_streams(spark):
    run = run_event_streams(spark, SF)
    main = read_main(spark, f"{run.serving}/{EVENT_SPEC.name}")
    assert sorted((r.user_id, r.event_id) for r in main.collect()) == expected_latest(spark)
    assert spark.read.parquet(run.conformed).count() == I.table(spark, SF, "events").count()


def test_failed_batch_is_replayed(spark, work, monkeypatch):
    run = run_event_streams(spark, SF)
    schema = conformed_schema(I.EVENT_CONTRACT, I.EVENT_PAYLOAD)
    calls = {"n": 0}
    real = jobs.publish_entity

    def flaky(*a, **k):
        calls["n"] += 1
        if calls["n"] == 1:
            real(*a, **k)                       # commits, then the batch "crashes"
            raise RuntimeError("executor lost after commit")
        return real(*a, **k)

    monkeypatch.setattr(jobs, "publish_entity", flaky)
    once = trigger_options(available_now=True)
    q = run_serving(spark, run.conformed, schema, f"{work}/serving", EVENT_SPEC, f"{work}/chk",
                    trigger=once, max_files_per_trigger=1, name=None)
    with pytest.raises(Exception):
        q.awaitTermination(300)
    stop_all(spark)
    q = run_serving(spark, run.conformed, schema, f"{work}/serving", EVENT_SPEC, f"{work}/chk",
                    trigger=once, max_files_per_trigger=1, name=None)
    q.awaitTermination(300)
    main = read_main(spark, f"{work}/serving/{EVENT_SPEC.name}")
    assert sorted((r.user_id, r.event_id) for r in main.collect()) == expected_latest(spark)
    assert main.count() == main.select("user_id").distinct().count()


def test_one_off_run_without_checkpoint(spark, work):
    """A run without a checkpoint keeps its progress under the shared folder."""
    from strata.sources.events import event_stream, file_events
    from strata.sources.raw import read_raw
    from strata.streaming.jobs import run_raw
    msgs = I.event_messages(I.table(spark, SF, "events"))
    msgs.write.parquet(f"{work}/hub")
    src = event_stream(file_events(spark, f"{work}/hub", msgs.schema))
    q = run_raw(src, f"{work}/raw", None, trigger_options(available_now=True), name=None)
    q.awaitTermination(120)
    assert read_raw(spark, f"{work}/raw").count() == msgs.count()
    import glob
    root = spark.sparkContext.getCheckpointDir().replace("file:", "")
    assert glob.glob(f"{root}/strata/checkpoint-stream-*/commits")


def test_a_layer_that_is_not_finished_in_time_stops_the_run(spark):
    before = len(spark.streams.active)
    with pytest.raises(TimeoutError):
        run_event_streams(spark, SF, upto="raw", timeout_s=0.01)
    assert len(spark.streams.active) == before
