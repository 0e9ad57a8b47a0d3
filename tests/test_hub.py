"""The hub log: positions, bounded replays, restarts, growing logs, and what a read touches."""

import json
import os

import pytest
from pyspark.sql import functions as F

from strata.sources.events import event_stream
from strata.sources.hub import Index, append_log, hub_messages, hub_stream, log_positions
from strata.sources.raw import read_raw
from strata.streaming.jobs import run_raw, trigger_options


def messages(spark, lo, hi, partitions=3):
    """Numbers lo..hi-1 of each hub partition; partition 2 has only even numbers."""
    df = spark.range(lo, hi).crossJoin(spark.range(partitions).withColumnRenamed("id", "partition"))
    df = df.where((F.col("partition") < 2) | (F.col("id") % 2 == 0))
    body = F.to_json(F.struct(F.lit("T").alias("Type"), F.col("id").alias("n")))
    return df.select(F.encode(body, "UTF-8").alias("body"), "partition", F.col("id").alias("sequenceNumber"))


def numbers(df):
    return sorted((r.partition, r.sequenceNumber) for r in df.collect())


def want(lo, hi, partitions=3):
    lo = lo if isinstance(lo, dict) else dict.fromkeys(range(partitions), lo)
    return sorted((p, n) for p in range(partitions) for n in range(lo.get(p, 0), hi) if p < 2 or n % 2 == 0)


@pytest.fixture()
def log(spark, work):
    for lo, hi in ((0, 40), (40, 41), (41, 100)):
        append_log(spark, messages(spark, lo, hi), f"{work}/hub")
    return f"{work}/hub"


def test_batches_between_positions(spark, log):
    assert log_positions(log) == {"0": 100, "1": 100, "2": 99}
    assert numbers(hub_messages(spark, log)) == want(0, 100)
    start = {"0": 10, "1": 41}
    assert numbers(hub_messages(spark, log, start)) == want({0: 10, 1: 41}, 100)
    assert numbers(hub_messages(spark, log, start, {"0": 20, "1": 41, "2": 5})) == \
        [(0, n) for n in range(10, 20)] + [(2, 0), (2, 2), (2, 4)]
    assert numbers(hub_messages(spark, log, "latest")) == []
    body = hub_messages(spark, log, {"0": 99, "1": 100, "2": 100}).first().body
    assert json.loads(bytes(body)) == {"Type": "T", "n": 99}


def test_a_read_opens_only_captures_after_its_start(log):
    index = Index(log)
    opened = []
    real = index.load
    index.load = lambda name: (opened.append(name), real(name))[1]
    files = {f for f, *_ in index.slices({"0": 50, "1": 50, "2": 50}, {"0": 100, "1": 100, "2": 99})}
    assert len(opened) == 1 and all("capture=000000000002" in f for f in files)


def stream(spark, log, work, **at):
    q = run_raw(event_stream(hub_stream(spark, log, **at)), f"{work}/raw", f"{work}/chk",
                trigger_options(available_now=True), name=None)
    q.awaitTermination(120)
    return q


def landed(spark, work):
    return sorted((r.partition, r.sequenceNumber) for r in read_raw(spark, f"{work}/raw").collect())


def test_a_stream_from_here_to_now_restarts_in_the_middle(spark, log, work):
    start, now = {"0": 10, "1": 90, "2": 0}, log_positions(log)
    stream(spark, log, work, start=start, end={"0": 30, "1": 95, "2": 41})
    first = landed(spark, work)
    assert first == [(0, n) for n in range(10, 30)] + [(1, n) for n in range(90, 95)] + [(2, n) for n in range(0, 41, 2)]
    append_log(spark, messages(spark, 100, 130), log)
    stream(spark, log, work, start=start, end=now)                # goes on where it stopped; what came later stays out
    assert landed(spark, work) == want({0: 10, 1: 90}, 100)
    stream(spark, log, work, start=start)
    assert landed(spark, work) == want({0: 10, 1: 90}, 130)
    stream(spark, log, work, start=start)
    assert landed(spark, work) == want({0: 10, 1: 90}, 130)


def test_a_failed_batch_is_read_again_from_its_positions(spark, log, work):
    seen = []

    def fail_once(df, batch_id):
        seen.append(numbers(df))
        if len(seen) == 1:
            raise RuntimeError("lost")

    def run():
        q = (hub_stream(spark, log, {"0": 95}).writeStream.foreachBatch(fail_once)
             .option("checkpointLocation", f"{work}/chk").trigger(availableNow=True).start())
        q.awaitTermination(120)

    with pytest.raises(Exception):
        run()
    append_log(spark, messages(spark, 100, 102), log)
    run()
    assert seen[0] == seen[1] == want({0: 95}, 100)
    run()                                       # the run after the repeated batch goes on
    assert sorted(seen[1] + sum(seen[2:], [])) == want({0: 95}, 102)


def test_partitions_that_appear_later_are_read_from_the_beginning(spark, log, work):
    stream(spark, log, work)
    append_log(spark, messages(spark, 100, 110, partitions=4).where("partition = 3"), log)
    stream(spark, log, work)
    assert landed(spark, work) == want(0, 100) + [(3, n) for n in range(100, 110, 2)]


def test_numbers_never_go_back(spark, log):
    with pytest.raises(ValueError, match="position"):
        append_log(spark, messages(spark, 99, 120), log)
    assert log_positions(log) == {"0": 100, "1": 100, "2": 99}
    assert numbers(hub_messages(spark, log)) == want(0, 100)


def test_an_empty_log(spark, work):
    os.makedirs(f"{work}/none".replace("file:", ""))
    assert numbers(hub_messages(spark, f"{work}/none")) == [] and log_positions(f"{work}/none") == {}
