"""Interval sets against Python sets, and the identity ledger: replays, holes, overlaps,
rejects, lost batches, merged levels, and what a batch reads."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

import strata.plans.conform as C
import strata.plans.ledger as L
from strata import inputs as I
from strata.operators import intervals as N
from strata.operators.envelope import event_columns, land_events
from strata.plans.conform import conform_batch
from strata.plans.ledger import IdentityLedger
from strata.sources.tables import child_folders, path_exists, read_table

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2031, 7, 4)


def numbers(rng, n):
    """(partition, number) pairs with runs, holes and block borders."""
    out = set()
    for _ in range(n):
        p, at = rng.randrange(3), rng.choice([0, 65_530, 131_000, -70]) + rng.randrange(60)
        out |= {(p, at + i) for i in range(rng.randrange(1, 9))}
    return out


def frame(spark, pairs):
    return spark.createDataFrame([(p, s) for p, s in pairs], "partition long, sequenceNumber long")


def told(df):
    return {(r.partition, x) for r in df.collect() for x in range(r.lo, r.hi + 1)}


def test_interval_sets_are_sets(spark):
    rng = random.Random(4)
    a, b = numbers(rng, 40), numbers(rng, 40)
    ra, rb = N.runs(frame(spark, [*a, *list(a)[:50], (None, 1), (1, None)])), N.runs(frame(spark, b))
    assert told(ra) == a and told(N.merged(ra.union(rb).union(ra))) == a | b and told(N.intersected(ra, rb)) == a & b
    apart = N.told_apart(ra, rb).collect()
    assert {(r.partition, x) for r in apart if r.seen for x in range(r.lo, r.hi + 1)} == a & b
    assert {(r.partition, x) for r in apart if not r.seen for x in range(r.lo, r.hi + 1)} == a - b
    for df, own in ((ra, a), (N.merged(ra.union(rb)), a | b)):
        rows = sorted((r.partition, r.block, r.lo, r.hi) for r in df.collect())
        assert all(lo >> N.BLOCK_BITS == hi >> N.BLOCK_BITS == block for _, block, lo, hi in rows)
        assert all(x[:2] != y[:2] or x[3] + 1 < y[2] for x, y in zip(rows, rows[1:]))          # maximal
        assert df.agg(N.size(df)).first()[0] == len(own)
    rows = frame(spark, [*a, (None, 3), (2, None)])
    left = {tuple(r) for r in N.not_in(rows, rb).collect()}
    assert left == (a - b) | {(None, 3), (2, None)}


def test_empty_sets(spark):
    none = frame(spark, [])
    assert told(N.runs(none)) == set() and told(N.merged(N.runs(none))) == set()
    one = N.runs(frame(spark, [(1, 5)]))
    assert told(N.told_apart(one, N.runs(none))) == {(1, 5)} and told(N.intersected(one, N.runs(none))) == set()


def landed(spark, where="true", days=0, broken=13):
    msgs = I.event_messages(I.table(spark, SF, "events")).where(where)
    body = F.when(F.pmod("sequenceNumber", F.lit(broken)) == 0, F.substring("body", 1, 20)).otherwise(F.col("body"))
    return land_events(event_columns(msgs.withColumn("body", body)), F.lit(DAY + dt.timedelta(days=days)))


def conform(spark, work, raw, **how):
    return conform_batch(spark, raw, I.EVENT_CONTRACT, I.EVENT_PAYLOAD, f"{work}/c", F.lit(DAY), **how)


def state(spark, work):
    good = read_table(spark, f"{work}/c").select("MetaData.SourcePartition", "MetaData.SourceSequenceNumber").collect()
    bad = spark.read.parquet(f"{work}/c_quarantine").select("partition", "sequenceNumber").collect()
    return sorted(map(tuple, good)), sorted(map(tuple, bad))


def whole(spark):
    ids = [(r.partition, r.sequenceNumber) for r in I.event_messages(I.table(spark, SF, "events")).collect()]
    return sorted(i for i in ids if i[1] % 13), sorted(i for i in ids if i[1] % 13 == 0)


def test_overlapping_batches_and_a_full_replay(spark, work):
    conform(spark, work, landed(spark, "sequenceNumber % 10 <> 3 AND sequenceNumber < 700"))
    conform(spark, work, landed(spark, "sequenceNumber % 10 <> 3 AND sequenceNumber > 500", 1))
    conform(spark, work, landed(spark, days=2).union(landed(spark, days=3)))
    assert state(spark, work) == whole(spark)
    assert conform(spark, work, landed(spark, days=4)) == 0
    assert state(spark, work) == whole(spark)
    assert told(IdentityLedger(spark, f"{work}/c").read()) == {*whole(spark)[0], *whole(spark)[1]}


def test_rows_without_an_identity_are_always_taken(spark, work):
    nameless = landed(spark, "sequenceNumber IN (1, 2)").withColumn("sequenceNumber", F.lit(None).cast("long"))
    conform(spark, work, landed(spark).union(nameless))
    conform(spark, work, landed(spark, days=1).union(nameless))
    none = read_table(spark, f"{work}/c").where("MetaData.SourceSequenceNumber IS NULL")
    assert none.count() == 4
    named = read_table(spark, f"{work}/c").where("MetaData.SourceSequenceNumber IS NOT NULL")
    assert named.count() == len(whole(spark)[0])


@pytest.mark.parametrize("lost_in, replayed", [("append", True), ("after append", False), ("commit", True), ("commit", False)])
def test_a_lost_batch_costs_no_event_and_doubles_none(spark, work, monkeypatch, lost_in, replayed):
    """The writer is lost before, between or after its writes; the same batch comes again,
    or another one that holds its events."""
    conform(spark, work, landed(spark, "sequenceNumber < 300"), batch=0)
    real = C.append_conformed

    def lose(*a, **k):
        if lost_in == "after append":
            real(*a, **k)
        raise RuntimeError("driver lost")

    with monkeypatch.context() as m:
        m.setattr(IdentityLedger, "commit", lose) if lost_in == "commit" else m.setattr(C, "append_conformed", lose)
        with pytest.raises(RuntimeError):
            conform(spark, work, landed(spark, "sequenceNumber BETWEEN 200 AND 800"), batch=1)
    if replayed:
        conform(spark, work, landed(spark, "sequenceNumber BETWEEN 200 AND 800"), batch=1)
    conform(spark, work, landed(spark, days=1), batch=2)
    assert state(spark, work) == whole(spark)
    assert child_folders(spark, f"{work}/c_ledger/pending") == []


def test_a_replay_reads_the_ledger_and_not_the_table(spark, work, monkeypatch):
    conform(spark, work, landed(spark))
    monkeypatch.setattr(C, "seen_conformed", lambda *a: pytest.fail("the conformed table was read"))
    monkeypatch.setattr(IdentityLedger, "landed", lambda *a: pytest.fail("the conformed table was read"))
    conform(spark, work, landed(spark, days=1))
    assert state(spark, work) == whole(spark)


def test_a_table_without_a_ledger_gets_one(spark, work):
    from strata.sources.tables import remove_path
    conform(spark, work, landed(spark, "sequenceNumber < 500"))
    remove_path(spark, f"{work}/c_ledger")
    conform(spark, work, landed(spark, days=1))
    assert state(spark, work) == whole(spark)


def test_levels_are_merged(spark, work, monkeypatch):
    monkeypatch.setattr(L, "FAN_IN", 3)
    ledger = IdentityLedger(spark, f"{work}/c")
    for i in range(9):
        ledger.begin(frame(spark, [(0, x) for x in range(i * 5, i * 5 + 7)]), f"q-{i}")
        ledger.commit(f"q-{i}")
    assert told(ledger.read()) == {(0, x) for x in range(47)}
    entries = {f.rsplit("level=", 1)[-1]: len(child_folders(spark, f)) for f in child_folders(spark, f"{ledger.path}/entered")}
    assert entries == {"0": 0, "1": 0, "2": 1}
    assert spark.read.parquet(*child_folders(spark, f"{ledger.path}/entered/level=2")).count() == 1


def test_a_batch_that_is_all_known_enters_nothing(spark, work):
    ledger = IdentityLedger(spark, f"{work}/c")
    ids = frame(spark, [(0, 1), (0, 2)])
    assert ledger.begin(ids, "a").new == 2
    ledger.commit("a")
    begun = ledger.begin(ids, "b")
    assert begun.new == 0 and told(begun.seen) == {(0, 1), (0, 2)}
    ledger.commit("b")
    assert not path_exists(spark, f"{ledger.path}/entered/level=0/run=b")
    assert ledger.begin(frame(spark, []), "c").seen is None
