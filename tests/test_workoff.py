"""Working off the quarantine: exactly once, whatever is lost in between."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

import strata.plans.workoff as W
from strata import inputs as I
from strata.operators.envelope import event_columns, land_events
from strata.plans.conform import conform_batch, conformed_schema
from strata.plans.workoff import closed_rejects, work_off
from strata.sources.tables import path_exists, read_table

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2031, 7, 4)
NEWER = StructType([StructField(f.name, f.dataType, f.nullable or f.name == "PublicationDate") for f in I.EVENT_CONTRACT.fields])


@pytest.fixture()
def table(spark, work):
    """Every 11th document is cut short, every other 11th has no publication date; two batches."""
    k = F.pmod(F.col("sequenceNumber"), F.lit(11))
    docs = I.event_document(I.table(spark, SF, "events"))
    doc = (F.when(k == 0, F.substring("doc", 1, 25)).when(k == 5, F.regexp_replace("doc", '"PublicationDate":"[^"]*",', ""))
           .otherwise(F.col("doc")))
    landed = land_events(event_columns(docs.select(F.encode(doc, "UTF-8").alias("body"), "partition", "sequenceNumber")), F.lit(DAY))
    for half in (0, 1):
        # the first batch has documents without a date only: its quarantine folder empties
        conform_batch(spark, landed.where((F.col("sequenceNumber") < 300) == (half == 0)).where(f"{half} = 1 OR sequenceNumber % 11 <> 0"),
                      I.EVENT_CONTRACT, I.EVENT_PAYLOAD, f"{work}/c", F.lit(DAY), batch=half)
    return f"{work}/c"


def state(spark, table):
    good = read_table(spark, table, schema=conformed_schema(I.EVENT_CONTRACT, I.EVENT_PAYLOAD))
    bad = spark.read.parquet(f"{table}_quarantine")
    numbers = lambda df, c: sorted(r[0] for r in df.select(c).collect())
    return numbers(good, "MetaData.SourceSequenceNumber"), numbers(bad, "sequenceNumber")


def want(spark):
    ids = [r.event_id for r in I.table(spark, SF, "events").collect() if r.event_id >= 300 or r.event_id % 11]
    return sorted(i for i in ids if i % 11), sorted(i for i in ids if i % 11 == 0)


def test_what_conforms_moves_once_and_is_closed(spark, table):
    done = work_off(spark, table, NEWER, I.EVENT_PAYLOAD, F.lit(DAY))
    good, bad = want(spark)
    assert state(spark, table) == (good, bad)
    moved = [i for i in good if i % 11 == 5]
    assert done == {"moved": len(moved), "left": len(bad)}
    assert work_off(spark, table, NEWER, I.EVENT_PAYLOAD, F.lit(DAY)) == {"moved": 0, "left": len(bad)}
    assert state(spark, table) == (good, bad)
    closed = closed_rejects(spark, table).collect()
    assert sorted(r.sequenceNumber for r in closed) == moved
    assert {r.was for r in closed} == {"required field missing: PublicationDate"} and {r.batch for r in closed} == {0, 1}


@pytest.mark.parametrize("lost_in", ["plan", "later rename", "removal"])
def test_a_lost_work_off_is_carried_on(spark, table, monkeypatch, lost_in):
    calls = {"n": 0}

    def losing(real, at):
        def run(*a):
            calls["n"] += 1
            if calls["n"] == at:
                raise RuntimeError("driver lost")
            return real(*a)
        return run

    name, at = {"plan": ("write_small_text", 1), "later rename": ("move_files", 2), "removal": ("remove_path", 1)}[lost_in]
    with monkeypatch.context() as m:
        m.setattr(W, name, losing(getattr(W, name), at))
        with pytest.raises(RuntimeError):
            work_off(spark, table, NEWER, I.EVENT_PAYLOAD, F.lit(DAY))
    work_off(spark, table, NEWER, I.EVENT_PAYLOAD, F.lit(DAY))
    good, bad = want(spark)
    assert state(spark, table) == (good, bad)
    assert sorted(r.sequenceNumber for r in closed_rejects(spark, table).collect()) == [i for i in good if i % 11 == 5]
    assert not path_exists(spark, f"{table}_workoff")


def test_nothing_to_work_off(spark, work):
    assert work_off(spark, f"{work}/none", NEWER, I.EVENT_PAYLOAD) == {"moved": 0, "left": 0}
    assert closed_rejects(spark, f"{work}/none") is None
