"""Raw landing: path and stamp of a document, empty batches, extra columns, broken bodies."""

import datetime as dt
import json

from pyspark.sql import functions as F

from strata.functions.docs import raw_document_path
from strata.operators.envelope import event_columns, land_events
from strata.sources.raw import read_raw, write_raw
from strata.sources.tables import path_exists
from strata.streaming.jobs import _skip_empty

STAMP = dt.datetime(2031, 7, 4, 5, 6, 7)
EVENTS = "decoded_body string, partition int, sequenceNumber int"


def test_path_and_document_follow_type_and_stamp(spark):
    body = json.dumps({"Type": "BOND", "coupon": 2.5, "legs": []})
    landed = land_events(spark.createDataFrame([(body, 3, 77)], EVENTS), F.lit(STAMP))
    path = raw_document_path("/lake/", "event_type", "BronzeCreatedAt", "partition", "sequenceNumber")
    row = landed.select("*", path.alias("path")).first()
    assert row["path"] == "/lake/bond/2031/07/04/event_3_77.json" and row["ingest_date"] == STAMP.date()
    assert json.loads(row["document"]) == {"Type": "BOND", "coupon": 2.5, "legs": [], "BronzeCreatedAt": "2031-07-04T05:06:07"}


def test_a_batch_without_rows_calls_no_writer(spark, work):
    seen = []
    _skip_empty(lambda batch, n: seen.append(n), "raw")(spark.createDataFrame([], EVENTS), 4)
    assert not seen and not path_exists(spark, f"{work}/raw")


def test_only_identity_and_document_reach_the_raw_zone(spark, work):
    rows = [(json.dumps({"Type": t}).encode(), p, n, "note") for t, p, n in (("Fund", 2, 9), ("Bond", 1, 8), ("Fund", 2, 10))]
    events = event_columns(spark.createDataFrame(rows, "body binary, partition int, sequenceNumber int, remark string"))
    write_raw(land_events(events), f"{work}/raw")
    zone = read_raw(spark, f"{work}/raw")
    assert not {"remark", "body"} & set(zone.columns)
    assert {(r.event_type, r.partition, r.sequenceNumber) for r in zone.collect()} == {("fund", 2, 9), ("bond", 1, 8), ("fund", 2, 10)}
    assert zone.where("BronzeCreatedAt IS NULL").count() == 0


def test_broken_bodies(spark):
    bodies = ["{bad", "[1]", '"x"', '{"Type":null}', '{"a":1}',
              '{"Type":"Bond","BronzeCreatedAt":"old","n":{"q":[1,2]}}']
    df = spark.createDataFrame([(b, 0, i) for i, b in enumerate(bodies)],
                               "decoded_body string, partition int, sequenceNumber int")
    out = {r.sequenceNumber: r for r in land_events(df, F.lit(STAMP)).collect()}
    for i in (0, 1, 2):
        assert out[i].stamped is False and out[i].document == bodies[i]
        assert out[i].event_type == "unknown"
    assert out[3].event_type == "unknown" and out[3].stamped
    assert out[4].event_type == "unknown"
    doc5 = json.loads(out[5].document)
    assert out[5].event_type == "bond"
    assert doc5["BronzeCreatedAt"] == "2031-07-04T05:06:07" and doc5["n"] == {"q": [1, 2]}
    assert list(doc5) == ["Type", "n", "BronzeCreatedAt"]


def test_repeated_keys_do_not_fail_the_batch(spark):
    bodies = ['{"a":1,"Type":"Bond","a":2}', '{"Type":"X","Type":"Equity"}', '{"Type":"Bond"}']
    df = spark.createDataFrame([(b, 0, i) for i, b in enumerate(bodies)],
                               "decoded_body string, partition int, sequenceNumber int")
    out = {r.sequenceNumber: r for r in land_events(df, F.lit(STAMP)).collect()}
    # first position, last value -- as a JSON loader reads repeated keys
    assert list(json.loads(out[0].document).items()) == [("a", 2), ("Type", "Bond"),
                                                          ("BronzeCreatedAt", "2031-07-04T05:06:07")]
    assert out[0].event_type == "bond" and out[1].event_type == "equity"
    assert out[2].event_type == "bond" and all(r.stamped for r in out.values())
