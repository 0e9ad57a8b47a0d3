"""The plan properties the design relies on at scale, checked on the plans."""

import datetime as dt

from pyspark.sql import functions as F

from strata import inputs as I
from strata.operators import monitor as M
from strata.operators.envelope import event_columns, land_events
from strata.operators.upsert import BucketedTable, read_buckets
from strata.operators.contract import conformance_counts
from strata.operators.upsert import merge_newest
from strata.plans.conform import append_conformed, conform, drop_seen, first_landing, seen_conformed
from strata.plans.publish import publish_entity
from strata.plans.spec import EntitySpec
from strata.registry import CONFORMED_EVENTS
from strata.sources.tables import read_table

SF = "/root/testdata/sf0.001"


def _plan(df) -> str:
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue()


def test_serving_reads_prune_to_touched_buckets(spark, work):
    spec = EntitySpec(name="T", key="k", buckets=8, ties=())
    df = spark.range(100).select(F.struct(F.lit("2025-01-01").alias("PublicationDate")).alias("MetaData"),
                                 F.col("id").alias("k"))
    publish_entity(spark, df, spec, work, stamp=F.current_timestamp())
    plan = _plan(read_buckets(spark, BucketedTable(f"{work}/T", "k", 8), [1, 3]))
    pf = [line for line in plan.splitlines() if line.startswith("PartitionFilters")]
    assert pf and "_bucket" in pf[0] and "IN (1,3)" in pf[0]


def test_replay_dedupe_pushes_identity_ranges_into_the_scan(spark, work):
    msgs = I.event_messages(I.table(spark, SF, "events"))
    landed = land_events(event_columns(msgs), F.lit(dt.datetime(2025, 3, 11)))
    good, _ = conform(spark, landed, I.EVENT_CONTRACT, I.EVENT_PAYLOAD)
    append_conformed(good, f"{work}/conformed")
    plan = _plan(drop_seen(landed, seen_conformed(spark, f"{work}/conformed")))
    assert "MetaData.SourceSequenceNumber" in plan and "GreaterThanOrEqual" in plan
    assert "ReadSchema: struct<MetaData:struct<SourcePartition:bigint,SourceSequenceNumber:bigint>>" in plan


def test_file_listing_never_reads_content(spark, work):
    spark.range(3).write.parquet(f"{work}/files")
    plan = _plan(M.files_per_folder(M.list_files(spark, f"{work}/files", glob="*.parquet")))
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert schemas and "path" in schemas[0] and "content" not in schemas[0]


def test_first_landing_limits_before_the_shuffle_and_leaves_rows_without_identity_alone(spark):
    msgs = I.event_messages(I.table(spark, SF, "events"))
    landed = land_events(event_columns(msgs), F.lit(dt.datetime(2031, 7, 4)))
    plan = _plan(first_landing(landed))
    assert plan.count("WindowGroupLimit (") >= 2            # partial and final
    none = landed.withColumn("sequenceNumber", F.lit(None).cast("long"))
    assert first_landing(none).count() == none.count()


def test_conformed_day_queries_read_one_day(spark, work):
    msgs = I.event_messages(I.table(spark, SF, "events"))
    good, _ = conform(spark, land_events(event_columns(msgs), F.lit(dt.datetime(2031, 7, 4))), I.EVENT_CONTRACT, I.EVENT_PAYLOAD)
    append_conformed(good, f"{work}/conformed")
    day = read_table(spark, f"{work}/conformed", schema=CONFORMED_EVENTS).where("ingest_date = DATE'2031-07-04'")
    assert day.count() == good.count()
    assert any(line.startswith("PartitionFilters") and "ingest_date" in line for line in _plan(day).splitlines())


def test_upsert_without_arrays_is_one_ranking(spark, work, monkeypatch):
    """Ranking, guard and merge read the batch once and shuffle once."""
    from strata.operators import upsert
    spec = EntitySpec(name="T", key="k", buckets=4, ties=())
    rows = spark.range(200).select(F.struct(F.lit("2031-01-01").alias("PublicationDate")).alias("MetaData"), F.col("id").alias("k"))
    rows.write.parquet(f"{work}/rows")
    batch = spark.read.parquet(f"{work}/rows")
    publish_entity(spark, batch, spec, work, stamp=F.lit(None).cast("timestamp"))
    plans = []
    real = upsert.commit_buckets
    monkeypatch.setattr(upsert, "commit_buckets", lambda s, content, *a: (plans.append(_plan(content)), real(s, content, *a)))
    publish_entity(spark, batch, spec, work, stamp=F.lit(None).cast("timestamp"))
    assert len(plans) == 1 and merge_newest is upsert.merge_newest
    details = plans[0].split("(1) ", 2)[-1]
    assert plans[0].count("/rows]") == 1 and "Join" not in plans[0]
    assert sum(line.strip().endswith("Window") or "] Window" in line for line in details.splitlines()) <= 1
    assert spark.read.parquet(f"{work}/T").count() == 200


def test_conformance_parses_each_document_once(spark):
    docs = spark.range(5).select(F.to_json(F.struct("id")).alias("document"))
    assert _plan(conformance_counts(docs, CONFORMED_EVENTS)).count("from_json") == 1
