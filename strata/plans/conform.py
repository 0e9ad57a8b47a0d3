"""K4: conform a batch of raw rows under a contract.

replayed copies dropped (Q7) ; documents parsed under the contract (J1) ;
malformed / mistyped / incomplete documents to quarantine (A7, A16, Q5) ;
``SilverCreatedAt`` stamped (B3) ; envelope split (B6) ; landing day added, by
which the conformed table is partitioned (A8).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import (DateType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata.functions.docs import STAMP_KEY, parse_stamp
from strata.operators.contract import CORRUPT, REASON, parse_documents, reject_reason, relax
from strata.operators.envelope import META, split_envelope
from strata.operators.intervals import not_in
from strata.operators.monitor import observe_rows, observed_rows
from strata.plans.ledger import IdentityLedger
from strata.sources.tables import append_table, read_table, table_exists

IDENTITY = ("partition", "sequenceNumber")
SOURCE_PARTITION = "SourcePartition"
SOURCE_SEQUENCE = "SourceSequenceNumber"
SOURCE_FILE = "SourceFile"
SILVER_STAMP = "SilverCreatedAt"
INGEST_DAY = "ingest_date"


def first_landing(raw: DataFrame) -> DataFrame:
    """Q7 within a batch: one row per event identity, the earliest landing.
    ``row_number() = 1`` over rows that have an identity keeps the partial limit
    before the shuffle; rows without one are never copies of each other, so they
    stay outside the window, where they are and unsorted."""
    w = Window.partitionBy(*IDENTITY).orderBy(F.col("BronzeCreatedAt").asc_nulls_last(),
                                             F.col("document").asc_nulls_last())
    known = F.col(IDENTITY[0]).isNotNull() & F.col(IDENTITY[1]).isNotNull()
    first = raw.where(known).withColumn("__r", F.row_number().over(w)).where(F.col("__r") == 1).drop("__r")
    return first.unionByName(raw.where(~known))


def drop_seen(raw: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Q7 across batches: drop events whose identity is in ``seen`` (partition,
    sequenceNumber).

    Hub sequence numbers grow, so the stored side is first cut to the batch's
    range of them (one row, however many hub partitions there are): the filter
    reaches the Parquet scan and row groups outside the range are skipped."""
    if seen is None:
        return raw
    r = raw.agg(F.min("sequenceNumber").alias("lo"), F.max("sequenceNumber").alias("hi")).first()
    if r["lo"] is None:
        return raw
    seen = seen.where(F.col("sequenceNumber").between(r["lo"], r["hi"])).distinct()
    return raw.join(seen, list(IDENTITY), "left_anti")


def drop_seen_runs(raw: DataFrame, seen: DataFrame | None) -> DataFrame:
    """Q7 across batches: drop events whose number is in the ledger's runs."""
    return raw if seen is None else not_in(raw, seen)


def seen_conformed(spark: SparkSession, path: str | None) -> DataFrame | None:
    """Identities of a conformed table; only those two fields are read."""
    if not path or not table_exists(spark, path):
        return None
    identity = StructType([StructField(META, StructType([
        StructField(SOURCE_PARTITION, LongType()), StructField(SOURCE_SEQUENCE, LongType())]))])
    return (read_table(spark, path, schema=identity)
            .select(F.col(f"{META}.{SOURCE_PARTITION}").alias("partition"),
                    F.col(f"{META}.{SOURCE_SEQUENCE}").alias("sequenceNumber")))


def tag(parsed: DataFrame, contract: StructType) -> DataFrame:
    """``parsed`` with the reason why a row breaks the contract (NULL: it doesn't).
    Both routes filter on it, so a caller that persists it parses once."""
    if CORRUPT not in parsed.columns:
        parsed = parsed.withColumn(CORRUPT, F.lit(None).cast("string"))
    return parsed.withColumn(REASON, reject_reason(contract))


def conform_tagged(raw: DataFrame, contract: StructType, seen: DataFrame | None = None,
                   dedupe: bool = True, seen_runs: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """Raw rows -> first landings not seen before, parsed and tagged. What was seen comes
    as identities (``seen``) or as the ledger's runs; those rows go before the ranking.
    ``carry`` names further columns to keep."""
    if dedupe:
        raw = first_landing(drop_seen_runs(drop_seen(raw, seen), seen_runs))
    keep = [c for c in ("partition", "sequenceNumber", "document", "source_file", *carry) if c in raw.columns]
    return tag(parse_documents(raw.select(*keep), contract, keep=keep), contract)


def conformed_rows(tagged: DataFrame, payload: str, stamp: Column | None = None) -> DataFrame:
    """The rows that conform: ``MetaData`` (document envelope, ``SilverCreatedAt``,
    source partition, sequence number and file), payload fields, landing day."""
    stamp = F.current_timestamp() if stamp is None else stamp
    have = tagged.columns
    good = tagged.where(F.col(REASON).isNull()).withColumn(SILVER_STAMP, stamp.cast("timestamp"))
    for new, old, kind in ((SOURCE_PARTITION, "partition", "long"), (SOURCE_SEQUENCE, "sequenceNumber", "long"),
                           (SOURCE_FILE, "source_file", "string")):
        good = good.withColumn(new, (F.col(old) if old in have else F.lit(None)).cast(kind))
    good = good.drop(REASON, CORRUPT, "partition", "sequenceNumber", "document", "source_file")
    day = parse_stamp(F.col(f"{META}.{STAMP_KEY}")) if STAMP_KEY in have else F.lit(None)
    return split_envelope(good, payload).withColumn(INGEST_DAY, day.cast("date"))


def rejected_rows(tagged: DataFrame, carry: tuple[str, ...] = ()) -> DataFrame:
    """The rows that don't: their identity, document and file, with the reason."""
    keep = [c for c in ("partition", "sequenceNumber", "document", "source_file", *carry) if c in tagged.columns]
    return tagged.where(F.col(REASON).isNotNull()).select(*keep, F.col(REASON).alias("reason"))


def conform(spark: SparkSession, raw: DataFrame, contract: StructType, payload: str,
            stamp: Column | None = None, conformed_path: str | None = None,
            dedupe: bool = True) -> tuple[DataFrame, DataFrame]:
    """(conformed rows, quarantined rows) of a batch of raw rows (``partition``,
    ``sequenceNumber``, ``document`` ...)."""
    tagged = conform_tagged(raw, contract, seen_conformed(spark, conformed_path), dedupe)
    return conformed_rows(tagged, payload, stamp), rejected_rows(tagged)


def write_conformed(tagged: DataFrame, payload: str, stamp: Column | None, conformed_path: str,
                    quarantine: str, query: str, batch: str) -> int:
    """Both routes of one parsed and tagged batch, which is computed once. Rejects
    replace the folder of their query and batch, so a replay doesn't add to them."""
    tagged = tagged.persist()
    try:
        good, obs = observe_rows(conformed_rows(tagged, payload, stamp), f"conform-{query}-{batch}")  # E7
        append_conformed(good, conformed_path)
        bad = rejected_rows(tagged)
        if bad.take(1):
            (bad.withColumn("query", F.lit(query)).withColumn("batch", F.lit(batch))
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("query", "batch").parquet(quarantine))
        return observed_rows(obs)
    finally:
        tagged.unpersist()


def conform_batch(spark: SparkSession, raw: DataFrame, contract: StructType, payload: str, conformed_path: str,
                  stamp: Column | None = None, query: str = "batch", batch: str | int | None = None) -> int:
    """K4 in whole: raw rows that the table hasn't taken yet are conformed and appended,
    rejects quarantined, both entered in the identity ledger; the rows appended. The
    ledger says what was taken, so no stored row is read, however long the history.
    The same ``query`` and ``batch`` again is a replay."""
    run = f"{query}-{uuid.uuid4().hex[:12] if batch is None else batch}"
    ledger = IdentityLedger(spark, conformed_path)
    begun = ledger.begin(raw.select(*IDENTITY), run)
    tagged = conform_tagged(raw, contract, seen_runs=begun.seen)
    rows = write_conformed(tagged, payload, stamp, conformed_path, ledger.quarantine, query, run.rsplit("-", 1)[-1])
    begun.release()
    ledger.commit(run)
    return rows


def conform_documents(parsed: DataFrame, contract: StructType, payload: str,
                      stamp: Column | None = None) -> tuple[DataFrame, DataFrame]:
    """K4 for documents read straight from a JSON folder (``json_documents``):
    ``parsed`` has the contract fields, ``_corrupt_record`` and ``source_file``,
    which goes to both the conformed rows' lineage and the rejects."""
    tagged = tag(parsed, contract)
    return conformed_rows(tagged, payload, stamp), tagged.where(F.col(REASON).isNotNull())


def append_conformed(rows: DataFrame, path: str) -> None:
    """Append, partitioned by landing day; rows are dealt by day first, so a
    batch adds about one file a day and size step (a heavy day is split)."""
    append_table(rows.hint("rebalance", INGEST_DAY), path, partition_by=[INGEST_DAY])


def conformed_schema(contract: StructType, payload: str) -> StructType:
    """Schema of the conformed table built from the contract."""
    rel = relax(contract)
    env = [f for f in rel.fields if f.name != payload]
    meta = StructType(env + [StructField(SILVER_STAMP, TimestampType()),
                             StructField(SOURCE_PARTITION, LongType()),
                             StructField(SOURCE_SEQUENCE, LongType()),
                             StructField(SOURCE_FILE, StringType())])
    pay = rel[payload].dataType
    return StructType([StructField(META, meta)] + list(pay.fields) + [StructField(INGEST_DAY, DateType())])
