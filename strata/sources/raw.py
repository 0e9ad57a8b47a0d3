"""The raw landing zone and JSON document folders.

Raw rows are written as Parquet partitioned by ``event_type`` and
``ingest_date`` (``key=value`` folders, so later reads prune by type and day);
each row keeps the event identity beside its stamped document. One file per
event, as a hub-to-file copier would do it, is replaced by one partitioned
append per micro-batch, written by the executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (BooleanType, DateType, LongType, StringType, StructField,
                               StructType, TimestampType, VariantType)

from strata.operators.contract import parse_documents

RAW_PARTITIONS = ("event_type", "ingest_date")
RAW_SCHEMA = StructType([
    StructField("partition", LongType()),
    StructField("sequenceNumber", LongType()),
    StructField("BronzeCreatedAt", TimestampType()),
    StructField("document", StringType()),
    StructField("stamped", BooleanType()),
    StructField("event_type", StringType()),
    StructField("ingest_date", DateType()),
])


def write_raw(landed: DataFrame, root: str, fmt: str = "parquet") -> None:
    """A3: append landed rows under ``event_type=.../ingest_date=...``.

    The ``rebalance`` hint groups rows by folder before the write, so a batch
    makes about one file per folder and size step instead of one per writer
    task and folder (the small files every later listing and read would pay
    for); AQE still splits a folder that is far above the advisory size, so a
    type holding most of the events is written by several tasks."""
    landed.select(*[f.name for f in RAW_SCHEMA.fields]).hint("rebalance", *RAW_PARTITIONS) \
          .write.mode("append").format(fmt).partitionBy(*RAW_PARTITIONS).save(root)


def read_raw(spark: SparkSession, root: str, event_type: str | None = None,
             day=None, fmt: str = "parquet") -> DataFrame:
    """Batch read of the raw zone; type and day filters prune folders."""
    df = spark.read.format(fmt).schema(RAW_SCHEMA).load(root)
    if event_type is not None:
        df = df.where(F.col("event_type") == event_type)
    if day is not None:
        df = df.where(F.col("ingest_date") == F.lit(day).cast("date"))
    return df


#: Spark writes a variant column's common fields as columns of their own, and reads only
#: the ones a query asks for.
VARIANT_CONF = {"spark.sql.variant.writeShredding.enabled": "true", "spark.sql.variant.inferShreddingSchema": "true",
                "spark.sql.variant.allowReadingShredded": "true", "spark.sql.variant.pushVariantIntoScan": "true"}
RAW_VARIANT_SCHEMA = StructType([
    StructField("partition", LongType()),
    StructField("sequenceNumber", LongType()),
    StructField("BronzeCreatedAt", TimestampType()),
    StructField("document", VariantType()),
    StructField("text", StringType()),
    StructField("event_type", StringType()),
    StructField("ingest_date", DateType()),
])


def use_variants(spark: SparkSession) -> None:
    """Set what shredded writes and pruned reads need on a session."""
    for name, value in VARIANT_CONF.items():
        spark.conf.set(name, value)


def write_raw_variant(landed: DataFrame, root: str) -> None:
    """A3 with the document as a variant, shredded into columns: a key, a type or a stamp is
    read without its document's text being read or parsed. What is no JSON object (or has
    a key twice inside it) keeps its text beside a NULL document."""
    use_variants(landed.sparkSession)
    parsed = F.when(F.col("stamped"), F.try_parse_json("document"))
    rows = landed.withColumn("__v", parsed).withColumn("text", F.when(F.col("__v").isNull(), F.col("document"))) \
                 .withColumn("document", F.col("__v"))
    rows.select(*[f.name for f in RAW_VARIANT_SCHEMA.fields]).hint("rebalance", *RAW_PARTITIONS) \
        .write.mode("append").partitionBy(*RAW_PARTITIONS).parquet(root)


def read_raw_variant(spark: SparkSession, root: str) -> DataFrame:
    use_variants(spark)
    return spark.read.schema(RAW_VARIANT_SCHEMA).parquet(root)


def document_keys(raw: DataFrame, keys: dict[str, tuple[str, str]], *others: str) -> DataFrame:
    """``name -> (JSON path, type)`` read from variant documents beside some columns; a value of
    another type is NULL. Only these paths' columns are read."""
    return raw.select(*others, *[F.try_variant_get("document", path, kind).alias(name) for name, (path, kind) in keys.items()])


def as_text(raw: DataFrame) -> DataFrame:
    """Rows of a variant raw zone as those of the text one: what the conform job reads."""
    return raw.select("partition", "sequenceNumber", "BronzeCreatedAt", F.coalesce(F.to_json("document"), F.col("text")).alias("document"),
                      F.col("document").isNotNull().alias("stamped"), "event_type", "ingest_date")


def raw_stream(spark: SparkSession, root: str, event_type: str | None = None,
               max_files_per_trigger: int | None = None, fmt: str = "parquet",
               archive_dir: str | None = None) -> DataFrame:
    """A4/A6 for the raw zone: new raw files as micro-batches.

    A file source lists its folder on every trigger; with ``archive_dir``
    processed files are moved there (Spark's ``cleanSource``), so the listed
    folder holds only the files not yet conformed."""
    r = spark.readStream.format(fmt).schema(RAW_SCHEMA)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    if archive_dir:
        r = r.option("cleanSource", "archive").option("sourceArchiveDir", archive_dir)
    df = r.load(root).withColumn("source_file", F.col("_metadata.file_path"))   # A15
    if event_type is not None:
        df = df.where(F.col("event_type") == event_type)
    return df


def json_documents(spark: SparkSession, path: str, contract: StructType,
                   multi_line: bool = True, stream: bool = False,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """A folder (or glob) of JSON documents under a pinned
    contract, batch or stream.

    Files are read as text -- a whole file per document when ``multi_line``
    (the one-document-per-file layout), else one document per line -- and
    parsed by ``parse_documents``, the same path as the raw zone: a broken
    document becomes a row with ``_corrupt_record`` set (quarantined by
    ``enforce``), and ``source_file`` is the file each row came from, taken
    here so it survives to the sink."""
    r = spark.readStream if stream else spark.read
    r = r.format("text").option("wholetext", multi_line)
    if stream and max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    text = r.load(path).select(F.col("value").alias("__doc"),
                               F.col("_metadata.file_path").alias("source_file"))
    if not multi_line:
        text = text.where(F.trim(F.col("__doc")) != "")
    return parse_documents(text, contract, doc="__doc", keep=["source_file"])
