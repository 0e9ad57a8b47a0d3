"""Event sources (A1, A2): any frame with ``body``, ``partition`` and
``sequenceNumber`` is a hub event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.envelope import event_columns


def event_stream(df: DataFrame, body: str = "body") -> DataFrame:
    """A1: decoded body + identity of a streaming (or batch) event frame."""
    return event_columns(df, body)


def kafka_events(spark: SparkSession, servers: str, topic: str,
                 replay_from_start: bool = False, options: dict | None = None) -> DataFrame:
    """A1/A2 on Kafka (needs the Kafka connector on the class path): ``value``
    is the body, the Kafka partition and offset are the event identity.
    ``replay_from_start`` reads the topic from its first offset (bounded when
    the query uses ``trigger(availableNow=True)``)."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic)
         .option("startingOffsets", "earliest" if replay_from_start else "latest"))
    for k, v in (options or {}).items():
        r = r.option(k, v)
    df = r.load()
    return df.select(F.col("value").alias("body"), F.col("partition").cast("bigint"),
                     F.col("offset").alias("sequenceNumber"))


def file_events(spark: SparkSession, path: str, schema: StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """A1 from files: a folder of event files as an unbounded source."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)
