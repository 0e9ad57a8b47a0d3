"""Inputs for the registered queries, derived by Spark from the driver tables.

The serving layer works on nested documents; the driver tables are flat, so
nesting is built here, row by row: arrays from a text's lines and words, struct
columns from a row's dimension rows. Events become hub messages whose bodies are
JSON documents of an ``Event`` entity keyed by ``user_id``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, LongType, StringType, StructField, StructType)

# Fixed values of the event documents.
EVENT_MODEL = "events"
EVENT_PAYLOAD = "Event"
PUBLICATION_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"
HUB_PARTITIONS = 4


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """documents as nested rows: ``lines`` array<struct<line, chars, words
    array<string>>> of the text's lines and their words, made within each row
    (bounded by the text, no shuffle); NULL texts have a NULL array."""
    words = lambda line: F.filter(F.split(line, " "), lambda w: w != "")
    lines = F.transform(F.split("text", "\n"), lambda line: F.struct(
        line.alias("line"), F.length(line).alias("chars"), words(line).alias("words")))
    return table(spark, sf_dir, "documents").select("doc_id", "lang", "source", lines.alias("lines"))


def turn_words(spark: SparkSession, sf_dir: str) -> DataFrame:
    """conversations with ``words`` array<string> of each turn, keyed by ``turn_id``."""
    conv = table(spark, sf_dir, "conversations")
    turn_id = F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    return conv.select(turn_id.alias("turn_id"), "role", F.split("text", " ").alias("words"))


def orders_with_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """orders + ``customer`` struct, itself holding ``nation`` holding ``region``."""
    region = table(spark, sf_dir, "region")
    nation = table(spark, sf_dir, "nation")
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders")
    r = region.select(F.col("r_regionkey").alias("__rk"),
                      F.struct("r_regionkey", "r_name").alias("region"))
    n = nation.join(r, nation["n_regionkey"] == r["__rk"], "left") \
              .select(F.col("n_nationkey").alias("__nk"),
                      F.struct("n_nationkey", "n_name", "n_regionkey", "region").alias("nation"))
    c = customer.join(n, customer["c_nationkey"] == n["__nk"], "left") \
                .select(F.col("c_custkey").alias("__ck"),
                        F.struct("c_custkey", "c_name", "c_nationkey", "c_acctbal",
                                 "c_mktsegment", "nation").alias("customer"))
    return orders.join(c, orders["o_custkey"] == c["__ck"], "left").drop("__ck")


def _initcap_word(c):
    return F.concat(F.upper(F.substring(c, 1, 1)), F.substr(c, F.lit(2)))


def event_document(events: DataFrame) -> DataFrame:
    """One JSON document per event (envelope + ``Event`` payload), with the hub
    identity: partition = event_id mod 4, sequenceNumber = event_id."""
    doc = F.to_json(F.struct(
        F.col("event_type").alias("ChangeType"),
        F.lit(EVENT_MODEL).alias("Model"),
        F.date_format("ts", PUBLICATION_FORMAT).alias("PublicationDate"),
        _initcap_word(F.col("event_type")).alias("Type"),
        F.struct("event_id", "user_id", "event_type", "value", "props").alias(EVENT_PAYLOAD)))
    return events.select(F.pmod(F.col("event_id"), F.lit(HUB_PARTITIONS)).alias("partition"),
                         F.col("event_id").alias("sequenceNumber"), doc.alias("doc"),
                         *events.columns)


def event_messages(events: DataFrame) -> DataFrame:
    """Hub messages: binary body + identity."""
    d = event_document(events)
    return d.select(F.encode("doc", "UTF-8").alias("body"), "partition", "sequenceNumber")


# The contract of a stamped event document.
EVENT_CONTRACT = StructType([
    StructField("ChangeType", StringType(), True),
    StructField("Model", StringType(), True),
    StructField("PublicationDate", StringType(), False),
    StructField("Type", StringType(), True),
    StructField(EVENT_PAYLOAD, StructType([
        StructField("event_id", LongType(), False),
        StructField("user_id", LongType(), True),
        StructField("event_type", StringType(), True),
        StructField("value", DoubleType(), True),
        StructField("props", StringType(), True),
    ]), False),
    StructField("BronzeCreatedAt", StringType(), True),
])
