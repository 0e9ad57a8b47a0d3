"""Raw landing and envelope operators.

``land_events`` turns a batch of hub events into raw rows: the decoded body is
stamped inside the JVM and tagged with its type and ingest date (the columns
the raw layer is partitioned by). ``split_envelope`` packs every column except
the payload into one ``MetaData`` struct and promotes the payload's fields.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.functions.docs import (STAMP_KEY, decode_body, format_stamp, object_map,
                                   object_type, stamp_object, unique_keys)

EVENT_COLUMNS = ("decoded_body", "partition", "sequenceNumber")
META = "MetaData"


def event_columns(df: DataFrame, body: str = "body") -> DataFrame:
    """A1/B1/B2: keep the decoded body and the event identity, drop the rest."""
    return df.select(decode_body(body).alias("decoded_body"),
                     F.col("partition"), F.col("sequenceNumber"))


def land_events(df: DataFrame, stamp: Column | None = None) -> DataFrame:
    """Stamp each event's document and derive type and date.

    ``stamp`` defaults to ``current_timestamp()`` (one value per batch). The
    document keeps its text when it is not a JSON object (``stamped`` false),
    so the conform step can quarantine it with its content.
    """
    stamp = F.current_timestamp() if stamp is None else stamp
    body = F.col("decoded_body")
    # each body is parsed once; type and stamped text both come from that map
    # (Catalyst keeps a non-cheap column used twice in its own projection)
    parsed = (df.select(F.col("partition").cast("bigint").alias("partition"),
                        F.col("sequenceNumber").cast("bigint").alias("sequenceNumber"),
                        body, stamp.cast("timestamp").alias(STAMP_KEY),
                        object_map(body).alias("__raw"))
                .select("partition", "sequenceNumber", "decoded_body", STAMP_KEY,
                        unique_keys(F.col("__raw")).alias("__obj")))
    stamped = parsed.select("partition", "sequenceNumber", "decoded_body", STAMP_KEY,
                            object_type(F.col("__obj")).alias("event_type"),
                            stamp_object(F.col("__obj"), format_stamp(F.col(STAMP_KEY)))
                            .alias("__stamped"))
    return stamped.select("partition", "sequenceNumber", STAMP_KEY, "event_type",
                          F.to_date(F.col(STAMP_KEY)).alias("ingest_date"),
                          F.coalesce(F.col("__stamped"), body).alias("document"),
                          F.col("__stamped").isNotNull().alias("stamped"))


def payload_fields(df: DataFrame, payload: str) -> list[str]:
    """Field names of the payload struct."""
    dt = df.schema[payload].dataType
    if not isinstance(dt, StructType):
        raise TypeError(f"payload column {payload} is not a struct")
    return dt.names


def split_envelope(df: DataFrame, payload: str, meta: str = META) -> DataFrame:
    """``MetaData`` = struct of every other column; payload fields promoted."""
    fields = payload_fields(df, payload)
    others = [c for c in df.columns if c != payload]
    if meta in fields:
        raise ValueError(f"payload field {meta!r} collides with the envelope column")
    p = F.col(f"`{payload}`")
    return df.select(F.struct(*[F.col(f"`{c}`") for c in others]).alias(meta),
                     *[p.getField(f).alias(f) for f in fields])
