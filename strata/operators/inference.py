"""Contract inference over the raw zone, a day at a time.

``schema_of_variant_agg`` tells the schema of a group of documents as one mergeable
aggregate, so each landing day's schema is found once, kept as one row, and merged with
the other days' when a contract is asked for: no document is read twice, and a day that
gets more documents is done again alone. ``merged_kind`` joins two such schemas as the
aggregate itself does (an object's fields by name; whole numbers, decimals and doubles
by the wider one; kinds that have nothing in common are VARIANT), so the merge of all days
is the schema of all documents. Names that differ in case only are one field, under the
least name (the aggregate takes whichever comes first).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, DataType, DecimalType, DoubleType, LongType, NullType, StringType, StructField,
                               StructType, VariantType, _parse_datatype_string)

from strata.sources.tables import table_exists

DAY = "ingest_date"
KEPT = f"documents long, schema string, {DAY} date"
# Digits of a whole number, and of the widest decimal.
WHOLE_DIGITS, MOST_DIGITS = 20, 38


def day_schemas(raw: DataFrame, doc: str = "document", day: str = DAY) -> DataFrame:
    """(documents, schema, day): what the documents of each day look like. Text that is no
    JSON has no schema; partial schemas are merged before the shuffle."""
    parsed = raw.select(F.col(day).alias(DAY), F.try_parse_json(F.col(doc)).alias("v"))
    return parsed.groupBy(DAY).agg(F.count("v").alias("documents"), F.schema_of_variant_agg("v").alias("schema")) \
                 .select("documents", "schema", DAY)


def keep_day_schemas(spark: SparkSession, raw: DataFrame, path: str, days: Sequence | None = None) -> None:
    """Write the schemas of the days that aren't kept yet, or of the given ones again; only
    those days of ``raw`` (partitioned by day) are read."""
    if days is not None:
        raw = raw.where(F.col(DAY).isin(list(days)))
    elif table_exists(spark, path):
        known = [r[0] for r in spark.read.schema(KEPT).parquet(path).select(DAY).distinct().collect()]
        raw = raw.where(~F.col(DAY).isin(known) | F.col(DAY).isNull())
    (day_schemas(raw).hint("rebalance", DAY).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(DAY).parquet(path))


def kind_of(schema: str) -> DataType:
    """The type that a schema text of the aggregate stands for."""
    parts = re.split(r"(`(?:[^`]|``)*`)", schema)           # names in back-ticks are left alone
    return _parse_datatype_string("".join(p if i % 2 else re.sub(r"\bOBJECT\b", "STRUCT", p) for i, p in enumerate(parts)))


def merged_kind(a: DataType, b: DataType) -> DataType:
    """The join of two schemas of ``schema_of_variant_agg``."""
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if isinstance(a, StructType) and isinstance(b, StructType):
        both: dict[str, StructField] = {}
        for f in (*a.fields, *b.fields):                    # names that differ in case only are one field
            g = both.get(f.name.lower())
            both[f.name.lower()] = f if g is None else StructField(min(f.name, g.name, key=str.encode), merged_kind(f.dataType, g.dataType))
        return StructType(sorted(both.values(), key=lambda f: f.name.encode()))
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        return ArrayType(merged_kind(a.elementType, b.elementType))
    numbers = (LongType, DecimalType, DoubleType)
    if isinstance(a, numbers) and isinstance(b, numbers):
        if isinstance(a, DoubleType) or isinstance(b, DoubleType):
            return DoubleType()
        scale = max(t.scale if isinstance(t, DecimalType) else 0 for t in (a, b))
        before = max(t.precision - t.scale if isinstance(t, DecimalType) else WHOLE_DIGITS for t in (a, b))
        return DecimalType(before + scale, scale) if before + scale <= MOST_DIGITS else DoubleType()
    return VariantType()


def kept_kind(spark: SparkSession, path: str) -> DataType:
    """The schema of all kept days (one short row a day comes to the driver)."""
    rows = spark.read.schema(KEPT).parquet(path).select("schema").distinct().collect()
    return reduce(merged_kind, (kind_of(r[0]) for r in rows if r[0]), NullType())


def as_contract(kind: DataType) -> DataType:
    """A schema as contract types: decimals become doubles, as JSON numbers are read; what is
    only known to be null, or of several kinds, is kept as text."""
    if isinstance(kind, StructType):
        return StructType([StructField(f.name, as_contract(f.dataType)) for f in kind.fields])
    if isinstance(kind, ArrayType):
        return ArrayType(as_contract(kind.elementType))
    if isinstance(kind, DecimalType):
        return DoubleType()
    return StringType() if isinstance(kind, (NullType, VariantType)) else kind


def leaves(kind: DataType, path: str = "") -> list[tuple[str, str]]:
    """(path, type) of every field that isn't a struct itself."""
    if isinstance(kind, StructType):
        return [x for f in kind.fields for x in leaves(f.dataType, f"{path}.{f.name}" if path else f.name)]
    return [(path, kind.simpleString())]
