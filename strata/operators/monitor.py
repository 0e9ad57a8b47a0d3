"""Monitoring queries over the three layers."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, TimestampNTZType, TimestampType

from strata.functions.docs import parse_stamp
from strata.functions.paths import folder_of


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(df: DataFrame, stamp) -> Column:
    """Calendar day of a stamp column. Text stamps are parsed leniently
    (unpadded dates count, garbage is NULL) instead of a cast that fails the
    query on one bad value under ANSI mode."""
    dtype = df.select(_c(stamp).alias("s")).schema["s"].dataType
    if isinstance(dtype, DateType):
        return _c(stamp)
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(_c(stamp))
    return F.to_date(parse_stamp(_c(stamp)))


def list_files(spark: SparkSession, path: str, glob: str | None = None) -> DataFrame:
    """One row per file (path, length, modificationTime); the content
    column is never selected, so no file is read."""
    r = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        r = r.option("pathGlobFilter", glob)
    return r.load(path).select("path", "length", "modificationTime")


def files_per_folder(files: DataFrame, root: str | None = None) -> DataFrame:
    """E1 + B18: files per folder (root prefix removed)."""
    return files.groupBy(folder_of("path", root).alias("folder")).agg(F.count("*").alias("files"))


def total_files(files: DataFrame) -> DataFrame:
    """E2."""
    return files.agg(F.count("*").alias("total_files"))


def rows_per_day(df: DataFrame, stamp, day_alias: str = "day",
                 count_alias: str = "row_count") -> DataFrame:
    """E3/E5 + G1: rows per calendar day of a stamp (string or timestamp)."""
    return (df.groupBy(day_of(df, stamp).alias(day_alias))
              .agg(F.count("*").alias(count_alias)).orderBy(day_alias))


def on_day(df: DataFrame, stamp: str, day) -> DataFrame:
    """Rows whose stamp falls on ``day``. Typed stamps get a half-open
    range (pushed to the scan); text stamps are parsed (``2025-3-2`` counts)."""
    day = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    nxt = day + _dt.timedelta(days=1)
    dtype = df.select(_c(stamp).alias("s")).schema["s"].dataType
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        lo = _dt.datetime.combine(day, _dt.time())
        hi = _dt.datetime.combine(nxt, _dt.time())
        return df.where((_c(stamp) >= F.lit(lo).cast(dtype)) & (_c(stamp) < F.lit(hi).cast(dtype)))
    if isinstance(dtype, DateType):
        return df.where(_c(stamp) == F.lit(day))
    return df.where(day_of(df, stamp) == F.lit(day))


def duplicates_on_day(df: DataFrame, key: str, stamp: str, day,
                      count_alias: str = "row_count") -> DataFrame:
    """Rows per business key on one day (keys above 1 are duplicates)."""
    return on_day(df, stamp, day).groupBy(key).agg(F.count("*").alias(count_alias))


def layer_reconciliation(raw: DataFrame, raw_stamp, conformed: DataFrame, conformed_stamp,
                         serving: DataFrame, serving_stamp, day_alias: str = "day") -> DataFrame:
    """E3 + E5 side by side: rows per day in each layer (days missing in a
    layer count 0; rows without a stamp are one row of the NULL day). The layers'
    per-day counts are summed by day: no join."""
    names = ("raw_rows", "conformed_rows", "serving_rows")

    def per_day(df, stamp, name):
        counts = [(F.count("*") if n == name else F.lit(0).cast("long")).alias(n) for n in names]
        return df.groupBy(day_of(df, stamp).alias(day_alias)).agg(*counts)

    every = (per_day(raw, raw_stamp, names[0]).union(per_day(conformed, conformed_stamp, names[1]))
             .union(per_day(serving, serving_stamp, names[2])))
    return every.groupBy(day_alias).agg(*[F.sum(n).alias(n) for n in names]).orderBy(day_alias)


def distinct_files(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """Distinct source files of a batch."""
    return df.select(file_col).distinct()


def first_file(df: DataFrame, file_col: str = "source_file") -> DataFrame:
    """The (deterministic) first file of a batch."""
    return df.agg(F.min(file_col).alias("first_file"))


def observe_rows(df: DataFrame, name: str = "batch") -> tuple[DataFrame, Observation]:
    """Count rows while the frame is written, without a second pass."""
    obs = Observation(name)
    return df.observe(obs, F.count(F.lit(1)).alias("rows")), obs


def observed_rows(obs: Observation) -> int:
    """The rows that ``observe_rows`` counted; 0 where Spark found at run time that the
    frame is empty and left the counter out of the plan."""
    row = obs._jo.getRow()
    return row.getLong(0) if row.length() else 0
