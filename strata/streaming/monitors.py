"""Monitors kept up to date by streams (E3, E5, E10): rows per day as a stateful aggregate.

The batch form (``operators/monitor.rows_per_day``) reads a whole layer each time. Here a
stream keeps each open day's count in its state store; a batch updates the days it
touched in a small table, by key, with their whole counts, so a batch that is done again
changes nothing. Days that the watermark has passed leave the state, so it is bounded by
the lateness and not by the history; the table keeps them.

A row that comes later than that is in no count. The stream observes how many rows it
read, which the progress table holds, so ``uncounted`` tells how many were too late (or
have no stamp) without a second pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata.operators.upsert import BucketedTable, read_serving, upsert_main
from strata.session import work_dir
from strata.streaming.jobs import _skip_empty, _start
from strata.streaming.progress import OBSERVED, ProgressTable, read_progress

DAY = "day"


def run_rows_per_day(stream: DataFrame, stamp: str, out: str, checkpoint: str | None, lateness: str = "2 days",
                     trigger: dict | None = None, name: str | None = "rows_per_day",
                     progress: ProgressTable | None = None) -> StreamingQuery:
    """Keep ``out`` (day, row_count) up to date with a stream's rows by the day of ``stamp``."""
    counted = (stream.observe(OBSERVED, F.count(F.lit(1)).alias("rows")).withWatermark(stamp, lateness)
               .groupBy(F.window(stamp, "1 day").alias("w")).agg(F.count("*").alias("row_count"))
               .select(F.to_date("w.start").alias(DAY), "row_count"))
    spark = stream.sparkSession
    staging = work_dir(spark, "rows-per-day")

    def fn(batch: DataFrame, batch_id: int) -> int:
        upsert_main(batch.sparkSession, batch, BucketedTable(out, DAY, 1), f"{staging}/{batch_id}", buckets=[0])
        return batch.count()

    def handler(batch: DataFrame, batch_id: int) -> None:
        batch = batch.persist()                     # a few days; the state is read and written once
        try:
            _skip_empty(fn, name or "rows_per_day", progress)(batch, batch_id)
        finally:
            batch.unpersist()
    return _start(counted, handler, checkpoint, trigger or {}, name, mode="update")


def read_rows_per_day(spark: SparkSession, out: str) -> DataFrame:
    stored = read_serving(spark, out)
    if stored is None:
        return spark.createDataFrame([], f"{DAY} date, row_count long")
    return stored.select(DAY, "row_count").orderBy(DAY)


def uncounted(spark: SparkSession, out: str, progress_path: str, job: str = "rows_per_day") -> int:
    """Rows that the stream read and that are in no day's count."""
    read = read_progress(spark, progress_path).where(F.col("name") == job).agg(F.coalesce(F.sum("observed"), F.lit(0))).first()[0]
    counted = read_rows_per_day(spark, out).agg(F.coalesce(F.sum("row_count"), F.lit(0))).first()[0]
    return read - counted
