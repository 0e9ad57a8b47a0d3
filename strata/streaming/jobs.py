"""The three layer jobs as ``foreachBatch`` streams.

Each callback skips empty batches (L8) and lets failures propagate (Q4): the
query stops, and a restart from the checkpoint replays the batch, which every
step here tolerates (raw duplicates are dropped by identity in conform, the
serving upsert is idempotent and reuses a complete staged commit).
Data faults never fail a batch: they go to quarantine tables.
"""

from __future__ import annotations

import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from strata.operators.envelope import land_events
from strata.operators.monitor import observe_rows, observed_rows
from strata.operators.contract import CORRUPT, load_contract
from strata.plans.conform import conform_batch, conformed_schema, tag, write_conformed  # noqa: F401
from strata.plans.publish import QUERY_ID_PROPERTY, publish_entity
from strata.plans.spec import EntitySpec
from strata.session import work_dir
from strata.streaming.progress import ProgressTable
from strata.sources.raw import json_documents, raw_stream, write_raw
from strata.sources.tables import table_stream

log = logging.getLogger("strata.streaming")

# Default intake per micro-batch of the file-stream jobs: a backfill becomes a
# series of bounded batches instead of one batch holding the whole history.
DEFAULT_MAX_FILES = 1000


def trigger_options(processing_time: str | None = None, available_now: bool = False) -> dict:
    """L3/L4: a fixed interval, a bounded catch-up (tests, replays) or as fast
    as possible (empty dict)."""
    if available_now:
        return {"availableNow": True}
    if processing_time:
        return {"processingTime": processing_time}
    return {}


def _start(df: DataFrame, handler, checkpoint: str | None, trigger: dict,
           name: str | None, mode: str = "append") -> StreamingQuery:
    """Start a foreachBatch query. Without a checkpoint (L10, a one-off run)
    a fresh one is taken under the shared checkpoint folder, never a
    machine-local temporary folder."""
    w = df.writeStream.outputMode(mode).foreachBatch(handler)
    if name:
        w = w.queryName(name)                       # L5
    if not checkpoint:
        checkpoint = work_dir(df.sparkSession, f"checkpoint-{name or 'stream'}")
    w = w.option("checkpointLocation", checkpoint)  # L2
    if trigger:
        w = w.trigger(**trigger)
    return w.start()                                # L6 (caller awaits)


def _skip_empty(fn, what: str, progress: ProgressTable | None = None):
    """The callback around ``fn(batch, batch_id) -> rows written``."""
    def handler(batch: DataFrame, batch_id: int) -> None:
        if batch.isEmpty():                         # L8
            log.info("%s: skipping empty batch %s", what, batch_id)
            return
        query = _query_id(batch.sparkSession)
        if progress is not None:
            progress.note(query, what, batch_id, None)
        rows = fn(batch, batch_id)
        log.info("%s batch %s: %s rows", what, batch_id, rows)
        if progress is not None:
            progress.note(query, what, batch_id, rows)
    return handler


def run_raw(events: DataFrame, raw_root: str, checkpoint: str | None,
            trigger: dict | None = None, stamp: Column | None = None,
            name: str | None = "raw", progress: ProgressTable | None = None) -> StreamingQuery:
    """Raw job: hub events (``decoded_body``, ``partition``, ``sequenceNumber``)
    are stamped and appended to the raw zone."""
    def fn(batch, batch_id):
        landed, obs = observe_rows(land_events(batch, stamp), f"raw-{batch_id}")
        write_raw(landed, raw_root)
        return observed_rows(obs)
    return _start(events, _skip_empty(fn, "raw", progress), checkpoint, trigger or {}, name)


def _contract(spark: SparkSession, contract: StructType | str) -> StructType:
    """A contract, or the path of its file."""
    return load_contract(spark, contract) if isinstance(contract, str) else contract


def _query_id(spark: SparkSession) -> str:
    return spark.sparkContext.getLocalProperty(QUERY_ID_PROPERTY) or "batch"


def run_conform(spark: SparkSession, raw_root: str, conformed_path: str, contract: StructType | str,
                payload: str, checkpoint: str | None, event_type: str | None = None,
                trigger: dict | None = None, max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
                stamp: Column | None = None, name: str | None = "conform",
                archive_dir: str | None = None, progress: ProgressTable | None = None) -> StreamingQuery:
    """Conform job: raw files -> contract -> conformed table (+ quarantine)."""
    contract = _contract(spark, contract)
    src = raw_stream(spark, raw_root, event_type, max_files_per_trigger, archive_dir=archive_dir)

    def fn(batch, batch_id):
        return conform_batch(spark, batch, contract, payload, conformed_path, stamp, _query_id(spark), batch_id)
    return _start(src, _skip_empty(fn, "conform", progress), checkpoint, trigger or {}, name)


def run_conform_documents(spark: SparkSession, folder: str, conformed_path: str, contract: StructType | str,
                          payload: str, checkpoint: str | None, multi_line: bool = True,
                          trigger: dict | None = None, max_files_per_trigger: int | None = DEFAULT_MAX_FILES,
                          stamp: Column | None = None, name: str | None = "conform-documents",
                          progress: ProgressTable | None = None) -> StreamingQuery:
    """Conform job over a folder of JSON documents (A4-A7, A15): each file's name
    goes into the rows' lineage and the rejects."""
    contract = _contract(spark, contract)
    src = json_documents(spark, folder, contract, multi_line, stream=True,
                         max_files_per_trigger=max_files_per_trigger)
    quarantine = conformed_path.rstrip("/") + "_quarantine"

    def fn(batch, batch_id):
        tagged = tag(batch, contract).withColumn("document", F.col(CORRUPT))
        return write_conformed(tagged, payload, stamp, conformed_path, quarantine, _query_id(spark), batch_id)
    return _start(src, _skip_empty(fn, "documents", progress), checkpoint, trigger or {}, name)


def run_serving(spark: SparkSession, conformed_path: str, schema: StructType, serving_root: str,
                spec: EntitySpec, checkpoint: str | None, trigger: dict | None = None,
                max_files_per_trigger: int | None = DEFAULT_MAX_FILES, stamp: Column | None = None,
                name: str | None = "serving", progress: ProgressTable | None = None) -> StreamingQuery:
    """Serving job: conformed table stream -> ``publish_entity`` per batch."""
    src = table_stream(spark, conformed_path, schema, max_files_per_trigger=max_files_per_trigger)

    def fn(batch, batch_id):
        # several passes read the batch (buckets, ranking, quarantine): keep it
        # (memory, spilling to disk) rather than re-reading the source files
        batch = batch.persist()
        try:
            publish_entity(spark, batch, spec, serving_root, stamp=stamp, batch_id=batch_id)
            return batch.count()                    # from what is kept
        finally:
            batch.unpersist()
    return _start(src, _skip_empty(fn, "serving", progress), checkpoint, trigger or {}, name)


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session."""
    n = 0
    for q in spark.streams.active:
        q.stop()
        n += 1
    return n
