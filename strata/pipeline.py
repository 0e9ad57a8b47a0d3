"""End-to-end runs of the three layers over the driver's ``events`` table.

Used by the registered queries and the tests: events become hub messages,
are written as several files, and flow raw -> conformed -> serving through
the streaming jobs (``availableNow``), or through the batch functions.
All output goes to a fresh folder under the shared checkpoint folder.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from strata import inputs as I
from strata.functions.docs import json_key, parse_stamp
from strata.plans.spec import EntitySpec
from strata.session import work_dir
from strata.sources.events import event_stream, file_events
from strata.streaming.jobs import (conformed_schema, run_conform, run_raw, run_serving,
                                   trigger_options)
from strata.streaming.progress import ProgressTable

# buckets of the registered queries' small serving tables; a real entity sizes them by its bytes
BUCKETS = 8
EVENT_SPEC = EntitySpec(name="Events", key="user_id", payload=I.EVENT_PAYLOAD, buckets=BUCKETS)
HUB_FILES = 8
# files per micro-batch: several batches per layer, without one batch per tiny file
CONFORM_FILES = 400
SERVING_FILES = 40


@dataclass(frozen=True)
class PipelineRun:
    root: str
    hub: str
    raw: str
    conformed: str
    serving: str


LAYERS = ("raw", "conformed", "serving")


def finish(query: StreamingQuery, timeout_s: float | None = None) -> None:
    """Wait until an ``availableNow`` query has worked off its input (L6). With a
    limit, a query that isn't done by then is stopped and the run fails: the next
    layer never starts on part of its input."""
    if timeout_s is None:
        query.awaitTermination()
    elif not query.awaitTermination(timeout_s):
        query.stop()
        raise TimeoutError(f"a layer was not finished after {timeout_s} s")


def landing_stamp():
    """Backfill stamp: the document's publication time (reproducible days)."""
    return parse_stamp(json_key(F.col("decoded_body"), "$.PublicationDate"))


def run_event_streams(spark: SparkSession, sf_dir: str, upto: str = "serving",
                      timeout_s: float | None = None, progress: ProgressTable | None = None) -> PipelineRun:
    """Hub files -> raw -> conformed -> serving with ``availableNow`` streams, up
    to the named layer. Every call is a run of its own."""
    last = LAYERS.index(upto)
    root = work_dir(spark, "events-pipeline")
    run = PipelineRun(root, f"{root}/hub", f"{root}/raw", f"{root}/conformed", f"{root}/serving")
    msgs = I.event_messages(I.table(spark, sf_dir, "events"))
    msgs.repartition(HUB_FILES, "partition", "sequenceNumber").write.mode("overwrite").parquet(run.hub)

    once = trigger_options(available_now=True)
    src = event_stream(file_events(spark, run.hub, msgs.schema, max_files_per_trigger=4))
    q = run_raw(src, run.raw, f"{root}/_chk/raw", once, stamp=landing_stamp(), name=None, progress=progress)
    finish(q, timeout_s)
    if last == 0:
        return run
    q = run_conform(spark, run.raw, run.conformed, I.EVENT_CONTRACT, I.EVENT_PAYLOAD,
                    f"{root}/_chk/conform", trigger=once, max_files_per_trigger=CONFORM_FILES, name=None, progress=progress)
    finish(q, timeout_s)
    if last == 1:
        return run
    schema = conformed_schema(I.EVENT_CONTRACT, I.EVENT_PAYLOAD)
    q = run_serving(spark, run.conformed, schema, run.serving, EVENT_SPEC, f"{root}/_chk/serving",
                    trigger=once, max_files_per_trigger=SERVING_FILES, name=None, progress=progress)
    finish(q, timeout_s)
    return run
