"""The progress table of the jobs (E7, L9): what each batch wrote, how long it took, what failed.

A job's callback notes a batch's row count (observed while it was written) as soon as the
batch is written; the listener adds Spark's own figures when the trigger is over, and an
entry for a batch that failed. An entry is one small JSON file a query and batch, so a
batch that is done again replaces its own and every reader sees whole entries.
"""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener

from strata.sources.tables import path_exists, write_small_text

ENTRY = ("query string, name string, batch long, rows long, input_rows long, observed long, millis long, started string, "
         "failure string")
OBSERVED = "rows_read"              # the name under which a stream observes its rows before it aggregates them


class ProgressTable(StreamingQueryListener):
    """Give it to the jobs as ``progress``; it listens until ``close``."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._noted: dict[tuple[str, int], dict] = {}
        self._lock = threading.Lock()
        spark.streams.addListener(self)

    def close(self) -> None:
        """Wait for the events that are on their way, and listen no more."""
        self.spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty()
        self.spark.streams.removeListener(self)

    def note(self, query: str, name: str | None, batch: int, rows: int | None) -> None:
        """A job's own word on a batch: begun (``rows`` None) or written."""
        entry = {"query": query, "name": name, "batch": batch, "rows": rows}
        with self._lock:
            self._noted[query, batch] = entry
        if rows is not None:
            self._write(f"{batch:012d}", entry)

    def _write(self, name: str, entry: dict) -> None:
        write_small_text(self.spark, f"{self.path}/{entry['query']}-{name}.json", json.dumps(entry))

    # -- Spark's word ----------------------------------------------------------------

    def onQueryStarted(self, event) -> None:
        pass

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryProgress(self, event) -> None:
        p = event.progress
        with self._lock:
            own = self._noted.pop((str(p.id), p.batchId), None)
        if own is not None and own["rows"] is not None:     # a trigger without a batch has nothing to say
            seen = (p.observedMetrics or {}).get(OBSERVED)
            self._write(f"{p.batchId:012d}", {**own, "input_rows": p.numInputRows, "started": p.timestamp,
                                              "observed": None if seen is None else seen["rows"],
                                              "millis": p.durationMs.get("triggerExecution")})

    def onQueryTerminated(self, event) -> None:
        if event.exception is None:
            return
        with self._lock:
            begun = [key for key in self._noted if key[0] == str(event.id)]
            own = [self._noted.pop(key) for key in sorted(begun)]
        last = own[-1] if own else {"query": str(event.id), "name": None, "batch": None, "rows": None}
        failure = [line for line in event.exception.splitlines() if line.strip()]
        self._write(f"failed-{event.runId}", {**last, "rows": None, "failure": failure[0] if failure else "unknown"})


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """One row a written batch, and one a failed attempt (``failure`` set, ``rows`` NULL)."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], ENTRY)
    return spark.read.schema(ENTRY).json(path)
