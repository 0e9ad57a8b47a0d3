"""A hub log with positions (A1, A2): bounded replay from any place, restarts in the middle.

A hub keeps its messages as numbered logs, one a hub partition. Here the log is a
folder: ``append_log`` writes a capture (messages as Parquet, dealt and sorted by
partition and number) and then an index file that says which numbers each file holds
and where every partition's log ends. A capture counts once its index is there.

``HubLog`` is a Spark data source over it. Its offset is a position for each hub
partition (the next number to read), so a query starts "from here", ends "at now", and
restarts from its checkpoint at the very next number. A trigger reads only the index
files that lie after its start. Every task reads slices of a few files, as Arrow
batches, with the numbers pushed into the Parquet scan.

The source runs in Python workers, so this package must be importable on the executors,
and the folder must be on a file system that PyArrow opens. One capture is appended at a time.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

from strata.sources.tables import write_small_text

FORMAT = "hub_log"
MESSAGE = "body binary, partition long, sequenceNumber long"
ROWS_PER_FILE = 500_000
ROWS_PER_TASK = 500_000
EARLIEST, LATEST = "earliest", "latest"
Positions = dict[str, int]


# -- the log -------------------------------------------------------------------------

def _open(path: str):
    import pyarrow.fs as pafs
    return pafs.FileSystem.from_uri(path) if ":" in path.split("/", 1)[0] else (pafs.LocalFileSystem(), path)


class Index:
    """The index files of a log, as the driver reads them. Each holds ``from`` and ``to``
    (positions before and after its capture) and ``files`` (file, partition, first, last, rows)."""

    def __init__(self, path: str):
        self.fs, self.root = _open(path.rstrip("/"))

    def names(self) -> list[str]:
        import pyarrow.fs as pafs
        found = self.fs.get_file_info(pafs.FileSelector(f"{self.root}/index", allow_not_found=True))
        return sorted(f.path for f in found if f.base_name.endswith(".json"))

    def load(self, name: str) -> dict:
        with self.fs.open_input_stream(name) as f:
            return json.loads(f.read())

    def latest(self) -> Positions:
        names = self.names()
        return self.load(names[-1])["to"] if names else {}

    def slices(self, start: Positions, end: Positions) -> list[tuple[str, int, int, int, int]]:
        """(file, partition, first, last, rows) that hold numbers from ``start`` to before
        ``end``; index files are read from the newest back to the one that holds the start."""
        out = []
        for name in reversed(self.names()):
            entry = self.load(name)
            for file, p, first, last, rows in entry["files"]:
                lo, hi = max(first, start.get(str(p), 0)), min(last, end.get(str(p), 0) - 1)
                if lo <= hi:
                    out.append((file, p, lo, hi, rows))
            if all(start.get(p, 0) >= at for p, at in entry["from"].items()) and set(end) <= set(entry["from"]):
                break
        return out[::-1]


def append_log(spark: SparkSession, messages: DataFrame, path: str) -> Positions:
    """Append a capture of messages (body, partition, sequenceNumber); the positions after
    it. Numbers go up: one that lies before its partition's position is refused."""
    path = path.rstrip("/")
    index = Index(path)
    before, number = index.latest(), len(index.names())
    data = f"{path}/data/capture={number:012d}"
    rows = messages.select(F.col("body").cast("binary").alias("body"), F.col("partition").cast("long").alias("partition"),
                           F.col("sequenceNumber").cast("long").alias("sequenceNumber"))
    (rows.repartitionByRange("partition", "sequenceNumber").sortWithinPartitions("partition", "sequenceNumber")
     .write.mode("overwrite").option("maxRecordsPerFile", ROWS_PER_FILE).parquet(data))
    # the files' own statistics would say it as well; only two columns are read, one row a file comes back
    held = (spark.read.schema(MESSAGE).parquet(data)
            .groupBy(F.col("_metadata.file_name").alias("file"), "partition")
            .agg(F.min("sequenceNumber").alias("first"), F.max("sequenceNumber").alias("last"), F.count("*").alias("n"))
            .orderBy("partition", "first").collect())
    after = dict(before)
    for r in held:
        if r["partition"] is None or r["first"] is None or r["first"] < before.get(str(r["partition"]), 0):
            raise ValueError(f"partition {r['partition']}: number {r['first']} lies before position "
                             f"{before.get(str(r['partition']), 0)}")
        after[str(r["partition"])] = max(after.get(str(r["partition"]), 0), r["last"] + 1)
    files = [(f"data/capture={number:012d}/{r['file']}", r["partition"], r["first"], r["last"], r["n"]) for r in held]
    write_small_text(spark, f"{path}/index/{number:012d}.json",
                     json.dumps({"from": before, "to": after, "files": files}))
    return after


def log_positions(path: str) -> Positions:
    """Where every partition's log ends now."""
    return Index(path).latest()


# -- the source ------------------------------------------------------------------------

@dataclass
class Slices(InputPartition):
    """What one task reads: (file, partition, first, last) each."""
    parts: list[tuple[str, int, int, int]]


class _Log:
    """What the batch and the stream reader share."""

    def __init__(self, options: dict[str, str]):
        self.path = options["path"].rstrip("/")
        self.starting = options.get("startingPositions", EARLIEST)
        self.ending = options.get("endingPositions", LATEST)

    def position(self, said: str) -> Positions:
        return {} if said == EARLIEST else Index(self.path).latest() if said == LATEST else \
            {str(p): int(at) for p, at in json.loads(said).items()}

    def start(self) -> Positions:
        return self.position(self.starting)

    def end(self) -> Positions:
        """Now, or the ending positions where the log has got that far."""
        now = Index(self.path).latest()
        if self.ending == LATEST:
            return now
        asked = self.position(self.ending)
        return {p: min(at, asked[p]) for p, at in now.items() if p in asked}

    def partitions(self, start: Positions, end: Positions) -> list[Slices]:
        out, held, rows = [], [], 0
        for file, p, first, last, n in Index(self.path).slices(start, end):
            held.append((file, p, first, last))
            rows += n
            if rows >= ROWS_PER_TASK:
                out.append(Slices(held))
                held, rows = [], 0
        return out + [Slices(held)] if held else out

    def read(self, partition: Slices | None) -> Iterator:
        if partition is None:                   # Spark's one task of a read without slices
            return
        import pyarrow as pa
        import pyarrow.dataset as ds
        fs, root = _open(self.path)
        schema = pa.schema([("body", pa.binary()), ("partition", pa.int64()), ("sequenceNumber", pa.int64())])
        for file, p, first, last in partition.parts:
            number = ds.field("sequenceNumber")
            rows = (ds.field("partition") == p) & (number >= first) & (number <= last)
            for batch in ds.dataset(f"{root}/{file}", schema, format="parquet", filesystem=fs).to_batches(filter=rows):
                if batch.num_rows:
                    yield batch


class _Batch(_Log, DataSourceReader):
    def partitions(self) -> list[Slices]:
        return super().partitions(self.start(), self.end())


class _Stream(_Log, DataSourceStreamReader):
    def initialOffset(self) -> Positions:
        return self.start()

    def latestOffset(self) -> Positions:
        # a partition that the log has not reached yet keeps its start
        return {**self.start(), **{p: max(at, self.start().get(p, 0)) for p, at in self.end().items()}}


class HubLog(DataSource):
    """``spark.read`` / ``readStream`` format ``hub_log``. Options: ``path``;
    ``startingPositions`` (``earliest``, ``latest`` or JSON, a number for each
    partition, others from 0); ``endingPositions`` (``latest``, or JSON: partitions
    that are not named are not read)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def reader(self, schema) -> DataSourceReader:
        return _Batch(self.options)

    def streamReader(self, schema) -> DataSourceStreamReader:
        return _Stream(self.options)


def _said(positions: Positions | str) -> str:
    return positions if isinstance(positions, str) else json.dumps({str(p): int(at) for p, at in positions.items()})


def _reader(spark: SparkSession, r, path: str, start, end):
    spark.dataSource.register(HubLog)
    return r.format(FORMAT).option("path", path).option("startingPositions", _said(start)) \
            .option("endingPositions", _said(end)).load()


def hub_stream(spark: SparkSession, path: str, start: Positions | str = EARLIEST,
               end: Positions | str = LATEST) -> DataFrame:
    """A1: a hub log as a stream of messages, from ``start`` on. "From here to now" is
    ``end=log_positions(path)`` with an ``availableNow`` trigger, which reads all of it as one
    batch; after a lost batch, such a run repeats that batch and the next one goes on."""
    return _reader(spark, spark.readStream, path, start, end)


def hub_messages(spark: SparkSession, path: str, start: Positions | str = EARLIEST,
                 end: Positions | str = LATEST) -> DataFrame:
    """A2: the messages between two positions, as a batch."""
    return _reader(spark, spark.read, path, start, end)
