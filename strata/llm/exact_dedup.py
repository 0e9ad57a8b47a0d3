"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition digests its documents and sorts the digests into one
run. Runs are then exchanged in rounds: ``fan_in`` neighbouring runs (a
binomial tree cut every log2(fan_in) levels) become one, by a merge of sorted
rows that keeps, for each digest, one verified identifier and the number of
rows. A run never holds a digest twice, so a merge meets at most ``fan_in``
rows of a digest: a text that fills a third of the table is as light as any
other. Each round deals (run, digest) over all partitions, so the last run is
as distributed as the first. Only digests travel (about 60 bytes a document),
never texts.

Verified: rows are merged when SHA-256, byte length and CRC-32 all agree.

Defined results: a NULL text is an empty text; a NULL id loses against any
other; rows that repeat an id with an equal text share its verdict; rows that
repeat an id with different texts are judged text by text; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, materialise

FAN_IN = 16
DIGESTED = "doc_id long, digest binary, n_bytes long, crc long, run int"
RUN = "run int, digest binary, n_bytes long, crc long, best_id long, n long"
RUN_SCHEMA = pa.schema([("run", pa.int32()), ("digest", pa.binary()), ("n_bytes", pa.int64()),
                        ("crc", pa.int64()), ("best_id", pa.int64()), ("n", pa.int64())])


def digest_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, data) -> digests of the text with A-Z lower-cased; the run is
    the number of the input partition."""
    from pyspark import TaskContext
    run = TaskContext.get().partitionId()
    for batch in batches:
        texts = [x.lower() for x in batch.column("data").to_pylist()]   # bytes.lower(): A-Z only
        yield pa.RecordBatch.from_arrays([
            batch.column("doc_id"),
            pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary()),
            pa.array([len(t) for t in texts], pa.int64()),
            pa.array([zlib.crc32(t) for t in texts], pa.int64()),
            pa.array(np.full(len(texts), run, np.int32)),
        ], names=["doc_id", "digest", "n_bytes", "crc", "run"])


class _Merge:
    """Collapses sorted rows to one row per (run, digest, n_bytes, crc),
    streaming: only the row that may continue in the next batch is held."""

    def __init__(self, largest: bool):
        self.pick = np.maximum if largest else np.minimum
        self.null = np.iinfo(np.int64).min if largest else np.iinfo(np.int64).max

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch]).cast(RUN_SCHEMA)
            if held is not None:
                t = pa.concat_tables([held, t])
            t = self.collapse(t.combine_chunks())
            held = t.slice(t.num_rows - 1)
            if t.num_rows > 1:
                yield from t.slice(0, t.num_rows - 1).to_batches()
        if held is not None:
            yield from held.to_batches()

    def collapse(self, t: pa.Table) -> pa.Table:
        run = t["run"].to_numpy()
        digest = np.frombuffer(b"".join(t["digest"].to_pylist()), np.uint8).reshape(-1, 32)
        size, crc = t["n_bytes"].to_numpy(), t["crc"].to_numpy()
        new = np.ones(len(run), bool)
        new[1:] = ((run[1:] != run[:-1]) | (size[1:] != size[:-1]) | (crc[1:] != crc[:-1])
                   | (digest[1:] != digest[:-1]).any(axis=1))
        at = np.flatnonzero(new)
        ids = t["best_id"].fill_null(int(self.null)).to_numpy()
        best = self.pick.reduceat(ids, at)
        n = np.add.reduceat(t["n"].to_numpy(), at)
        kept = t.take(pa.array(at))
        return pa.table([kept["run"], kept["digest"], kept["n_bytes"], kept["crc"],
                         pa.array(best, mask=best == self.null), pa.array(n, pa.int64())],
                        schema=RUN_SCHEMA)


def merge_runs(runs: DataFrame, partitions: int | None, largest: bool) -> DataFrame:
    """One merge: rows sorted by Spark's external sorter, collapsed in a stream."""
    if partitions is not None:
        runs = runs.repartition(partitions, "run", "digest")
    runs = runs.sortWithinPartitions("run", "digest", "n_bytes", "crc")
    return runs.mapInArrow(_Merge(largest), RUN)


def tree_merge(digests: DataFrame, keep: str = "largest", fan_in: int = FAN_IN,
               partitions: int | None = None) -> DataFrame:
    """The root run: one row per distinct text with ``best_id`` and ``n``."""
    spark = digests.sparkSession
    largest = keep == "largest"
    n_runs = (digests.agg(F.max("run")).first()[0] or 0) + 1
    parts = partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    runs = digests.select("run", "digest", "n_bytes", "crc", F.col("doc_id").alias("best_id"),
                          F.lit(1).cast("long").alias("n"))
    runs = merge_runs(runs, None, largest)          # level 0: one sorted run per partition
    while True:
        runs = runs.withColumn("run", F.floor(F.col("run") / fan_in).cast("int"))
        runs = merge_runs(runs, parts, largest)
        n_runs = -(-n_runs // fan_in)
        if n_runs == 1:
            return runs


def exact_dedup(docs: DataFrame, keep: str = "largest", fan_in: int = FAN_IN) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256: one row per document."""
    digests = materialise(ids_and_bytes(docs).mapInArrow(digest_rows, DIGESTED), "digests")
    root = tree_merge(digests, keep, fan_in).filter("n > 1")
    # an equi-join whose document side AQE may split: a hot text is no hot task
    d, r = digests.alias("d"), root.alias("r")
    same = ((F.col("d.digest") == F.col("r.digest")) & (F.col("d.n_bytes") == F.col("r.n_bytes"))
            & (F.col("d.crc") == F.col("r.crc")))
    keep_id = F.when(F.col("r.n").isNull(), F.col("d.doc_id")).otherwise(F.col("r.best_id"))
    return d.join(r, same, "left").select(
        F.col("d.doc_id").alias("doc_id"), keep_id.alias("keep_id"),
        F.coalesce(F.col("r.n"), F.lit(1)).cast("long").alias("group_size"),
        F.col("d.doc_id").eqNullSafe(keep_id).alias("kept"),
        F.lower(F.hex(F.col("d.digest"))).alias("text_sha256"))


def keep_rows(docs: DataFrame, verdicts: DataFrame) -> DataFrame:
    """``docs`` (all columns) without the rows that a verdict table (doc_id, text_sha256,
    kept) drops, told by id and by the digest of the text with A-Z lower-cased; of
    rows that repeat an id and a text one stays (by a hash of its other columns).

    The texts are dealt once, by id and digest: the rank among repeated rows and the
    join with the dropped ones use the same deal. A row that repeats very often
    reaches it once a task. The columns travel in one struct, so any names and types
    may be among them; a NULL id is an id of its own and a NULL text an empty one."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    who = F.coalesce(F.col("doc_id").cast("long").cast("string"), F.lit("")).alias("who")
    text = F.translate(F.coalesce(F.col("text"), F.lit("")), upper, upper.lower())
    others = F.to_json(F.struct(*[docs[c] for c in docs.columns if c != "text"]))
    rows = docs.select(who, F.sha2(text.cast("binary"), 256).alias("sha"),
                       F.xxhash64(others).alias("tie"), F.struct("*").alias("row"))
    first = F.row_number().over(Window.partitionBy("who", "sha").orderBy("tie"))
    rows = rows.withColumn("first", first).filter("first = 1")
    dropped = verdicts.filter(~F.col("kept")).select(who, F.col("text_sha256").alias("sha")).distinct()
    return rows.join(dropped, ["who", "sha"], "left_anti").select("row.*")
