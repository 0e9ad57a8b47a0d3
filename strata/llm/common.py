"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import gc
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from strata.session import checkpoint_root

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def ids_and_bytes(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The key as long and the whole text as UTF-8 bytes (NULL counts as empty)
    under the names ``doc_id`` and ``data``; every other column is pruned."""
    return df.select(df[key].cast("long").alias("doc_id"),
                     F.coalesce(df[text].cast("binary"), F.lit(b"")).alias("data"))


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and read it back: the
    lineage is cut and the rows survive the loss of any executor."""
    import uuid
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex[:12]}"
    df.write.mode("overwrite").option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def slices(batch: pa.RecordBatch, column: str, max_bytes: int) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that no piece holds more than about ``max_bytes`` of one
    binary column (a single longer value is a piece of its own)."""
    sizes = np.diff(offsets(batch.column(column)))
    if not len(sizes):
        return
    piece = np.cumsum(sizes) // max_bytes
    cuts = [0, *(np.flatnonzero(np.diff(piece)) + 1).tolist(), len(sizes)]
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield batch.slice(a, b - a)


def offsets(col: pa.Array) -> np.ndarray:
    """Value offsets of a binary column, starting at 0."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset: col.offset + len(col) + 1]
    return off.astype(np.int64) - int(off[0])


def joined_bytes(col: pa.Array) -> np.ndarray:
    """All values of a binary column, one after the other."""
    if not len(col) or col.buffers()[2] is None:
        return np.zeros(0, np.uint8)
    kind = np.int64 if pa.types.is_large_binary(col.type) else np.int32
    off = np.frombuffer(col.buffers()[1], dtype=kind)[col.offset: col.offset + len(col) + 1]
    return np.frombuffer(col.buffers()[2], dtype=np.uint8)[int(off[0]): int(off[-1])]


def long_array(col: pa.Array) -> pa.Array:
    return col.cast(pa.int64())


SALTS = 256


def least_of_each(rows: DataFrame, key: str, order: list, limit: int, rank: str = "r") -> DataFrame:
    """The ``limit`` first rows of each key by a hash of ``order``, with their rank.
    A rank over salted keys comes first: what the partitions' own limits let
    through of a hot key is dealt over ``SALTS`` tasks, and at most ``SALTS * limit``
    rows of a key meet in the last rank."""
    salted = rows.withColumn("__salt", F.pmod(F.xxhash64(F.lit(1), *order), F.lit(SALTS)))
    by = [F.xxhash64(*order), *order]
    for keys in ([key, "__salt"], [key]):
        window = Window.partitionBy(*keys).orderBy(*by)
        salted = salted.withColumn(rank, F.row_number().over(window)).filter(F.col(rank) <= limit)
    return salted.drop("__salt")


def no_cycle_collection(generator):
    """For generators that make many small tuples and lists, none of them in a
    cycle: Python's cycle collector would walk them again and again."""
    @functools.wraps(generator)
    def run(*args):
        on = gc.isenabled()
        gc.disable()
        try:
            yield from generator(*args)
        finally:
            if on:
                gc.enable()
    return run
