"""The identity ledger of a conformed table (Q7): which hub events it has taken.

Hub numbers are dense, so the numbers seen of each hub partition are a few runs
(``operators/intervals``), however long the history. A batch is compared with the
runs of its own blocks; the conformed table itself isn't read.

A batch first writes the runs it is about to add as *pending*, then its rows, then
renames the pending folder into the ledger. A batch that finds a folder still pending
(its writer was lost in between) asks the conformed table and the quarantine, for
those runs' range only, which of the numbers landed, and enters just these: no event
is lost, none is taken twice. Entered runs are small folders; when a level
has ``FAN_IN`` of them, they are merged into one of the next level. All
entries are sets, so one that is entered twice changes nothing.

One writer at a time (a conformed table has one conform job).
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.intervals import RUN, intersected, merged, runs, size, told_apart
from strata.sources.tables import child_folders, move_path, path_exists, remove_path, table_exists

FAN_IN = 32


@dataclass(frozen=True)
class Batch:
    """What ``begin`` tells: the numbers of the batch that are new, and the runs (of
    the batch's blocks) that were seen before, or None where there are none."""
    new: int
    seen: DataFrame | None
    held: DataFrame | None = None       # persisted, a few rows

    def release(self) -> None:
        if self.held is not None:
            self.held.unpersist()


class IdentityLedger:
    def __init__(self, spark: SparkSession, conformed_path: str):
        self.spark = spark
        self.conformed, self.quarantine = conformed_path.rstrip("/"), conformed_path.rstrip("/") + "_quarantine"
        self.path = f"{self.conformed}_ledger"

    # -- reading -------------------------------------------------------------------

    def _entered(self) -> list[str]:
        return [run for level in child_folders(self.spark, f"{self.path}/entered")
                for run in child_folders(self.spark, level)]

    def read(self, lo_block: int | None = None, hi_block: int | None = None) -> DataFrame:
        """All entered runs, or those of a range of blocks; they may overlap."""
        folders = self._entered()
        if not folders:
            return self.spark.createDataFrame([], RUN)
        df = self.spark.read.schema(RUN).parquet(*folders)
        return df if lo_block is None else df.where(F.col("block").between(lo_block, hi_block))

    def landed(self, lo: int, hi: int) -> DataFrame:
        """Identities of a range of numbers in the conformed table and the quarantine."""
        from strata.plans.conform import seen_conformed
        found = self.spark.createDataFrame([], "partition long, sequenceNumber long")
        stored = seen_conformed(self.spark, self.conformed)
        if stored is not None:
            found = found.union(stored)
        if table_exists(self.spark, self.quarantine):
            bad = self.spark.read.parquet(self.quarantine)
            if {"partition", "sequenceNumber"} <= set(bad.columns):
                found = found.union(bad.select(F.col("partition").cast("long"), F.col("sequenceNumber").cast("long")))
        return found.where(F.col("sequenceNumber").between(lo, hi))

    # -- a batch -------------------------------------------------------------------

    def begin(self, ids: DataFrame, run: str) -> Batch:
        """Compare a batch's identities (partition, sequenceNumber) with the ledger and
        write the new ones as pending. Only those two columns of the batch are read."""
        self.settle()
        own = runs(ids).persist()
        try:
            about = own.agg(F.min("block").alias("a"), F.max("block").alias("b"), size(own).alias("n")).first()
            if about["a"] is None:
                return Batch(0, None)
            apart = told_apart(own, self.read(about["a"], about["b"])).persist()
            new = apart.where(~F.col("seen")).drop("seen")
            n_new = new.agg(size(new)).first()[0]
            if n_new:
                new.write.mode("overwrite").parquet(self._pending(run))
            if n_new == about["n"]:
                apart.unpersist()
                return Batch(n_new, None)
            return Batch(n_new, apart.where("seen").drop("seen"), apart)
        finally:
            own.unpersist()

    def commit(self, run: str) -> None:
        """The batch's rows are written: its numbers are seen from now on."""
        if path_exists(self.spark, self._pending(run)):
            move_path(self.spark, self._pending(run), f"{self.path}/entered/level=0/run={run}")
            self._compact()

    def _pending(self, run: str) -> str:
        return f"{self.path}/pending/run={run}"

    # -- after a loss, and upkeep ----------------------------------------------------

    def settle(self) -> None:
        """Enter what landed of batches that were lost before their commit; a ledger of
        a table that has none yet is made from the table."""
        if not path_exists(self.spark, self.path):
            if table_exists(self.spark, self.conformed) or table_exists(self.spark, self.quarantine):
                self._enter(runs(self.landed(-(1 << 63), (1 << 63) - 1)), "rebuilt")
            return
        for folder in child_folders(self.spark, f"{self.path}/pending"):
            # a write that was lost itself has no mark, and nothing was written after it
            if path_exists(self.spark, f"{folder}/_SUCCESS"):
                pending = self.spark.read.schema(RUN).parquet(folder)
                about = pending.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).first()
                if about["lo"] is not None:
                    self._enter(intersected(pending, runs(self.landed(about["lo"], about["hi"]))),
                                f"{folder.rsplit('run=', 1)[-1]}-landed")
            remove_path(self.spark, folder)

    def _enter(self, found: DataFrame, run: str, level: int = 0) -> None:
        found.write.mode("overwrite").parquet(f"{self.path}/entered/level={level}/run={run}")

    def _compact(self) -> None:
        for folder in child_folders(self.spark, f"{self.path}/entered"):
            level, entries = int(folder.rsplit("level=", 1)[-1]), child_folders(self.spark, folder)
            if len(entries) >= FAN_IN:
                both = self.spark.read.schema(RUN).parquet(*entries)
                self._enter(merged(both), uuid.uuid4().hex[:12], level + 1)
                for entry in entries:               # sets: until they are gone, they only say the same again
                    remove_path(self.spark, entry)
