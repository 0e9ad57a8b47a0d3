"""Working off the quarantine (A16, L9): rejected documents read again under a newer contract.

What conforms now moves to the conformed table, what doesn't stays with its new reason,
and what moved is entered in ``<conformed>_quarantine_closed`` with the reason it once
had. Exactly once: the new rows, the rows that stay and the closed entries are all
written beside the tables first, then a plan, then files are renamed into place. A
work-off that is lost before its plan is written has changed nothing; one that is
lost later is carried on by the next call, since a file that has been renamed is not
there to be renamed again. No row is read or written twice, whatever was lost.

Rejects without a document text (a document job keeps it only for malformed ones) stay.
One work-off at a time, and none while a conform job writes the same quarantine.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.contract import REASON
from strata.plans.conform import INGEST_DAY, conform_tagged, conformed_rows, rejected_rows
from strata.sources.tables import (child_folders, move_files, move_path, path_exists, read_small_text, remove_path, table_exists,
                                   write_small_text)

PLAN = "_plan.json"
ORIGIN = ("query", "batch")
WAS = "was"


def work_off(spark: SparkSession, conformed_path: str, contract: StructType, payload: str,
             stamp: Column | None = None) -> dict[str, int]:
    """Rows moved to the conformed table and rows that stay in quarantine."""
    conformed = conformed_path.rstrip("/")
    quarantine, aside = f"{conformed}_quarantine", f"{conformed}_workoff"
    if path_exists(spark, f"{aside}/{PLAN}"):
        _finish(spark, conformed, quarantine, aside)
    if not table_exists(spark, quarantine):
        return {"moved": 0, "left": 0}
    rejects = spark.read.parquet(quarantine)
    carried = rejects.withColumn("__o", F.struct(*ORIGIN, F.col("reason").alias(WAS)))
    tagged = conform_tagged(carried.where(F.col("document").isNotNull()), contract, dedupe=False, carry=("__o",)).persist()
    try:
        ok = F.col(REASON).isNull()
        good = conformed_rows(tagged.drop("__o"), payload, stamp)
        good.hint("rebalance", INGEST_DAY).write.mode("overwrite").partitionBy(INGEST_DAY).parquet(f"{aside}/good")
        still = rejected_rows(tagged, carry=("__o",)).select("*", *[f"__o.{c}" for c in ORIGIN]).drop("__o")
        left = still.unionByName(rejects.where(F.col("document").isNull()), allowMissingColumns=True)
        left.hint("rebalance", *ORIGIN).write.mode("overwrite").partitionBy(*ORIGIN).parquet(f"{aside}/left")
        names = [c for c in ("partition", "sequenceNumber", "source_file") if c in tagged.columns]
        closed = tagged.where(ok).select(*names, "__o.*")
        closed.hint("rebalance").write.mode("overwrite").parquet(f"{aside}/closed")
        moved, n_left = closed.count(), spark.read.parquet(f"{aside}/left").count()
    finally:
        tagged.unpersist()
    folders = [f for q in child_folders(spark, quarantine) for f in child_folders(spark, q)]
    plan = {"folders": [f[len(quarantine) + 1:] for f in folders],
            "left": [f[len(aside) + 6:] for q in child_folders(spark, f"{aside}/left") for f in child_folders(spark, q)]}
    write_small_text(spark, f"{aside}/{PLAN}", json.dumps(plan))
    _finish(spark, conformed, quarantine, aside)
    return {"moved": moved, "left": n_left}


def _finish(spark: SparkSession, conformed: str, quarantine: str, aside: str) -> None:
    """Carry out a plan from wherever it stands."""
    plan = json.loads(read_small_text(spark, f"{aside}/{PLAN}"))
    for folder in child_folders(spark, f"{aside}/good"):
        move_files(spark, folder, f"{conformed}/{folder.rsplit('/', 1)[-1]}")
    move_files(spark, f"{aside}/closed", f"{quarantine}_closed")
    for name in plan["folders"]:
        if name in plan["left"]:
            if path_exists(spark, f"{aside}/left/{name}"):
                move_path(spark, f"{aside}/left/{name}", f"{quarantine}/{name}")
        else:
            remove_path(spark, f"{quarantine}/{name}")
    remove_path(spark, aside)


def closed_rejects(spark: SparkSession, conformed_path: str) -> DataFrame | None:
    """What was worked off: identity, file, first batch and the reason it had (``was``)."""
    path = f"{conformed_path.rstrip('/')}_quarantine_closed"
    return spark.read.parquet(path) if table_exists(spark, path) else None
