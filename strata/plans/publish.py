"""K3: publish a conformed batch to the serving tables.

null keys and unreadable order stamps -> quarantine (C1, L11) ; flatten (B9) ;
latest per key in the batch (F1) ; guard against stored newer rows (Q3) ;
children replaced per parent (B14, K2) ; main upserted (B10, B3, K1).

Without arrays, stored and new rows are ranked together: one shuffle. When the
entity has, or ever had, arrays, the ranked + guarded batch is written once to
the staging folder and every child table and the main table read that copy, so
the batch is computed once and the guard's read of the main table can never see
a half-written swap.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.operators.flatten import (UID_COL, array_columns, child_table_name, drop_arrays,
                                      explode_child, flatten_structs, tombstones)
from strata.operators.latest import latest_per_key, split_null_keys
from strata.operators.upsert import (BUCKET_COL, CODEC, DELETED_COL, BucketedTable, deal_parents, merge_newest, open_table,
                                     read_buckets, replace_children, touched_buckets, upsert_main)
from strata.plans.spec import EntitySpec
from strata.sources.tables import remove_path

STAGING = "_staging"
QUERY_ID_PROPERTY = "sql.streaming.queryId"   # set by Spark while a micro-batch runs
QUARANTINE = "_quarantine"


def main_table(spec: EntitySpec, root: str) -> BucketedTable:
    """A fixed number of buckets, or one that grows where the spec names none."""
    return BucketedTable(f"{root.rstrip('/')}/{spec.name}", spec.key, spec.buckets or 1,
                         bucket_bytes=None if spec.buckets else spec.bucket_bytes, lookups=spec.lookups)


def child_table(spec: EntitySpec, root: str, array_col: str) -> BucketedTable:
    buckets = spec.child_buckets or spec.buckets
    return BucketedTable(f"{root.rstrip('/')}/{child_table_name(spec.name, array_col)}",
                         f"{spec.name}_{spec.key}", buckets or 1,
                         files_per_bucket=spec.child_files_per_bucket, spread_col=UID_COL,
                         bucket_bytes=None if buckets else spec.bucket_bytes)


def _as_json(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != "_reject_reason"]))


def newest(rows: DataFrame, spec: EntitySpec, last: list[Column] = ()) -> DataFrame:
    """the newest row of each key; ``last`` breaks what ties are left."""
    return latest_per_key(rows, spec.key, spec.order_columns(rows), spec.tie_columns(rows) + list(last))


def split_batch(batch: DataFrame, spec: EntitySpec) -> tuple[DataFrame, DataFrame]:
    """(flattened rows that can be ranked, rejects: rows without a key or with an
    order stamp that can't be read)."""
    good, rejects = split_null_keys(batch, spec.key)
    flat = flatten_structs(good)
    # a stamp that can't be read has no place in the order: it would lose in silence
    unread = spec.unreadable(flat)
    rejects = rejects.select(_as_json(rejects).alias("row"), "_reject_reason").unionByName(
        flat.where(unread).select(_as_json(flat).alias("row"),
                                  F.lit("unreadable order stamp").alias("_reject_reason")))
    return flat.where(~unread), rejects


def guard_newer(spark: SparkSession, ranked: DataFrame, spec: EntitySpec, table: BucketedTable,
                buckets: list[int] | None = None) -> DataFrame:
    """Q3: drop batch rows whose order tuple is below the stored row's; equal
    tuples pass, so a replay passes. The stored side is read for the touched
    buckets only."""
    if spec.guard == "none":
        return ranked
    if buckets is None:
        buckets = touched_buckets(ranked.select(spec.key), table)
    stored = read_buckets(spark, table, buckets)
    if stored is None:
        return ranked
    names = [n for n in spec.present_order_names(ranked) if n in stored.columns]
    spec_stored = EntitySpec(**{**spec.__dict__, "order": tuple(n for n in spec.order if n in names),
                                "ties": tuple(n for n in spec.ties if n in names)})
    new_t = F.struct(*[e.alias(f"o{i}") for i, e in
                       enumerate(spec_stored.order_columns(ranked) + spec_stored.tie_columns(ranked))])
    old_t = F.struct(*[e.alias(f"o{i}") for i, e in
                       enumerate(spec_stored.order_columns(stored) + spec_stored.tie_columns(stored))])
    old = stored.select(F.col(spec.key).alias("__k"), old_t.alias("__old"))
    new = ranked.withColumn("__new", new_t)
    joined = new.join(old, new[spec.key] == old["__k"], "left")
    return joined.where(F.col("__k").isNull() | (F.col("__new") >= F.col("__old"))) \
                 .drop("__k", "__old", "__new")


def publish_entity(spark: SparkSession, batch: DataFrame, spec: EntitySpec, root: str,
                   stamp: Column | None = None, batch_id: int | None = None) -> dict:
    """Publish one batch of conformed rows (MetaData struct + payload fields)."""
    if spec.key not in batch.columns:
        raise ValueError(f"business key {spec.key!r} is not a top-level column of the batch "
                         f"(columns: {batch.columns})")
    root = root.rstrip("/")
    query = spark.sparkContext.getLocalProperty(QUERY_ID_PROPERTY) or "batch"
    if batch_id is not None:
        # the streaming query's id survives restarts from the same checkpoint and
        # changes with a new one, so a staged copy is only ever reused by a
        # replay of the very same batch
        run = f"{query}-{batch_id}"
    else:
        run = uuid.uuid4().hex
    staging = f"{root}/{STAGING}/{spec.name}/{run}"
    stamp = F.current_timestamp() if stamp is None else stamp

    flat, rejects = split_batch(batch, spec)
    if not spec.present_order_names(flat):
        raise ValueError(f"{spec.name}: none of the order columns {spec.order + spec.ties} is in the batch")
    main_t, arrays = open_table(spark, main_table(spec, root), array_columns(flat))
    # one pass over the key column: the touched buckets, and -1 when any row is rejected
    marks = (flat.select(main_t.bucket_of().alias("b"))
             .union(rejects.select(F.lit(-1).alias("b"))).distinct().collect())
    buckets = sorted(r["b"] for r in marks if r["b"] >= 0)
    has_rejects = any(r["b"] < 0 for r in marks)
    deleted = F.coalesce(F.expr(spec.delete_when), F.lit(False)) if spec.delete_when else F.lit(False)
    reuse = batch_id is not None
    if not arrays and spec.guard == "newest":
        # one shuffle: stored rows of the touched buckets and the batch are ranked
        # together, which is ranking, guard and merge in one (an equal batch row wins,
        # so that a replay gives the same table)
        rows = flat.withColumn(DELETED_COL, deleted).withColumn(spec.stamp_col, stamp)
        merge_newest(spark, rows, main_t, f"{staging}/main", lambda r, last: newest(r, spec, last), reuse, buckets)
    else:
        _publish_with_children(spark, flat, spec, root, main_t, arrays, staging, stamp, deleted, reuse, buckets)

    if has_rejects:
        # a folder a batch: a replay replaces its rejects and doesn't add to them
        (rejects.withColumn("query", F.lit(query)).withColumn("batch", F.lit(run))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("query", "batch").parquet(f"{root}/{QUARANTINE}/{spec.name}"))
    # every table is committed: the staged copies are no longer needed
    remove_path(spark, staging)
    return {"arrays": arrays, "rejects": has_rejects}


def _publish_with_children(spark: SparkSession, flat: DataFrame, spec: EntitySpec, root: str,
                           main_t: BucketedTable, arrays: list[str], staging: str, stamp: Column,
                           deleted: Column, reuse: bool, buckets: list[int]) -> None:
    """Rank, guard, then replace the children of each array the table ever had and
    the main rows; all read one written copy of the survivors."""
    survivors = guard_newer(spark, newest(flat, spec), spec, main_t, buckets)
    survivors.withColumn(DELETED_COL, deleted).write.mode("overwrite").option("compression", CODEC).parquet(f"{staging}/survivors")
    staged = spark.read.parquet(f"{staging}/survivors")
    uid_parts = tuple(c for c in spec.order if c in staged.columns)
    for a in arrays:
        table, _ = open_table(spark, child_table(spec, root, a))
        if a in staged.columns:
            src = staged.withColumn(a, F.when(~F.col(DELETED_COL), F.col(a)))
            src = src.select(*[F.col(f"`{c}`") for c in dict.fromkeys([spec.key, a, *uid_parts])])
            src, dealt = deal_parents(src, spec.key, table)
            children = explode_child(src, spec.key, a, spec.name, tombstones=True, uid_parts=uid_parts)
        else:
            # the batch's documents lack the array: the parents have no children any more
            dealt = False
            children = tombstones(staged, spec.key, a, spec.name, uid_parts)
        parents = staged.select(F.col(spec.key).alias(table.key))
        same = (table.buckets, table.bucket_bytes) == (main_t.buckets, main_t.bucket_bytes)
        replace_children(spark, children, parents, table, f"{staging}/{a}", reuse_staged=reuse,
                         buckets=buckets if same else None, parents_unique=True, dealt=dealt)
    main = drop_arrays(staged).withColumn(spec.stamp_col, stamp)
    upsert_main(spark, main, main_t, f"{staging}/main", reuse_staged=reuse, buckets=buckets)


__all__ = ["publish_entity", "split_batch", "newest", "guard_newer", "main_table", "child_table",
           "BUCKET_COL"]
