"""A key holding a third of the rows: results stay whole and exact, and the
plans keep the hot key away from a single unbounded buffer where they can."""

from pyspark.sql import functions as F

from strata.operators import serve as S
from strata.operators.latest import latest_per_key
from strata.operators.upsert import BucketedTable, read_children, replace_children


def _hot(spark, n=30000):
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id")).alias("k"),
        F.col("id").alias("v"))
    return df


def test_latest_with_a_hot_key(spark):
    out = latest_per_key(_hot(spark), "k", ["v"])
    got = dict((r.k, r.v) for r in out.collect())
    assert got[0] == 29997 and len(got) == 20001
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan or "WindowGroupLimit" in plan


def test_relate_with_a_hot_parent(spark):
    child = _hot(spark).select(F.col("k").alias("Main_k"), F.col("v"))
    main = spark.range(0, 30000, 1).select(F.col("id").alias("k"), (F.col("id") * 2).alias("w"))
    out = S.relate(main, child, "k", "Main_k")
    assert out.count() == 30000 + (30000 - 20001)       # every child row + parents without children
    assert out.where(F.col("k") == 0).count() == 10000


def test_children_of_a_hot_parent_are_replaced_whole(spark, work):
    t = BucketedTable(f"{work}/Main_Arr", "Main_k", buckets=4, files_per_bucket=4,
                      spread_col="MetaData_GoldUniqueId")
    rows = _hot(spark).select(F.col("k").alias("Main_k"), F.col("v").cast("int").alias("MetaData_Position"),
                              F.sha2(F.col("v").cast("string"), 256).alias("MetaData_GoldUniqueId"))
    parents = rows.select("Main_k").distinct()
    replace_children(spark, rows, parents, t, f"{work}/stage1")
    again = rows.where(F.col("Main_k") == 0).limit(5)   # the hot parent now has 5 children
    replace_children(spark, again, spark.range(1).select(F.lit(0).cast("bigint").alias("Main_k")),
                     t, f"{work}/stage2")
    kids = read_children(spark, t.path)
    assert kids.where(F.col("Main_k") == 0).count() == 5
    assert kids.count() == 20000 + 5
