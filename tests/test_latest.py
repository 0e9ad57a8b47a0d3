"""Latest per key: stamps as text, ties, nulls; null keys."""

from pyspark.sql import functions as F

from strata.functions.docs import parse_stamp
from strata.operators.latest import latest_per_key, split_null_keys


def test_latest_with_text_stamps(spark):
    rows = [("A", "2025-03-01T10:00:00", 1), ("A", "2025-3-2", 2),        # unpadded is newer
            ("B", "2025-01-01T00:00:00", 1), ("B", None, 2),                # null stamp loses
            ("C", "2025-01-01T00:00:00", 1), ("C", "2025-01-01T00:00:00", 2),  # tie -> tie column
            ("D", "garbage", 1), ("D", "2024-01-01", 2)]                    # unparsable loses
    df = spark.createDataFrame(rows, "k string, pub string, seq int")
    out = latest_per_key(df, "k", [parse_stamp(F.col("pub")), F.col("pub")], [F.col("seq")])
    got = {r.k: r.seq for r in out.collect()}
    assert got == {"A": 2, "B": 1, "C": 2, "D": 2}


def test_plan_limits_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = latest_per_key(df, "k", ["v"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_null_keys_go_to_quarantine(spark):
    df = spark.createDataFrame([(None, 1), ("a", 2), (None, 3)], "k string, v int")
    good, bad = split_null_keys(df, "k")
    assert [r.v for r in good.collect()] == [2]
    assert sorted(r.v for r in bad.collect()) == [1, 3]
    assert {r._reject_reason for r in bad.collect()} == {"null business key"}
