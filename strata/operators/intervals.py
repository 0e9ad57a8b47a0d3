"""Interval sets of whole numbers, per key, as tables (partition, block, lo, hi).

Numbers are kept as maximal runs inside blocks of ``BLOCK`` numbers, so a dense
history is one row a block, while a key with a huge share of all numbers is still
many groups of a bounded size: whatever the holes, a block has at most
``BLOCK / 2`` runs. Set operations are one sweep over the runs' ends inside each
block, all built-in window functions, no join.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BLOCK_BITS = 16
SPAN_BITS = 8                       # width of the equi-join keys of ``covered_by``
RUN = "partition long, block long, lo long, hi long"
WITHIN = ("partition", "block")


def block_of(value: Column) -> Column:
    return F.shiftright(value, BLOCK_BITS)


def runs(ids: DataFrame) -> DataFrame:
    """(partition, sequenceNumber) rows, in any order and number, as runs; rows
    without either are no numbers. Repeats are dropped before the shuffle."""
    known = (ids.select(F.col("partition").cast("long").alias("partition"), F.col("sequenceNumber").cast("long").alias("at"))
             .where("partition IS NOT NULL AND at IS NOT NULL").distinct()
             .withColumn("block", block_of(F.col("at"))))
    place = F.row_number().over(Window.partitionBy(*WITHIN).orderBy("at"))
    return (known.withColumn("run", F.col("at") - place).groupBy(*WITHIN, "run")
            .agg(F.min("at").alias("lo"), F.max("at").alias("hi")).drop("run"))


def sweep(left: DataFrame, right: DataFrame, side: Callable[[Column, Column], Column]) -> DataFrame:
    """Runs of the numbers for which ``side(in left, in right)`` isn't NULL, with its
    value as ``side``; runs are maximal for each value."""
    def ends(df, l, r):
        end = lambda at, sign: F.struct(at.alias("at"), F.lit(sign * l).alias("l"), F.lit(sign * r).alias("r"))
        return df.select(*WITHIN, F.explode(F.array(end(F.col("lo"), 1), end(F.col("hi") + 1, -1))).alias("e")).select(*WITHIN, "e.*")

    edges = ends(left, 1, 0).union(ends(right, 0, 1)).groupBy(*WITHIN, "at").agg(F.sum("l").alias("l"), F.sum("r").alias("r"))
    w = Window.partitionBy(*WITHIN).orderBy("at")
    swept = edges.select(*WITHIN, F.col("at").alias("lo"), (F.lead("at").over(w) - 1).alias("hi"),
                         side(F.sum("l").over(w) > 0, F.sum("r").over(w) > 0).alias("side"))
    kept = swept.where("hi IS NOT NULL AND side IS NOT NULL")
    own = Window.partitionBy(*WITHIN).orderBy("lo")
    apart = F.coalesce((F.lag("hi").over(own) + 1 < F.col("lo")) | (F.lag("side").over(own) != F.col("side")), F.lit(True))
    return (kept.withColumn("new", apart.cast("int")).withColumn("run", F.sum("new").over(own))
            .groupBy(*WITHIN, "run", "side").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
            .select(*WITHIN, "lo", "hi", "side"))


def merged(intervals: DataFrame) -> DataFrame:
    """The union of intervals that may overlap, as maximal runs."""
    return sweep(intervals, intervals.limit(0), lambda a, b: F.when(a, F.lit(True))).drop("side")


def intersected(left: DataFrame, right: DataFrame) -> DataFrame:
    return sweep(left, right, lambda a, b: F.when(a & b, F.lit(True))).drop("side")


def told_apart(left: DataFrame, right: DataFrame) -> DataFrame:
    """The runs of ``left``, cut into those in ``right`` (``seen``) and those that aren't."""
    return sweep(left, right, lambda a, b: F.when(a, b)).withColumnRenamed("side", "seen")


def size(intervals: DataFrame) -> Column:
    """The aggregate that counts the numbers of disjoint runs."""
    return F.coalesce(F.sum(F.col("hi") - F.col("lo") + 1), F.lit(0))


def not_in(rows: DataFrame, intervals: DataFrame) -> DataFrame:
    """Rows (partition, sequenceNumber ...) whose number is in none of the runs; rows
    without a number stay. An anti-join on spans of 256 numbers, of which a span has
    at most 128 runs, so holes never make a row meet many of them."""
    spans = intervals.select(F.col("partition").alias("__p"), F.col("lo").alias("__lo"), F.col("hi").alias("__hi"),
                             F.explode(F.sequence(F.shiftright("lo", SPAN_BITS), F.shiftright("hi", SPAN_BITS))).alias("__span"))
    number = F.col("sequenceNumber").cast("long")
    inside = ((F.col("partition").cast("long") == F.col("__p")) & (F.shiftright(number, SPAN_BITS) == F.col("__span"))
              & number.between(F.col("__lo"), F.col("__hi")))
    return rows.join(spans, inside, "left_anti")
