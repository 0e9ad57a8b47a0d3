"""Serving-model queries."""

from __future__ import annotations

import datetime as _dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# The main-table columns that sum by default in the BI model
# (every other column does not aggregate).
INSTRUMENT_DEFAULT_SUMS = (
    "IssuePrice", "LegNo", "Volume", "Bond_AccruedInterestDays", "Bond_CouponRateMinimum",
    "Bond_CouponTermLength", "Bond_DelayDays", "Bond_ExCouponDays", "Bond_ExRedemptionDays",
    "Bond_ExpectedInflationRate", "Bond_FaceValue", "Bond_FirstFixing",
    "Bond_IndexTimeLagLength", "Bond_InterestAdjustmentFactor", "Bond_InterestFixingDays",
    "Bond_InterestRate", "Bond_IssuedVolume", "Bond_LotSize", "Bond_MinimumTradeVolume",
    "Bond_PriceDifferenceIfAdjust", "Bond_QuoteFactor", "Bond_Quotedecimals",
    "Bond_RedemptionPrice", "Bond_RedemptionTermLength", "Bond_SettlementDays",
    "Bond_SpreadRate", "Bond_YieldBetaAssumption", "Equity_LotSize",
    "Equity_MinimumTradeVolume", "Equity_QuoteFactor", "Equity_SettlementDays",
)
# The report's detail columns.
DETAIL_COLUMNS = ("GainID", "ShortName", "MetaData_GoldCreatedAt")

_AGGS = {"sum": F.sum, "min": F.min, "max": F.max, "avg": F.avg, "count": F.count,
         "count_distinct": F.count_distinct}


def relate(main: DataFrame, child: DataFrame, key: str, parent_key: str,
           collision_prefix: str = "child_") -> DataFrame:
    """Main LEFT JOIN child on ``main.key = child.parent_key``.

    Written as (child ⋈ main) ∪ (main without children) so that a parent with
    a huge share of the child rows sits on the side AQE may split (the
    streamed side of an inner join); the parents-without-children side joins
    against the distinct child keys (partially aggregated before the shuffle).
    A child column named like a main column (a child field called like the
    key) is renamed ``collision_prefix + name``.
    """
    child_cols = [c for c in child.columns if c != parent_key]
    taken = {c.lower() for c in main.columns}
    out_name = {c: (collision_prefix + c if c.lower() in taken else c) for c in child_cols}
    m, c = main.alias("__m"), child.alias("__c")
    q = lambda side, name: F.col(f"{side}.`{name}`")
    matched = c.join(m, q("__c", parent_key) == q("__m", key), "inner") \
               .select(*[q("__m", x).alias(x) for x in main.columns],
                       *[q("__c", x).alias(out_name[x]) for x in child_cols],
                       q("__c", parent_key).alias(parent_key))
    keys = child.select(F.col(parent_key).alias("__pk")).distinct()
    lonely = main.join(keys, F.col(key) == F.col("__pk"), "left_anti")
    ctypes = {f.name: f.dataType for f in child.schema.fields}
    lonely = lonely.select(*[F.col(x) for x in main.columns],
                           *[F.lit(None).cast(ctypes[x]).alias(out_name[x]) for x in child_cols],
                           F.lit(None).cast(ctypes[parent_key]).alias(parent_key))
    return matched.unionByName(lonely)


def serving_model(spark, root: str, main_name: str, key: str, children: Iterable[str],
                  register: bool = True) -> dict[str, DataFrame]:
    """D4 + A14: the serving model -- the main table and every child table
    ``{main}_{array}`` registered as views, and one relationship frame per
    child (``relate``: main LEFT JOIN child on the prefixed key)."""
    from strata.operators.upsert import read_children, read_main
    main = read_main(spark, f"{root.rstrip('/')}/{main_name}")
    out: dict[str, DataFrame] = {}
    if main is None:
        return out
    if register:
        main.createOrReplaceTempView(main_name)
    for name in children:
        child = read_children(spark, f"{root.rstrip('/')}/{name}")
        if child is None:
            continue
        if register:
            child.createOrReplaceTempView(name)
        out[name] = relate(main, child, key, f"{main_name}_{key}", collision_prefix=f"{name}_")
    return out


def default_measures(df: DataFrame, measures: Mapping[str, str] | Iterable[str],
                     by: Iterable[str] = ()) -> DataFrame:
    """The model's default aggregate per column (``{col: 'sum'}`` or a list
    of columns that sum), optionally per group; columns absent in ``df`` are
    skipped. Output names are ``{agg}_{col}``."""
    if not isinstance(measures, Mapping):
        measures = {c: "sum" for c in measures}
    aggs = [_AGGS[a](F.col(c)).alias(f"{a}_{c}") for c, a in measures.items() if c in df.columns]
    by = list(by)
    return df.groupBy(*by).agg(*aggs) if by else df.agg(*aggs)


def imports_by_change_type(main: DataFrame, col: str = "MetaData_ChangeType",
                           count_alias: str = "imports") -> DataFrame:
    """E8 + G2: non-null count per change type, largest first."""
    return main.groupBy(col).agg(F.count(col).alias(count_alias)) \
               .orderBy(F.desc(count_alias), F.asc(col))


def total_imports(main: DataFrame, key: str = "GainID", alias: str = "imports") -> DataFrame:
    """Count of the key (non-null)."""
    return main.agg(F.count(key).alias(alias))


def import_timeline(main: DataFrame, stamp: str = "MetaData_GoldCreatedAt",
                    count_alias: str = "imports") -> DataFrame:
    """E10 + G3: imports per serving stamp, oldest first."""
    return main.groupBy(stamp).agg(F.count(stamp).alias(count_alias)).orderBy(stamp)


def import_detail(main: DataFrame, today=None, filters: Mapping[str, Iterable] | None = None,
                  columns: Iterable[str] = DETAIL_COLUMNS,
                  stamp: str = "MetaData_GoldCreatedAt") -> DataFrame:
    """B19 + C5 + C6 + G3: rows stamped on ``today`` (the current date when
    not given, as the report's relative filter), as a half-open range so the
    filter reaches the scan; categorical filters (no values = no filter);
    newest first."""
    dtype = main.schema[stamp].dataType
    if today is None:
        # current_date() is folded to a literal at planning: still pushable
        lo_c = F.current_date().cast(dtype)
        hi_c = F.date_add(F.current_date(), 1).cast(dtype)
    else:
        today = _dt.date.fromisoformat(today) if isinstance(today, str) else today
        lo = _dt.datetime.combine(today, _dt.time())
        lo_c = F.lit(lo).cast(dtype)
        hi_c = F.lit(lo + _dt.timedelta(days=1)).cast(dtype)
    df = main.where((F.col(stamp) >= lo_c) & (F.col(stamp) < hi_c))
    for c, values in (filters or {}).items():
        values = list(values or [])
        if values:
            df = df.where(F.col(c).isin(values))
    return df.select(*columns).orderBy(F.desc(stamp))
