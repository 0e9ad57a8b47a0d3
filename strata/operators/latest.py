"""Latest row per business key.

``row_number() = 1`` over the key lets Catalyst insert a partial
``WindowGroupLimit`` *before* the shuffle: every map task keeps only its best
row per key, so a key that holds a third of the rows reaches the exchange as
one row per task, not as a third of the data.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RANK_COL = "__rank"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def latest_per_key(df: DataFrame, key: str | Sequence[str], order: Sequence,
                   ties: Sequence = ()) -> DataFrame:
    """Keep, per key, the row with the greatest ``order`` tuple (NULLs lose),
    then the greatest ``ties`` tuple. Deterministic when ``ties`` break every tie.
    Rows with a NULL key form one group like any key: route them away first
    with ``split_null_keys`` (``publish_entity`` does)."""
    keys = [key] if isinstance(key, str) else list(key)
    sort = [_c(o).desc_nulls_last() for o in list(order) + list(ties)]
    w = Window.partitionBy(*keys).orderBy(*sort)
    return df.withColumn(RANK_COL, F.row_number().over(w)) \
             .where(F.col(RANK_COL) == 1).drop(RANK_COL)


def split_null_keys(df: DataFrame, key: str | Sequence[str],
                    reason: str = "null business key") -> tuple[DataFrame, DataFrame]:
    """(rows with a key, rows without one + ``_reject_reason``)."""
    keys = [key] if isinstance(key, str) else list(key)
    has_key = F.lit(True)
    for k in keys:
        has_key = has_key & F.col(k).isNotNull()
    good = df.where(has_key)
    bad = df.where(~has_key).withColumn("_reject_reason", F.lit(reason))
    return good, bad
