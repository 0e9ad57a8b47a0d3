"""Measures over the whole serving model (D4, E11, C6): one main table, any number of children.

A filter on any table holds for all of them, as in a report: it is carried to the main
table as a key set (a semi-join), and the main rows that are left are carried to every
child the same way. Every measure is aggregated on its own table before it meets
another, so two child tables never multiply each other's rows; only groups are combined.

Each child is read once and shuffled once, by its parent key (or not at all, where the
main side is small enough for Spark to broadcast it); the child side streams through
semi and inner joins, which AQE may split where a parent has very many rows. NULL groups
are groups; a child row without a parent counts nowhere; measures of a table that has no
row in a group are NULL there (counts are 0).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MAIN = "main"


@dataclass(frozen=True)
class Model:
    main: DataFrame
    key: str
    children: Mapping[str, tuple[DataFrame, str]] = field(default_factory=dict)     # name -> (rows, parent key)

    def __post_init__(self):
        if MAIN in self.children:
            raise ValueError(f"{MAIN!r} names the main table")


def _known(model: Model, names) -> None:
    unknown = set(names) - {MAIN, *model.children}
    if unknown:
        raise ValueError(f"no such table in the model: {sorted(unknown)}")


def filtered(model: Model, filters: Mapping[str, Column]) -> Model:
    """The model under filters on any of its tables: the main rows that pass their own
    filter and have a passing row in every filtered child; the child rows that pass
    their own and belong to such a main row."""
    _known(model, filters)
    main = model.main.where(filters[MAIN]) if MAIN in filters else model.main
    own = {name: (df.where(filters[name]) if name in filters else df, parent) for name, (df, parent) in model.children.items()}
    for name in filters:
        if name != MAIN:
            df, parent = own[name]
            keys = df.select(F.col(parent).alias("__parent"))
            main = main.join(keys, F.col(model.key) == F.col("__parent"), "left_semi")
    left = main.select(F.col(model.key).alias("__key"))
    return Model(main, model.key, {name: (df.join(left, F.col(parent) == F.col("__key"), "left_semi"), parent)
                                   for name, (df, parent) in own.items()})


def measures(model: Model, by: Sequence[str], wanted: Mapping[str, Mapping[str, Column]],
             filters: Mapping[str, Column] | None = None) -> DataFrame:
    """``wanted`` names aggregates for each table (``{"main": {"n": count("*")}, ...}``), over the
    model under ``filters``; one row for each group of the main table's columns ``by``
    that any of the tables has rows in."""
    _known(model, wanted)
    aliases = [a for own in wanted.values() for a in own]
    if len(set(aliases)) < len(aliases):
        raise ValueError("measures of two tables have one name")
    if filters:
        model = filtered(model, filters)
    parts, of_none = [], {}
    for name, own in wanted.items():
        rows = model.main
        table = model.main if name == MAIN else model.children[name][0]
        of_none |= table.limit(0).agg(*[c.alias(alias) for alias, c in own.items()]).first().asDict()
        if name != MAIN:
            rows, parent = model.children[name]
            groups = model.main.select(F.col(model.key).alias("__key"), *[F.col(c).alias(f"__by_{i}") for i, c in enumerate(by)])
            rows = rows.join(groups, F.col(parent) == F.col("__key"))
            rows = rows.groupBy(*[F.col(f"__by_{i}").alias(c) for i, c in enumerate(by)])
        else:
            rows = rows.groupBy(*by)
        parts.append(rows.agg(*[c.alias(alias) for alias, c in own.items()]))
    both = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    # a group has one row from each table, so this only puts them side by side
    out = both.groupBy(*by).agg(*[F.max(a).alias(a) for a in aliases])
    # what an aggregate says of no rows: 0 for a count, NULL for most
    return out.select(*by, *[F.col(a) if of_none[a] is None else F.coalesce(a, F.lit(of_none[a])).alias(a) for a in aliases])
