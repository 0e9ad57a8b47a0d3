"""Measures over main and children under filters on any of them, by brute force."""

import random

import pytest
from pyspark.sql import functions as F

from strata.operators.model import Model, filtered, measures


@pytest.fixture(scope="module")
def tables(spark):
    rng = random.Random(8)
    main = [(k, rng.choice(["a", "b", None]), rng.randrange(10)) for k in range(40)]
    a = [(rng.choice([*range(45), None]), rng.randrange(100)) for _ in range(300)]
    b = [(rng.choice(range(30)), rng.randrange(100)) for _ in range(80)] + [(7, 1)] * 200
    c = [(rng.choice(range(0, 40, 2)), rng.choice("xy")) for _ in range(60)]
    model = Model(spark.createDataFrame(main, "k long, g string, v long"), "k",
                  {"a": (spark.createDataFrame(a, "k long, v long"), "k"), "b": (spark.createDataFrame(b, "p long, v long"), "p"),
                   "c": (spark.createDataFrame(c, "p long, flag string"), "p")})
    return model, main, a, b, c


def wanted():
    return {"main": {"n": F.count("*"), "v": F.sum("v")}, "a": {"a_sum": F.sum("v"), "a_n": F.count("v")},
            "b": {"b_max": F.max("v"), "b_n": F.count("*")}}


def brute(tables, f_main, f_a, f_c):
    _, main, a, b, c = tables
    keys = {k for k, g, v in main if f_main(v)}
    if f_a is not None:
        keys &= {p for p, v in a if f_a(v)}
    if f_c is not None:
        keys &= {p for p, flag in c if f_c(flag)}
    out = {}
    for g in {g for k, g, v in main if k in keys}:
        own = {k for k, h, v in main if h == g and k in keys}
        av = [v for p, v in a if p in own and (f_a is None or f_a(v))]
        bv = [v for p, v in b if p in own]
        out[g] = (len(own), sum(v for k, h, v in main if k in own), sum(av) if av else None, len(av), max(bv) if bv else None, len(bv))
    return out


@pytest.mark.parametrize("main_f, a_f, c_f", [(None, None, None), (5, None, None), (None, 90, None), (None, None, "x"), (3, 50, "y")])
def test_filters_reach_all_tables_and_no_table_multiplies_another(tables, main_f, a_f, c_f):
    filters = {}
    if main_f is not None:
        filters["main"] = F.col("v") >= main_f
    if a_f is not None:
        filters["a"] = F.col("v") >= a_f
    if c_f is not None:
        filters["c"] = F.col("flag") == c_f
    got = {r.g: tuple(r)[1:] for r in measures(tables[0], ["g"], wanted(), filters).collect()}
    assert got == brute(tables, lambda v: main_f is None or v >= main_f, None if a_f is None else lambda v: v >= a_f,
                        None if c_f is None else lambda f: f == c_f)


def test_a_filter_that_leaves_nothing(tables):
    assert measures(tables[0], ["g"], wanted(), {"c": F.col("flag") == "z"}).collect() == []
    left = filtered(tables[0], {"c": F.col("flag") == "z"})
    assert left.main.count() == 0 and all(df.count() == 0 for df, _ in left.children.values())


def test_totals_without_groups(tables):
    row = measures(tables[0], [], wanted()).first()
    _, main, a, b, _ = tables
    assert (row.n, row.a_n, row.b_n) == (40, sum(p is not None and p < 40 and v is not None for p, v in a), len(b))


def test_wrong_names_are_refused(tables):
    with pytest.raises(ValueError, match="no such table"):
        measures(tables[0], ["g"], {"z": {"n": F.count("*")}})
    with pytest.raises(ValueError, match="one name"):
        measures(tables[0], ["g"], {"a": {"n": F.count("*")}, "b": {"n": F.count("*")}})
