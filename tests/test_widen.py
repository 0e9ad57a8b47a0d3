"""The type lattice, and tables whose columns get wider types."""

import datetime as dt
import itertools

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string as T

from strata.operators.contract import contract_report
from strata.operators.upsert import read_children, read_main, stored_schema
from strata.operators.widen import lifted_by_reader, union, upper_bound, without_void
from strata.plans.publish import publish_entity
from strata.plans.spec import EntitySpec

BOUNDS = [("tinyint", "int", "int"), ("int", "bigint", "bigint"), ("float", "double", "double"), ("int", "double", "double"),
          ("smallint", "float", "float"), ("int", "float", "double"), ("bigint", "double", None), ("bigint", "float", None),
          ("date", "timestamp", "timestamp"), ("date", "timestamp_ntz", "timestamp_ntz"), ("timestamp_ntz", "timestamp", "timestamp"),
          ("void", "array<int>", "array<int>"), ("string", "int", None), ("boolean", "int", None), ("string", "date", None),
          ("decimal(5,2)", "decimal(6,4)", "decimal(7,4)"), ("int", "decimal(5,2)", "decimal(12,2)"), ("decimal(5,2)", "double", None),
          ("decimal(38,0)", "decimal(38,10)", None), ("array<int>", "array<bigint>", "array<bigint>"),
          ("map<string,int>", "map<string,double>", "map<string,double>"), ("map<int,int>", "map<bigint,int>", None),
          ("struct<a:int,b:string>", "struct<B:string,c:date,a:bigint>", "struct<a:bigint,b:string,c:date>"),
          ("array<struct<a:void>>", "array<struct<a:int>>", "array<struct<a:int>>"), ("struct<a:int>", "struct<a:string>", None),
          ("array<int>", "int", None)]


@pytest.mark.parametrize("a, b, want", BOUNDS)
def test_upper_bounds(spark, a, b, want):
    for x, y in ((a, b), (b, a)):
        got = upper_bound(T(x), T(y))
        # the order of a struct's fields follows its first side
        assert (got is None) if want is None else (x == b and "struct" in x or got.simpleString() == want)
        assert got is None or upper_bound(got, T(x)) == got == upper_bound(got, T(y))


def test_the_bound_is_a_lattice(spark):
    kinds = [T(k) for k in ("tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp_ntz", "timestamp", "void",
                            "string", "decimal(5,2)", "decimal(20,0)")]
    for a, b, c in itertools.product(kinds, repeat=3):
        assert upper_bound(a, b) == upper_bound(b, a) and upper_bound(a, a) == a
        ab, bc = upper_bound(a, b), upper_bound(b, c)
        left, right = ab and upper_bound(ab, c), bc and upper_bound(a, bc)
        # where both ways end, they end at the same type
        assert left is None or right is None or left == right


def test_conflicts_are_named(spark):
    a, b = (T(t) for t in ("struct<k:int,s:struct<x:bigint,y:int>,t:string>", "struct<s:struct<y:bigint,x:double>,t:int,u:int>"))
    merged, conflicts = union(a, b)
    assert conflicts == [("s.x", "bigint", "double"), ("t", "string", "int")]
    assert merged.simpleString() == "struct<k:int,s:struct<x:bigint,y:bigint>,t:string,u:int>"
    report = {(r.path, r.issue): r.widened for r in contract_report(spark, b, a).collect()}
    assert report[("t", "type")] is None and report[("s.x", "type")] is None and report[("s.y", "type")] == "bigint"


def test_void_is_left_out(spark):
    assert without_void(T("struct<a:void,b:struct<c:void>,d:array<void>,e:int,f:struct<g:void,h:int>>")).simpleString() == \
        "struct<e:int,f:struct<h:int>>"
    assert lifted_by_reader(T("struct<a:int,b:array<float>>"), T("struct<b:array<double>,a:bigint,c:int>"))
    assert not lifted_by_reader(T("struct<a:struct<d:date>>"), T("struct<a:struct<d:timestamp>>"))


SPECS = [EntitySpec(name="W", key="k", ties=(), buckets=3), EntitySpec(name="W", key="k", ties=(), bucket_bytes=4000)]


def batch(spark, rows, schema, day):
    df = spark.createDataFrame(rows, schema)
    return df.select(F.struct(F.lit(day).alias("PublicationDate")).alias("MetaData"), *df.columns)


@pytest.mark.parametrize("spec", SPECS)
def test_columns_get_wider_batch_by_batch(spark, work, spec):
    day = dt.date(2031, 5, 6)
    steps = [("k long, n int, x float, d date, v void, s struct<a:int>, xs array<int>",
              [(i, i, i / 2, day, None, (i,), [i]) for i in range(40)]),
             ("k long, n long, x double, d date, v void, s struct<a:int,b:void>, xs array<bigint>",
              [(i, 1 << 40, 0.1, day, None, (i, None), [1 << 40, 2]) for i in range(30, 50)]),
             ("k long, n int, x float, d timestamp, v string, s struct<b:string,a:bigint>, xs array<int>",
              [(i, i, i / 4, dt.datetime(2031, 5, 6, 7), "v", ("b", 1 << 41), [7]) for i in range(45, 60)])]
    want = {}
    for at, (schema, rows) in enumerate(steps):
        publish_entity(spark, batch(spark, rows, schema, f"2031-01-0{at + 1}"), spec, work, stamp=F.lit(None).cast("timestamp"))
        for r in rows:
            s = r[5] if at < 2 else r[5][::-1]
            when = r[3] if isinstance(r[3], dt.datetime) else dt.datetime(2031, 5, 6)
            want[r[0]] = (r[0], r[1], r[2], when, r[4], s[0], s[1] if len(s) > 1 else None, tuple(r[6]))
    main = read_main(spark, f"{work}/W")
    kinds = dict(main.dtypes)
    assert (kinds["n"], kinds["x"], kinds["d"], kinds["v"], kinds["s_a"], kinds["s_b"]) == ("bigint", "double", "timestamp", "string", "bigint", "string")
    kids = {}
    for r in read_children(spark, f"{work}/W_xs").orderBy("MetaData_Position").collect():
        kids.setdefault(r.W_k, []).append(r.xs)
    got = {r.k: (r.k, r.n, r.x, r.d, r.v, r.s_a, r.s_b, tuple(kids[r.k])) for r in main.collect()}
    assert got == want


@pytest.mark.parametrize("spec", SPECS[:1])
def test_types_without_a_bound_are_refused_before_any_write(spark, work, spec):
    publish_entity(spark, batch(spark, [(1, 5)], "k long, n long", "2031-01-01"), spec, work)
    with pytest.raises(ValueError, match="column n: type double"):
        publish_entity(spark, batch(spark, [(1, 5.5)], "k long, n double", "2031-01-02"), spec, work)
    with pytest.raises(ValueError, match="key k"):
        publish_entity(spark, batch(spark, [(1, 5)], "k int, n int", "2031-01-02"), EntitySpec(**{**spec.__dict__, "guard": "none"}), work)
    assert [(r.k, r.n) for r in read_main(spark, f"{work}/W").collect()] == [(1, 5)]
    assert isinstance(stored_schema(spark, f"{work}/W"), StructType)


def test_an_interrupted_rewrite_for_a_lift_is_repaired(spark, work, monkeypatch):
    import strata.operators.upsert as U
    spec = SPECS[1]
    publish_entity(spark, batch(spark, [(i, dt.date(2031, 1, 1)) for i in range(300)], "k long, d date", "2031-01-01"), spec, work, batch_id=0)
    real = U._write_partitioned

    def lost(df, table, path, mode_dynamic):
        if path == table.path:
            raise RuntimeError("lost")
        real(df, table, path, mode_dynamic)

    later = batch(spark, [(5, dt.datetime(2031, 1, 2))], "k long, d timestamp", "2031-01-02")
    with monkeypatch.context() as m:
        m.setattr(U, "remember_schema", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            publish_entity(spark, later, spec, work, batch_id=1)
    assert read_main(spark, f"{work}/W").count() == 300
    publish_entity(spark, later, spec, work, batch_id=1)
    got = {r.k: r.d for r in read_main(spark, f"{work}/W").collect()}
    assert len(got) == 300 and got[5] == dt.datetime(2031, 1, 2) and got[6] == dt.datetime(2031, 1, 1)
