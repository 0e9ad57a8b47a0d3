"""Flatten, drop arrays, child frames: names, order, traps and untouched types."""

import datetime as dt
import decimal

import pytest

from strata.operators.flatten import (POSITION_COL, UID_COL, child_frames, drop_arrays,
                                      expand_struct, explode_child, flatten_structs)


def test_flatten_order_and_names(spark):
    df = spark.createDataFrame([(1, (2, (3,)), 4, (5,))],
                               "a int, S1 struct<x:int, T:struct<y:int>>, b int, S2 struct<z:int>")
    flat = flatten_structs(df)
    assert flat.columns == ["a", "b", "S1_x", "S2_z", "S1_T_y"]
    assert tuple(flat.first()) == (1, 4, 2, 5, 3)


def test_expand_one_struct_keeps_deeper_structs(spark):
    df = spark.createDataFrame([(1, (2, (3,)))], "a int, S struct<x:int, T:struct<y:int>>")
    out = expand_struct(df, "S", "S_")
    assert out.columns == ["a", "S_x", "S_T"]


def test_name_traps(spark):
    df = spark.createDataFrame([(1, (2,))], "a_b int, a struct<b:int>")
    with pytest.raises(ValueError, match="duplicate"):
        flatten_structs(df)
    dotted = spark.createDataFrame([((7,),)], "s struct<`x.y`:int>")
    assert flatten_structs(dotted).columns == ["s_x.y"]
    assert flatten_structs(dotted).first()[0] == 7
    # a child field named like the key: the key is renamed with the table prefix
    kids = spark.createDataFrame([("K", [("K2", "v")])], "GainID string, Ids array<struct<GainID:string, v:string>>")
    child = explode_child(kids, "GainID", "Ids", "Instrument")
    assert child.columns[:3] == ["Instrument_GainID", POSITION_COL, "GainID"]


def test_untouched_types_and_nested_arrays(spark):
    df = spark.createDataFrame(
        [(1, {"k": 1}, decimal.Decimal("1.50"), dt.date(2025, 1, 2), (3, [(4, (5,), [6])]))],
        "id int, m map<string,int>, d decimal(10,2), day date, "
        "s struct<x:int, arr:array<struct<p:int, q:struct<r:int>, z:array<int>>>>")
    flat = flatten_structs(df)
    assert flat.columns == ["id", "m", "d", "day", "s_x", "s_arr"]
    r = flat.first()
    assert r.m == {"k": 1} and r.d == decimal.Decimal("1.50") and r.day == dt.date(2025, 1, 2)
    kids = child_frames(flat, "id", "Main")
    assert list(kids) == ["s_arr"]
    k = kids["s_arr"].first()
    # one level only (nested struct and array stay columns)
    assert k.p == 4 and k.q.r == 5 and k.z == [6]


def test_drop_arrays_and_tombstones(spark):
    df = spark.createDataFrame([(1, [1, 2], "x"), (2, [], "y"), (3, None, "z")],
                               "id int, arr array<int>, s string")
    assert drop_arrays(df).columns == ["id", "s"]
    plain = explode_child(df, "id", "arr", "T")
    assert sorted((r.T_id, r[POSITION_COL], r.arr) for r in plain.collect()) == [(1, 0, 1), (1, 1, 2)]
    tomb = explode_child(df, "id", "arr", "T", tombstones=True)
    rows = sorted((r.T_id, r[POSITION_COL]) for r in tomb.collect())
    assert rows == [(1, 0), (1, 1), (2, None), (3, None)]
    ids = [r[UID_COL] for r in tomb.collect()]
    assert len(set(ids)) == 4 and all(len(i) == 64 for i in ids)


def test_nested_child_frames_recurse(spark):
    from strata.operators.flatten import nested_child_frames
    df = spark.createDataFrame([("K", [("a", [1, 2]), ("b", [])]), ("L", None)],
                               "id string, A array<struct<n:string, B:array<int>>>")
    frames = nested_child_frames(df, "id", "T")
    assert sorted(frames) == ["T_A", "T_A_B"]
    assert frames["T_A"].columns == ["T_id", POSITION_COL, "n"]
    assert sorted(tuple(r) for r in frames["T_A_B"].collect()) == [("K", 0, 0, 1), ("K", 0, 1, 2)]
    assert frames["T_A_B"].columns == ["T_id", "A_Position", POSITION_COL, "B"]
