"""Flatten structs, drop arrays and split arrays into child frames.

Every function here is a schema walk on the driver that emits ONE projection
(or one ``Generate`` + projection); no data moves through the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

from strata.functions.ids import row_uid

POSITION_COL = "MetaData_Position"
UID_COL = "MetaData_GoldUniqueId"
SEP = "_"


def _top(name: str) -> Column:
    return F.col(f"`{name.replace('`', '``')}`")


def struct_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, StructType)]


def array_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, ArrayType)]


def _check_unique(names: list[str], what: str) -> None:
    seen: dict[str, str] = {}
    dups = []
    for n in names:
        k = n.lower()
        if k in seen:
            dups.append(n)
        seen[k] = n
    if dups:
        raise ValueError(f"{what} would produce duplicate column names: {sorted(set(dups))}")


def expand_struct(df: DataFrame, struct_col: str, prefix: str = "") -> DataFrame:
    """One struct column replaced by its fields (``prefix + field``), at the end."""
    if not isinstance(df.schema[struct_col].dataType, StructType):
        raise TypeError(f"{struct_col} is not a struct")
    leaves = _leaves(df, lambda level, name: level == 0 and name == struct_col,
                     lambda parent, field: prefix + field)
    _check_unique([n for n, _ in leaves], f"expanding {struct_col}")
    return df.select(*[c.alias(n) for n, c in leaves])


def _leaves(df: DataFrame, opens, name_of) -> list[tuple[str, Column]]:
    """(name, column) of the frame after opening structs, level by level: what is
    not opened keeps its place, fields of opened structs follow."""
    out: list[tuple[str, Column]] = []
    level, depth = [(f.name, _top(f.name), f.dataType) for f in df.schema.fields], 0
    while level:
        below = []
        for name, column, dtype in level:
            if isinstance(dtype, StructType) and opens(depth, name):
                below += [(name_of(name, f.name), column.getField(f.name), f.dataType) for f in dtype.fields]
            else:
                out.append((name, column))
        level, depth = below, depth + 1
    return out


def flatten_structs(df: DataFrame, sep: str = SEP) -> DataFrame:
    """Flatten every struct to any depth; names joined by ``sep``.

    Column order equals expanding level by level (new columns to the end), the
    way repeated ``expand_struct`` calls order them. Arrays, maps and other
    types are kept as they are. Raises on duplicate output names (``a_b``
    beside ``a.b``)."""
    leaves = _leaves(df, lambda level, name: True, lambda parent, field: f"{parent}{sep}{field}")
    _check_unique([n for n, _ in leaves], "flatten_structs")
    return df.select(*[c.alias(n) for n, c in leaves])


def drop_arrays(df: DataFrame) -> DataFrame:
    """Drop every top-level array column."""
    arrays = set(array_columns(df))
    return df.select(*[_top(c) for c in df.columns if c not in arrays])


def explode_child(df: DataFrame, key: str, array_col: str, table: str,
                  tombstones: bool = False, uid_parts: tuple = (),
                  keep_position: bool = True) -> DataFrame:
    """One child frame from an array column.

    Rows: the parent key renamed ``{table}_{key}``, the element position and the
    element: struct elements expanded one level without prefix, scalar elements
    kept as a column named after the array. A NULL or empty array gives no row,
    or, with ``tombstones=True``, one row whose position is NULL (the marker the
    upsert uses to delete a parent's old children).
    ``uid_parts`` (columns of ``df``) are hashed with key, array name and
    position into ``MetaData_GoldUniqueId``.
    """
    parent_key = f"{table}{SEP}{key}"
    gen = F.posexplode_outer if tombstones else F.posexplode
    extra = [_top(c).alias(f"__uid{i}") for i, c in enumerate(uid_parts)]
    exploded = df.select(_top(key).alias(parent_key), *extra,
                         gen(_top(array_col)).alias(POSITION_COL, "__elem"))
    etype = df.schema[array_col].dataType.elementType
    if isinstance(etype, StructType):
        elem_cols = [F.col("__elem").getField(f.name).alias(f.name) for f in etype.fields]
        names = [f.name for f in etype.fields]
    else:
        elem_cols = [F.col("__elem").alias(array_col)]
        names = [array_col]
    base = [parent_key] + ([POSITION_COL] if keep_position else [])
    _check_unique(base + names + [UID_COL], f"child table {table}{SEP}{array_col}")
    cols = [F.col(parent_key)]
    if keep_position:
        cols.append(F.col(POSITION_COL))
    cols += elem_cols
    if uid_parts is not None:
        uid = row_uid(F.col(parent_key), F.lit(array_col), F.col(POSITION_COL),
                      *[F.col(f"__uid{i}") for i in range(len(uid_parts))])
        cols.append(uid.alias(UID_COL))
    return exploded.select(*cols)


def tombstones(df: DataFrame, key: str, array_col: str, table: str, uid_parts: tuple = ()) -> DataFrame:
    """One row per parent without a position, as ``explode_child`` gives for an
    empty array: for a frame that lacks the array."""
    none = F.lit(None).cast("int")
    uid = row_uid(_top(key), F.lit(array_col), none, *[_top(c) for c in uid_parts])
    return df.select(_top(key).alias(f"{table}{SEP}{key}"), none.alias(POSITION_COL), uid.alias(UID_COL))


def child_frames(df: DataFrame, key: str, table: str, tombstones: bool = False,
                 uid_parts: tuple = ()) -> dict[str, DataFrame]:
    """``{array name: child frame}`` for every top-level array column."""
    return {a: explode_child(df, key, a, table, tombstones=tombstones, uid_parts=uid_parts)
            for a in array_columns(df)}


def child_table_name(table: str, array_col: str) -> str:
    return f"{table}{SEP}{array_col}"


def nested_child_frames(df: DataFrame, key: str, table: str) -> dict[str, DataFrame]:
    """Q11 option: child frames for every array and, recursively, for arrays
    inside array elements (``{table}_{A}_{B}``). A grandchild row carries the
    root key, the position of its parent element (``{A}_Position``) and its
    own position; struct elements are expanded one level at each step."""
    out: dict[str, DataFrame] = {}

    def walk(frame: DataFrame, carry: list[str], name: str) -> None:
        for a in array_columns(frame):
            if a in carry:
                continue
            pos_name = f"{a}{SEP}Position"
            keep = [_top(c) for c in carry]
            etype = frame.schema[a].dataType.elementType
            exploded = frame.select(*keep, F.posexplode(_top(a)).alias(POSITION_COL, "__elem"))
            if isinstance(etype, StructType):
                elem = [F.col("__elem").getField(f.name).alias(f.name) for f in etype.fields]
                names = [f.name for f in etype.fields]
            else:
                elem = [F.col("__elem").alias(a)]
                names = [a]
            child_name = f"{name}{SEP}{a}"
            _check_unique(carry + [POSITION_COL] + names, f"child table {child_name}")
            child = exploded.select(*[_top(c) for c in carry], F.col(POSITION_COL), *elem)
            out[child_name] = child.select(
                *[_top(c) for c in child.columns if not isinstance(child.schema[c].dataType, ArrayType)
                  or c in carry])
            deeper = child.withColumnRenamed(POSITION_COL, pos_name)
            walk(deeper, carry + [pos_name], child_name)

    root = df.select(_top(key).alias(f"{table}{SEP}{key}"),
                     *[_top(c) for c in array_columns(df)])
    walk(root, [f"{table}{SEP}{key}"], table)
    return out
