"""Type widening: the least type that holds every value of two types, where there is one.

The order is by loss-free lifts only: whole numbers by width; whole numbers of up to 32
bits below double and those of up to 16 bits below float; float below double; decimals by
digits before and after the point, whole numbers among them; date below both
timestamps, the one without a zone below the one with; void below all; structs by the
union of their fields, arrays and map values by their elements. Long and double, text
and anything else, have no upper bound: a pair like that is reported, never guessed.
"""

from __future__ import annotations

from pyspark.sql.types import (ArrayType, ByteType, DataType, DateType, DecimalType, DoubleType, FloatType, IntegerType,
                               LongType, MapType, NullType, ShortType, StructField, StructType, TimestampNTZType,
                               TimestampType)

WHOLE = (ByteType, ShortType, IntegerType, LongType)
DIGITS = {ByteType: 3, ShortType: 5, IntegerType: 10, LongType: 20}
TIMES = (DateType, TimestampNTZType, TimestampType)
MOST_DIGITS = 38


def _numbers(a: DataType, b: DataType) -> DataType | None:
    """Upper bound of two different numeric types."""
    kinds = {type(a), type(b)}
    if kinds <= set(WHOLE):
        return max((a, b), key=lambda t: WHOLE.index(type(t)))
    if DecimalType in kinds:
        if kinds & {FloatType, DoubleType}:
            return None
        scale = [t.scale if isinstance(t, DecimalType) else 0 for t in (a, b)]
        before = [t.precision - t.scale if isinstance(t, DecimalType) else DIGITS[type(t)] for t in (a, b)]
        digits = max(before) + max(scale)
        return DecimalType(digits, max(scale)) if digits <= MOST_DIGITS else None
    if LongType in kinds:
        return None                     # a double has 53 bits
    return FloatType() if IntegerType not in kinds and DoubleType not in kinds else DoubleType()


def upper_bound(a: DataType, b: DataType) -> DataType | None:
    """The least type above both (nullable everywhere inside), None where there is none."""
    if isinstance(a, StructType) and isinstance(b, StructType):
        merged, conflicts = union(a, b)
        return None if conflicts else merged
    if isinstance(a, ArrayType) and isinstance(b, ArrayType):
        element = upper_bound(a.elementType, b.elementType)
        return None if element is None else ArrayType(element, True)
    if isinstance(a, MapType) and isinstance(b, MapType):
        value = upper_bound(a.valueType, b.valueType)
        return None if value is None or a.keyType != b.keyType else MapType(a.keyType, value, True)
    if a == b or isinstance(b, NullType):
        return a
    if isinstance(a, NullType):
        return b
    if type(a) in TIMES and type(b) in TIMES:
        return max((a, b), key=lambda t: TIMES.index(type(t)))
    number = (*WHOLE, FloatType, DoubleType, DecimalType)
    return _numbers(a, b) if isinstance(a, number) and isinstance(b, number) else None


def union(a: StructType, b: StructType, path: str = "") -> tuple[StructType, list[tuple[str, str, str]]]:
    """Both structs' fields, by name as Spark compares names (a's places first), and the
    fields that have no upper bound: (path, type in a, type in b); those keep a's type."""
    fields, conflicts = [], []
    other = {f.name.lower(): f for f in b.fields}
    for f in a.fields:
        g = other.pop(f.name.lower(), None)
        kind = f.dataType
        if g is not None:
            if isinstance(kind, StructType) and isinstance(g.dataType, StructType):
                kind, inside = union(kind, g.dataType, f"{path}{f.name}.")
                conflicts += inside
            else:
                kind = upper_bound(kind, g.dataType)
                if kind is None:
                    conflicts.append((path + f.name, f.dataType.simpleString(), g.dataType.simpleString()))
                    kind = f.dataType
        fields.append(StructField(f.name, kind, True, f.metadata))
    fields += [StructField(g.name, g.dataType, True, g.metadata) for g in other.values()]
    return StructType(fields), conflicts


def lifted_by_reader(old: DataType, new: DataType) -> bool:
    """Whether Parquet files of the old type can be read under the new one: Spark's reader
    makes every lift of this order itself, but that from a date to a timestamp with zone
    and those from void."""
    if isinstance(old, StructType) and isinstance(new, StructType):
        now = {f.name.lower(): f.dataType for f in new.fields}
        return all(f.name.lower() in now and lifted_by_reader(f.dataType, now[f.name.lower()]) for f in old.fields)
    if isinstance(old, ArrayType) and isinstance(new, ArrayType):
        return lifted_by_reader(old.elementType, new.elementType)
    if isinstance(old, MapType) and isinstance(new, MapType):
        return lifted_by_reader(old.valueType, new.valueType)
    if isinstance(old, DateType) and isinstance(new, TimestampType) or isinstance(old, NullType):
        return old == new
    return True


def without_void(kind: DataType) -> DataType | None:
    """The type without what is only known to be null: a field of type void, or whose parts
    all are, tells nothing yet, and a file need not hold it."""
    if isinstance(kind, StructType):
        fields = [(f, without_void(f.dataType)) for f in kind.fields]
        kept = [StructField(f.name, t, f.nullable, f.metadata) for f, t in fields if t is not None]
        return StructType(kept) if kept else None
    if isinstance(kind, ArrayType):
        element = without_void(kind.elementType)
        return None if element is None else ArrayType(element, kind.containsNull)
    if isinstance(kind, MapType):
        value = without_void(kind.valueType)
        return None if value is None else MapType(kind.keyType, value, kind.valueContainsNull)
    return None if isinstance(kind, NullType) else kind
