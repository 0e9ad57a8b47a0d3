"""Schema contracts.

A contract is a Spark ``StructType`` kept as JSON. Documents are parsed under
the contract made nullable (a file stream relaxes nullability anyway); rows
that are malformed, mistyped or miss a required field go to quarantine with a
reason instead of failing or silently turning into NULLs.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (ArrayType, BooleanType, DateType, IntegralType, MapType, NumericType,
                               StringType, StructField, StructType, TimestampType)

from strata.operators.widen import upper_bound

CORRUPT = "_corrupt_record"
REASON = "_reject_reason"


# ---------------------------------------------------------------- files
def save_contract(spark: SparkSession, schema: StructType, path: str) -> None:
    """Write the contract JSON as a one-line text dataset at ``path``."""
    spark.createDataFrame([(schema.json(),)], "value string") \
         .coalesce(1).write.mode("overwrite").text(path)


def load_contract(spark: SparkSession, path: str) -> StructType:
    """Read a contract written by ``save_contract`` (or any JSON file)."""
    text = spark.read.text(path, wholetext=True).first()[0]
    return StructType.fromJson(json.loads(text))


def infer_contract(spark: SparkSession, folder: str, multi_line: bool = True) -> StructType:
    """Union schema of a folder of JSON documents (distributed inference);
    the corrupt-record column inference adds for a bad file is dropped."""
    schema = spark.read.option("multiLine", multi_line).json(folder).schema
    return StructType([f for f in schema.fields if f.name != CORRUPT])


# ---------------------------------------------------------------- parsing
def relax(dt):
    """The same type with every field nullable."""
    if isinstance(dt, StructType):
        return StructType([StructField(f.name, relax(f.dataType), True, f.metadata)
                           for f in dt.fields])
    if isinstance(dt, ArrayType):
        return ArrayType(relax(dt.elementType), True)
    if isinstance(dt, MapType):
        return MapType(dt.keyType, relax(dt.valueType), True)
    return dt


def parse_documents(df: DataFrame, contract: StructType, doc: str = "document",
                    keep: list[str] | None = None) -> DataFrame:
    """Parse a JSON text column under the (relaxed) contract.

    Output: the ``keep`` columns, the contract's top-level fields and
    ``_corrupt_record`` (the text, when it is not an object or a value does not
    fit its type)."""
    keep = [c for c in df.columns if c != doc] if keep is None else keep
    schema = StructType(relax(contract).fields + [StructField(CORRUPT, StringType(), True)])
    parsed = F.from_json(F.col(doc), schema, {"columnNameOfCorruptRecord": CORRUPT,
                                              "mode": "PERMISSIVE"})
    return (df.select(*[F.col(c) for c in keep], parsed.alias("__doc"), F.col(doc).alias("__text"))
              .select(*[F.col(c) for c in keep],
                      *[F.col("__doc").getField(f.name).alias(f.name) for f in contract.fields],
                      # NULL/blank text parses to a NULL struct: treat as corrupt
                      F.when(F.col("__doc").isNull(), F.coalesce(F.col("__text"), F.lit("")))
                       .otherwise(F.col("__doc").getField(CORRUPT)).alias(CORRUPT)))


def _required_checks(c: Column, dt, path: str) -> list[tuple[str, Column]]:
    """(path, predicate that holds when the required field is present) pairs."""
    out = []
    if isinstance(dt, StructType):
        for f in dt.fields:
            sub = c.getField(f.name)
            p = f"{path}.{f.name}" if path else f.name
            if not f.nullable:
                out.append((p, sub.isNotNull()))
            for q, pred in _required_checks(sub, f.dataType, p):
                # a nested requirement binds only when its parent is present
                out.append((q, sub.isNull() | pred))
    elif isinstance(dt, ArrayType) and isinstance(dt.elementType, StructType):
        inner = _required_checks_lambda(dt.elementType, path + "[]")
        for q, fn in inner:
            out.append((q, c.isNull() | F.forall(c, fn)))
    return out


def _required_checks_lambda(st: StructType, path: str):
    res = []
    for f in st.fields:
        p = f"{path}.{f.name}"
        if not f.nullable:
            res.append((p, (lambda name: (lambda x: x.isNull() | x.getField(name).isNotNull()))(f.name)))
    return res


def required_checks(contract: StructType) -> list[tuple[str, Column]]:
    """All required-field predicates of a contract, top level and nested."""
    out = []
    for f in contract.fields:
        c = F.col(f"`{f.name}`")
        if not f.nullable:
            out.append((f.name, c.isNotNull()))
        for q, pred in _required_checks(c, f.dataType, f.name):
            out.append((q, c.isNull() | pred))
    return out


def reject_reason(contract: StructType) -> Column:
    """First reason a parsed row breaks the contract, NULL when it conforms."""
    branches = F.when(F.col(CORRUPT).isNotNull(), F.lit("malformed or mistyped document"))
    for path, ok in required_checks(contract):
        branches = branches.when(~ok, F.lit(f"required field missing: {path}"))
    return branches


def enforce(parsed: DataFrame, contract: StructType) -> tuple[DataFrame, DataFrame]:
    """(conforming rows without ``_corrupt_record``, rejects with ``_reject_reason``).

    One projection computes the reason; both outputs filter on it, so a caller
    that persists ``parsed`` first pays for the parse once."""
    tagged = parsed.withColumn(REASON, reject_reason(contract))
    good = tagged.where(F.col(REASON).isNull()).drop(REASON, CORRUPT)
    bad = tagged.where(F.col(REASON).isNotNull())
    return good, bad


# ---------------------------------------------------------------- reports
def _diff(expected: StructType, actual: StructType, prefix: str = "") -> list[tuple]:
    rows = []
    e_names, a_names = expected.fieldNames(), actual.fieldNames()
    a_by = {f.name: f for f in actual.fields}
    for f in expected.fields:
        p = prefix + f.name
        if f.name not in a_by:
            rows.append((p, "missing", f.dataType.simpleString(), None, None))
            continue
        g = a_by[f.name]
        if isinstance(f.dataType, StructType) and isinstance(g.dataType, StructType):
            rows += _diff(f.dataType, g.dataType, p + ".")
        elif f.dataType != g.dataType:
            wide = upper_bound(f.dataType, g.dataType)
            rows.append((p, "type", f.dataType.simpleString(), g.dataType.simpleString(),
                         None if wide is None else wide.simpleString()))
        if f.nullable != g.nullable:
            rows.append((p, "nullability", str(f.nullable).lower(), str(g.nullable).lower(), None))
        if f.metadata != g.metadata:
            rows.append((p, "metadata", json.dumps(f.metadata, sort_keys=True),
                         json.dumps(g.metadata, sort_keys=True), None))
    for g in actual.fields:
        if g.name not in e_names:
            rows.append((prefix + g.name, "extra", None, g.dataType.simpleString(), None))
    common_e = [n for n in e_names if n in a_names]
    common_a = [n for n in a_names if n in e_names]
    if common_e != common_a:
        rows.append((prefix.rstrip(".") or "<root>", "order", ",".join(common_e), ",".join(common_a), None))
    return rows


def contract_report(spark: SparkSession, actual: StructType, contract: StructType) -> DataFrame:
    """One row per difference (path, issue, expected, actual, widened), recursive
    into structs; empty when the schemas match in names, types, nullability,
    metadata and order. ``widened`` is the type that would hold both sides of a type
    difference; NULL there means that none does, and a table of that column refuses the other."""
    return spark.createDataFrame(_diff(contract, actual),
                                 "path string, issue string, expected string, actual string, widened string")


def _json_kind(dtype) -> str:
    """Pattern of the JSON kinds that may hold a value of the type (a cast alone
    would cut a fraction off or read a number from a text)."""
    if isinstance(dtype, IntegralType):
        return "^BIGINT$"
    if isinstance(dtype, NumericType):
        return "^(BIGINT|DOUBLE|FLOAT|DECIMAL)"
    if isinstance(dtype, BooleanType):
        return "^BOOLEAN$"
    if isinstance(dtype, (StructType, MapType)):
        return "^OBJECT"
    if isinstance(dtype, ArrayType):
        return "^ARRAY"
    return "^STRING$" if isinstance(dtype, (DateType, TimestampType)) else "."


def conformance_counts(df: DataFrame, contract: StructType, doc: str = "document") -> DataFrame:
    """J3 over data: per top-level contract field, how many documents lack it
    and how many carry a value that does not fit its type.

    Each document is parsed once, to a map of variants; each field is then tried
    against its type on its own, so a bad value in one field never blanks the
    others. One distributed aggregation: partial counts per task, then a single
    tiny merge."""
    base = df.select(F.from_json(F.col(doc), "map<string,variant>").alias("__m"))
    aggs = []
    for i, f in enumerate(contract.fields):
        value = F.try_element_at(F.col("__m"), F.lit(f.name))
        present = value.isNotNull() & ~F.coalesce(F.is_variant_null(value), F.lit(True))
        fits = (F.rlike(F.schema_of_variant(value), F.lit(_json_kind(f.dataType)))
                & F.try_variant_get(value, "$", relax(f.dataType).simpleString()).isNotNull())
        aggs.append(F.count_if(~F.coalesce(present, F.lit(False))).alias(f"m{2 * i}"))
        aggs.append(F.count_if(present & ~fits).alias(f"m{2 * i + 1}"))
    counts = base.agg(*aggs)
    rows = [F.struct(F.lit(f.name).alias("field"),
                     F.lit(f.dataType.simpleString()).alias("expected_type"),
                     F.lit(not f.nullable).alias("required"),
                     F.col(f"m{2 * i}").alias("missing_rows"),
                     F.col(f"m{2 * i + 1}").alias("mistyped_rows"))
            for i, f in enumerate(contract.fields)]
    return counts.select(F.explode(F.array(*rows)).alias("s")).select("s.*")
