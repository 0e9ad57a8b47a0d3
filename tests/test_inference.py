"""Schemas kept a day at a time and merged, against the aggregate over all documents."""

import datetime as dt
import itertools
import random

from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from strata.operators.inference import as_contract, day_schemas, keep_day_schemas, kept_kind, kind_of, leaves, merged_kind

DOCS = ['{"a":1}', '{"a":1.5}', '{"a":"x"}', '{"a":1e10}', '{"a":null}', '{"a":{"b":[1,2.25,null]}}', '{"a":[]}', '{"a":[{"x y":true}]}',
        '{"a":10.25}', '{bad', '[1]', '{"a":123456789012345678901234567890}', '{"a":0.00000000000000000001}', '{"b":1,"a":2}', '{"a.b":1}',
        '{}', '{"OBJECT":{"OBJECT":"OBJECT"}}', '{"a":{"b":[[1],[0.5]],"c":false}}', 'null', '3', '{"`":1}', '{"é":[{"q":1},{"q":"t"}]}']


def whole(df):
    return kind_of(df.agg(F.schema_of_variant_agg(F.try_parse_json("document"))).first()[0])


def test_two_documents_merge_as_the_aggregate_does(spark):
    pairs = list(itertools.combinations(range(len(DOCS)), 2))
    rows = [(i, DOCS[k]) for i, pair in enumerate(pairs) for k in pair]
    df = spark.createDataFrame(rows, "i int, document string").withColumn("v", F.try_parse_json("document"))
    single = {r.document: kind_of(r.s) for r in df.groupBy("document").agg(F.schema_of_variant_agg("v").alias("s")).collect()}
    for r in df.groupBy("i").agg(F.schema_of_variant_agg("v").alias("s")).collect():
        x, y = (single[DOCS[k]] for k in pairs[r.i])
        assert merged_kind(x, y) == merged_kind(y, x) == kind_of(r.s), (DOCS[pairs[r.i][0]], DOCS[pairs[r.i][1]])


def test_names_that_differ_in_case_are_one_field():
    a, b = kind_of("OBJECT<a: BIGINT, c: BIGINT>"), kind_of("OBJECT<A: DOUBLE>")
    assert merged_kind(a, b) == merged_kind(b, a) == kind_of("OBJECT<A: DOUBLE, c: BIGINT>")


def test_days_are_kept_and_merged(spark, work):
    rng = random.Random(6)
    rows = [(dt.date(2031, 1, 1 + i % 9), rng.choice(DOCS[:9] + DOCS[13:18])) for i in range(200)]
    raw = spark.createDataFrame(rows, "ingest_date date, document string")
    raw.write.partitionBy("ingest_date").parquet(f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")
    early = raw.where("ingest_date < DATE'2031-01-05'")
    keep_day_schemas(spark, early, f"{work}/kept")
    assert kept_kind(spark, f"{work}/kept") == whole(early)
    keep_day_schemas(spark, raw, f"{work}/kept")
    assert kept_kind(spark, f"{work}/kept") == whole(raw)
    kept = spark.read.parquet(f"{work}/kept")
    assert kept.count() == 9 and kept.agg(F.sum("documents")).first()[0] == 200
    # a day that got another document is done again, alone
    more = spark.createDataFrame([(dt.date(2031, 1, 3), '{"late":{"x":1}}')], "ingest_date date, document string")
    more.write.mode("append").partitionBy("ingest_date").parquet(f"{work}/raw")
    raw = spark.read.parquet(f"{work}/raw")
    keep_day_schemas(spark, raw, f"{work}/kept", days=[dt.date(2031, 1, 3)])
    assert kept_kind(spark, f"{work}/kept") == whole(raw)
    assert ("late.x", "bigint") in leaves(kept_kind(spark, f"{work}/kept"))


def test_only_new_days_are_read(spark, work):
    df = spark.createDataFrame([(dt.date(2031, 1, d), '{"a":1}') for d in (1, 2)], "ingest_date date, document string")
    keep_day_schemas(spark, df.where("ingest_date = DATE'2031-01-01'"), f"{work}/kept")
    poisoned = df.withColumn("document", F.when(F.col("ingest_date") == dt.date(2031, 1, 1), F.raise_error(F.lit("read again")))
                             .otherwise(F.col("document")))
    keep_day_schemas(spark, poisoned, f"{work}/kept")
    assert spark.read.parquet(f"{work}/kept").count() == 2


def test_contract_types(spark):
    kind = as_contract(kind_of("OBJECT<a: DECIMAL(21,1), `b.c`: VOID, d: ARRAY<OBJECT<e: VARIANT>>, f: BOOLEAN>"))
    assert kind.simpleString() == "struct<a:double,b.c:string,d:array<struct<e:string>>,f:boolean>"
    assert isinstance(kind, StructType)


def test_no_documents(spark):
    assert day_schemas(spark.createDataFrame([], "ingest_date date, document string")).collect() == []
