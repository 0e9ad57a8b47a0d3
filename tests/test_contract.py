"""Contracts: parsing, quarantine reasons, reports, files."""

import json

from pyspark.sql.types import (ArrayType, LongType, StringType, StructField, StructType)

from strata.operators.contract import (contract_report, enforce, infer_contract, load_contract,
                                       parse_documents, save_contract)

CONTRACT = StructType([
    StructField("Type", StringType(), True),
    StructField("PublicationDate", StringType(), False),
    StructField("Item", StructType([
        StructField("Id", StringType(), False),
        StructField("Size", LongType(), True),
        StructField("Tags", ArrayType(StructType([StructField("T", StringType(), False)])), True),
    ]), True),
])


def _route(spark, docs):
    df = spark.createDataFrame(list(enumerate(docs)), "n int, document string")
    good, bad = enforce(parse_documents(df, CONTRACT), CONTRACT)
    return ({r.n for r in good.collect()},
            {r.n: r._reject_reason for r in bad.collect()})


def test_contract_breaks(spark):
    docs = [
        json.dumps({"Type": "a", "PublicationDate": "2025-01-01", "Item": {"Id": "x", "Size": 1}}),
        json.dumps({"Type": "a", "Item": {"Id": "x"}}),                       # required missing
        json.dumps({"PublicationDate": "p", "Item": {"Id": "x", "Tags": "notarray"}}),  # mistyped
        json.dumps({"PublicationDate": 5, "Item": {"Id": 7}}),                 # number for string
        json.dumps({"PublicationDate": "p", "Extra": 1, "Item": {"Id": "x"}}),  # extra field
        json.dumps({"PublicationDate": "p", "Item": {"Size": 3}}),             # nested required
        json.dumps({"PublicationDate": "p", "Item": {"Id": "y", "Tags": [{"T": None}]}}),
        "{bad",
        json.dumps({"PublicationDate": "p"}),                                  # optional parent absent
    ]
    good, bad = _route(spark, docs)
    assert good == {0, 3, 4, 8}
    assert bad[1] == "required field missing: PublicationDate"
    assert bad[2] == "malformed or mistyped document"
    assert bad[5] == "required field missing: Item.Id"
    assert bad[6] == "required field missing: Item.Tags[].T"
    assert bad[7] == "malformed or mistyped document"


def test_report_lists_every_difference(spark):
    actual = StructType([
        StructField("Item", StructType([StructField("Id", LongType(), True)]), True),
        StructField("Type", StringType(), True),
        StructField("PublicationDate", StringType(), True),
        StructField("New", StringType(), True),
    ])
    rows = {(r.path, r.issue) for r in contract_report(spark, actual, CONTRACT).collect()}
    assert ("Item.Id", "type") in rows and ("Item.Id", "nullability") in rows
    assert ("Item.Size", "missing") in rows and ("New", "extra") in rows
    assert ("PublicationDate", "nullability") in rows and ("<root>", "order") in rows
    assert contract_report(spark, CONTRACT, CONTRACT).count() == 0


def test_contract_files_and_inference(spark, work):
    save_contract(spark, CONTRACT, f"{work}/contract")
    assert load_contract(spark, f"{work}/contract") == CONTRACT
    folder = f"{work}/docs"
    spark.createDataFrame([('{"a": 1, "b": {"c": "x"}}',), ('{"a": 2, "d": [1]}',), ("{bad",)],
                          "value string").coalesce(1).write.text(folder)
    inferred = infer_contract(spark, folder, multi_line=False)
    assert inferred.fieldNames() == ["a", "b", "d"]


def test_first_landing_keeps_rows_without_identity(spark):
    import datetime as dt

    from strata.plans.conform import first_landing
    t1, t2 = dt.datetime(2025, 1, 1), dt.datetime(2025, 1, 2)
    raw = spark.createDataFrame(
        [(0, 1, t2, "d"), (0, 1, t1, "d"), (None, None, t1, "x"), (None, None, t1, "y"), (0, None, t1, "z")],
        "partition bigint, sequenceNumber bigint, BronzeCreatedAt timestamp, document string")
    out = [(r.partition, r.sequenceNumber, r.BronzeCreatedAt, r.document)
           for r in first_landing(raw).collect()]
    assert len(out) == 4 and (0, 1, t1, "d") in out and (0, 1, t2, "d") not in out
    assert {d for *_, d in out} == {"d", "x", "y", "z"}


def test_conformed_schema_matches_what_conform_writes(spark):
    import datetime as dt

    from pyspark.sql import functions as F

    from strata import inputs as I
    from strata.operators.contract import relax
    from strata.operators.envelope import event_columns, land_events
    from strata.plans.conform import conform, conformed_schema
    msgs = I.event_messages(I.table(spark, "/root/testdata/sf0.001", "events"))
    landed = land_events(event_columns(msgs), F.lit(dt.datetime(2025, 3, 11)))
    good, _ = conform(spark, landed, I.EVENT_CONTRACT, I.EVENT_PAYLOAD)
    assert relax(good.schema) == relax(conformed_schema(I.EVENT_CONTRACT, I.EVENT_PAYLOAD))
