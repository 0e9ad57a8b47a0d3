"""JSON document folders in the one-document-per-file layout, batch and stream."""

import json
import os
from collections import Counter

from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from strata.operators.monitor import distinct_files, first_file
from strata.plans.conform import conform_documents
from strata.registry import write_each
from strata.sources.raw import json_documents
from strata.sources.tables import append_table, read_table
from strata.streaming.jobs import stop_all

CONTRACT = StructType([
    StructField("Type", StringType(), True),
    StructField("PublicationDate", StringType(), False),
    StructField("Instrument", StructType([StructField("GainID", StringType(), True),
                                          StructField("LegNo", LongType(), True)]), True),
    StructField("BronzeCreatedAt", StringType(), True),
])


def _write_docs(root):
    docs = {
        "instrument/2025/03/11/event_0_1.json": {"Type": "Instrument", "PublicationDate": "2025-03-10",
                                                 "Instrument": {"GainID": "G1", "LegNo": 1},
                                                 "BronzeCreatedAt": "2025-03-11T14:52:53"},
        "instrument/2025/03/11/event_0_2.json": {"Type": "Instrument", "PublicationDate": "2025-03-11",
                                                 "Instrument": {"GainID": "G2", "LegNo": 2}},
        "instrument/2025/03/12/event_1_3.json": {"Type": "Instrument",
                                                 "Instrument": {"GainID": "G3"}},
    }
    for rel, doc in docs.items():
        p = os.path.join(root, rel)
        os.makedirs(os.path.dirname(p), exist_ok=True)
        with open(p, "w") as fh:
            json.dump(doc, fh, indent=2)
    with open(os.path.join(root, "instrument/2025/03/12/event_1_4.json"), "w") as fh:
        fh.write('{"Type": "Instrument",\n  "PublicationDate": ')


def test_multiline_documents_batch(spark, work):
    root = work.replace("file:", "") + "/bronze"
    _write_docs(root)
    parsed = json_documents(spark, f"{root}/instrument/*/*/*/*.json", CONTRACT, multi_line=True)
    good, bad = conform_documents(parsed, CONTRACT, "Instrument", F.lit("2025-03-11 15:00:00"))
    assert sorted(r.GainID for r in good.collect()) == ["G1", "G2"]
    assert good.columns == ["MetaData", "GainID", "LegNo", "ingest_date"]
    assert good.schema["MetaData"].dataType.names == ["Type", "PublicationDate", "BronzeCreatedAt",
                                                     "SilverCreatedAt", "SourcePartition", "SourceSequenceNumber",
                                                     "SourceFile"]
    assert all(r.f.endswith(".json") for r in good.select(F.col("MetaData.SourceFile").alias("f")).collect())
    reasons = sorted(r._reject_reason for r in bad.collect())
    assert reasons == ["malformed or mistyped document", "required field missing: PublicationDate"]
    assert distinct_files(parsed).count() == 4
    assert first_file(parsed).first()[0].endswith("2025/03/11/event_0_1.json")


def test_multiline_documents_stream_one_file_per_trigger(spark, work):
    root = work.replace("file:", "") + "/bronze"
    _write_docs(root)
    out = f"{work}/silver"
    src = json_documents(spark, f"{root}/instrument/*/*/*/*.json", CONTRACT, stream=True,
                         max_files_per_trigger=1)
    batches = []

    def on_batch(df, batch_id):
        good, _ = conform_documents(df, CONTRACT, "Instrument")
        append_table(good, out)
        batches.append(batch_id)

    q = (src.writeStream.foreachBatch(on_batch).option("checkpointLocation", f"{work}/chk")
         .trigger(availableNow=True).start())
    q.awaitTermination(120)
    stop_all(spark)
    assert len(batches) == 4
    assert sorted(r.GainID for r in read_table(spark, out).collect()) == ["G1", "G2"]


def test_files_of_one_document_are_dealt_over_tasks(spark, work):
    """Rows of one partition: no task writes more files than asked for, but for what dealing is off by."""
    rows = spark.range(95).coalesce(1).select(F.concat(F.lit("doc\n"), "id").alias("value"))
    write_each(rows, f"{work}/docs", files_per_task=10)
    names = [n for n in os.listdir(work.replace("file:", "") + "/docs") if n.endswith(".txt")]
    by_task = Counter(n.split("-")[1] for n in names)
    assert len(names) == 95 and len(by_task) == 10 and max(by_task.values()) <= 12
    got = spark.read.text(f"{work}/docs", wholetext=True).collect()
    assert sorted(r[0].strip() for r in got) == sorted(f"doc\n{i}" for i in range(95))
    write_each(rows.where("false"), f"{work}/none")
    assert spark.read.text(f"{work}/none").count() == 0
