"""Monitoring and serving-model queries."""

import datetime as dt

from strata.operators import monitor as M
from strata.operators import serve as S


def test_files_per_folder_strips_root_literally(spark, work):
    df = spark.createDataFrame([("a", 1)], "x string, y int")
    for sub in ("t=1/d=2", "t=1/d=3"):
        df.coalesce(1).write.parquet(f"{work}/root.x/{sub}")
    files = M.list_files(spark, f"{work}/root.x", glob="*.parquet")
    assert files.columns == ["path", "length", "modificationTime"]
    out = {r.folder: r.files for r in M.files_per_folder(files, root=f"{work}/root.x").collect()}
    assert out == {"/t=1/d=2": 1, "/t=1/d=3": 1}
    assert M.total_files(files).first()[0] == 2


def test_days_from_text_and_typed_stamps(spark):
    df = spark.createDataFrame([("k", "2025-03-04T10:00:00"), ("k", "2025-3-4"), ("j", "2025-03-05")],
                               "GainID string, BronzeCreatedAt string")
    assert {r.GainID: r.row_count for r in
            M.duplicates_on_day(df, "GainID", "BronzeCreatedAt", "2025-03-04").collect()} == {"k": 2}
    ts = spark.createDataFrame([(dt.datetime(2025, 3, 4, 23, 59),), (dt.datetime(2025, 3, 5),)], "t timestamp")
    assert M.on_day(ts, "t", "2025-03-04").count() == 1
    days = M.rows_per_day(df, "BronzeCreatedAt").collect()
    assert [(r.day, r.row_count) for r in days] == [(dt.date(2025, 3, 4), 2),
                                                                  (dt.date(2025, 3, 5), 1)]


def test_relate_keeps_lonely_parents(spark):
    main = spark.createDataFrame([("A", 1), ("B", 2)], "GainID string, v int")
    child = spark.createDataFrame([("A", "x"), ("A", "y"), ("Z", "orphan")], "Instrument_GainID string, c string")
    out = sorted((r.GainID, r.c) for r in S.relate(main, child, "GainID", "Instrument_GainID").collect())
    assert out == [("A", "x"), ("A", "y"), ("B", None)]


def test_report_queries(spark):
    now = dt.datetime(2025, 3, 4, 12)
    main = spark.createDataFrame(
        [("1", "s1", "L1", "Update", now), ("2", "s2", "L2", "Update", now - dt.timedelta(days=1)),
         ("3", "s3", "L3", "Create", now), (None, "s4", "L4", None, now)],
        "GainID string, ShortName string, LongName string, MetaData_ChangeType string, "
        "MetaData_GoldCreatedAt timestamp")
    assert [tuple(r) for r in S.imports_by_change_type(main).collect()] == [
        ("Update", 2), ("Create", 1), (None, 0)]
    assert S.total_imports(main).first()[0] == 3
    assert [r.imports for r in S.import_timeline(main).collect()] == [1, 3]
    detail = S.import_detail(main, "2025-03-04", {"LongName": ["L1", "L3"], "ShortName": []})
    assert detail.columns == ["GainID", "ShortName", "MetaData_GoldCreatedAt"]
    assert sorted(r.GainID for r in detail.collect()) == ["1", "3"]
    m = S.default_measures(spark.createDataFrame([(1.0, 2, "x")], "IssuePrice double, LegNo bigint, s string"),
                           S.INSTRUMENT_DEFAULT_SUMS)
    assert m.columns == ["sum_IssuePrice", "sum_LegNo"]


def test_serving_model_relates_every_child(spark, work):
    from pyspark.sql import functions as F

    from strata.plans.publish import publish_entity
    from strata.plans.spec import EntitySpec
    spec = EntitySpec(name="Instrument", key="GainID", buckets=2, ties=())
    df = spark.createDataFrame(
        [(("2025-01-01",), "A", [("EUR",)], [("X", "1")]), (("2025-01-01",), "B", [], None)],
        "MetaData struct<PublicationDate:string>, GainID string, QuoteCurrency array<struct<Currency:string>>, "
        "InstrumentIdentifiers array<struct<GainID:string, ID_Value:string>>")
    publish_entity(spark, df, spec, work, stamp=F.current_timestamp())
    model = S.serving_model(spark, work, "Instrument", "GainID",
                            ["Instrument_QuoteCurrency", "Instrument_InstrumentIdentifiers"])
    assert sorted(model) == ["Instrument_InstrumentIdentifiers", "Instrument_QuoteCurrency"]
    q = sorted((r.GainID, r.Currency) for r in model["Instrument_QuoteCurrency"].collect())
    assert q == [("A", "EUR"), ("B", None)]
    ids = spark.sql("SELECT Instrument_GainID, GainID, ID_Value FROM Instrument_InstrumentIdentifiers").collect()
    assert [tuple(r) for r in ids] == [("A", "X", "1")]


def test_bad_text_stamps_do_not_fail_monitors(spark):
    df = spark.createDataFrame([("k", "2025-03-04T10:00:00"), ("k", "garbage"), ("j", None)],
                               "GainID string, BronzeCreatedAt string")
    got = {r.day: r.row_count for r in M.rows_per_day(df, "BronzeCreatedAt").collect()}
    assert got == {dt.date(2025, 3, 4): 1, None: 2}
    assert M.duplicates_on_day(df, "GainID", "BronzeCreatedAt", "2025-03-04").count() == 1


def test_import_detail_defaults_to_today(spark):
    from pyspark.sql import functions as F
    main = spark.range(3).select(F.col("id").cast("string").alias("GainID"),
                                 F.lit("s").alias("ShortName"),
                                 F.when(F.col("id") < 2, F.current_timestamp())
                                  .otherwise(F.current_timestamp() - F.expr("INTERVAL 2 DAYS"))
                                  .alias("MetaData_GoldCreatedAt"))
    assert sorted(r.GainID for r in S.import_detail(main).collect()) == ["0", "1"]
    plan = S.import_detail(main)._jdf.queryExecution().optimizedPlan().toString()
    assert "current_date" not in plan       # folded to a literal before execution


def test_observed_row_count_comes_with_the_write(spark):
    df, obs = M.observe_rows(spark.range(1234), "probe")
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 1234
