"""The raw zone with variant documents: what is kept, read back and pruned."""

import datetime as dt
import glob
import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from strata import inputs as I
from strata.operators.envelope import event_columns, land_events
from strata.sources.raw import as_text, document_keys, read_raw_variant, write_raw, write_raw_variant, read_raw

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2031, 7, 4)
BODIES = ['{"Type":"A","n":1,"deep":{"x":[1,2.5,null]}}', '{"Type":"A","n":"text","more":true}', '{"Type":"B","n":1e400}', "{cut", "[1]", "",
          '{"Type":null,"in":{"k":1,"k":2}}', '{"Type":"C","n":12345678901234567890123456789012345678901234567890}', '{"Type":"D","n":1,"n":2}']


def landed(spark, bodies):
    rows = [(b, 0, i) for i, b in enumerate(bodies)]
    df = spark.createDataFrame(rows, "body string, partition long, sequenceNumber long")
    return land_events(event_columns(df.withColumn("body", F.encode("body", "UTF-8"))), F.lit(DAY))


def test_every_row_is_kept_as_the_text_zone_keeps_it(spark, work):
    write_raw_variant(landed(spark, BODIES), f"{work}/v")
    write_raw(landed(spark, BODIES), f"{work}/t")
    got = {r.sequenceNumber: r for r in as_text(read_raw_variant(spark, f"{work}/v")).collect()}
    want = {r.sequenceNumber: r for r in read_raw(spark, f"{work}/t").collect()}
    assert set(got) == set(want) == set(range(len(BODIES)))
    for i, w in want.items():
        g = got[i]
        assert (g.event_type, g.ingest_date, g.BronzeCreatedAt, g.partition) == (w.event_type, w.ingest_date, w.BronzeCreatedAt, w.partition)
        assert g.document == w.document or json.loads(g.document) == json.loads(w.document)
    assert not got[3].stamped and got[0].stamped


def test_keys_are_read_from_their_own_columns(spark, work):
    msgs = I.event_messages(I.table(spark, SF, "events"))
    write_raw_variant(land_events(event_columns(msgs), F.lit(DAY)), f"{work}/v")
    raw = read_raw_variant(spark, f"{work}/v")
    keys = document_keys(raw, {"t": ("$.Type", "string"), "u": (f"$.{I.EVENT_PAYLOAD}.user_id", "long")}, "sequenceNumber")
    want = {r.event_id: (r.event_type.capitalize(), r.user_id) for r in I.table(spark, SF, "events").collect()}
    assert {r.sequenceNumber: (r.t, r.u) for r in keys.collect()} == want
    import contextlib
    import io
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        keys.explain("formatted")
    read = next(line for line in buf.getvalue().splitlines() if line.startswith("ReadSchema"))
    assert "variant" not in read and "string" in read and "text" not in read
    file = glob.glob(f"{work}/v/*/*/*.parquet".replace("file:", ""))[0]
    names = [c.path for c in (pq.ParquetFile(file).schema.column(i) for i in range(len(pq.ParquetFile(file).schema)))]
    assert any("typed_value.Type" in n for n in names) and any("user_id.typed_value" in n for n in names)
