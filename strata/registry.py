"""Registered queries: one per operator group of the inventory, each with the
DuckDB SQL that computes the same result from the same tables.

Every query reads whole driver tables (or data Spark derives from them);
queries that write (upsert, conform, streams) write under the session's
shared checkpoint folder.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable
from functools import reduce

from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (IntegerType, LongType, StringType, StructField, StructType,
                               TimestampType)

from strata import inputs as I
from strata.functions.docs import json_key, raw_document_path
from strata.operators import flatten as FL
from strata.operators import monitor as M
from strata.operators import serve as S
from strata.operators.contract import (REASON, conformance_counts, contract_report, enforce, infer_contract,
                                       load_contract, parse_documents, save_contract)
from strata.operators.envelope import event_columns, land_events, split_envelope
from strata.operators.inference import as_contract, keep_day_schemas, kept_kind, leaves
from strata.operators.intervals import BLOCK_BITS, merged, size
from strata.operators.latest import latest_per_key, split_null_keys
from strata.operators.model import Model, measures
from strata.operators.upsert import bucket_sizes, lookup, read_children, read_main, stored_layout
from strata.pipeline import BUCKETS, EVENT_SPEC, finish, run_event_streams
from strata.plans.conform import append_conformed, conform, conform_batch, conform_tagged, conformed_schema, tag
from strata.plans.ledger import IdentityLedger
from strata.plans.publish import main_table, publish_entity
from strata.plans.spec import EntitySpec
from strata.plans.workoff import closed_rejects, work_off
from strata.session import work_dir
from strata.sources.events import event_stream, file_events
from strata.sources.hub import append_log, hub_messages, hub_stream, log_positions
from strata.sources.raw import as_text, document_keys, json_documents, read_raw, read_raw_variant, write_raw, write_raw_variant
from strata.sources.tables import path_exists, read_table, register_view
from strata.streaming.jobs import run_conform, run_conform_documents, run_raw, stop_all, trigger_options
from strata.streaming.monitors import read_rows_per_day, run_rows_per_day, uncounted
from strata.streaming.progress import ProgressTable, read_progress

# Fixed parameters of the registered queries (no wall clock in a compared result).
FIXED_STAMP = _dt.datetime(2031, 7, 4, 5, 6, 7)
DUP_DAY = "2024-01-15"
DETAIL_DAY = "2024-01-30"
DETAIL_TYPES = ("click", "view")

# the conformed event table's schema, known from the contract (no footer scans)
CONFORMED_EVENTS = conformed_schema(I.EVENT_CONTRACT, I.EVENT_PAYLOAD)



# ------------------------------------------------------------------ events
def q_latest_per_key(spark, sf):
    ev = I.table(spark, sf, "events")
    return latest_per_key(ev, "user_id", ["ts"], ["event_id"])


SQL_LATEST_PER_KEY = """
SELECT event_id, ts, user_id, event_type, value, props FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST,
                                                       event_id DESC NULLS LAST) = 1
"""


def q_latest_props(spark, sf):
    """Flagship: latest event per user with its parsed ``props.k``."""
    latest = q_latest_per_key(spark, sf)
    return latest.select("user_id", "event_id", "ts", "event_type", "value",
                         json_key("props", "$.k", "int").alias("k"))


SQL_LATEST_PROPS = """
SELECT user_id, event_id, ts, event_type, value,
       CAST(json_extract_string(props, '$.k') AS INTEGER) AS k
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


def q_parse_json_field(spark, sf):
    ev = I.table(spark, sf, "events")
    return ev.select("event_id", json_key("props", "$.k", "int").alias("k"))


SQL_PARSE_JSON_FIELD = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events
"""


def q_rows_per_day(spark, sf):
    return M.rows_per_day(I.table(spark, sf, "events"), "ts")


SQL_ROWS_PER_DAY = """
SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1 ORDER BY 1
"""


def q_duplicates_on_day(spark, sf):
    return M.duplicates_on_day(I.table(spark, sf, "events"), "user_id", "ts", DUP_DAY)


SQL_DUPLICATES_ON_DAY = f"""
SELECT user_id, count(*) AS row_count FROM events
WHERE ts >= TIMESTAMP '{DUP_DAY} 00:00:00' AND ts < TIMESTAMP '{DUP_DAY} 00:00:00' + INTERVAL 1 DAY
GROUP BY user_id
"""


def q_null_key_quarantine(spark, sf):
    ev = I.table(spark, sf, "events")
    ev = ev.withColumn("user_id", F.when(F.pmod("event_id", F.lit(7)) == 0, F.lit(None))
                       .otherwise(F.col("user_id")))
    good, bad = split_null_keys(ev, "user_id")
    return (good.select("event_id", F.lit("accepted").alias("route"),
                        F.lit(None).cast("string").alias("reason"))
            .unionByName(bad.select("event_id", F.lit("quarantine").alias("route"),
                                    F.col("_reject_reason").alias("reason"))))


SQL_NULL_KEY_QUARANTINE = """
SELECT event_id,
       CASE WHEN event_id % 7 = 0 THEN 'quarantine' ELSE 'accepted' END AS route,
       CASE WHEN event_id % 7 = 0 THEN 'null business key' END AS reason
FROM events
"""


# ------------------------------------------------------------------ raw / envelope
def q_decode_and_stamp(spark, sf):
    """Hub messages (every 13th body cut short) decoded, stamped,
    typed and dated; keys of the stamped document read back."""
    msgs = I.event_messages(I.table(spark, sf, "events"))
    msgs = msgs.withColumn("body", F.when(F.pmod("sequenceNumber", F.lit(13)) == 0,
                                          F.substring("body", 1, 20)).otherwise(F.col("body")))
    landed = land_events(event_columns(msgs), F.lit(FIXED_STAMP))
    # the stamped document is parsed once; a body that is no object has no keys to read
    read = landed.withColumn("__m", F.when(F.col("stamped"), F.from_json("document", "map<string,variant>")))
    key = lambda name: F.try_variant_get(F.try_element_at("__m", F.lit(name)), "$", "string")
    return read.select(
        "partition", "sequenceNumber", "event_type", "ingest_date", "stamped",
        key("Type").alias("doc_type"), key("BronzeCreatedAt").alias("doc_stamp"),
        F.when(F.col("stamped"), F.size(F.map_keys("__m"))).alias("doc_keys"),
        raw_document_path("/raw", "event_type", "BronzeCreatedAt", "partition",
                          "sequenceNumber").alias("raw_path"))


SQL_DECODE_AND_STAMP = """
WITH e AS (SELECT event_id, event_type, event_id % 13 = 0 AS broken,
                  upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS typ FROM events)
SELECT event_id % 4 AS partition, event_id AS sequenceNumber,
       CASE WHEN broken THEN 'unknown' ELSE lower(event_type) END AS event_type,
       DATE '2031-07-04' AS ingest_date,
       NOT broken AS stamped,
       CASE WHEN broken THEN NULL ELSE typ END AS doc_type,
       CASE WHEN broken THEN NULL ELSE '2031-07-04T05:06:07' END AS doc_stamp,
       CAST(CASE WHEN broken THEN NULL ELSE 6 END AS INTEGER) AS doc_keys,
       '/raw/' || CASE WHEN broken THEN 'unknown' ELSE lower(event_type) END
         || '/2031/07/04/event_' || CAST(event_id % 4 AS VARCHAR) || '_'
         || CAST(event_id AS VARCHAR) || '.json' AS raw_path
FROM e
"""


def q_envelope_split(spark, sf):
    """Documents parsed under the contract; envelope packed in
    ``MetaData``, payload promoted; flattened for comparison."""
    docs = I.event_document(I.table(spark, sf, "events"))
    parsed = parse_documents(docs.select("sequenceNumber", "doc"), I.EVENT_CONTRACT, doc="doc",
                             keep=[])
    good, _ = enforce(parsed, I.EVENT_CONTRACT)
    return FL.flatten_structs(split_envelope(good, I.EVENT_PAYLOAD))


SQL_ENVELOPE_SPLIT = """
SELECT event_type AS MetaData_ChangeType, 'events' AS MetaData_Model,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS MetaData_PublicationDate,
       upper(substr(event_type, 1, 1)) || substr(event_type, 2) AS MetaData_Type,
       CAST(NULL AS VARCHAR) AS MetaData_BronzeCreatedAt,
       event_id, user_id, event_type, value, props
FROM events
"""


# ------------------------------------------------------------------ flatten / arrays
def q_flatten_nested(spark, sf):
    return FL.flatten_structs(I.orders_with_customer(spark, sf))


SQL_FLATTEN_NESTED = """
SELECT o.*, c.c_custkey AS customer_c_custkey, c.c_name AS customer_c_name,
       c.c_nationkey AS customer_c_nationkey, c.c_acctbal AS customer_c_acctbal,
       c.c_mktsegment AS customer_c_mktsegment,
       n.n_nationkey AS customer_nation_n_nationkey, n.n_name AS customer_nation_n_name,
       n.n_regionkey AS customer_nation_n_regionkey,
       r.r_regionkey AS customer_nation_region_r_regionkey,
       r.r_name AS customer_nation_region_r_name
FROM orders o LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
"""


def q_explode_struct_array(spark, sf):
    return FL.explode_child(I.line_documents(spark, sf), "doc_id", "lines", "Documents").drop("words")


_LINES = """
lines AS (SELECT doc_id, generate_subscripts(l, 1) - 1 AS pos, unnest(l) AS line
          FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents))"""


def _uid(*parts: str) -> str:
    """The row id in SQL: each part as length:value."""
    texts = (f"CAST({p} AS VARCHAR)" for p in parts)
    return "sha256(concat_ws(chr(31), " + ", ".join(f"length({t}) || ':' || {t}" for t in texts) + "))"


SQL_EXPLODE_STRUCT_ARRAY = f"""
WITH {_LINES}
SELECT doc_id AS Documents_doc_id, CAST(pos AS INTEGER) AS MetaData_Position, line,
       CAST(length(line) AS INTEGER) AS chars, {_uid("doc_id", "'lines'", "pos")} AS MetaData_GoldUniqueId
FROM lines
"""


def q_expand_struct(spark, sf):
    """One struct column opened, the struct inside it kept."""
    nested = I.orders_with_customer(spark, sf)
    open_ = FL.expand_struct(nested, "customer", prefix="cust_")
    return open_.select("o_orderkey", "cust_c_custkey", "cust_c_name",
                        F.col("cust_nation").getField("n_name").alias("nation_name"))


SQL_EXPAND_STRUCT = """
SELECT o_orderkey, c_custkey AS cust_c_custkey, c_name AS cust_c_name, n_name AS nation_name
FROM orders LEFT JOIN customer ON o_custkey = c_custkey LEFT JOIN nation ON c_nationkey = n_nationkey
"""


def q_drop_arrays(spark, sf):
    """A written nested table read as a main table without its array; the
    array's own read counts the lines beside it."""
    path = f"{work_dir(spark, 'nested')}/documents"
    I.line_documents(spark, sf).write.parquet(path)
    nested = spark.read.parquet(path)
    lines = FL.explode_child(nested, "doc_id", "lines", "Documents")
    count = lines.groupBy("Documents_doc_id").agg(F.count("*").alias("n_lines"))
    main = FL.drop_arrays(nested)
    return main.join(count, main["doc_id"] == count["Documents_doc_id"], "left").drop("Documents_doc_id")


SQL_DROP_ARRAYS = """
SELECT doc_id, lang, source, len(string_split(text, chr(10))) AS n_lines FROM documents
"""


def q_explode_scalar_array(spark, sf):
    emb = I.table(spark, sf, "embeddings")
    return FL.explode_child(emb, "vec_id", "embedding", "Embeddings").drop(FL.UID_COL)


SQL_EXPLODE_SCALAR_ARRAY = """
SELECT vec_id AS Embeddings_vec_id,
       CAST(generate_subscripts(embedding, 1) - 1 AS INTEGER) AS MetaData_Position,
       unnest(embedding) AS embedding
FROM embeddings
"""


def q_explode_turns(spark, sf):
    """Child frames of every array of a row; the words of each turn."""
    return FL.child_frames(I.turn_words(spark, sf), "turn_id", "Turns")["words"].drop(FL.UID_COL)


SQL_EXPLODE_TURNS = """
SELECT turn_id AS Turns_turn_id, CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS MetaData_Position,
       unnest(w) AS words
FROM (SELECT conv_id || '-' || turn AS turn_id, string_split(text, ' ') AS w FROM conversations)
"""


def q_explode_nested_arrays(spark, sf):
    """Q11 option, B14: arrays inside array elements become their own child
    table; a word row carries the document key, its line's position and its own."""
    return FL.nested_child_frames(I.line_documents(spark, sf), "doc_id", "Documents")["Documents_lines_words"]


SQL_EXPLODE_NESTED_ARRAYS = f"""
WITH {_LINES},
words AS (SELECT doc_id, pos, list_filter(string_split(line, ' '), lambda w: w <> '') AS w FROM lines)
SELECT doc_id AS Documents_doc_id, CAST(pos AS INTEGER) AS lines_Position,
       CAST(generate_subscripts(w, 1) - 1 AS INTEGER) AS MetaData_Position, unnest(w) AS words
FROM words
"""


# ------------------------------------------------------------------ serving model
def q_model_view(spark, sf):
    """Main rows related to their child rows, main rows without any kept."""
    return S.relate(I.table(spark, sf, "orders"), I.table(spark, sf, "lineitem"), "o_orderkey", "l_orderkey")


SQL_MODEL_VIEW = "SELECT * FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey"


def q_default_measures(spark, sf):
    li = I.table(spark, sf, "lineitem")
    m = S.default_measures(li, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"],
                           by=["l_returnflag", "l_linestatus"])
    return m.select("l_returnflag", "l_linestatus",
                    *[F.round(c, 2).alias(c) for c in m.columns if c.startswith("sum_")])


SQL_DEFAULT_MEASURES = """
SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_l_quantity,
       round(sum(l_extendedprice), 2) AS sum_l_extendedprice,
       round(sum(l_discount), 2) AS sum_l_discount, round(sum(l_tax), 2) AS sum_l_tax
FROM lineitem GROUP BY 1, 2
"""


def q_model_measures(spark, sf):
    """Customers with two child tables that are measured (their orders, the
    lines of these) and a third that is filtered (lines sent back), by market segment; no child
    multiplies another's rows, and both filters hold for all tables."""
    orders, lines = I.table(spark, sf, "orders"), I.table(spark, sf, "lineitem")
    owned = lines.join(orders.select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    model = Model(I.table(spark, sf, "customer"), "c_custkey",
                  {"orders": (orders, "o_custkey"), "lines": (owned, "o_custkey"), "returns": (owned.where("l_returnflag = 'R'"), "o_custkey")})
    got = measures(model, ["c_mktsegment"],
                   {"main": {"customers": F.count("*"), "balance": F.sum("c_acctbal")},
                    "orders": {"orders": F.count("*"), "total": F.sum("o_totalprice")},
                    "lines": {"lines": F.count("*"), "quantity": F.sum("l_quantity")}},
                   {"main": F.col("c_acctbal") > 0, "returns": F.col("l_quantity") >= 45})
    return got.select("c_mktsegment", "customers", "orders", "lines", *[F.round(c, 2).alias(c) for c in ("balance", "total", "quantity")])


SQL_MODEL_MEASURES = """
WITH owned AS (SELECT l.*, o_custkey FROM lineitem l JOIN orders ON l_orderkey = o_orderkey),
kept AS (SELECT * FROM customer WHERE c_acctbal > 0
         AND c_custkey IN (SELECT o_custkey FROM owned WHERE l_returnflag = 'R' AND l_quantity >= 45)),
m AS (SELECT c_mktsegment, count(*) AS customers, round(sum(c_acctbal), 2) AS balance FROM kept GROUP BY 1),
o AS (SELECT c_mktsegment, count(*) AS orders, round(sum(o_totalprice), 2) AS total FROM orders JOIN kept ON o_custkey = c_custkey GROUP BY 1),
l AS (SELECT c_mktsegment, count(*) AS lines, round(sum(l_quantity), 2) AS quantity FROM owned JOIN kept ON o_custkey = c_custkey GROUP BY 1)
SELECT c_mktsegment, customers, orders, lines, balance, total, quantity FROM m JOIN o USING (c_mktsegment) JOIN l USING (c_mktsegment)
"""


LOOKUP_KEYS = [0, 7, 77, 777, 999, -5, 10**9]
LOOKUP_SPEC = EntitySpec(name="Found", key="event_id", bucket_bytes=64 << 10, ties=(), lookups=("user_id",))


def q_lookup_by_value(spark, sf):
    """All events in a serving table with Bloom filters on its key and users; the events
    of some keys, some of them unknown, and those of the busiest user."""
    root = f"{work_dir(spark, 'lookup')}/serving"
    ev = I.table(spark, sf, "events")
    publish_entity(spark, ev.select(F.struct(F.col("ts").alias("PublicationDate")).alias("MetaData"), "event_id", "user_id", "event_type"),
                   LOOKUP_SPEC, root, stamp=F.lit(FIXED_STAMP))
    busiest = ev.groupBy("user_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "user_id").first()["user_id"]
    table = main_table(LOOKUP_SPEC, root)
    by_key = lookup(spark, table, LOOKUP_KEYS).withColumn("by", F.lit("key"))
    by_user = lookup(spark, table, [], user_id=[busiest]).withColumn("by", F.lit("user"))
    return by_key.union(by_user).select("by", "event_id", "user_id", "event_type")


SQL_LOOKUP_BY_VALUE = f"""
WITH busiest AS (SELECT user_id FROM events GROUP BY user_id ORDER BY count(*) DESC, user_id LIMIT 1)
SELECT 'key' AS by, event_id, user_id, event_type FROM events WHERE event_id IN {tuple(LOOKUP_KEYS)}
UNION ALL SELECT 'user', event_id, user_id, event_type FROM events WHERE user_id = (SELECT user_id FROM busiest)
"""


def q_imports_by_change_type(spark, sf):
    return S.imports_by_change_type(q_latest_per_key(spark, sf), col="event_type")


SQL_LATEST_CTE = """
WITH latest AS (SELECT * FROM events QUALIFY row_number() OVER
  (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
"""

SQL_IMPORTS_BY_CHANGE_TYPE = SQL_LATEST_CTE + """
SELECT event_type, count(event_type) AS imports FROM latest GROUP BY 1 ORDER BY 2 DESC, 1
"""


def q_total_imports(spark, sf):
    return S.total_imports(q_latest_per_key(spark, sf), key="user_id")


SQL_TOTAL_IMPORTS = SQL_LATEST_CTE + "SELECT count(user_id) AS imports FROM latest"


def q_import_timeline(spark, sf):
    return S.import_timeline(q_latest_per_key(spark, sf), stamp="ts")


SQL_IMPORT_TIMELINE = SQL_LATEST_CTE + """
SELECT ts, count(ts) AS imports FROM latest GROUP BY 1 ORDER BY 1
"""


def q_import_detail(spark, sf):
    return S.import_detail(q_latest_per_key(spark, sf), DETAIL_DAY,
                           filters={"event_type": DETAIL_TYPES, "user_id": []},
                           columns=("user_id", "event_type", "ts"), stamp="ts")


SQL_IMPORT_DETAIL = SQL_LATEST_CTE + f"""
SELECT user_id, event_type, ts FROM latest
WHERE ts >= TIMESTAMP '{DETAIL_DAY} 00:00:00' AND ts < TIMESTAMP '{DETAIL_DAY} 00:00:00' + INTERVAL 1 DAY
  AND event_type IN {tuple(DETAIL_TYPES)!r}
ORDER BY ts DESC
"""



# ------------------------------------------------------------------ contract / conform
def _landed(spark, sf, stamp=FIXED_STAMP, where=None):
    msgs = I.event_messages(I.table(spark, sf, "events"))
    if where is not None:
        msgs = msgs.where(where)
    return land_events(event_columns(msgs), F.lit(stamp))


def q_bad_document_quarantine(spark, sf):
    """Broken, incomplete and mistyped documents are routed to
    quarantine with a reason; the rest is conformed."""
    docs = I.event_document(I.table(spark, sf, "events"))
    k = F.pmod(F.col("sequenceNumber"), F.lit(11))
    doc = (F.when(k == 0, F.substring("doc", 1, 25))
            .when(k == 5, F.regexp_replace("doc", '"PublicationDate":"[^"]*",', ""))
            .when(k == 7, F.regexp_replace("doc", '"value":[^,}]*', '"value":"abc"'))
            .otherwise(F.col("doc")))
    msgs = docs.select(F.encode(doc, "UTF-8").alias("body"), "partition", "sequenceNumber")
    landed = land_events(event_columns(msgs), F.lit(FIXED_STAMP))
    tagged = conform_tagged(landed, I.EVENT_CONTRACT)
    return tagged.select("sequenceNumber",
                         F.when(F.col(REASON).isNull(), "conformed").otherwise("quarantine").alias("route"),
                         F.col(REASON).alias("reason"))


SQL_BAD_DOCUMENT_QUARANTINE = """
SELECT event_id AS sequenceNumber,
       CASE WHEN event_id % 11 IN (0, 5, 7) THEN 'quarantine' ELSE 'conformed' END AS route,
       CASE WHEN event_id % 11 IN (0, 7) THEN 'malformed or mistyped document'
            WHEN event_id % 11 = 5 THEN 'required field missing: PublicationDate' END AS reason
FROM events
"""


def q_dedupe_replayed_events(spark, sf):
    """Q7: every event landed once, a third landed again a day later (some of
    those inside the same batch); the conformed table holds each event once,
    with its first landing."""
    work = work_dir(spark, "dedupe")
    conformed_path = f"{work}/conformed"
    day2 = FIXED_STAMP + _dt.timedelta(days=1)
    first = _landed(spark, sf)
    again = _landed(spark, sf, day2, F.pmod(F.col("sequenceNumber"), F.lit(3)) == 0)
    batch1 = first.unionByName(again.where(F.pmod(F.col("sequenceNumber"), F.lit(2)) == 0))
    for batch in (batch1, again):
        conform_batch(spark, batch, I.EVENT_CONTRACT, I.EVENT_PAYLOAD, conformed_path, F.lit(FIXED_STAMP))
    flat = FL.flatten_structs(read_table(spark, conformed_path, schema=CONFORMED_EVENTS))
    return flat.select("event_id", "user_id", "event_type", "value", "props",
                       "MetaData_BronzeCreatedAt", "MetaData_SourceSequenceNumber")


SQL_DEDUPE_REPLAYED_EVENTS = """
SELECT event_id, user_id, event_type, value, props,
       '2031-07-04T05:06:07' AS MetaData_BronzeCreatedAt, event_id AS MetaData_SourceSequenceNumber
FROM events
"""


def _numbered_messages(spark, sf):
    """Hub messages as a hub numbers them: 0, 1, 2 ... in each partition; every 13th
    body is cut short."""
    msgs = I.event_messages(I.table(spark, sf, "events"))
    body = F.when(F.pmod("sequenceNumber", F.lit(13)) == 0, F.substring("body", 1, 20)).otherwise(F.col("body"))
    return msgs.select(body.alias("body"), "partition", F.floor(F.col("sequenceNumber") / 4).alias("sequenceNumber"))


def q_replay_whole_history(spark, sf):
    """Q7, K4, A2: a history with holes is conformed in three batches, then all of it is
    replayed a day later: only the holes land, and every number is in the ledger, as
    maximal runs. Each event's route and landing, and its partition's ledger."""
    work = work_dir(spark, "history")
    conformed_path = f"{work}/conformed"
    msgs = _numbered_messages(spark, sf)
    number, part = F.col("sequenceNumber"), F.pmod(F.xxhash64(F.shiftright("sequenceNumber", 5)), F.lit(3))
    hole = F.pmod(number, F.lit(10)) == 3
    landed = lambda df, days: land_events(event_columns(df), F.lit(FIXED_STAMP + _dt.timedelta(days=days)))
    for b in range(3):
        conform_batch(spark, landed(msgs.where(~hole & (part == b)), 0), I.EVENT_CONTRACT, I.EVENT_PAYLOAD, conformed_path,
                      F.lit(FIXED_STAMP))
    conform_batch(spark, landed(msgs, 1), I.EVENT_CONTRACT, I.EVENT_PAYLOAD, conformed_path, F.lit(FIXED_STAMP))
    known = merged(IdentityLedger(spark, conformed_path).read())
    known = known.groupBy(F.col("partition").alias("p")).agg(size(known).alias("seen"), F.count("*").alias("runs"))
    good = read_table(spark, conformed_path, schema=CONFORMED_EVENTS).select(
        F.col("MetaData.SourcePartition").alias("partition"), F.col("MetaData.SourceSequenceNumber").alias("sequenceNumber"),
        F.lit("conformed").alias("route"), F.col("ingest_date").alias("landed"))
    bad = spark.read.parquet(f"{conformed_path}_quarantine").select("partition", "sequenceNumber", F.lit("quarantine"),
                                                                    F.lit(None).cast("date"))
    return good.union(bad).join(known, F.col("partition") == F.col("p")).drop("p")


SQL_REPLAY_WHOLE_HISTORY = f"""
WITH e AS (SELECT event_id % 4 AS partition, event_id // 4 AS n, event_id % 13 = 0 AS broken FROM events)
SELECT partition, CAST(n AS BIGINT) AS sequenceNumber, CASE WHEN broken THEN 'quarantine' ELSE 'conformed' END AS route,
       CASE WHEN broken THEN NULL WHEN n % 10 = 3 THEN DATE '2031-07-05' ELSE DATE '2031-07-04' END AS landed,
       CAST(count(*) OVER (PARTITION BY partition) AS BIGINT) AS seen,
       CAST(max(n >> {BLOCK_BITS}) OVER (PARTITION BY partition) + 1 AS BIGINT) AS runs
FROM e
"""

HUB_START = {"0": 10, "1": 20, "2": 30, "3": 0}


def q_replay_from_positions(spark, sf):
    """A1, A2: a hub log grows by three captures; a stream begins at a position of each
    partition, is stopped after the first, restarts twice and reads up to "now", and
    the same span is read as a batch. How often each message landed and was read."""
    work = work_dir(spark, "positions")
    log, msgs = f"{work}/hub", _numbered_messages(spark, sf).persist()
    top = msgs.agg(F.max("sequenceNumber")).first()[0]
    cuts = [0, top // 3, top // 2, top + 1]
    for lo, hi in zip(cuts, cuts[1:]):
        append_log(spark, msgs.where(F.col("sequenceNumber").between(lo, hi - 1)), log)
        src = event_stream(hub_stream(spark, log, HUB_START, log_positions(log)))
        finish(run_raw(src, f"{work}/raw", f"{work}/chk", trigger_options(available_now=True), stamp=F.lit(FIXED_STAMP), name=None))
    msgs.unpersist()
    landed = read_raw(spark, f"{work}/raw").groupBy("partition", "sequenceNumber").agg(F.count("*").alias("landed"))
    read = (hub_messages(spark, log, HUB_START, {p: top // 2 for p in HUB_START})
            .groupBy(F.col("partition").alias("p"), F.col("sequenceNumber").alias("s")).agg(F.count("*").alias("read")))
    same = (F.col("partition") == F.col("p")) & (F.col("sequenceNumber") == F.col("s"))
    return landed.join(read, same, "left").select("partition", "sequenceNumber", "landed", F.coalesce("read", F.lit(0)).alias("read"))


SQL_REPLAY_FROM_POSITIONS = f"""
WITH e AS (SELECT event_id % 4 AS partition, event_id // 4 AS n, max(event_id // 4) OVER () AS top FROM events),
s AS (SELECT partition, n, top FROM e JOIN (VALUES {", ".join(f"({p}, {at})" for p, at in HUB_START.items())}) v(p, begins) ON partition = p AND n >= begins)
SELECT partition, CAST(n AS BIGINT) AS sequenceNumber, CAST(1 AS BIGINT) AS landed, CAST(CASE WHEN n < top // 2 THEN 1 ELSE 0 END AS BIGINT) AS read
FROM s
"""

# A contract stricter than the data: value must be integral, props an object,
# and a required channel field that no document has.
STRICT_EVENT_CONTRACT = StructType([
    StructField("event_id", LongType(), False),
    StructField("ts", TimestampType(), True),
    StructField("user_id", LongType(), False),
    StructField("event_type", StringType(), True),
    StructField("value", LongType(), True),
    StructField("props", StructType([StructField("k", IntegerType(), True)]), True),
    StructField("channel", StringType(), False),
])


def q_contract_conformance(spark, sf):
    ev = I.table(spark, sf, "events")
    docs = ev.select(F.to_json(F.struct(*ev.columns)).alias("document"))
    return conformance_counts(docs, STRICT_EVENT_CONTRACT)


SQL_CONTRACT_CONFORMANCE = """
WITH n AS (SELECT count(*) AS total, count(event_id) AS ids, count(ts) AS tss,
                  count(user_id) AS users, count(event_type) AS types, count(value) AS vals,
                  count(props) AS props FROM events)
SELECT 'event_id' AS field, 'bigint' AS expected_type, true AS required,
       total - ids AS missing_rows, CAST(0 AS BIGINT) AS mistyped_rows FROM n
UNION ALL SELECT 'ts', 'timestamp', false, total - tss, 0 FROM n
UNION ALL SELECT 'user_id', 'bigint', true, total - users, 0 FROM n
UNION ALL SELECT 'event_type', 'string', false, total - types, 0 FROM n
UNION ALL SELECT 'value', 'bigint', false, total - vals, vals FROM n
UNION ALL SELECT 'props', 'struct<k:int>', false, total - props, props FROM n
UNION ALL SELECT 'channel', 'string', true, total, 0 FROM n
"""


def q_json_document_folder(spark, sf):
    """Stamped documents kept as a folder of JSON text
    (every 17th line cut short); the contract is inferred from the folder, the
    documents are read under it with their source file and conformed; broken
    lines go to quarantine."""
    work = work_dir(spark, "json-docs")
    landed = _landed(spark, sf)
    text = landed.select(F.when(F.pmod("sequenceNumber", F.lit(17)) == 0,
                                F.substring("document", 1, 30))
                         .otherwise(F.col("document")).alias("value"))
    text.write.text(f"{work}/docs")
    contract = infer_contract(spark, f"{work}/docs", multi_line=False)
    tagged = tag(json_documents(spark, f"{work}/docs", contract, multi_line=False), contract)
    ok = F.col(REASON).isNull()
    fields = {"MetaData_BronzeCreatedAt": "BronzeCreatedAt", "MetaData_ChangeType": "ChangeType",
              "MetaData_PublicationDate": "PublicationDate"}
    fields |= {c: f"{I.EVENT_PAYLOAD}.{c}" for c in ("event_id", "user_id", "event_type", "value", "props")}
    return tagged.select(*[F.when(ok, F.col(path)).alias(c) for c, path in fields.items()],
                         F.when(ok, "conformed").otherwise("quarantine").alias("route"), F.col(REASON).alias("reason"))


SQL_JSON_DOCUMENT_FOLDER = """
SELECT CASE WHEN b THEN NULL ELSE '2031-07-04T05:06:07' END AS MetaData_BronzeCreatedAt,
       CASE WHEN b THEN NULL ELSE event_type END AS MetaData_ChangeType,
       CASE WHEN b THEN NULL ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS MetaData_PublicationDate,
       CASE WHEN b THEN NULL ELSE event_id END AS event_id,
       CASE WHEN b THEN NULL ELSE user_id END AS user_id,
       CASE WHEN b THEN NULL ELSE event_type END AS event_type,
       CASE WHEN b THEN NULL ELSE value END AS value,
       CASE WHEN b THEN NULL ELSE props END AS props,
       CASE WHEN b THEN 'quarantine' ELSE 'conformed' END AS route,
       CASE WHEN b THEN 'malformed or mistyped document' END AS reason
FROM (SELECT *, event_id % 17 = 0 AS b FROM events)
"""


# ------------------------------------------------------------------ serving upsert
_MAIN_COLS = ("user_id", "event_id", "event_type", "value", "props",
              "MetaData_PublicationDate", "MetaData_ChangeType")

SQL_LATEST_MAIN = """
SELECT user_id, event_id, event_type, value, props,
       strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') AS MetaData_PublicationDate,
       event_type AS MetaData_ChangeType
FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1
"""


def q_upsert_main(spark, sf):
    """Conformed events published in four batches, out of order;
    the main table equals the global latest per user."""
    work = work_dir(spark, "upsert")
    good, _ = conform(spark, _landed(spark, sf), I.EVENT_CONTRACT, I.EVENT_PAYLOAD,
                      F.lit(FIXED_STAMP))
    append_conformed(good, f"{work}/conformed")
    conformed = read_table(spark, f"{work}/conformed", schema=CONFORMED_EVENTS)
    cut = F.pmod(F.xxhash64(F.col("event_id")), F.lit(4))
    for b in (2, 0, 3, 1):
        publish_entity(spark, conformed.where(cut == b), EVENT_SPEC, f"{work}/serving",
                       stamp=F.lit(FIXED_STAMP))
    return read_main(spark, f"{work}/serving/{EVENT_SPEC.name}").select(*_MAIN_COLS)


def q_latest_text_stamps(spark, sf):
    """Stamps written in several text forms (seven fraction digits, an offset,
    minutes only, unpadded parts), published in batches out of order: the newest
    by time wins, whatever its form; stamps that can't be read are rejected."""
    root = f"{work_dir(spark, 'stamps')}/serving"
    ev = I.table(spark, sf, "events").select("event_id", "user_id", F.date_trunc("minute", "ts").alias("t"))
    form = F.pmod("event_id", F.lit(6))
    text = (F.when(form == 0, F.concat(F.date_format("t", "yyyy-MM-dd'T'HH:mm:ss"), F.lit(".0000000Z")))
            .when(form == 1, F.concat(F.date_format(F.col("t") + F.expr("INTERVAL 1 HOUR"), "yyyy-MM-dd'T'HH:mm:ss"), F.lit("+01:00")))
            .when(form == 2, F.date_format("t", "yyyy-MM-dd'T'HH:mm"))
            .when(form == 3, F.date_format("t", "yyyy-M-d H:m:s"))
            .when(form == 4, F.lit("soon")).otherwise(F.date_format("t", "yyyy-MM-dd HH:mm:ss'Z'")))
    batch = ev.select(F.struct(text.alias("PublicationDate"), F.col("event_id").alias("SourceSequenceNumber")).alias("MetaData"),
                      "user_id", "event_id", "t")
    spec = EntitySpec(name="Stamps", key="user_id", buckets=BUCKETS)
    cut = F.pmod(F.xxhash64("event_id"), F.lit(3))
    for b in (1, 2, 0):
        publish_entity(spark, batch.where(cut == b), spec, root, stamp=F.lit(FIXED_STAMP))
    return read_main(spark, f"{root}/Stamps").select("user_id", "event_id", "t")


SQL_LATEST_TEXT_STAMPS = """
SELECT user_id, event_id, t FROM (SELECT user_id, event_id, date_trunc('minute', ts) AS t FROM events WHERE event_id % 6 <> 4)
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY t DESC, event_id DESC) = 1
"""

WIDENED_SPEC = EntitySpec(name="Widened", key="event_id", buckets=BUCKETS, ties=())


def q_widened_serving_table(spark, sf):
    """The even events are published with narrow types (whole numbers, float,
    date, a column without a type, a struct and an array of whole numbers), the odd ones
    with wider types and one more field. Old files are read under the widened schema;
    the date, which Parquet's reader can't lift, is rewritten."""
    root = f"{work_dir(spark, 'widened')}/serving"
    ev = I.table(spark, sf, "events")
    small, odd = F.pmod("event_id", F.lit(1000)).cast("int"), F.pmod("event_id", F.lit(2)) == 1
    meta = F.struct(F.date_format("ts", I.PUBLICATION_FORMAT).alias("PublicationDate")).alias("MetaData")
    narrow = ev.where(~odd).select(
        meta, "event_id", small.alias("n"), (small / 8).cast("float").alias("x"), F.to_date("ts").alias("at"),
        F.lit(None).alias("extra"), F.struct(small.alias("a")).alias("s"), F.array(small, small + 1).alias("xs"))
    big = F.col("event_id").cast("long") + F.lit(1 << 40)
    wide = ev.where(odd).select(
        meta, "event_id", big.alias("n"), (small / 7).alias("x"), F.col("ts").cast("timestamp").alias("at"), F.col("event_type").alias("extra"),
        F.struct(big.alias("a"), F.col("event_type").alias("b")).alias("s"), F.array(big).alias("xs"))
    for batch in (narrow, wide):
        publish_entity(spark, batch, WIDENED_SPEC, root, stamp=F.lit(FIXED_STAMP))
    xs = read_children(spark, f"{root}/Widened_xs").groupBy("Widened_event_id").agg(F.sum("xs").alias("xs"))
    main = read_main(spark, f"{root}/Widened").select("event_id", "n", "x", F.date_format("at", "yyyy-MM-dd HH:mm:ss").alias("at"),
                                                      "extra", "s_a", "s_b")
    return main.join(xs, F.col("event_id") == F.col("Widened_event_id")).drop("Widened_event_id")


SQL_WIDENED_SERVING_TABLE = f"""
WITH e AS (SELECT *, event_id % 2 = 1 AS odd, event_id % 1000 AS small, event_id + {1 << 40} AS big FROM events)
SELECT event_id, CAST(CASE WHEN odd THEN big ELSE small END AS BIGINT) AS n,
       CASE WHEN odd THEN small / 7.0::DOUBLE ELSE small / 8.0::DOUBLE END AS x,
       strftime(CASE WHEN odd THEN ts ELSE date_trunc('day', ts) END, '%Y-%m-%d %H:%M:%S') AS at,
       CASE WHEN odd THEN event_type END AS extra, CAST(CASE WHEN odd THEN big ELSE small END AS BIGINT) AS s_a,
       CASE WHEN odd THEN event_type END AS s_b, CAST(CASE WHEN odd THEN big ELSE 2 * small + 1 END AS BIGINT) AS xs
FROM e
"""

GROWING_SPEC = EntitySpec(name="Growing", key="event_id", bucket_bytes=64 << 10)


def q_growing_serving_table(spark, sf):
    """K1, A10: a table that begins with a tiny batch, then takes the rest of the
    events in two batches and newer versions of a third of them. Its content after
    every batch, and whether its buckets fit its bytes by then."""
    work = work_dir(spark, "growing")
    ev = I.table(spark, sf, "events")
    stamped = lambda df, later: df.select(
        F.struct((F.col("ts") + F.expr(f"INTERVAL {later} DAYS")).alias("PublicationDate")).alias("MetaData"),
        "event_id", "user_id", "event_type", (F.col("value") + later).alias("value"), "props")
    k = F.pmod("event_id", F.lit(500))
    batches = [stamped(ev.where(k == 0), 0), stamped(ev.where(k >= 250), 0), stamped(ev.where(k.between(1, 249)), 0),
               stamped(ev.where(F.pmod("event_id", F.lit(3)) == 0), 1)]
    path = f"{work}/serving/{GROWING_SPEC.name}"
    for step, batch in enumerate(batches):
        publish_entity(spark, batch, GROWING_SPEC, f"{work}/serving", stamp=F.lit(FIXED_STAMP))
        sizes = bucket_sizes(spark, path)
        # linear hashing: a bucket that isn't split yet holds two units, files' own bytes aside
        fits = (max(sizes.values()) <= 3 * GROWING_SPEC.bucket_bytes
                and sum(sizes.values()) <= 1.5 * stored_layout(spark, path)["buckets"] * GROWING_SPEC.bucket_bytes)
        (read_main(spark, path).groupBy("event_type")
         .agg(F.count("*").alias("rows"), F.sum("event_id").alias("ids"), F.sum(F.floor("value")).alias("whole_values"))
         .withColumn("fits", F.lit(fits)).write.parquet(f"{work}/states/step={step}"))
    return spark.read.parquet(f"{work}/states").select(F.col("step").cast("int").alias("step"), "event_type", "rows", "ids",
                                                       "whole_values", "fits")


SQL_GROWING_SERVING_TABLE = """
WITH steps AS (SELECT unnest(range(4)) AS step),
stored AS (SELECT step, event_type, event_id, value + CASE WHEN step = 3 AND event_id % 3 = 0 THEN 1 ELSE 0 END AS value
           FROM events JOIN steps ON event_id % 500 = 0 OR (step >= 1 AND event_id % 500 >= 250) OR step >= 2)
SELECT CAST(step AS INTEGER) AS step, event_type, count(*) AS rows, CAST(sum(event_id) AS BIGINT) AS ids,
       CAST(sum(floor(value)) AS BIGINT) AS whole_values, true AS fits
FROM stored GROUP BY step, event_type
"""

DOCUMENT_SPEC = EntitySpec(name="Documents", key="doc_id", buckets=BUCKETS, ties=())


def _document_batch(spark, sf, published: str, changed: bool):
    """All documents; or a third of them, with emptied, reversed or shortened lines
    and, beyond those, some whose batch lacks the array (made by the caller)."""
    docs = I.line_documents(spark, sf).select("doc_id", "lang", F.transform(
        "lines", lambda x: F.struct(x["line"].alias("line"), x["chars"].alias("chars"))).alias("lines"))
    if changed:
        k, arr = F.pmod("doc_id", F.lit(9)), F.col("lines")
        docs = docs.where(F.pmod("doc_id", F.lit(3)) == 0).withColumn(
            "lines", F.when(k == 0, F.slice(arr, 1, 0)).when(k == 3, F.reverse(arr))
            .otherwise(F.slice(arr, 1, F.greatest(F.size(arr) - 1, F.lit(0)))))
    return docs.select(F.struct(F.lit(published).alias("PublicationDate")).alias("MetaData"), *docs.columns)


def q_replace_children(spark, sf):
    """A third of the documents published with emptied,
    reversed or shortened line arrays, then all of them with an older date, then
    every tenth again in a newer batch that lacks the array. Child rows of a parent
    are replaced as a whole, the older batch brings no old lines back, and parents
    of the batch without the array have no children any more."""
    root = f"{work_dir(spark, 'children')}/serving"
    bare = _document_batch(spark, sf, "2031-03-01T00:00:00", False).where(F.pmod("doc_id", F.lit(10)) == 0).drop("lines")
    for batch in (_document_batch(spark, sf, "2031-02-01T00:00:00", True),
                  _document_batch(spark, sf, "2031-01-01T00:00:00", False), bare):
        publish_entity(spark, batch, DOCUMENT_SPEC, root, stamp=F.lit(FIXED_STAMP))
    return read_children(spark, f"{root}/Documents_lines").drop(FL.UID_COL)


SQL_REPLACE_CHILDREN = f"""
WITH {_LINES},
counted AS (SELECT *, count(*) OVER (PARTITION BY doc_id) AS n FROM lines WHERE doc_id % 10 <> 0)
SELECT doc_id AS Documents_doc_id,
       CAST(CASE WHEN doc_id % 9 = 3 THEN n - 1 - pos ELSE pos END AS INTEGER) AS MetaData_Position,
       line, CAST(length(line) AS INTEGER) AS chars
FROM counted
WHERE doc_id % 9 <> 0 AND NOT (doc_id % 9 = 6 AND pos = n - 1)
"""


# ------------------------------------------------------------------ streams and monitors
def q_stream_raw_to_serving(spark, sf):
    """Hub files -> raw -> conformed -> serving as three
    availableNow streams; the serving main table is the latest per user."""
    run = run_event_streams(spark, sf)
    return read_main(spark, f"{run.serving}/{EVENT_SPEC.name}").select(*_MAIN_COLS)


def q_raw_rows_per_folder(spark, sf):
    """A3 layout: raw rows per ``event_type=/ingest_date=`` folder."""
    run = run_event_streams(spark, sf, upto="raw")
    raw = read_raw(spark, run.raw)
    return raw.groupBy(F.concat(F.lit("event_type="), "event_type", F.lit("/ingest_date="),
                                F.col("ingest_date").cast("string")).alias("folder")) \
              .agg(F.count("*").alias("rows"))


SQL_RAW_ROWS_PER_FOLDER = """
SELECT 'event_type=' || lower(event_type) || '/ingest_date=' || CAST(CAST(ts AS DATE) AS VARCHAR)
         AS folder, count(*) AS rows
FROM events GROUP BY 1
"""


FILE_ROWS = 40


def q_raw_variant_zone(spark, sf):
    """The raw zone with variant documents (every 13th body is cut short and stays
    text): keys read back from the shredded columns, and the route each row takes when it is
    conformed from there."""
    root = work_dir(spark, "variants")
    msgs = I.event_messages(I.table(spark, sf, "events"))
    msgs = msgs.withColumn("body", F.when(F.pmod("sequenceNumber", F.lit(13)) == 0, F.substring("body", 1, 20)).otherwise(F.col("body")))
    write_raw_variant(land_events(event_columns(msgs), F.lit(FIXED_STAMP)), f"{root}/raw")
    raw = read_raw_variant(spark, f"{root}/raw")
    keys = document_keys(raw, {"doc_type": ("$.Type", "string"), "stamp": ("$.BronzeCreatedAt", "string"),
                               "user_id": (f"$.{I.EVENT_PAYLOAD}.user_id", "long"), "value": (f"$.{I.EVENT_PAYLOAD}.value", "double")},
                         "partition", "sequenceNumber", "event_type", "ingest_date")
    tagged = conform_tagged(as_text(raw), I.EVENT_CONTRACT)
    route = tagged.select(F.col("partition").alias("p"), F.col("sequenceNumber").alias("s"), F.col(REASON).alias("reason"))
    return keys.join(route, (F.col("partition") == F.col("p")) & (F.col("sequenceNumber") == F.col("s"))).drop("p", "s")


SQL_RAW_VARIANT_ZONE = """
WITH e AS (SELECT *, event_id % 13 = 0 AS broken FROM events)
SELECT event_id % 4 AS partition, event_id AS sequenceNumber, CASE WHEN broken THEN 'unknown' ELSE lower(event_type) END AS event_type,
       DATE '2031-07-04' AS ingest_date, CASE WHEN NOT broken THEN upper(substr(event_type, 1, 1)) || substr(event_type, 2) END AS doc_type,
       CASE WHEN NOT broken THEN '2031-07-04T05:06:07' END AS stamp, CASE WHEN NOT broken THEN user_id END AS user_id,
       CASE WHEN NOT broken THEN value END AS value, CASE WHEN broken THEN 'malformed or mistyped document' END AS reason
FROM e
"""


def q_files_per_folder(spark, sf):
    """Events kept as files of at most 40 rows, a folder for each type and
    day; a file listing (contents never read) counts the files of every folder and of all."""
    root = f"{work_dir(spark, 'files')}/raw"
    ev = I.table(spark, sf, "events")
    # one writer a folder, so that the rows alone say how many files it has
    (ev.select("event_id", F.lower("event_type").alias("event_type"), F.to_date("ts").alias("ingest_date"))
     .repartition("event_type", "ingest_date").sortWithinPartitions("event_type", "ingest_date")
     .write.option("maxRecordsPerFile", FILE_ROWS).partitionBy("event_type", "ingest_date").parquet(root))
    files = M.list_files(spark, root, glob="*.parquet")
    return M.files_per_folder(files, root=root).crossJoin(F.broadcast(M.total_files(files)))


SQL_FILES_PER_FOLDER = f"""
WITH f AS (SELECT '/event_type=' || lower(event_type) || '/ingest_date=' || CAST(CAST(ts AS DATE) AS VARCHAR) AS folder,
                  CAST(ceil(count(*) / {FILE_ROWS}.0) AS BIGINT) AS files FROM events GROUP BY 1)
SELECT folder, files, CAST(sum(files) OVER () AS BIGINT) AS total_files FROM f
"""


def q_layer_reconciliation(spark, sf):
    """E3 + E5: rows per landing day in the raw, conformed and serving layers; raw
    rows of every eleventh event have no stamp here and are the NULL day's."""
    run = run_event_streams(spark, sf)
    stamp = F.when(F.pmod("sequenceNumber", F.lit(11)) != 0, F.col("BronzeCreatedAt"))
    raw = read_raw(spark, run.raw).select(stamp.alias("landed"))
    conformed = read_table(spark, run.conformed, schema=CONFORMED_EVENTS)
    serving = read_main(spark, f"{run.serving}/{EVENT_SPEC.name}")
    return M.layer_reconciliation(raw, "landed", conformed, "ingest_date", serving, "MetaData_BronzeCreatedAt")


SQL_LAYER_RECONCILIATION = """
WITH latest AS (SELECT ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1),
landed AS (
  SELECT CASE WHEN event_id % 11 <> 0 THEN CAST(ts AS DATE) END AS day, 1 AS r, 0 AS c, 0 AS s FROM events
  UNION ALL SELECT CAST(ts AS DATE), 0, 1, 0 FROM events
  UNION ALL SELECT CAST(ts AS DATE), 0, 0, 1 FROM latest)
SELECT day, CAST(sum(r) AS BIGINT) AS raw_rows, CAST(sum(c) AS BIGINT) AS conformed_rows,
       CAST(sum(s) AS BIGINT) AS serving_rows
FROM landed GROUP BY day ORDER BY day
"""


def q_conformed_rows_per_day_sql(spark, sf):
    """A14 + E3 in SQL: rows per landing day, from the partition column alone."""
    run = run_event_streams(spark, sf, upto="conformed")
    register_view(read_table(spark, run.conformed, schema=CONFORMED_EVENTS), "conformed_events")
    return spark.sql("SELECT ingest_date AS day, count(1) AS row_count FROM conformed_events GROUP BY ingest_date")


def q_serving_rows_per_day_sql(spark, sf):
    """A14 + E5 in SQL: users of the serving table by the landing day of their
    newest event."""
    run = run_event_streams(spark, sf)
    register_view(read_main(spark, f"{run.serving}/{EVENT_SPEC.name}"), "serving_events")
    return spark.sql("SELECT ingest_date AS day, count(user_id) AS users FROM serving_events GROUP BY ingest_date")


def q_conformed_duplicates_on_day_sql(spark, sf):
    """A14 + E4 + C3 in SQL: business keys with several records on one landing
    day; the day is a partition, so no other day is read."""
    run = run_event_streams(spark, sf, upto="conformed")
    register_view(read_table(spark, run.conformed, schema=CONFORMED_EVENTS), "conformed_events")
    return spark.sql(f"""
        SELECT user_id, count(1) AS records, max(event_id) AS last_event FROM conformed_events
        WHERE ingest_date = DATE'{DUP_DAY}' GROUP BY user_id HAVING count(1) > 1""")


SQL_CONFORMED_ROWS_PER_DAY = """
SELECT CAST(ts AS DATE) AS day, count(*) AS row_count FROM events GROUP BY 1
"""

SQL_SERVING_ROWS_PER_DAY = """
SELECT CAST(ts AS DATE) AS day, count(*) AS users FROM (
  SELECT ts FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1)
GROUP BY 1
"""

SQL_CONFORMED_DUPLICATES_ON_DAY = f"""
SELECT user_id, count(*) AS records, max(event_id) AS last_event FROM events
WHERE CAST(ts AS DATE) = DATE '{DUP_DAY}' GROUP BY user_id HAVING count(*) > 1
"""


def q_stream_progress(spark, sf):
    """The three layers as streams, each batch entered in the progress table; then
    the raw job once more over a broken folder, which fails. Rows and failures by job."""
    root = work_dir(spark, "progress")
    table = ProgressTable(spark, f"{root}/progress")
    run = run_event_streams(spark, sf, progress=table)
    hub = file_events(spark, run.hub, I.event_messages(I.table(spark, sf, "events")).schema)
    broken = event_stream(hub.withColumn("body", F.when(F.raise_error(F.lit("hub lost")).isNull(), F.col("body"))))
    try:
        finish(run_raw(broken, f"{root}/raw", f"{root}/chk", trigger_options(available_now=True), name=None, progress=table))
    except StreamingQueryException:
        pass
    table.close()
    entries = read_progress(spark, f"{root}/progress")
    timed = F.count_if(F.col("rows").isNotNull() & (F.col("millis").isNull() | (F.col("input_rows") < 1)))
    return entries.groupBy(F.coalesce("name", F.lit("raw")).alias("job")).agg(
        F.sum("rows").alias("rows"), F.count("failure").alias("failures"), timed.alias("untimed"))


SQL_STREAM_PROGRESS = """
SELECT unnest(['raw', 'conform', 'serving']) AS job, n AS rows, CAST(unnest([1, 0, 0]) AS BIGINT) AS failures, CAST(0 AS BIGINT) AS untimed
FROM (SELECT count(*) AS n FROM events)
"""


def q_rows_per_day_stream(spark, sf):
    """Rows per day kept by a stateful stream over three parts of the events, by time;
    with the last part come events of the first two, of which those that the watermark has
    passed are in no count, but counted."""
    root = work_dir(spark, "daily")
    ev = I.table(spark, sf, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    first, last = ev.agg(F.min("ts"), F.max("ts")).first()
    cuts = [first + (last - first) * x for x in (1 / 3, 2 / 3)]
    delayed = F.pmod("event_id", F.lit(50)) == 7
    early, mid = F.col("ts") < F.lit(cuts[0]), F.col("ts") < F.lit(cuts[1])
    parts = [ev.where(early & ~delayed), ev.where(~early & mid & ~delayed), ev.where(~mid | delayed)]
    table = ProgressTable(spark, f"{root}/progress")
    for part in parts:
        part.write.mode("append").parquet(f"{root}/events")
        stream = file_events(spark, f"{root}/events", ev.schema)
        finish(run_rows_per_day(stream, "ts", f"{root}/daily", f"{root}/chk", "1 day", trigger_options(available_now=True), progress=table))
    table.close()
    late = uncounted(spark, f"{root}/daily", f"{root}/progress")
    return read_rows_per_day(spark, f"{root}/daily").withColumn("late", F.lit(late).cast("long"))


SQL_ROWS_PER_DAY_STREAM = """
WITH b AS (SELECT epoch_us(min(ts)) AS lo, epoch_us(max(ts)) AS hi FROM events),
e AS (SELECT CAST(ts AS DATE) AS day, event_id % 50 = 7 AS delayed, epoch_us(ts) AS us,
             epoch_us(ts) < lo + round((hi - lo) * (2.0::DOUBLE / 3)) AS before FROM events, b),
w AS (SELECT max(us) - 86400000000 AS mark FROM e WHERE before AND NOT delayed),
t AS (SELECT day, delayed AND epoch_us(CAST(day AS TIMESTAMP)) + 86400000000 <= mark AS late FROM e, w)
SELECT day, CAST(count(*) FILTER (NOT late) AS BIGINT) AS row_count, (SELECT count(*) FROM t WHERE late) AS late
FROM t GROUP BY day
"""


def q_stream_bad_documents(spark, sf):
    """Hub events of which every 13th body is cut short, landed
    twice in batches of their own: the conformed table and the quarantine hold
    each event once, and each reject names its raw file."""
    root = work_dir(spark, "bad-stream")
    msgs = I.event_messages(I.table(spark, sf, "events"))
    msgs = msgs.withColumn("body", F.when(F.pmod("sequenceNumber", F.lit(13)) == 0, F.substring("body", 1, 20))
                           .otherwise(F.col("body")))
    contract = f"{root}/contract"
    save_contract(spark, I.EVENT_CONTRACT, contract)                # A17: the job reads it from the file
    for day in (0, 1):
        landed = land_events(event_columns(msgs), F.lit(FIXED_STAMP + _dt.timedelta(days=day)))
        write_raw(landed, f"{root}/raw")
        finish(run_conform(spark, f"{root}/raw", f"{root}/conformed", contract, I.EVENT_PAYLOAD, f"{root}/chk",
                           trigger=trigger_options(available_now=True), name=None))
    good = read_table(spark, f"{root}/conformed", schema=CONFORMED_EVENTS)
    bad = spark.read.parquet(f"{root}/conformed_quarantine")
    return (good.select(F.col("MetaData.SourceSequenceNumber").alias("sequenceNumber"), F.lit("conformed").alias("route"),
                        F.contains("MetaData.SourceFile", F.lit("/raw/")).alias("has_file"))
            .union(bad.select("sequenceNumber", F.lit("quarantine"), F.contains("source_file", F.lit("/raw/")))))


SQL_STREAM_BAD_DOCUMENTS = """
SELECT event_id AS sequenceNumber, CASE WHEN event_id % 13 = 0 THEN 'quarantine' ELSE 'conformed' END AS route,
       true AS has_file
FROM events
"""


def q_quarantine_worked_off(spark, sf):
    """Documents cut short and documents without a publication date are
    quarantined by the conform stream; a newer contract, in which the date is optional,
    works the quarantine off, and a second call finds nothing to do. Where each event is
    in the end, and the reason it once had."""
    root = work_dir(spark, "workoff")
    k = F.pmod(F.col("sequenceNumber"), F.lit(11))
    docs = I.event_document(I.table(spark, sf, "events"))
    doc = (F.when(k == 0, F.substring("doc", 1, 25)).when(k == 5, F.regexp_replace("doc", '"PublicationDate":"[^"]*",', ""))
           .otherwise(F.col("doc")))
    msgs = docs.select(F.encode(doc, "UTF-8").alias("body"), "partition", "sequenceNumber")
    write_raw(land_events(event_columns(msgs), F.lit(FIXED_STAMP)), f"{root}/raw")
    finish(run_conform(spark, f"{root}/raw", f"{root}/conformed", I.EVENT_CONTRACT, I.EVENT_PAYLOAD, f"{root}/chk",
                       trigger=trigger_options(available_now=True), name=None))
    newer = StructType([StructField(f.name, f.dataType, f.nullable or f.name == "PublicationDate") for f in I.EVENT_CONTRACT.fields])
    done = [work_off(spark, f"{root}/conformed", newer, I.EVENT_PAYLOAD, F.lit(FIXED_STAMP)) for _ in range(2)]
    good = read_table(spark, f"{root}/conformed", schema=CONFORMED_EVENTS).select(
        F.col("MetaData.SourceSequenceNumber").alias("sequenceNumber"), F.lit("conformed").alias("route"))
    bad = spark.read.parquet(f"{root}/conformed_quarantine").select("sequenceNumber", F.lit("quarantine"))
    was = closed_rejects(spark, f"{root}/conformed").select(F.col("sequenceNumber").alias("s"), "was")
    return (good.union(bad).join(was, F.col("sequenceNumber") == F.col("s"), "left").drop("s")
            .withColumn("moved", F.lit(done[0]["moved"]).cast("long")).withColumn("moved_again", F.lit(done[1]["moved"]).cast("long")))


SQL_QUARANTINE_WORKED_OFF = """
SELECT event_id AS sequenceNumber, CASE WHEN event_id % 11 = 0 THEN 'quarantine' ELSE 'conformed' END AS route,
       CASE WHEN event_id % 11 = 5 THEN 'required field missing: PublicationDate' END AS was,
       CAST(count(*) FILTER (event_id % 11 = 5) OVER () AS BIGINT) AS moved, CAST(0 AS BIGINT) AS moved_again
FROM events
"""


FILES_PER_TASK = 500


def write_each(docs: DataFrame, path: str, files_per_task: int = FILES_PER_TASK) -> None:
    """Each row (``value``) as a file of its own. A file costs milliseconds however small it is,
    so rows are dealt by their number, not their bytes: a task writes about as many, whatever the table."""
    tasks = -(-docs.count() // files_per_task)
    docs.repartition(max(1, tasks)).write.option("maxRecordsPerFile", "1").text(path)


def q_multiline_documents(spark, sf):
    """Every supplier is a pretty-printed document of its own file,
    streamed through the document job; the rows name their files, of which the
    distinct ones and the first are reported."""
    root = work_dir(spark, "multiline")
    docs = I.table(spark, sf, "supplier").select(F.to_json(F.struct(
        F.lit("Supplier").alias("Type"), F.lit("2031-01-01").alias("BronzeCreatedAt"),
        F.struct("s_suppkey", "s_name", "s_nationkey").alias("Supplier")), {"pretty": "true"}).alias("value"))
    write_each(docs, f"{root}/docs")
    contract = StructType([StructField("Type", StringType()), StructField("BronzeCreatedAt", StringType()),
                           StructField("Supplier", StructType([StructField("s_suppkey", LongType(), False), StructField("s_name", StringType()),
                                                               StructField("s_nationkey", LongType())]), False)])
    finish(run_conform_documents(spark, f"{root}/docs/*.txt", f"{root}/conformed", contract, "Supplier", f"{root}/chk",
                                 trigger=trigger_options(available_now=True), max_files_per_trigger=20_000, name=None))
    got = read_table(spark, f"{root}/conformed", schema=conformed_schema(contract, "Supplier"))
    named = got.select("s_suppkey", "s_name", "s_nationkey", F.col("MetaData.SourceFile").alias("source_file"))
    by_nation = named.groupBy("s_nationkey").agg(F.count("*").alias("documents"), F.sum("s_suppkey").alias("keys"),
                                                 F.max(F.length("s_name")).alias("longest"))
    # one row each: the count of distinct files, and the first of them
    files = M.distinct_files(named).agg(F.count("*").alias("files"), F.min("source_file").alias("least"))
    first = M.first_file(named).select("first_file")
    facts = files.join(first, F.col("least") == F.col("first_file")).select("files")
    return by_nation.crossJoin(F.broadcast(facts))


SQL_MULTILINE_DOCUMENTS = """
SELECT s_nationkey, count(*) AS documents, CAST(sum(s_suppkey) AS BIGINT) AS keys, CAST(max(length(s_name)) AS INTEGER) AS longest,
       (SELECT count(*) FROM supplier) AS files
FROM supplier GROUP BY s_nationkey
"""


def q_contract_report(spark, sf):
    """The schema of the table's documents, as Spark infers it, against
    a written contract file: missing, extra and mistyped fields, in arrays too."""
    root = work_dir(spark, "contract")
    save_contract(spark, STRICT_EVENT_CONTRACT, f"{root}/contract")
    ev = I.table(spark, sf, "events")
    ev.select(F.to_json(F.struct("event_id", "user_id", "event_type", "value",
                                 F.array(F.struct("event_id", "event_type")).alias("history")))).write.text(f"{root}/docs")
    actual = infer_contract(spark, f"{root}/docs", multi_line=False)
    report = contract_report(spark, actual, load_contract(spark, f"{root}/contract"))
    return report.where("issue <> 'nullability'").select("path", "issue")


SQL_CONTRACT_REPORT = """
WITH actual AS (SELECT unnest(['event_id', 'user_id', 'event_type', 'value', 'history']) AS path FROM (SELECT count(*) FROM events)),
contract AS (SELECT unnest(['event_id', 'ts', 'user_id', 'event_type', 'value', 'props', 'channel']) AS path)
SELECT path, 'missing' AS issue FROM contract WHERE path NOT IN (SELECT path FROM actual)
UNION ALL SELECT path, 'extra' FROM actual WHERE path NOT IN (SELECT path FROM contract)
UNION ALL SELECT 'value', 'type'
UNION ALL SELECT '<root>', 'order'
"""


def q_contract_by_day(spark, sf):
    """Stamped documents, of which every seventh has one field more, in the raw zone; the
    first days' schemas are kept, then the other days', and merged: every field of the
    contract, its type, and the days that have it."""
    root = work_dir(spark, "contract-days")
    ev = I.table(spark, sf, "events")
    more = F.when(F.pmod("event_id", F.lit(7)) == 0, F.col("event_type"))
    doc = F.to_json(F.struct(F.lit("Event").alias("Type"), F.struct("event_id", "user_id", "value", more.alias("more")).alias("Event"),
                             F.array("event_id", "user_id").alias("ids")))
    ev.select(doc.alias("document"), F.to_date("ts").alias("ingest_date")).write.partitionBy("ingest_date").parquet(f"{root}/raw")
    raw = spark.read.parquet(f"{root}/raw")
    keep_day_schemas(spark, raw.where(F.col("ingest_date") < F.lit(DUP_DAY).cast("date")), f"{root}/kept")
    keep_day_schemas(spark, raw, f"{root}/kept")
    fields = spark.createDataFrame(leaves(as_contract(kept_kind(spark, f"{root}/kept"))), "path string, type string")
    kept = spark.read.parquet(f"{root}/kept")
    # a day has a field if its schema names it
    last = F.concat(F.regexp_extract("path", "([^.]+)$", 1), F.lit(": "))
    return (fields.join(kept, F.contains("schema", last)).groupBy("path", "type")
            .agg(F.count("*").alias("days"), F.sum("documents").alias("documents")))


SQL_CONTRACT_BY_DAY = """
WITH f AS (SELECT * FROM (VALUES ('Type', 'string'), ('Event.event_id', 'bigint'), ('Event.user_id', 'bigint'), ('Event.value', 'double'),
                                 ('ids', 'array<bigint>')) v(path, type)),
d AS (SELECT CAST(ts AS DATE) AS day, count(*) AS n, bool_or(event_id % 7 = 0) AS more FROM events GROUP BY 1)
SELECT path, type, count(*) AS days, CAST(sum(n) AS BIGINT) AS documents FROM f, d GROUP BY path, type
UNION ALL SELECT 'Event.more', 'string', count(*), CAST(sum(n) AS BIGINT) FROM d WHERE more
"""


def q_stream_facts(spark, sf):
    """The raw job under each trigger over the same hub files:
    its name, the rows that landed, whether an empty batch landed any, and whether
    anything is active after all are stopped."""
    root = work_dir(spark, "facts")
    msgs = I.event_messages(I.table(spark, sf, "events"))
    msgs.repartition(4, "sequenceNumber").write.parquet(f"{root}/hub")
    msgs.limit(0).write.parquet(f"{root}/empty")
    rows = []
    for trigger, hub in (("interval", "hub"), ("immediate", "hub"), ("available", "hub"), ("empty", "empty")):
        src = event_stream(file_events(spark, f"{root}/{hub}", msgs.schema, max_files_per_trigger=2))
        how = trigger_options("1 second" if trigger == "interval" else None, trigger in ("available", "empty"))
        # The one-off runs take a checkpoint of their own
        q = run_raw(src, f"{root}/raw-{trigger}", None if how.get("availableNow") else f"{root}/chk-{trigger}", how,
                    stamp=F.lit(FIXED_STAMP), name=f"raw_{trigger}")
        name = q.name
        if how.get("availableNow"):
            finish(q)
        else:
            q.processAllAvailable()
        rows.append((trigger, name))
    stop_all(spark)
    active = len(spark.streams.active)
    facts = spark.createDataFrame(rows, "trigger string, name string")
    landed = [read_raw(spark, f"{root}/raw-{t}").agg(F.count("*").alias("landed")).select(F.lit(t).alias("t"), "landed")
              for t, _ in rows if path_exists(spark, f"{root}/raw-{t}")]
    counted = reduce(DataFrame.union, landed)
    return facts.join(counted, F.col("trigger") == F.col("t"), "left").select(
        "trigger", "name", F.coalesce("landed", F.lit(0)).cast("long").alias("landed"), F.lit(active).alias("active"))


SQL_STREAM_FACTS = """
SELECT t AS trigger, 'raw_' || t AS name, CASE WHEN t = 'empty' THEN 0 ELSE n END AS landed, CAST(0 AS INTEGER) AS active
FROM (SELECT unnest(['interval', 'immediate', 'available', 'empty']) AS t, n FROM (SELECT count(*) AS n FROM events))
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "latest_per_key": q_latest_per_key,
    "latest_props": q_latest_props,
    "parse_json_field": q_parse_json_field,
    "rows_per_day": q_rows_per_day,
    "duplicates_on_day": q_duplicates_on_day,
    "null_key_quarantine": q_null_key_quarantine,
    "decode_and_stamp": q_decode_and_stamp,
    "envelope_split": q_envelope_split,
    "flatten_nested": q_flatten_nested,
    "explode_struct_array": q_explode_struct_array,
    "drop_arrays": q_drop_arrays,
    "explode_scalar_array": q_explode_scalar_array,
    "explode_turns": q_explode_turns,
    "explode_nested_arrays": q_explode_nested_arrays,
    "model_view": q_model_view,
    "default_measures": q_default_measures,
    "model_measures": q_model_measures,
    "lookup_by_value": q_lookup_by_value,
    "imports_by_change_type": q_imports_by_change_type,
    "total_imports": q_total_imports,
    "import_timeline": q_import_timeline,
    "import_detail": q_import_detail,
    "expand_struct": q_expand_struct,
    "latest_text_stamps": q_latest_text_stamps,
    "stream_progress": q_stream_progress,
    "rows_per_day_stream": q_rows_per_day_stream,
    "stream_bad_documents": q_stream_bad_documents,
    "quarantine_worked_off": q_quarantine_worked_off,
    "multiline_documents": q_multiline_documents,
    "contract_report": q_contract_report,
    "contract_by_day": q_contract_by_day,
    "stream_facts": q_stream_facts,
    "bad_document_quarantine": q_bad_document_quarantine,
    "dedupe_replayed_events": q_dedupe_replayed_events,
    "replay_whole_history": q_replay_whole_history,
    "replay_from_positions": q_replay_from_positions,
    "contract_conformance": q_contract_conformance,
    "json_document_folder": q_json_document_folder,
    "upsert_main": q_upsert_main,
    "growing_serving_table": q_growing_serving_table,
    "widened_serving_table": q_widened_serving_table,
    "replace_children": q_replace_children,
    "stream_raw_to_serving": q_stream_raw_to_serving,
    "raw_rows_per_folder": q_raw_rows_per_folder,
    "raw_variant_zone": q_raw_variant_zone,
    "files_per_folder": q_files_per_folder,
    "layer_reconciliation": q_layer_reconciliation,
    "conformed_rows_per_day_sql": q_conformed_rows_per_day_sql,
    "serving_rows_per_day_sql": q_serving_rows_per_day_sql,
    "conformed_duplicates_on_day_sql": q_conformed_duplicates_on_day_sql,
}

ORACLES: dict[str, str] = {
    "latest_per_key": SQL_LATEST_PER_KEY,
    "latest_props": SQL_LATEST_PROPS,
    "parse_json_field": SQL_PARSE_JSON_FIELD,
    "rows_per_day": SQL_ROWS_PER_DAY,
    "duplicates_on_day": SQL_DUPLICATES_ON_DAY,
    "null_key_quarantine": SQL_NULL_KEY_QUARANTINE,
    "decode_and_stamp": SQL_DECODE_AND_STAMP,
    "envelope_split": SQL_ENVELOPE_SPLIT,
    "flatten_nested": SQL_FLATTEN_NESTED,
    "explode_struct_array": SQL_EXPLODE_STRUCT_ARRAY,
    "drop_arrays": SQL_DROP_ARRAYS,
    "explode_scalar_array": SQL_EXPLODE_SCALAR_ARRAY,
    "explode_turns": SQL_EXPLODE_TURNS,
    "explode_nested_arrays": SQL_EXPLODE_NESTED_ARRAYS,
    "model_view": SQL_MODEL_VIEW,
    "default_measures": SQL_DEFAULT_MEASURES,
    "model_measures": SQL_MODEL_MEASURES,
    "lookup_by_value": SQL_LOOKUP_BY_VALUE,
    "imports_by_change_type": SQL_IMPORTS_BY_CHANGE_TYPE,
    "total_imports": SQL_TOTAL_IMPORTS,
    "import_timeline": SQL_IMPORT_TIMELINE,
    "import_detail": SQL_IMPORT_DETAIL,
    "expand_struct": SQL_EXPAND_STRUCT,
    "latest_text_stamps": SQL_LATEST_TEXT_STAMPS,
    "stream_progress": SQL_STREAM_PROGRESS,
    "rows_per_day_stream": SQL_ROWS_PER_DAY_STREAM,
    "stream_bad_documents": SQL_STREAM_BAD_DOCUMENTS,
    "quarantine_worked_off": SQL_QUARANTINE_WORKED_OFF,
    "multiline_documents": SQL_MULTILINE_DOCUMENTS,
    "contract_report": SQL_CONTRACT_REPORT,
    "contract_by_day": SQL_CONTRACT_BY_DAY,
    "stream_facts": SQL_STREAM_FACTS,
    "raw_variant_zone": SQL_RAW_VARIANT_ZONE,
    "files_per_folder": SQL_FILES_PER_FOLDER,
    "bad_document_quarantine": SQL_BAD_DOCUMENT_QUARANTINE,
    "dedupe_replayed_events": SQL_DEDUPE_REPLAYED_EVENTS,
    "replay_whole_history": SQL_REPLAY_WHOLE_HISTORY,
    "replay_from_positions": SQL_REPLAY_FROM_POSITIONS,
    "contract_conformance": SQL_CONTRACT_CONFORMANCE,
    "json_document_folder": SQL_JSON_DOCUMENT_FOLDER,
    "upsert_main": SQL_LATEST_MAIN,
    "growing_serving_table": SQL_GROWING_SERVING_TABLE,
    "widened_serving_table": SQL_WIDENED_SERVING_TABLE,
    "replace_children": SQL_REPLACE_CHILDREN,
    "stream_raw_to_serving": SQL_LATEST_MAIN,
    "raw_rows_per_folder": SQL_RAW_ROWS_PER_FOLDER,
    "layer_reconciliation": SQL_LAYER_RECONCILIATION,
    "conformed_rows_per_day_sql": SQL_CONFORMED_ROWS_PER_DAY,
    "serving_rows_per_day_sql": SQL_SERVING_ROWS_PER_DAY,
    "conformed_duplicates_on_day_sql": SQL_CONFORMED_DUPLICATES_ON_DAY,
}
