"""The registered queries of this subpackage and their DuckDB oracles. Every
query reads its whole tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import (byte_bpe, decontaminate, exact_dedup, filter_audit, html_extract, language_id, license_scan, minhash,
                        piece_bpe, pii, quality_fm, spelling, suffix_dedup)
from strata.llm.common import table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
BPE_RANKS = "byte_bpe_multi_50k.tiktoken"
PIECES = "piece_bpe_32k.model"


def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"), keep="largest")


OP1_SQL = f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{LOWER}') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256
FROM d
"""


def op2_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.repeated_bytes(table(spark, sf_dir, "documents"))


# Bytes are handled as hexadecimal digits, two a byte.
OP2_SQL = """
WITH d AS (SELECT doc_id, lower(hex(encode(coalesce(text, '')))) AS x FROM documents),
starts AS (SELECT doc_id, x, unnest(range(0, len(x) // 2 - 99)) AS p FROM d),
windows AS (SELECT doc_id, p, md5(substr(x, 2 * p + 1, 200)) AS w FROM starts),
ranked AS (SELECT doc_id, p, row_number() OVER (PARTITION BY w ORDER BY doc_id, p) AS r FROM windows),
gone AS (SELECT doc_id, p, lag(p) OVER (PARTITION BY doc_id ORDER BY p) AS before FROM ranked WHERE r > 1),
numbered AS (SELECT doc_id, p, sum(CASE WHEN before IS NULL OR p > before + 100 THEN 1 ELSE 0 END)
                    OVER (PARTITION BY doc_id ORDER BY p) AS span FROM gone),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 100 AS b FROM numbered GROUP BY doc_id, span),
own AS (SELECT doc_id, count(*) AS n_spans, sum(b - a) AS n_removed, list(a ORDER BY a) AS s, list(b ORDER BY a) AS e
        FROM spans GROUP BY doc_id),
kept AS (SELECT doc_id, n_spans, n_removed, string_agg(substr(x, 2 * a + 1, 2 * (b - a)), '' ORDER BY a) AS k
         FROM (SELECT doc_id, n_spans, n_removed, x, unnest(list_concat([0], e)) AS a,
                      unnest(list_concat(s, [CAST(len(x) // 2 AS BIGINT)])) AS b FROM own JOIN d USING (doc_id))
         GROUP BY doc_id, n_spans, n_removed)
SELECT d.doc_id, CAST(len(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k, x))) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return language_id.identify(docs, language_id.train(docs))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def _words(text: str) -> str:
    return rf"regexp_extract_all(translate({text}, '{UPPER}', '{LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


def _bigrams(words: str) -> str:
    return f"list_distinct(list_transform(range(1, len({words})), lambda i: {words}[i] || ' ' || {words}[i + 1]))"


_TEMPLATE_ROWS = ", ".join("('{}', '{}')".format(name, text.replace("'", "''"))
                           for name, texts in license_scan.TEMPLATES.items() for text in texts)
OP4_SQL = rf"""
WITH t AS (SELECT name, {_bigrams("w")} AS b FROM (SELECT name, {_words("text")} AS w FROM (VALUES {_TEMPLATE_ROWS}) v(name, text))),
d AS (SELECT doc_id, coalesce(text, '') AS x, string_split(coalesce(text, ''), chr(10)) AS lines,
             regexp_split_to_array(coalesce(text, ''), '
[ 	
]*
') AS paragraphs FROM documents),
units AS (SELECT doc_id, unnest(list_concat([x], CASE WHEN len(paragraphs) > 1 THEN paragraphs ELSE [] END,
                                            CASE WHEN len(lines) > 1 THEN lines ELSE [] END)) AS u FROM d),
numbered AS (SELECT doc_id, row_number() OVER () AS unit, {_words("u")} AS w FROM units),
sized AS (SELECT doc_id, unit, {_bigrams("w")} AS b FROM numbered WHERE len(w) > 1),
dice AS (SELECT doc_id, unit, name, 2.0::DOUBLE * len(list_intersect(s.b, t.b)) / (len(s.b) + len(t.b)) AS dice
         FROM sized s JOIN t ON len(t.b) BETWEEN len(s.b) * 0.6 AND len(s.b) * 1.6),
best AS (SELECT doc_id, unit, name, dice FROM dice WHERE dice >= {license_scan.THRESHOLD}
         QUALIFY row_number() OVER (PARTITION BY unit ORDER BY dice DESC, name) = 1),
found AS (SELECT doc_id, count(*) AS n_units, string_agg(DISTINCT name, ',' ORDER BY name) AS licenses,
                 (array_agg(name ORDER BY dice DESC, name))[1] AS best, max(dice) AS best_dice FROM best GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_units, 0) AS n_units, coalesce(licenses, '') AS licenses, coalesce(best, '') AS best,
       coalesce(best_dice, 0.0::DOUBLE) AS best_dice
FROM d LEFT JOIN found USING (doc_id)
"""


def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trip(table(spark, sf_dir, "documents"),
                               public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.drop("spans", "items")


OP6_SQL = rf"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'),
                                             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
phrases AS (SELECT DISTINCT item, list_slice(w, i, i + 9) AS p
            FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 9) + 1)) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(p) AS k FROM phrases),
starts AS (SELECT doc_id, i, k, list_slice(w, i, i + k - 1) AS p
           FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k)),
found AS (SELECT s.doc_id, s.i, s.k, ph.item FROM starts s JOIN phrases ph ON s.p = ph.p),
hit AS (SELECT doc_id, count(DISTINCT j) AS n_hit
        FROM (SELECT doc_id, unnest(range(i, i + k)) AS j FROM found) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s
          FROM (SELECT DISTINCT doc_id, item FROM found) GROUP BY doc_id)
SELECT d.doc_id, len(d.w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_pii(table(spark, sf_dir, "documents"))


def op8_quality_fm(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return quality_fm.score(docs, quality_fm.train(docs, table(spark, sf_dir, "labels")))


def op9_html_extract(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extract.extract(table(spark, sf_dir, "pages"))


def op10_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


# The checksum's table follows from its rule (CRC-32, reflected polynomial 0xEDB88320).
OP11_SQL = rf"""
WITH RECURSIVE crc AS (SELECT list_transform(range(256), lambda i: list_reduce([i, 1, 2, 3, 4, 5, 6, 7, 8],
                              lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS t),
runs AS (SELECT doc_id, run, count(*) AS c
         FROM (SELECT doc_id, unnest(regexp_extract_all(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[a-z\x{{C0}}-\x{{FF}}]+')) AS run
               FROM documents) GROUP BY doc_id, run),
bytes AS (SELECT run, c, hex(encode(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || run)) AS x FROM runs),
sums AS (SELECT run, c, xor(4294967295, list_reduce(
             list_concat([4294967295], list_transform(range(len(x) // 2), lambda i: CAST('0x' || substr(x, 2 * i + 1, 2) AS BIGINT))),
             lambda s, b: xor(s >> 8, t[(xor(s, b) & 255) + 1]))) AS h FROM bytes, crc),
written AS (SELECT CASE WHEN h % {spelling.NOISE} = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, c
            FROM sums),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM written GROUP BY word
          HAVING length(word) >= {spelling.LEAST_LENGTH} AND sum(c) >= {spelling.LEAST_COUNT}),
less AS (SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
         FROM (SELECT word, unnest(range(1, length(word) + 1)) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS other FROM less a JOIN less b ON a.i = b.i AND a.rest = b.rest WHERE a.word <> b.word
          UNION SELECT a.word, b.word FROM less a JOIN words b ON a.rest = b.word
          UNION SELECT b.word, a.word FROM less a JOIN words b ON a.rest = b.word),
near AS (SELECT p.word, count(*) AS n_near, (array_agg(p.other ORDER BY o.n DESC, p.other))[1] AS best, max(o.n) AS best_n
         FROM pairs p JOIN words o ON p.other = o.word GROUP BY p.word),
forms AS (SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN best_n >= {spelling.RATIO} * w.n THEN best END AS form,
                 CASE WHEN best_n >= {spelling.RATIO} * w.n THEN best_n END AS form_n
          FROM words w LEFT JOIN near ON w.word = near.word),
chain AS (SELECT word, word AS last, 0 AS depth FROM forms
          UNION ALL SELECT c.word, f.form, c.depth + 1 FROM chain c JOIN forms f ON c.last = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, max_by(last, depth) AS root FROM chain GROUP BY word)
SELECT f.word, f.form, r.root, f.n, f.n_near, f.form_n FROM forms f JOIN roots r ON f.word = r.word
"""


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return piece_bpe.round_trip(table(spark, sf_dir, "documents"), public_tokenizers.path(PIECES))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


OP13_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t,
                  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT doc_id, part, CAST(len(w) < 50 AS INT) + 2 * CAST(100 * len(list_distinct(w)) < 65 * len(w) AS INT)
             + 4 * CAST(100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 5 * length(t) AS INT)
             + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT)
             + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false) AS INT) AS mask FROM d),
l AS (SELECT doc_id, max(CASE WHEN quality = 1 THEN 1 ELSE 0 END) AS good, max(CASE WHEN toxic = 1 THEN 1 ELSE 0 END) AS toxic
      FROM labels GROUP BY doc_id),
counts AS (SELECT part, mask, count(*) AS n, sum(coalesce(good, 0)) AS good, sum(coalesce(toxic, 0)) AS toxic
           FROM m LEFT JOIN l ON m.doc_id = l.doc_id GROUP BY part, mask),
bits AS (SELECT unnest(range(5)) AS i),
orders AS (SELECT [a.i, b.i, c.i, d.i, e.i] AS o FROM bits a JOIN bits b ON b.i <> a.i JOIN bits c ON c.i NOT IN (a.i, b.i)
           JOIN bits d ON d.i NOT IN (a.i, b.i, c.i) JOIN bits e ON e.i NOT IN (a.i, b.i, c.i, d.i)),
steps AS (SELECT list_aggregate(list_transform(o, lambda x: chr(CAST(65 + x AS INT))), 'string_agg', '') AS filter_order, step,
                 CAST(1 << o[step] AS INT) AS bit,
                 CAST(coalesce(list_sum(list_transform(o[1:step - 1], lambda x: 1 << x)), 0) AS INT) AS before
          FROM (SELECT o, unnest(range(1, 6)) AS step FROM orders)),
told AS (SELECT part, filter_order, step, bit,
                sum(CASE WHEN mask & (before + bit) = 0 THEN n ELSE 0 END) AS kept,
                sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN n ELSE 0 END) AS removed,
                sum(CASE WHEN mask & before > 0 AND mask & bit > 0 THEN n ELSE 0 END) AS redundant,
                sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
                sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN good ELSE 0 END) AS good_lost,
                sum(CASE WHEN mask & before = 0 AND mask & bit > 0 THEN toxic ELSE 0 END) AS toxic_lost
         FROM counts, steps GROUP BY part, filter_order, step, bit)
SELECT part, filter_order, CAST(step AS INT) AS step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
       CAST(toxic_lost AS BIGINT) AS toxic_lost, CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM told
"""


QUERIES = {
    "op1_exact_dedup": op1_exact_dedup,
    "op2_suffix_dedup": op2_suffix_dedup,
    "op3_language_id": op3_language_id,
    "op4_license_scan": op4_license_scan,
    "op5_byte_bpe": op5_byte_bpe,
    "op6_decontaminate": op6_decontaminate,
    "op7_pii": op7_pii,
    "op8_quality_fm": op8_quality_fm,
    "op9_html_extract": op9_html_extract,
    "op10_near_dedup": op10_near_dedup,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_sentencepiece": op12_sentencepiece,
    "op13_filter_audit": op13_filter_audit,
}

ORACLES = {
    "op1_exact_dedup": OP1_SQL,
    "op2_suffix_dedup": OP2_SQL,
    "op4_license_scan": OP4_SQL,
    "op6_decontaminate": OP6_SQL,
    "op11_spelling_variants": OP11_SQL,
    "op13_filter_audit": OP13_SQL,
}
