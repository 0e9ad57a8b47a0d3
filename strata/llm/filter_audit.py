"""Filter interaction audit with truth-table survival words.

A document fails a set of filters, a mask of one bit a filter. Its survival word
is the truth table of "survives the subset": bit S of 2^k is set if the document
fails none of the filters in S (k = 5: one 32-bit word). The number of documents
that survive a subset is then one bit's count over all words, a positional
popcount, made by carry-save adders: three vectors of words become a sum vector
and a carry vector of twice the weight, until two words a weight are left.

Tasks emit one count a part, label and subset; Spark adds them up, so a part that
holds a third of all rows is as many partial sums as there are tasks. Everything
the audit tells (survivors after any step of any order, what a step removes, what
it would have removed, what only it removes, Shapley sums) is a sum or difference
of these 2^k counts. Only digests and masks are shuffled, never texts.

Filters (whole texts; words are maximal runs without ASCII white space):
A under 50 words; B 100 * distinct words < 65 * words; C 100 * characters A-Z >
5 * code points; D any of #$%&*|; E the text equals one of a smaller doc_id.

Defined results: a NULL text is an empty text (fails A; E if a smaller id is empty
too); a NULL source is the part ''; a NULL id is smaller and larger than none, and
has no label; rows that repeat an id are each counted, and pass E unless a smaller
id holds their text; a label counts if any row of ``labels`` with that id has it;
labels of unknown ids are ignored; an empty table gives no rows; other columns
are not read.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import materialise, slices

FILTERS = "ABCDE"
COPY = 1 << FILTERS.index("E")
LEAST_WORDS, DISTINCT, CAPITALS = 50, 65, 5
UPPER = bytes(range(ord("A"), ord("Z") + 1))
CONTINUED = bytes(range(0x80, 0xC0))            # bytes that begin no code point
SIGNS = b"#$%&*|"
LABELS = ("all", "good", "toxic")
BATCH_BYTES = 2_000_000
HELD = 4096                                     # parts whose counts a task holds
MASKED = "doc_id long, part string, mask int, digest binary"
COUNTS = "part string, label int, subset int, n long"


def own_mask(text: bytes) -> int:
    """The filters that a text fails by itself."""
    words = text.split()
    code_points = len(text.translate(None, CONTINUED))
    capitals = len(text) - len(text.translate(None, UPPER))
    return ((len(words) < LEAST_WORDS)
            | (100 * len(set(words)) < DISTINCT * len(words)) << 1
            | (100 * capitals > CAPITALS * code_points) << 2
            | (len(text.translate(None, SIGNS)) < len(text)) << 3)


def mask_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows in slices(batch, "data", BATCH_BYTES):
            texts = rows.column("data").to_pylist()
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), rows.column("part"),
                pa.array([own_mask(t) for t in texts], pa.int32()),
                pa.array([hashlib.sha256(t).digest() for t in texts], pa.binary())],
                names=["doc_id", "part", "mask", "digest"])


def masked(docs: DataFrame) -> DataFrame:
    """doc_id, part, mask: the filters that every document fails, E included."""
    data = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"),
                       F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("data"))
    own = materialise(data.mapInArrow(mask_rows, MASKED), "masks")
    # minima are combined before the shuffle; a text with one row needs no partner. They
    # are written, so that both sides of the join are read from a shuffle and Spark may
    # split the rows of a text with very many copies
    first = (own.groupBy("digest").agg(F.min("doc_id").alias("first"), F.count("*").alias("copies"))
             .filter("copies > 1").select(F.col("digest").alias("of"), "first"))
    first = materialise(first, "copies")
    copy = F.coalesce(F.col("doc_id") > F.col("first"), F.lit(False))
    return (own.join(first, F.col("digest") == F.col("of"), "left")
            .select("doc_id", "part", F.when(copy, F.col("mask") + COPY).otherwise(F.col("mask")).alias("mask")))


def labelled(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """masks with ``label``: bit 0 is set for quality 1, bit 1 for toxic 1."""
    mark = lambda c: F.max(F.coalesce((F.col(c) == 1).cast("int"), F.lit(0)))
    told = (labels.groupBy(F.col("doc_id").cast("long").alias("told_id"))
            .agg((mark("quality") + 2 * mark("toxic")).alias("told")).filter("told > 0"))
    return (masks.join(told, F.col("doc_id") == F.col("told_id"), "left")
            .select("part", "mask", F.coalesce("told", F.lit(0)).alias("label")))


def survival_words(n_filters: int = len(FILTERS)) -> np.ndarray:
    """The survival word of every mask."""
    masks, subsets = np.arange(1 << n_filters)[:, None], np.arange(1 << n_filters)
    return ((masks & subsets == 0).astype(np.uint64) << subsets.astype(np.uint64)).sum(axis=1).astype(np.uint32)


def positional_popcount(words: np.ndarray, bits: int = 32) -> np.ndarray:
    """How many words have each bit set, by carry-save adders."""
    counts, weight = np.zeros(bits, np.int64), 1
    places = np.arange(bits, dtype=np.uint32)
    while len(words):
        carries = []
        while len(words) > 2:
            k = len(words) // 3
            a, b, c = words[:k], words[k: 2 * k], words[2 * k: 3 * k]
            half = a ^ b
            carries.append((a & b) | (half & c))
            words = np.concatenate((half ^ c, words[3 * k:]))
        counts += weight * ((words[:, None] >> places) & 1).sum(axis=0, dtype=np.int64)
        words = np.concatenate(carries) if carries else words[:0]
        weight *= 2
    return counts


def count_subsets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(part, mask, label) -> partial counts a part, label (of LABELS) and subset."""
    word_of = survival_words()
    held: dict[str, np.ndarray] = {}

    def told():
        counts = np.concatenate(list(held.values()))
        n, subsets = len(counts), len(word_of)
        parts = np.repeat(np.array(list(held), object), len(LABELS) * subsets)
        yield pa.RecordBatch.from_arrays([
            pa.array(parts, pa.string()),
            pa.array(np.tile(np.repeat(np.arange(len(LABELS), dtype=np.int32), subsets), len(held))),
            pa.array(np.tile(np.arange(subsets, dtype=np.int32), n)),
            pa.array(counts.reshape(-1))], names=["part", "label", "subset", "n"])

    for batch in batches:
        if not batch.num_rows:
            continue
        parts = batch.column("part").dictionary_encode()
        code, label = parts.indices.to_numpy(), batch.column("label").to_numpy()
        words = word_of[batch.column("mask").to_numpy()]
        order = np.argsort(code, kind="stable")
        ends = np.cumsum(np.bincount(code, minlength=len(parts.dictionary)))
        for part, a, b in zip(parts.dictionary.to_pylist(), [0, *ends[:-1].tolist()], ends.tolist()):
            own, tags = words[order[a:b]], label[order[a:b]]
            counts = np.stack([positional_popcount(own), positional_popcount(own[tags & 1 > 0]),
                               positional_popcount(own[tags & 2 > 0])])
            held[part] = held[part] + counts if part in held else counts
        if len(held) > HELD:
            yield from told()
            held.clear()
    if held:
        yield from told()


def subset_survivors(rows: DataFrame) -> DataFrame:
    """part, survivors: for each of LABELS an array of 2^k counts, by subset."""
    counts = rows.mapInArrow(count_subsets, COUNTS).groupBy("part", "label", "subset").agg(F.sum("n").alias("n"))
    size = 1 << len(FILTERS)
    place = (F.col("label") * size + F.col("subset")).alias("at")
    every = F.transform(F.sort_array(F.collect_list(F.struct(place, "n"))), lambda x: x["n"])    # 3 x 32 a part
    return (counts.groupBy("part").agg(every.alias("c"))
            .select("part", *[F.slice("c", i * size + 1, size).alias(name) for i, name in enumerate(LABELS)]))


def _steps() -> list[dict]:
    """Every step of every order: the subset before it and its filter's bit."""
    out = []
    for order in permutations(range(len(FILTERS))):
        before = 0
        for step, f in enumerate(order, 1):
            out.append({"filter_order": "".join(FILTERS[i] for i in order), "step": step, "before": before, "f": f})
            before |= 1 << f
    return out


def _shapley(f: int, survivors: Column) -> Column:
    """What filter f removes, summed over all orders: each subset without f comes before
    it in |S|! (k - 1 - |S|)! of them."""
    k = len(FILTERS)
    weight = lambda s: factorial(s.bit_count()) * factorial(k - 1 - s.bit_count())
    weights = [-weight(s ^ (1 << f)) if s >> f & 1 else weight(s) for s in range(1 << k)]
    product = F.zip_with(survivors, F.array(*[F.lit(w).cast("long") for w in weights]), lambda a, b: a * b)
    return F.aggregate(product, F.lit(0).cast("long"), lambda a, b: a + b)


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row a part, order of the filters and step: part, filter_order, step, kept,
    removed, redundant, unique_fails, good_lost, toxic_lost, shapley."""
    k = len(FILTERS)
    full = (1 << k) - 1
    counts = subset_survivors(labelled(masked(docs), labels))
    steps = F.from_json(F.lit(json.dumps(_steps())), "array<struct<filter_order:string,step:int,before:int,f:int>>")
    rows = (counts.withColumn("shapley", F.array(*[_shapley(f, F.col("all")) for f in range(k)]))
            .withColumn("s", F.explode(steps)))
    f, before = F.col("s.f"), F.col("s.before")
    bit = F.element_at(F.array(*[F.lit(1 << i) for i in range(k)]), f + 1)
    after = before.bitwiseOR(bit)
    at = lambda label, subset: F.element_at(F.col(label), subset + 1)
    removed = at("all", before) - at("all", after)
    return rows.select(
        "part", "s.filter_order", "s.step", at("all", after).alias("kept"), removed.alias("removed"),
        (at("all", F.lit(0)) - at("all", bit) - removed).alias("redundant"),
        (at("all", F.lit(full) - bit) - at("all", F.lit(full))).alias("unique_fails"),
        (at("good", before) - at("good", after)).alias("good_lost"),
        (at("toxic", before) - at("toxic", after)).alias("toxic_lost"),
        F.element_at(F.col("shapley"), f + 1).alias("shapley"))
