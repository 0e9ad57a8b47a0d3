"""Language identification by bit-sliced Bloom filters of byte n-grams.

One filter serves all languages: its slots hold bit masks, a bit a language, cut
into slices of eight languages. Adding an n-gram of a language sets that bit in
the n-gram's ``PROBES`` slots; the AND of these slots is the mask of all languages
that contain the n-gram. A text's n-grams are looked up, the bits counted for
each language (popcounts), and the counts corrected for the filter's false
positives: a language whose slots are filled to a share f answers "yes" to an
absent n-gram with probability f^PROBES, so of n n-grams with c answers the
estimate is (c/n - f^PROBES) / (1 - f^PROBES). The largest estimate decides; the
score is its share of all estimates.

N-grams are of ``SIZES`` bytes of the text in which A-Z are lower-cased and all
other ASCII bytes but letters are one blank. A language's filter holds the
n-grams that occur at least ``LEAST`` times in its training texts and are not
``RATIO`` times rarer there than in another language.

The training sample has at most ``SAMPLE_ROWS`` texts of each language (the least
by a hash of the id; a documented bound), whose n-grams are counted by Spark.
Scoring reads every whole text in one map without a shuffle; the filter it
carries has ``SLOTS`` bytes a slice.

Defined results: NULL texts and texts without a letter are ``und`` with score 0; a
text with letters but no known n-gram gets the most frequent language with
score 0 (``und`` if nothing was learnt); ties go to the first language in order;
repeated rows are judged row by row; a NULL id counts as the empty string where
ids are hashed; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, joined_bytes, least_of_each, offsets, slices

SIZES = (2, 3, 4)
SLOTS = 1 << 18
PROBES = 3
LEAST = 3
RATIO = 4.0
SAMPLE_ROWS = 400
BATCH_BYTES = 2_000_000
UNKNOWN = "und"
LETTER = re.compile(r"[^\W\d_]")
COUNTS = "lang string, gram long, n long"
SCORES = "doc_id long, lang_pred string, score double"
_NORMAL = np.frombuffer(bytes(b if b >= 128 or chr(b).isalpha() else 32 for b in range(256)).lower(), np.uint8)
_ODD = np.random.default_rng(7).integers(0, 1 << 63, PROBES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a NULL id counts as no text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def held_out(doc_id: Column) -> Column:
    return remainder(doc_id, 4) == 2


def grams(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each size: the n-grams of texts that end at ``ends`` (codes that carry
    their size), and where each text's n-grams start. A blank closes each text
    and opens it, so no n-gram reaches over its ends."""
    sizes = np.diff(np.concatenate(([0], ends)))
    text_of = np.repeat(np.arange(len(sizes)), sizes)
    padded = np.full(len(data) + 2 * len(sizes), 32, np.uint8)
    padded[np.arange(len(data)) + 2 * text_of + 1] = _NORMAL[data]
    start = np.cumsum(sizes + 2) - sizes - 2
    code = padded.astype(np.int64)
    for size in range(2, max(SIZES) + 1):
        code = code[:-1] << 8 | padded[size - 1:]
        if size in SIZES:
            n = np.maximum(sizes + 3 - size, 0)
            at = np.cumsum(n) - n
            rows = np.repeat(start - at, n) + np.arange(n.sum())
            got = code[rows]
            yield got | size << 40, at
        if not len(code):
            return


def _sample_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            lang = np.array(part.column("lang").to_pylist())
            for own in sorted(set(lang.tolist())):
                texts = part.column("data").filter(pa.array(lang == own))
                got = [g for g, _ in grams(joined_bytes(texts), offsets(texts)[1:])]
                codes, n = np.unique(np.concatenate(got), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([own] * len(codes), pa.string()), pa.array(codes), pa.array(n, pa.int64())],
                    names=["lang", "gram", "n"])


def slots(gram: np.ndarray) -> list[np.ndarray]:
    return [(gram.astype(np.uint64) * a) >> np.uint64(64 - (SLOTS - 1).bit_length()) for a in _ODD]


@dataclass
class Model:
    languages: list[str]
    slices: list[np.ndarray]        # a byte a slot: eight languages
    wrong: np.ndarray               # false-positive rate of each language
    common: str

    @classmethod
    def of(cls, languages: list[str], members: list[np.ndarray], common: str) -> "Model":
        planes = [np.zeros(SLOTS, np.uint8) for _ in range(-(-len(languages) // 8))]
        wrong = np.zeros(len(languages))
        for i, own in enumerate(members):
            plane, bit = planes[i // 8], np.uint8(1 << i % 8)
            for at in slots(own):
                np.bitwise_or.at(plane, at, bit)
            wrong[i] = np.count_nonzero(plane & bit) / SLOTS
        return cls(languages, planes, wrong ** PROBES, common)

    def masks(self, gram: np.ndarray, plane: np.ndarray) -> np.ndarray:
        """The languages (of one slice) that contain each n-gram."""
        out = np.full(len(gram), 255, np.uint8)
        for at in slots(gram):
            out &= plane[at]
        return out

    def estimates(self, data: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Corrected share of n-grams that each language contains, a row a text."""
        total = np.zeros(len(ends), np.int64)
        yes = np.zeros((len(ends), len(self.languages)), np.int64)
        bits = np.arange(256)[:, None] >> np.arange(8) & 1
        for gram, at in grams(data, ends):
            n = np.diff(np.append(at, len(gram)))
            total += n
            text = np.repeat(np.arange(len(ends)) * 256, n)
            for s, plane in enumerate(self.slices):
                seen = np.bincount(text + self.masks(gram, plane), minlength=256 * len(ends))
                own = seen.reshape(-1, 256) @ bits
                yes[:, 8 * s: 8 * s + 8] += own[:, : len(self.languages) - 8 * s]
        share = yes / np.maximum(total, 1)[:, None]
        return np.clip((share - self.wrong) / (1 - np.minimum(self.wrong, 0.999)), 0, 1)


def train(docs: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Learn from text and lang of rows that aren't held out."""
    rows = docs.select(docs["doc_id"].cast("long").alias("doc_id"), docs["text"].cast("binary").alias("data"),
                       docs["lang"].alias("lang"))
    known = rows.filter(F.col("lang").isNotNull() & F.col("data").isNotNull() & ~held_out(F.col("doc_id")))
    chosen = least_of_each(known.select("lang", "doc_id"), "lang", ["doc_id"], sample_rows)
    chosen = chosen.select(F.col("doc_id").alias("chosen_id")).distinct()
    sample = known.join(F.broadcast(chosen), F.col("doc_id") == F.col("chosen_id")).select("lang", "data")
    counted = (sample.mapInArrow(_sample_counts, COUNTS).groupBy("lang", "gram")
               .agg(F.sum("n").alias("n")))
    total = counted.groupBy(F.col("lang").alias("tl")).agg(F.sum("n").alias("total"))
    counted = counted.join(F.broadcast(total), F.col("lang") == F.col("tl"))    # a row a language
    counted = counted.withColumn("share", F.col("n") / F.col("total"))
    best = F.max("share").over(Window.partitionBy("gram"))
    kept = (counted.withColumn("best", best).filter((F.col("n") >= LEAST) & (F.col("share") * RATIO >= F.col("best")))
            .groupBy("lang").agg(F.sum("n").alias("n"), F.collect_list("gram").alias("grams"))).collect()
    kept.sort(key=lambda r: r["lang"])
    members = [np.array(sorted(r["grams"]), np.int64) for r in kept]
    common = max(kept, key=lambda r: r["n"])["lang"] if kept else UNKNOWN
    return Model.of([r["lang"] for r in kept], members, common)


class Identify:
    def __init__(self, model: Model):
        self.model = model

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = self.model
        for batch in batches:
            for part in slices(batch, "data", BATCH_BYTES):
                texts = part.column("data")
                letters = [bool(LETTER.search(x.decode("utf-8", "replace"))) for x in texts.to_pylist()]
                pred, score = [UNKNOWN] * len(texts), np.zeros(len(texts))
                if model.languages:
                    est = model.estimates(joined_bytes(texts), offsets(texts)[1:])
                    total = est.sum(axis=1)
                    top = est.argmax(axis=1)
                    score = np.where(total > 0, est.max(axis=1) / np.maximum(total, 1e-12), 0.0)
                    pred = [(model.languages[t] if s > 0 else model.common) if ok else UNKNOWN
                            for t, s, ok in zip(top.tolist(), total.tolist(), letters)]
                    score = np.where(letters, score, 0.0)
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(pred, pa.string()), pa.array(score, pa.float64())],
                    names=["doc_id", "lang_pred", "score"])


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row per document."""
    found = ids_and_bytes(docs).mapInArrow(Identify(model), SCORES)
    return found.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "lang_pred", "score")
