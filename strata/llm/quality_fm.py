"""Quality classifier: a factorisation machine over a text's own features.

Features of a text: its words, hashed (weights are roots of their counts, the
whole scaled to length 1); structure statistics (shares of upper case, digits,
symbols, line repeats, word repeats, ...), each put into one of ``BINS`` bins
whose edges are quantiles of the training sample; and its length class. All are
indices of one vector x, and the score is the logistic of

    w0 + sum_i w_i x_i + 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2)

which takes time linear in the number of non-zero features.

The fit sees at most ``sample_rows`` labelled rows (the least by a hash of the
id; a documented bound), whose features, not texts, come to the driver. Scoring
reads every whole text in one map without a shuffle; the model it carries has
a size fixed by ``HASHED`` and ``RANK``.

Defined results: NULL and empty texts are scored as texts without words; a NULL
id counts as the empty string where ids are hashed; without labelled rows every
score is 0.5 (predicted 1); labels that are NULL are not used, of repeated labels
of an id the least counts; repeated rows are scored row by row; an empty table
gives an empty result; further columns are not read.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, no_cycle_collection, slices

HASHED = 1 << 15
RANK = 8
BINS = 10
LENGTHS = 24
SAMPLE_ROWS = 4000
STEPS = 1500
BATCH = 32
RATE = 0.1
DECAY = 1e-4
SEED = 17
BATCH_BYTES = 4_000_000
FEATURES = "idx array<int>, val array<float>, stats array<double>, label double"
SCORES = "doc_id long, score double"

#: Byte classes whose shares are statistics, in this order.
CLASSES = np.zeros((256, 7), np.float64)
for _b in range(256):
    _c = chr(_b)
    CLASSES[_b] = (65 <= _b <= 90, 97 <= _b <= 122, 48 <= _b <= 57, _b == 10, _b in (9, 13, 32),
                   _b >= 128, _b < 128 and not _c.isalnum() and not _c.isspace())
N_STATS = CLASSES.shape[1] + 7


def statistics(data: bytes, words: list[bytes], counts: Counter) -> list[float]:
    """Structure statistics of one text; all 0 where there is nothing to count."""
    size, n = max(1, len(data)), max(1, len(words))
    shares = np.bincount(np.frombuffer(data, np.uint8), minlength=256) @ CLASSES / size
    lines = [x for x in data.split(b"\n") if x]
    symbols = sum(1 for w in words if not w[-1:].isalnum() and w[-1] < 128)
    return [*shares.tolist(),
            len(counts) / n,                                       # distinct words
            max(counts.values(), default=0) / n,                   # the most frequent word
            sum(map(bytes.__eq__, words, words[1:])) / n,          # words that repeat the one before
            len(set(lines)) / max(1, len(lines)),                  # distinct lines
            sum(map(len, words)) / n,                              # mean word length
            symbols / n,                                           # words that end in a symbol
            n / max(1, len(lines))]                                # words a line


def features(data: bytes) -> tuple[list[int], list[float], list[float]]:
    """Hashed words with their weights, and the statistics."""
    words = data.split()
    counts = Counter(words)
    stats = statistics(data, words, counts)
    scale = 1 / math.sqrt(max(1, len(words)))
    idx = [zlib.crc32(w) % HASHED for w in counts]
    val = [math.sqrt(c) * scale for c in counts.values()]
    return idx, val, stats


@dataclass
class Model:
    edges: np.ndarray           # statistics x inner bin edges
    w0: float
    w: np.ndarray
    v: np.ndarray

    def rows(self, stats: np.ndarray, sizes: np.ndarray) -> np.ndarray:
        """Indices of the statistics' bins and of the length class, a row for each text."""
        bins = np.empty((len(stats), N_STATS + 1), np.int64)
        for s in range(N_STATS):
            bins[:, s] = HASHED + s * BINS + np.searchsorted(self.edges[s], stats[:, s], side="right")
        length = np.minimum(np.log2(sizes + 1).astype(np.int64), LENGTHS - 1)
        bins[:, N_STATS] = HASHED + N_STATS * BINS + length
        return bins

    def margin(self, idx: np.ndarray, val: np.ndarray, at: np.ndarray):
        """The machine's value for texts whose features start at ``at``; and the factor sums."""
        vx = self.v[idx] * val[:, None]
        sums = np.add.reduceat(vx, at, axis=0)
        squares = np.add.reduceat(vx * vx, at, axis=0)
        linear = np.add.reduceat(self.w[idx] * val, at)
        return self.w0 + linear + 0.5 * (sums * sums - squares).sum(axis=1), sums


def flat(parts: list[tuple[list[int], list[float], list[float]]], sizes: np.ndarray, model: Model):
    """The features of many texts, one after the other, and where each text starts."""
    bins = model.rows(np.array([p[2] for p in parts]), sizes)
    weight = 1 / math.sqrt(N_STATS + 1)
    n = np.array([len(p[0]) for p in parts]) + N_STATS + 1
    at = np.cumsum(n) - n
    idx, val = np.empty(n.sum(), np.int64), np.empty(n.sum(), np.float32)
    for (i, x, _), start, own in zip(parts, at.tolist(), bins):
        idx[start: start + N_STATS + 1], val[start: start + N_STATS + 1] = own, weight
        idx[start + N_STATS + 1: start + N_STATS + 1 + len(i)] = i
        val[start + N_STATS + 1: start + N_STATS + 1 + len(i)] = x
    return idx, val, at


def blank(rank: int = RANK) -> Model:
    size = HASHED + N_STATS * BINS + LENGTHS
    return Model(np.tile(np.arange(1.0, BINS), (N_STATS, 1)), 0.0, np.zeros(size), np.zeros((size, rank)))


def fit(parts, sizes: np.ndarray, labels: np.ndarray, steps: int = STEPS, seed: int = SEED) -> Model:
    """AdaGrad on the logistic loss: whole passes over the sample in small
    batches, ``steps`` batches or a little more."""
    rng = np.random.default_rng(seed)
    model = blank()
    if not len(labels):
        return model
    stats = np.array([p[2] for p in parts])
    model.edges = np.quantile(stats, np.arange(1, BINS) / BINS, axis=0).T.copy()
    share = np.clip(labels.mean(), 0.01, 0.99)
    model.w0 = math.log(share / (1 - share))
    if labels.min() == labels.max():
        return model
    model.v = rng.normal(0, 0.05, model.v.shape)
    gw, gv, g0 = np.full(model.w.shape, 1e-8), np.full(model.v.shape, 1e-8), 1e-8
    for _ in range(math.ceil(steps / math.ceil(len(labels) / BATCH))):
        order = rng.permutation(len(labels))
        for i in range(0, len(order), BATCH):
            rows = order[i: i + BATCH]
            idx, val, at = flat([parts[r] for r in rows], sizes[rows], model)
            z, sums = model.margin(idx, val, at)
            error = 1 / (1 + np.exp(-z)) - labels[rows]
            of = np.repeat(np.arange(len(rows)), np.diff(np.append(at, len(idx))))
            dw = error[of] * val
            dv = dw[:, None] * (sums[of] - model.v[idx] * val[:, None])
            used, where = np.unique(idx, return_inverse=True)
            sw = np.bincount(where, dw, len(used)) / len(rows) + DECAY * model.w[used]
            sv = np.stack([np.bincount(where, dv[:, f], len(used)) for f in range(dv.shape[1])], 1)
            sv = sv / len(rows) + DECAY * model.v[used]
            gw[used] += sw * sw
            gv[used] += sv * sv
            model.w[used] -= RATE * sw / np.sqrt(gw[used])
            model.v[used] -= RATE * sv / np.sqrt(gv[used])
            e = error.mean()
            g0 += e * e
            model.w0 -= RATE * e / math.sqrt(g0)
    return model


def _sample_features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [features(x) for x in batch.column("data").to_pylist()]
        yield pa.RecordBatch.from_arrays([
            pa.array([g[0] for g in got], pa.list_(pa.int32())),
            pa.array([g[1] for g in got], pa.list_(pa.float32())),
            pa.array([[*g[2], float(len(x))] for g, x in zip(got, batch.column("data").to_pylist())],
                     pa.list_(pa.float64())),
            batch.column("label").cast(pa.float64()),
        ], names=["idx", "val", "stats", "label"])


def id_remainder(doc_id: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n`` (a NULL id counts as no text)."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % n


def held_out(doc_id: Column) -> Column:
    return id_remainder(doc_id, 3) == 1


def train(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Model:
    """Fit on at most ``sample_rows`` labelled rows that aren't held out."""
    chosen = (labels.select(labels["doc_id"].cast("long").alias("label_id"), labels["quality"].alias("label"))
              .filter(F.col("label").isNotNull() & F.col("label_id").isNotNull()
                      & ~held_out(F.col("label_id")))
              .groupBy("label_id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64("label_id"), "label_id").limit(sample_rows))
    rows = (ids_and_bytes(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
            .select("doc_id", "data", "label").mapInArrow(_sample_features, FEATURES).toArrow())
    parts = [(r["idx"], r["val"], r["stats"][:-1]) for r in rows.to_pylist()]
    # the order in which rows arrive must not change the fit
    order = sorted(range(len(parts)), key=lambda i: (parts[i][0], parts[i][2]))
    sizes = np.array([r[-1] for r in rows["stats"].to_pylist()], np.float64)
    target = (rows["label"].to_numpy() > 0).astype(np.float64)
    return fit([parts[i] for i in order], sizes[order], target[order])


class Scorer:
    def __init__(self, model: Model):
        self.model = model

    def of(self, texts: list[bytes]) -> np.ndarray:
        sizes = np.array([float(len(x)) for x in texts])
        z, _ = self.model.margin(*flat([features(x) for x in texts], sizes, self.model))
        return 1 / (1 + np.exp(-np.clip(z, -500, 500)))

    @no_cycle_collection
    def scores(self, batches):
        for batch in batches:
            for part in slices(batch, "data", BATCH_BYTES):
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(self.of(part.column("data").to_pylist()))],
                    names=["doc_id", "score"])

    @no_cycle_collection
    def accepted(self, batches):
        """The rows of ``documents`` whose text scores 0.5 or more, as they are."""
        for batch in batches:
            for i in range(0, batch.num_rows, 500):
                part = batch.slice(i, 500)
                texts = [(x or "").encode() for x in part.column("text").to_pylist()]
                yield part.filter(pa.array(self.of(texts) >= 0.5))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted: one row per document."""
    scored = ids_and_bytes(docs).mapInArrow(Scorer(model).scores, SCORES)
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                         F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` (all columns) without the documents that the model rejects."""
    return docs.mapInArrow(Scorer(model).accepted, docs.schema)
