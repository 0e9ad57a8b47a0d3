"""MinHash near-dedup by a multi-index Hamming join.

1. Every whole text becomes the set of its distinct word shingles (64-bit
   hashes), a digest of that set, and a signature of MinHash symbols of ``BITS``
   bits. Texts of equal sets form a class, which from here on is one row: exact
   copies cost nothing further and are never paired.
2. Multi-index: a signature is split into m chunks of ``SYMBOLS`` symbols. Two
   signatures that differ in at most 2m - 1 symbols have, by pigeonhole, a chunk
   with at most one error; so each chunk is indexed with no error and with one,
   by enumerating the symbol that may differ (the other symbols are the key). All
   pairs under that distance are met for certain. m follows from the similarity
   (10 at 0.85, 13 at 0.8): a pair that is just similar enough lies under the
   distance (19 of 60, where its mean is 9), or is still met unless all chunks
   have two errors or more; less than one in a million is not.
3. Classes that share a key are joined to the key's least class (a star, never
   all pairs), and the components of these edges are the candidate groups: every
   link has both ends in one group.
4. Links are confirmed on full sets, inside a group, by intersection counts. A
   group of more than ``BLOCK`` shingles is split: its classes go to size classes
   (a link bounds the ratio of sizes, so only neighbouring size classes can hold
   one), those to blocks by hash, and each pair of blocks is a task of its own.
   A task returns a spanning star of what it linked; the components of these are
   the result.

Defined results: NULL and empty texts have an empty set, are kept and linked with
nothing; fewer words than a shingle are one shingle; rows with equal sets share a
component; rows that repeat an id with an equal text share its verdict; a NULL id
is no component's least id unless all are NULL; an empty table gives an empty
result; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, materialise, no_cycle_collection, slices
from strata.llm.components import connected_components

SYMBOLS, BITS = 6, 16
MISSED = 1e-6
SEED = 41
BLOCK = 100_000
BATCH_BYTES = 2_000_000
REMEMBERED = 100_000
SIGNED = "doc_id long, n_shingles long, digest binary, sig binary, sha binary"
KEYS = "key long, cid long"
LINKS = "a long, b long"


def _odd(seed: int, *shape: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    return rng.integers(0, 1 << 63, shape, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


_PLACES = _odd(SEED, 64)


def chunks_for(percent: int) -> int:
    """Chunks so that a pair of just this similarity meets in one but for ``MISSED``."""
    s = percent / 100
    meet = s ** SYMBOLS + SYMBOLS * s ** (SYMBOLS - 1) * (1 - s)
    return 1 if meet >= 1 else math.ceil(math.log(MISSED) / math.log(1 - meet))


def _mix(x: np.ndarray) -> np.ndarray:
    """A fixed permutation of 64-bit values that spreads every bit."""
    x = x ^ (x >> np.uint64(31))
    x = x * _PLACES[62]
    x = x ^ (x >> np.uint64(29))
    x = x * _PLACES[63]
    return x ^ (x >> np.uint64(32))


class _Words(dict):
    """Word -> 64-bit hash, remembered."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        if len(self) >= REMEMBERED:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(data: bytes, size: int, words: dict) -> np.ndarray:
    """Sorted distinct shingle hashes of a text (A-Z lower-cased, words are runs
    without white space)."""
    own = data.lower().split()
    h = np.fromiter(map(words.__getitem__, own), np.uint64, len(own))
    n = len(own) - size + 1
    if n > 0:
        parts = [h[i: i + n] * _PLACES[i] for i in range(size)]
        return np.unique(_mix(np.sum(parts, axis=0, dtype=np.uint64)))
    if len(h):                              # the whole sequence; its length tells it from shingles
        return _mix(np.sum(h * _PLACES[:len(h)], dtype=np.uint64, keepdims=True) + np.uint64(len(h)))
    return h


def signatures(values: np.ndarray, at: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """MinHash symbols (a row each) of the sets that start at ``at``."""
    out = np.empty((len(at), len(hashes)), np.uint16)
    for i, a in enumerate(hashes):
        out[:, i] = _mix(np.minimum.reduceat(values * a, at)) >> np.uint64(64 - BITS)
    return out


def set_digest(shingles: np.ndarray) -> bytes:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest()


class Sign:
    def __init__(self, size: int, chunks: int):
        self.size, self.hashes = size, _odd(SEED + 1, chunks * SYMBOLS)

    @no_cycle_collection
    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = _Words()
        for batch in batches:
            for part in slices(batch, "data", BATCH_BYTES):
                texts = part.column("data").to_pylist()
                sets = [shingle_set(x, self.size, words) for x in texts]
                sizes = np.array([len(s) for s in sets], np.int64)
                sigs: list[bytes | None] = [None] * len(sets)
                some = np.flatnonzero(sizes)
                # a few sets at a time, so that they stay in the processor's cache
                step = np.cumsum(sizes[some]) // 30_000
                for rows in np.split(some, np.flatnonzero(np.diff(step)) + 1) if len(some) else []:
                    at = np.cumsum(sizes[rows]) - sizes[rows]
                    got = signatures(np.concatenate([sets[r] for r in rows]), at, self.hashes)
                    for r, s in zip(rows.tolist(), got):
                        sigs[r] = s.tobytes()
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"), pa.array(sizes),
                    pa.array([set_digest(s) for s in sets], pa.binary()),
                    pa.array(sigs, pa.binary()),
                    pa.array([hashlib.sha256(x.lower()).digest() for x in texts], pa.binary())],
                    names=["doc_id", "n_shingles", "digest", "sig", "sha"])


class IndexKeys:
    """Every chunk of a signature without one of its symbols, as a 64-bit key."""

    def __init__(self, chunks: int):
        self.chunks = chunks
        self.weights, self.salts = _odd(SEED + 2, chunks, SYMBOLS), _odd(SEED + 3, chunks, SYMBOLS)

    def __call__(self, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = batch.slice(i, 4096)
                sig = np.frombuffer(b"".join(part.column("sig").to_pylist()), np.uint16)
                terms = sig.reshape(-1, self.chunks, SYMBOLS).astype(np.uint64) * self.weights
                keys = _mix(terms.sum(axis=2, dtype=np.uint64)[:, :, None] - terms + self.salts)
                cids = np.repeat(part.column("cid").to_numpy(), self.chunks * SYMBOLS)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.reshape(-1).view(np.int64)), pa.array(cids)], names=["key", "cid"])


def confirm(cids: np.ndarray, sets: list[np.ndarray], percent: int) -> tuple[np.ndarray, np.ndarray]:
    """A spanning star (least id, other id) of each component of the links
    100 * intersection >= percent * union among these sets."""
    sizes = np.array([len(s) for s in sets], np.int64)
    order = np.lexsort((cids, sizes))
    cids, sizes = cids[order], sizes[order]
    shingles, dense = np.unique(np.concatenate([sets[i] for i in order]), return_inverse=True)
    ends = np.cumsum(sizes)
    starts = ends - sizes
    label = np.arange(len(cids))
    mark = np.zeros(len(shingles), bool)
    # sizes rise, so the possible partners of a set are the next ones, as far as the ratio of sizes allows
    last = np.searchsorted(sizes, sizes * 100 // percent, side="right")
    for i, j in enumerate(last.tolist()):
        if j <= i + 1 or (label[i + 1: j] == label[i]).all():
            continue
        own = dense[starts[i]: ends[i]]
        mark[own] = True
        common = np.add.reduceat(mark[dense[starts[i + 1]: ends[j - 1]]], starts[i + 1: j] - starts[i + 1],
                                 dtype=np.int64)
        mark[own] = False
        linked = i + 1 + np.flatnonzero(100 * common >= percent * (sizes[i] + sizes[i + 1: j] - common))
        for other in np.unique(label[linked]).tolist():
            if other != label[i]:
                label[label == other] = label[i]
    least = np.full(len(cids), np.iinfo(np.int64).max)
    np.minimum.at(least, label, cids)
    root = least[label]
    return root[root != cids], cids[root != cids]


def confirmer(size: int, percent: int):
    """The function that a task of ``confirm`` runs on its rows."""
    def run(rows: pa.Table) -> pa.Table:
        words = _Words()
        sets = [shingle_set(x, size, words) for x in rows["data"].to_pylist()]
        # an id may have come with other texts as well: those that aren't the class's go
        own = [i for i, d in enumerate(rows["digest"].to_pylist()) if set_digest(sets[i]) == d]
        a, b = confirm(rows["cid"].to_numpy()[own], [sets[i] for i in own], percent)
        return pa.table({"a": pa.array(a, pa.int64()), "b": pa.array(b, pa.int64())})
    return run


def candidate_groups(classes: DataFrame, chunks: int) -> DataFrame:
    """(node, label): classes that share index keys, by stars and their components."""
    keys = classes.select("cid", "sig").mapInArrow(IndexKeys(chunks), KEYS)
    shared = (keys.groupBy(F.col("key").alias("k")).agg(F.min("cid").alias("lo"), F.max("cid").alias("hi"))
              .filter("lo != hi").select("k", "lo"))
    star = keys.join(shared, F.col("key") == F.col("k")).filter("cid != lo")
    return connected_components(star.select(F.col("lo").alias("a"), F.col("cid").alias("b")))


def tasks_of(members: DataFrame, percent: int, block: int) -> DataFrame:
    """members (cid, label, n_shingles, ...) with ``task``: the group as a whole,
    or for a large group each pair of blocks that a class belongs to."""
    step = math.log(100 / (percent - 1))        # a little wider than the ratio that a link allows
    members = members.withColumn("sc", F.floor(F.log(F.col("n_shingles").cast("double")) / step).cast("int"))
    total = members.groupBy(F.col("label").alias("tl")).agg(F.sum("n_shingles").alias("total"))
    large = total.filter(F.col("total") > block).select("tl")
    blocks = (members.join(large, F.col("label") == F.col("tl"), "left_semi").groupBy("label", "sc")
              .agg(F.ceil(F.sum("n_shingles") / block).cast("int").alias("nb")))
    blocks = materialise(blocks, "blocks")
    whole = (members.join(large, F.col("label") == F.col("tl"), "left_anti")
             .withColumn("task", F.concat_ws("/", "label")))
    # a class meets the blocks of its own size class and of the next smaller and larger ones
    near = blocks.select(F.col("label").alias("nl"), F.explode(F.sequence(F.col("sc") - 1, F.col("sc") + 1)).alias("at"),
                         F.col("sc").alias("osc"), F.col("nb").alias("onb"))
    own = blocks.select(F.col("label").alias("ol"), F.col("sc").alias("os"), F.col("nb").alias("own_nb"))
    split = (members.join(own, (F.col("label") == F.col("ol")) & (F.col("sc") == F.col("os")))
             .join(near, (F.col("label") == F.col("nl")) & (F.col("sc") == F.col("at")))
             .withColumn("mine", F.pmod(F.xxhash64("cid"), F.col("own_nb")).cast("int"))
             .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("onb") - 1))))
    me, it = F.struct(F.col("sc").alias("s"), F.col("mine").alias("b")), F.struct(F.col("osc").alias("s"), F.col("other").alias("b"))
    split = split.withColumn("task", F.concat_ws("/", F.col("label"), F.least(me, it)["s"], F.least(me, it)["b"],
                                                 F.greatest(me, it)["s"], F.greatest(me, it)["b"]))
    return whole.select("task", "cid", "rep", "digest").union(split.select("task", "cid", "rep", "digest"))


def judged_rows(docs: DataFrame, shingle: int, percent: int, block: int) -> DataFrame:
    """doc_id, sha, n_shingles, component_id, leads: one row per document. ``leads``
    marks the one (id, text) that stands for its component: of its least id the text
    of least digest, so that an id with several texts leads with one."""
    data = ids_and_bytes(docs)
    chunks = chunks_for(percent)
    signed = materialise(data.mapInArrow(Sign(shingle, chunks), SIGNED), "signatures")
    last = F.lit((1 << 63) - 1)
    own = F.struct(F.coalesce("doc_id", last).alias("id"), F.col("sha"))
    classes = (signed.filter("n_shingles > 0").groupBy("digest", "n_shingles")
               .agg(F.min("doc_id").alias("rep"), F.first("sig").alias("sig"), F.count("*").alias("copies"),
                    F.min(own).alias("lead"))
               .withColumn("cid", F.monotonically_increasing_id()))
    classes = materialise(classes, "classes")       # the class numbers are fixed by being written
    groups = candidate_groups(classes, chunks)
    members = materialise(classes.join(groups, F.col("cid") == F.col("node")).select("cid", "rep", "digest", "n_shingles", "label"),
                          "members")
    todo = tasks_of(members, percent, block)
    # the text of one document of each class
    texts = todo.join(data, F.col("rep").eqNullSafe(F.col("doc_id"))).select("task", "cid", "digest", "data")
    links = texts.groupBy("task").applyInArrow(confirmer(shingle, percent), LINKS)
    linked = connected_components(links)
    found = classes.join(linked, F.col("cid") == F.col("node"), "left")
    least = (found.filter("label is not null").groupBy(F.col("label").alias("cl"))
             .agg(F.min("rep").alias("component_id"), F.min("lead").alias("first")))
    named = (found.filter("label is not null or copies > 1")
             .join(least, F.col("label") == F.col("cl"), "left")
             .select(F.col("digest").alias("cd"), F.col("n_shingles").alias("cn"),
                     F.coalesce("component_id", "rep").alias("component"), F.coalesce("first", "lead").alias("first")))
    alone = F.col("cd").isNull()
    return (signed.join(named, (F.col("digest") == F.col("cd")) & (F.col("n_shingles") == F.col("cn")), "left")
            .select("doc_id", "sha", "n_shingles",
                    F.when(alone, F.col("doc_id")).otherwise(F.col("component")).alias("component_id"),
                    (alone | (own == F.col("first"))).alias("leads")))


def near_dedup(docs: DataFrame, shingle: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: one row per document."""
    return judged_rows(docs, shingle, percent, block).select(
        "doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def near_verdicts(docs: DataFrame, shingle: int = 5, percent: int = 80, block: int = BLOCK) -> DataFrame:
    """doc_id, text_sha256, kept: one (id, text) of each component is kept; what
    ``exact_dedup.keep_rows`` asks for."""
    return judged_rows(docs, shingle, percent, block).select(
        "doc_id", F.lower(F.hex("sha")).alias("text_sha256"), F.col("leads").alias("kept"))
