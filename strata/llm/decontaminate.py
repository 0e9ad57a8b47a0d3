"""Benchmark decontamination with an FM-index per training shard.

Test phrases are the windows of ``WINDOW`` consecutive words of each benchmark
item (an item of fewer words is one window). A task cuts its documents into
shards of ``SHARD_BYTES``, writes each shard as a sequence of word numbers of the
benchmark's vocabulary (any other word breaks the sequence; stretches shorter
than the shortest phrase can hold no phrase and are left out), builds its
FM-index, searches all phrases backwards through wavelet-matrix ranks, locates
the occurrences by sampled suffix positions and merges them into spans.

Documents are never shuffled. The benchmark goes to the tasks in blocks of about
``BLOCK_BYTES`` of text, each a broadcast of its own, of which a task holds one
at a time: any size of benchmark is searched whole with bounded memory.

Defined results: NULL or empty texts have no words; items without words have no
window; repeated rows are judged row by row; repeated item ids count once; a
NULL item id is the empty string; an empty benchmark contaminates nothing; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, slices
from strata.llm.fm_index import FmIndex

WINDOW = 10
SHARD_BYTES = 8_000_000
BLOCK_BYTES = 8_000_000
BREAK = 1                       # the symbol between stretches; words follow from 2
FOUND = ("doc_id long, n_words long, n_hit long, n_items long, items_sha256 string, "
         "contaminated boolean, spans array<struct<start:long,end:long>>, items array<string>")

#: Bytes of words (0-9, a-z and all above 127) stay, A-Z are lower-cased, others are blanks.
WORD_BYTES = bytes(b if b >= 128 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words_of(data: bytes) -> list[bytes]:
    return data.translate(WORD_BYTES).split()


class Phrases:
    """The windows of a block of items, as numbers of its vocabulary."""

    def __init__(self, items: list[tuple[str, bytes]], window: int = WINDOW):
        self.number: dict[bytes, int] = {}
        at: dict[tuple[int, ...], int] = {}
        owners: list[tuple[int, int]] = []
        self.items = sorted({i for i, _ in items})
        item_number = {x: n for n, x in enumerate(self.items)}
        for item, data in items:
            ids = [self.number.setdefault(w, len(self.number) + 2) for w in words_of(data)]
            for i in range(max(1, len(ids) - window + 1) if ids else 0):
                phrase = tuple(ids[i: i + window])
                owners.append((at.setdefault(phrase, len(at)), item_number[item]))
        self.lengths = np.array([len(p) for p in at], np.int64)
        self.patterns = np.zeros((len(at), window), np.int64)
        for row, p in enumerate(at):
            self.patterns[row, window - len(p):] = p
        self.shortest = int(self.lengths.min()) if at else 0
        pairs = np.array(sorted(set(owners)), np.int64).reshape(-1, 2)
        self.owner_items = pairs[:, 1]
        self.owner_start = np.searchsorted(pairs[:, 0], np.arange(len(at) + 1))

    def occurrences(self, numbers: np.ndarray, doc_of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first word) of every occurrence in a shard, whose words have
        these numbers (0: in no phrase) and belong to these documents."""
        nothing = np.zeros(0, np.int64), np.zeros(0, np.int64)
        inside = np.flatnonzero(numbers)
        if not len(self.lengths) or not len(inside):
            return nothing
        new = np.ones(len(inside), bool)
        new[1:] = (np.diff(inside) != 1) | (np.diff(doc_of[inside]) != 0)
        first = np.flatnonzero(new)
        size = np.diff(np.append(first, len(inside)))
        keep = np.repeat(size >= self.shortest, size)
        inside, stretch = inside[keep], np.repeat(np.arange(len(first)), size)[keep]
        if not len(inside):
            return nothing
        # a break before each stretch
        gaps = np.cumsum(np.concatenate(([1], np.diff(stretch) != 0)))
        place = np.arange(len(inside)) + gaps
        seq = np.full(len(inside) + gaps[-1], BREAK, np.int64)
        seq[place] = numbers[inside]
        word = np.zeros(len(seq), np.int64)
        word[place] = inside
        index = FmIndex(seq, len(self.number) + 2)
        phrase, ranges = index.find(self.patterns, self.lengths)
        n = ranges[:, 1] - ranges[:, 0]
        rows = np.repeat(ranges[:, 0] - np.cumsum(n) + n, n) + np.arange(n.sum())
        return np.repeat(phrase, n), word[index.locate(rows)]


def _merged(hit: np.ndarray) -> list[dict]:
    """Spans of True."""
    edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return [{"start": a, "end": b} for a, b in edges.reshape(-1, 2).tolist()]


class Search:
    """What a task runs; ``blocks`` are broadcasts of lists of (item id, text)."""

    def __init__(self, blocks, window: int):
        self.blocks, self.window = blocks, window

    def phrases(self) -> Iterator[Phrases]:
        if len(self.blocks) == 1:
            if not hasattr(self, "_only"):
                self._only = Phrases(self.blocks[0].value, self.window)
            yield self._only
            return
        for block in self.blocks:
            yield Phrases(block.value, self.window)

    def shard(self, texts: list[bytes]):
        """Per document: number of words, which are hit, ids of the items found."""
        words = [words_of(t) for t in texts]
        sizes = np.array([len(w) for w in words], np.int64)
        doc_of = np.repeat(np.arange(len(words)), sizes)
        delta = np.zeros(len(doc_of) + 1, np.int64)
        found: list[set[str]] = [set() for _ in words]
        for phrases in self.phrases():
            get = phrases.number.get
            numbers = np.fromiter((get(w, 0) for own in words for w in own), np.int64, len(doc_of))
            phrase, start = phrases.occurrences(numbers, doc_of)
            np.add.at(delta, start, 1)
            np.add.at(delta, start + phrases.lengths[phrase], -1)
            pairs = np.unique(doc_of[start] * max(1, len(phrases.lengths)) + phrase)
            for d, p in zip(*(x.tolist() for x in np.divmod(pairs, max(1, len(phrases.lengths))))):
                a, b = phrases.owner_start[p], phrases.owner_start[p + 1]
                found[d].update(phrases.items[i] for i in phrases.owner_items[a:b])
        hit = np.cumsum(delta[:-1]) > 0
        ends = np.cumsum(sizes)
        return [(n, hit[e - n: e], sorted(f)) for n, e, f in zip(sizes.tolist(), ends.tolist(), found)]

    def rows(self, batches):
        for batch in batches:
            for part in slices(batch, "data", SHARD_BYTES):
                got = self.shard(part.column("data").to_pylist())
                n_hit = [int(h.sum()) for _, h, _ in got]
                yield pa.RecordBatch.from_arrays([
                    part.column("doc_id"),
                    pa.array([n for n, _, _ in got], pa.int64()),
                    pa.array(n_hit, pa.int64()),
                    pa.array([len(f) for _, _, f in got], pa.int64()),
                    pa.array([hashlib.sha256(",".join(f).encode()).hexdigest() for _, _, f in got]),
                    pa.array([n > 0 for n in n_hit]),
                    pa.array([_merged(h) for _, h, _ in got],
                             pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                    pa.array([f for _, _, f in got], pa.list_(pa.string())),
                ], names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated",
                          "spans", "items"])

    def clean(self, batches):
        """The rows of ``documents`` in which nothing is found, as they are."""
        for batch in batches:
            data = pa.RecordBatch.from_arrays(
                [pa.array(range(batch.num_rows)), batch.column("text").cast(pa.binary()).fill_null(b"")],
                names=["row", "data"])
            for part in slices(data, "data", SHARD_BYTES):
                got = self.shard(part.column("data").to_pylist())
                rows = batch.slice(part.column("row")[0].as_py(), part.num_rows)
                yield rows.filter(pa.array([not h.any() for _, h, _ in got]))


def _search(bench: DataFrame, window: int) -> Search:
    spark = bench.sparkSession
    items = bench.select(F.coalesce(bench["item_id"].cast("string"), F.lit("")).alias("item"),
                         F.coalesce(bench["text"].cast("binary"), F.lit(b"")).alias("data"))
    total = items.agg(F.sum(F.length("data"))).first()[0] or 0
    n = max(1, -(-total // BLOCK_BYTES))
    blocks = []
    for b in range(n):
        part = items.filter(F.pmod(F.xxhash64("item", "data"), F.lit(n)) == b).toArrow()
        blocks.append(spark.sparkContext.broadcast(
            list(zip(part["item"].to_pylist(), part["data"].to_pylist()))))
    return Search(blocks, window)


def contamination(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: the counts, the merged spans of hit words (word
    numbers, end exclusive) and the ids of the items found."""
    return ids_and_bytes(docs).mapInArrow(_search(bench, window).rows, FOUND)


def decontaminate(docs: DataFrame, bench: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (all columns) without the documents that hold a phrase."""
    return docs.mapInArrow(_search(bench, window).clean, docs.schema)
