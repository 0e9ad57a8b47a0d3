"""Byte-level BPE encoding and decoding with a segment tree per piece.

A piece (one match of the split pattern) is a row of bytes. A segment tree over
the byte positions stores in every node the least (pair rank, position) below
it, so the root is the leftmost pair of minimum rank. A merge gives the pair's
token to its left position, unlinks its right position from the live
neighbours, and makes three point updates (the merged position, its live left
neighbour, the dead position), each logarithmic in the piece.

Pieces of up to ``WIDEST`` bytes are merged many at a time: their trees are
rows of one array and every step works on the rows that still have a pair.
Longer pieces use the same tree one by one (n merges of log n steps), so a
piece of a hundred thousand letters is no trouble. Pieces repeat, so each
task remembers those it has merged, up to ``REMEMBERED``; the memory is emptied
when full and at the task's end, and only saves time.

Defined results: NULL and empty texts have no tokens (the digests are those of
the empty string); the split needs no special tokens, their strings are
ordinary text; repeated rows and ids are encoded row by row; an empty table
gives an empty result; other columns are not read.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from strata.llm.common import ids_and_bytes, no_cycle_collection, slices

WIDEST = 128
REMEMBERED = 200_000
BATCH_BYTES = 2_000_000
TREE_CELLS = 1 << 16            # pieces merged at a time, times their width
POSITION_BITS = 32              # of a key of one long piece: rank, then position
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, ids array<int>"


def read_ranks(data: bytes) -> list[bytes]:
    """The tokens of a rank file (base64 token, rank), by rank."""
    pairs = sorted((int(rank), base64.b64decode(token))
                   for token, rank in (line.split() for line in data.splitlines() if line))
    if [r for r, _ in pairs] != list(range(len(pairs))):
        raise ValueError("ranks must count up from 0")
    return [token for _, token in pairs]


class Bpe:
    """Encoder and decoder of one vocabulary."""

    def __init__(self, tokens: list[bytes], pattern: str):
        import regex
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.split = regex.compile(pattern).findall
        self.byte = np.array([self.rank[bytes([b])] for b in range(256)], np.int64)
        self.pair: dict[int, int] = {}
        for merged, token in enumerate(tokens):
            for cut in range(1, len(token)):
                a, b = self.rank.get(token[:cut]), self.rank.get(token[cut:])
                if a is not None and b is not None:
                    self.pair[a << 32 | b] = merged
        keys = np.fromiter(self.pair.keys(), np.int64, len(self.pair))
        order = np.argsort(keys)
        self.pair_keys = np.append(keys[order], np.iinfo(np.int64).max)
        self.pair_ranks = np.append(np.fromiter(self.pair.values(), np.int64, len(self.pair))[order], 0)
        self.known: dict[str, tuple[int, ...]] = {}

    # -- many pieces at a time -------------------------------------------------

    def keys_of(self, left: np.ndarray, right: np.ndarray, at: np.ndarray, width: int,
                none: int) -> np.ndarray:
        """Tree keys (rank * width + position) of pairs; ``none`` where they don't merge."""
        pair = left.astype(np.int64) << 32 | right
        i = np.searchsorted(self.pair_keys, pair)
        return np.where(self.pair_keys[i] == pair, self.pair_ranks[i] * width + at, none).astype(np.int32)

    def merge_many(self, pieces: list[bytes], width: int) -> list[tuple[int, ...]]:
        """Merge pieces of 2 to ``width`` bytes (a power of two)."""
        n, none = len(pieces), len(self.tokens) * width
        sizes = np.fromiter(map(len, pieces), np.int32, n)
        inside = np.arange(width) < sizes[:, None]
        symbol = np.full((n, width + 1), -1, np.int32)
        symbol[:, :width][inside] = self.byte[np.frombuffer(b"".join(pieces), np.uint8)]
        after = np.minimum(np.arange(1, width + 1, dtype=np.int32), sizes[:, None])
        before = np.broadcast_to(np.arange(-1, width, dtype=np.int32), (n, width + 1)).copy()
        tree = np.full((n, 2 * width), none, np.int32)
        r, p = np.nonzero(inside[:, 1:])
        tree[r, width + p] = self.keys_of(symbol[r, p], symbol[r, p + 1], p, width, none)
        level = width
        while level > 1:
            tree[:, level // 2: level] = np.minimum(tree[:, level: 2 * level: 2],
                                                    tree[:, level + 1: 2 * level: 2])
            level //= 2
        row = np.arange(n)
        while True:
            root = tree[row, 1]
            live = root != none
            row, root = row[live], root[live]
            if not len(row):
                break
            at = root % width
            dead = after[row, at]
            follow = after[row, dead]
            symbol[row, at] = merged = root // width
            symbol[row, dead] = -1
            after[row, at] = follow
            before[row, follow] = at            # the end of the piece is a position as well
            prior = before[row, at]
            right, left = follow < sizes[row], prior >= 0
            rows = np.concatenate((row[left], row[right]))
            starts = np.concatenate((prior[left], at[right]))
            firsts = np.concatenate((symbol[row[left], prior[left]], merged[right]))
            seconds = np.concatenate((merged[left], symbol[row[right], follow[right]]))
            tree[row, width + dead] = none
            tree[row, width + at] = none
            tree[rows, width + starts] = self.keys_of(firsts, seconds, starts, width, none)
            node = np.stack((dead, at, np.where(left, prior, at))) + width
            while node[0, 0] > 1:
                node >>= 1
                tree[row, node] = np.minimum(tree[row, 2 * node], tree[row, 2 * node + 1])
        alive = symbol >= 0
        flat = symbol[alive].tolist()
        ends = np.cumsum(alive.sum(axis=1)).tolist()
        return [tuple(flat[a:b]) for a, b in zip([0, *ends[:-1]], ends)]

    # -- one long piece --------------------------------------------------------

    def merge_one(self, piece: bytes) -> tuple[int, ...]:
        n = len(piece)
        width = 1 << (n - 1).bit_length()
        symbol = self.byte[np.frombuffer(piece, np.uint8)].tolist()
        after, before = list(range(1, n + 1)), list(range(-1, n))
        pair = self.pair.get
        none = len(self.tokens) << POSITION_BITS
        tree = [none] * (2 * width)

        def key(a: int, b: int) -> int:
            rank = pair(symbol[a] << 32 | symbol[b])
            return none if rank is None else rank << POSITION_BITS | a

        def put(position: int, value: int) -> None:
            i = position + width
            tree[i] = value
            while i > 1:
                i >>= 1
                x, y = tree[2 * i], tree[2 * i + 1]
                least = x if x < y else y
                if tree[i] == least:
                    return
                tree[i] = least

        tree[width: width + n - 1] = [key(i, i + 1) for i in range(n - 1)]
        for i in range(width - 1, 0, -1):
            tree[i] = min(tree[2 * i], tree[2 * i + 1])
        while tree[1] != none:
            at, rank = tree[1] & ((1 << POSITION_BITS) - 1), tree[1] >> POSITION_BITS
            dead = after[at]
            follow = after[dead]
            symbol[at], symbol[dead] = rank, -1
            after[at] = follow
            if follow < n:
                before[follow] = at
            put(dead, none)
            put(at, key(at, follow) if follow < n else none)
            if before[at] >= 0:
                put(before[at], key(before[at], at))
        return tuple(s for s in symbol if s >= 0)

    # -- texts -----------------------------------------------------------------

    def learn(self, pieces: set[str]) -> None:
        """Merge the pieces that aren't remembered."""
        if len(self.known) + len(pieces) > REMEMBERED:
            self.known.clear()
        by_width: dict[int, list[tuple[str, bytes]]] = {}
        for piece in pieces.difference(self.known):
            data = piece.encode()
            whole = self.rank.get(data)
            if whole is not None:               # a piece that is a token needs no merge
                self.known[piece] = (whole,)
            elif len(data) > WIDEST:
                self.known[piece] = self.merge_one(data)
            else:
                by_width.setdefault(max(4, 1 << (len(data) - 1).bit_length()), []).append((piece, data))
        for width, todo in by_width.items():
            step = TREE_CELLS // width
            for i in range(0, len(todo), step):
                part = todo[i: i + step]
                self.known.update(zip((p for p, _ in part),
                                      self.merge_many([d for _, d in part], width)))

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        split = [self.split(t) for t in texts]
        self.learn(set(chain.from_iterable(split)))
        for pieces in split:
            yield list(chain.from_iterable(map(self.known.__getitem__, pieces)))

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


#: One encoder per worker process and vocabulary: its tables are made once.
_ENCODERS: dict[tuple[bytes, str], Bpe] = {}


class Encoder:
    """What a task runs; carries the rank file's bytes (under 1 MB, fixed)."""

    def __init__(self, ranks: bytes, pattern: str):
        self.ranks, self.pattern = ranks, pattern

    def bpe(self) -> Bpe:
        at = (hashlib.sha256(self.ranks).digest(), self.pattern)
        if at not in _ENCODERS:
            _ENCODERS[at] = Bpe(read_ranks(self.ranks), self.pattern)
        return _ENCODERS[at]

    def parts(self, batches: Iterator[pa.RecordBatch]):
        try:
            for batch in batches:
                for part in slices(batch, "data", BATCH_BYTES):
                    yield part.column("doc_id"), [x.decode("utf-8", "replace")
                                                  for x in part.column("data").to_pylist()]
        finally:
            self.bpe().known.clear()        # a worker lives on; what it remembered need not

    @no_cycle_collection
    def tokens(self, batches):
        bpe = self.bpe()
        for ids, texts in self.parts(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(list(bpe.encode_batch(texts)), pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    @no_cycle_collection
    def digests(self, batches):
        bpe = self.bpe()
        names = list(map(str, range(len(bpe.tokens))))
        sha = lambda data: hashlib.sha256(data).hexdigest()
        for doc_ids, texts in self.parts(batches):
            n, a, b = [], [], []
            for ids in bpe.encode_batch(texts):
                n.append(len(ids))
                a.append(sha(",".join(map(names.__getitem__, ids)).encode()))
                b.append(sha(bpe.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def decoded(self, batches):
        bpe = self.bpe()
        for batch in batches:
            texts = [None if x is None else bpe.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.binary())],
                                             names=["doc_id", "data"])


def _encoder(ranks_path: str, pattern: str) -> Encoder:
    with open(ranks_path, "rb") as f:
        return Encoder(f.read(), pattern)


def encode(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, ids: the token ids of every whole text."""
    return ids_and_bytes(docs).mapInArrow(_encoder(ranks_path, pattern).tokens, TOKENS)


def decode(tokens: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, data: the bytes that the ids stand for."""
    return tokens.mapInArrow(_encoder(ranks_path, pattern).decoded, "doc_id long, data binary")


def round_trip(docs: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass."""
    return ids_and_bytes(docs).mapInArrow(_encoder(ranks_path, pattern).digests, DIGESTS)
