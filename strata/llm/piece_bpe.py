"""SentencePiece BPE encoding and decoding by vectorised merge rounds.

A text is normalised as its model says (identity rule: a dummy space in front,
spaces as U+2581) and cut into words wherever no piece of the vocabulary holds the
two characters beside the cut next to each other; no merge can cross such a
place. All words that a batch brings anew are merged together: their symbols lie
in one flat array. A round finds the least pair rank of every word (a segmented
minimum), merges the leftmost non-overlapping pairs of that rank in all words at
once, and compacts the arrays; words without a pair leave them. Rounds go on
until no pair remains.

The library merges one pair at a time: best score first, leftmost of equals. Merging
all pairs of a rank at once gives the same, unless the merged piece can go on to a
piece of an equal or better rank, which the library would then make first. Those
pieces ("early" ones, found when the vocabulary is read) are merged one a word and
round. A word of more than ``LONGEST`` symbols (a run of thousands of spaces or of
one letter) is merged in the same order from a heap, so that it isn't read again
for each of its merges.

A character that is no piece becomes the pieces of its bytes. Words repeat, so
each task remembers those it has merged, up to ``REMEMBERED``; the memory is
emptied when full and at the task's end, and only saves time.

Defined results: NULL and empty texts have the end id alone and decode to an empty
text; the strings of control and byte pieces are ordinary text; U+2581 in a text
decodes to a space, as in the library; repeated rows and ids are encoded row by row;
an empty table gives an empty result; other columns are not read. A model of
another kind (no BPE, another normaliser, user-defined or unused pieces, no byte
pieces) is refused.
"""

from __future__ import annotations

import hashlib
import heapq
import re
import struct
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, no_cycle_collection, slices

SPACE = "▁"
# Fixed values of the model format: kinds of pieces, the BPE model type.
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
BPE = 2
LONGEST = 4096
REMEMBERED = 400_000
BATCH_BYTES = 4_000_000
DIGESTS = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
TOKENS = "doc_id long, ids array<int>"
NO_PAIR = np.iinfo(np.int32).max


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a serialised message's fields."""
    def varint(i):
        value = shift = 0
        while True:
            b = data[i]
            i += 1
            value |= (b & 0x7F) << shift
            shift += 7
            if b < 0x80:
                return value, i
    i = 0
    while i < len(data):
        tag, i = varint(i)
        if tag & 7 == 0:
            value, i = varint(i)
        else:
            size = {1: 8, 5: 4}.get(tag & 7)
            if size is None:
                size, i = varint(i)
            value, i = data[i: i + size], i + size
        yield tag >> 3, value


class Model:
    """Pieces, scores and kinds of a model file, and what it does to a text first."""

    def __init__(self, data: bytes):
        self.pieces: list[str] = []
        self.scores: list[float] = []
        self.kinds: list[int] = []
        trainer: dict = {}
        normaliser: dict = {}
        for number, value in _fields(data):
            if number == 1:
                piece = dict(_fields(value))
                self.pieces.append(piece[1].decode())
                self.scores.append(struct.unpack("<f", piece[2])[0] if 2 in piece else 0.0)
                self.kinds.append(piece.get(3, NORMAL))
            elif number == 2:
                trainer = dict(_fields(value))
            elif number == 3:
                normaliser = dict(_fields(value))
        if trainer.get(3) != BPE or not trainer.get(35):
            raise ValueError("only BPE models with byte pieces are read")
        if trainer.get(24) or normaliser.get(2) or normaliser.get(4, 1) or not normaliser.get(5, 1):
            raise ValueError("only identity normalisers that keep every space, as prefix, are read")
        if {USER_DEFINED, UNUSED} & set(self.kinds):
            raise ValueError("user-defined and unused pieces are not read")
        self.prefix = SPACE if normaliser.get(3, 1) else ""
        self.unknown = trainer.get(44, " ⁇ ".encode()).decode()
        self.end = trainer.get(42, 2)


class KeyTable:
    """Places of 64-bit keys in an open-addressed table, for many keys at a time."""

    EMPTY = np.iinfo(np.int64).min
    FACTOR = np.uint64(0x9E3779B97F4A7C15)

    def __init__(self, keys: list[int]):
        bits = max(4, (4 * len(keys)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.keys = np.full((1 << bits) + len(keys) + 1, self.EMPTY, np.int64)      # no chain wraps round
        self.place = []
        home = self._home(np.array(keys, np.int64)).tolist() if keys else []
        for key, at in zip(keys, home):
            while self.keys[at] != self.EMPTY:
                at += 1
            self.keys[at] = key
            self.place.append(at)

    def _home(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * self.FACTOR) >> self.shift).astype(np.int64)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place, whether the key is there)."""
        at = self._home(keys)
        held = self.keys[at]
        other = np.flatnonzero((held != keys) & (held != self.EMPTY))
        while len(other):
            at[other] += 1
            held[other] = self.keys[at[other]]
            other = other[(held[other] != keys[other]) & (held[other] != self.EMPTY)]
        return at, held == keys


class Pieces:
    """Encoder and decoder of one model."""

    def __init__(self, model: Model):
        self.model = model
        ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, model.kinds)) if k == NORMAL}
        self.byte = [0] * 256
        for i, (p, k) in enumerate(zip(model.pieces, model.kinds)):
            if k == BYTE:
                self.byte[int(p[3:-1], 16)] = i
        # symbols: pieces, then characters that are only parts of pieces
        symbol = dict(ids)
        for c in sorted(set(chain.from_iterable(ids))):
            symbol.setdefault(c, len(model.pieces) + len(symbol) - len(ids))
        self.symbol = symbol
        # equal scores are an equal rank
        levels = {s: r for r, s in enumerate(sorted({model.scores[i] for i in ids.values()}, reverse=True))}
        self.rank = np.full(len(model.pieces) + len(symbol), NO_PAIR, np.int32)
        for i in ids.values():
            self.rank[i] = levels[model.scores[i]]
        self.pair: dict[int, int] = {}
        early, beside = set(), set()
        for piece, i in ids.items():
            beside.update(zip(piece, piece[1:]))
            for cut in range(1, len(piece)):
                a, b = symbol.get(piece[:cut]), symbol.get(piece[cut:])
                if a is None or b is None:
                    continue
                self.pair[a << 32 | b] = i
                early.update(part for part, text in ((a, piece[:cut]), (b, piece[cut:]))
                             if len(text) > 1 and self.rank[part] >= self.rank[i])
        self.pairs = KeyTable(list(self.pair))
        self.pair_to = np.zeros(len(self.pairs.keys), np.int32)
        self.pair_to[self.pairs.place] = list(self.pair.values())
        self.early = np.zeros(len(self.rank) + 1, bool)
        self.early[list(early)] = True
        # no cut is needed between characters that some piece holds side by side
        self.beside = KeyTable([ord(a) << 21 | ord(b) for a, b in beside])
        self.of_char = np.full(0x110000, -1, np.int32)
        for c, i in symbol.items():
            if len(c) == 1:
                self.of_char[ord(c)] = i
        lonely = "".join(c for c in "\t\n\r" if not any(c in pair for pair in beside))
        # nor before a space after another character, where none holds such a pair
        apart = lonely if any(b == SPACE != a for a, b in beside) else SPACE + lonely
        word = f"{SPACE}*[^{apart}]+|{SPACE}+" if apart else "(?s:.+)"
        self.split = re.compile(f"[{lonely}]|{word}" if lonely else word).findall
        self.known: dict[str, tuple[int, ...]] = {}
        self.texts = [p.replace(SPACE, " ") if k == NORMAL else "" for p, k in zip(model.pieces, model.kinds)]
        self.texts[model.kinds.index(UNKNOWN)] = model.unknown
        # an ASCII byte is a character by itself, whatever stands beside it
        for v in range(0x80):
            self.texts[self.byte[v]] = chr(v)
        self.value = {i: v for v, i in enumerate(self.byte) if v >= 0x80}

    # -- merge rounds ------------------------------------------------------------

    def merged(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The piece that each pair makes and its rank (``NO_PAIR`` where none)."""
        key = left.astype(np.int64) << 32 | (right.astype(np.int64) & 0xFFFFFFFF)
        at, found = self.pairs.find(key)
        to = self.pair_to[at]
        return to, np.where(found, self.rank[to], NO_PAIR)

    def rounds(self, symbols: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge the words that begin at ``starts`` of a flat symbol array; the array
        that remains and where each word ends in it."""
        n_words = len(starts)
        sizes = np.diff(starts, append=len(symbols))
        word = np.repeat(np.arange(n_words), sizes)
        done: list[tuple[np.ndarray, np.ndarray]] = []
        to, rank = self._pairs(symbols, word)
        while len(symbols):
            first = np.flatnonzero(np.diff(word, prepend=-1))
            least = np.minimum.reduceat(rank, first)
            size = np.diff(first, append=len(symbols))
            live = np.repeat(least != NO_PAIR, size)
            if not live.all():                              # finished words leave the arrays
                done.append((symbols[~live], word[~live]))
                symbols, word, to, rank = symbols[live], word[live], to[live], rank[live]
                if not len(symbols):
                    break
                size, least = size[least != NO_PAIR], least[least != NO_PAIR]
            at = np.flatnonzero(rank == np.repeat(least, size))
            # leftmost first, none overlapping: every other one of a chain of neighbours
            head = np.diff(at, prepend=-2) != 1
            chain_start = at[head][np.cumsum(head) - 1]
            leftmost = np.diff(word[at], prepend=-1) != 0
            alone = self.early[to[at]]
            # an early piece is merged alone, and nothing of its word that comes after it
            after_early = np.maximum.accumulate(np.where(leftmost, np.arange(len(at)), 0))
            seen = np.cumsum(alone) - alone
            blocked = (seen - seen[after_early]) > 0
            at = at[((at - chain_start) % 2 == 0) & ~blocked & (leftmost | ~alone)]
            symbols[at] = to[at]
            keep = np.ones(len(symbols), bool)
            keep[at + 1] = False
            place = np.cumsum(keep) - 1
            symbols, word, to, rank = symbols[keep], word[keep], to[keep], rank[keep]
            changed = np.zeros(len(symbols) + 1, bool)
            changed[place[at]] = True
            changed[place[at] - 1] = True                   # the last one stands for "before the first"
            self._renew(symbols, word, to, rank, np.flatnonzero(changed[:-1]))
        if not done:
            return symbols, np.zeros(n_words, np.int64)
        flat, of = (np.concatenate(x) for x in zip(*done))
        order = np.argsort(of, kind="stable")
        return flat[order], np.cumsum(np.bincount(of, minlength=n_words))

    def _pairs(self, symbols, word):
        to = np.zeros(len(symbols), np.int32)
        rank = np.full(len(symbols), NO_PAIR, np.int32)
        self._renew(symbols, word, to, rank, np.arange(len(symbols)))
        return to, rank

    def _renew(self, symbols, word, to, rank, at):
        """Pair ranks of the places ``at`` with the symbol after them in the same word."""
        rank[at] = NO_PAIR
        at = at[at + 1 < len(symbols)]
        at = at[word[at] == word[at + 1]]
        to[at], rank[at] = self.merged(symbols[at], symbols[at + 1])

    def merge_long(self, symbols: list[int]) -> list[int]:
        """The same merges of one long word, from a heap of (rank, place)."""
        n = len(symbols)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap: list[tuple[int, int, int, int]] = []

        def offer(a: int, b: int) -> None:
            if 0 <= a and b < n and symbols[a] >= 0 and symbols[b] >= 0:
                made = self.pair.get(symbols[a] << 32 | symbols[b])
                if made is not None:
                    heapq.heappush(heap, (int(self.rank[made]), a, symbols[a], symbols[b]))

        for i in range(n - 1):
            offer(i, i + 1)
        gone = [False] * n
        while heap:
            _, a, x, y = heapq.heappop(heap)
            b = after[a]
            if gone[a] or symbols[a] != x or b >= n or symbols[b] != y:
                continue                                    # made before one of its symbols changed
            symbols[a] = self.pair[x << 32 | y]
            gone[b] = True
            after[a] = after[b]
            if after[b] < n:
                before[after[b]] = a
            offer(before[a], a)
            offer(a, after[a])
        return [s for s, g in zip(symbols, gone) if not g]

    # -- texts -------------------------------------------------------------------

    def learn(self, words: set[str]) -> None:
        """Merge the words that aren't remembered."""
        if len(self.known) + len(words) > REMEMBERED:
            self.known.clear()
        new = list(words.difference(self.known))
        if not new:
            return
        chars = np.frombuffer("".join(new).encode("utf-32-le"), np.uint32).astype(np.int64)
        ends = np.cumsum(np.fromiter(map(len, new), np.int64, len(new)))
        symbols = self.of_char[chars]
        # words are cut further between characters that no piece holds side by side
        pair = chars[:-1] << 21 | chars[1:]
        cut = np.ones(len(chars), bool)
        cut[1:] = ~self.beside.find(pair)[1]
        cut[ends[:-1]] = True
        starts = np.flatnonzero(cut)
        sizes = np.diff(starts, append=len(chars))
        long = np.flatnonzero(sizes > LONGEST)
        short = np.repeat(sizes <= LONGEST, sizes)
        short_starts = (np.cumsum(np.where(sizes <= LONGEST, sizes, 0)) - sizes)[sizes <= LONGEST]
        # a character that is no symbol is told by its code point
        told = np.where(symbols < 0, -1 - chars, symbols)
        flat, own_ends = self.rounds(told[short].astype(np.int64), short_starts)
        piece_ends = np.zeros(len(starts), np.int64)
        piece_ends[sizes <= LONGEST] = np.diff(own_ends, prepend=0)
        by_long = {}
        for i in long.tolist():
            by_long[i] = self.merge_long(told[starts[i]: starts[i] + sizes[i]].tolist())
            piece_ends[i] = len(by_long[i])
        if by_long:
            short_parts = iter(np.split(flat, own_ends))
            flat = np.concatenate([by_long[i] if i in by_long else next(short_parts) for i in range(len(starts))])
        # the parts of a word together again
        last = np.searchsorted(starts, ends) - 1
        word_ends = np.cumsum(piece_ends)[last]
        odd = np.flatnonzero((flat < 0) | (flat >= len(self.model.pieces)))
        at, flat = [0, *word_ends.tolist()], flat.tolist()
        self.known.update(zip(new, [tuple(flat[a:b]) for a, b in zip(at, at[1:])]))
        # words with characters that are no pieces
        for i in np.unique(np.searchsorted(word_ends, odd, side="right")).tolist():
            self.known[new[i]] = tuple(chain.from_iterable(map(self._spelled, self.known[new[i]])))

    def _spelled(self, symbol: int) -> list[int]:
        if 0 <= symbol < len(self.model.pieces):
            return [symbol]
        c = chr(-1 - symbol) if symbol < 0 else next(c for c, i in self.symbol.items() if i == symbol)
        return [self.byte[b] for b in c.encode()]

    def encode_batch(self, texts: list[str]) -> Iterator[list[int]]:
        """The ids of each text, the end id included."""
        split = [self.split(self.model.prefix + t.replace(" ", SPACE)) if t else [] for t in texts]
        self.learn(set(chain.from_iterable(split)))
        end = [self.model.end]
        for words in split:
            yield list(chain(chain.from_iterable(map(self.known.__getitem__, words)), end))

    def decode(self, ids: list[int]) -> str:
        """The text that ids stand for; runs of byte pieces are read as UTF-8, each
        byte that is none as U+FFFD."""
        out = list(map(self.texts.__getitem__, ids))
        # the space in front goes if the first piece that shows begins with it
        if self.model.prefix:
            shows = next((i for i, x in enumerate(ids) if self.model.kinds[x] != CONTROL), None)
            if shows is not None and self.model.kinds[ids[shows]] == NORMAL:
                out[shows] = out[shows].removeprefix(" ")
        value = self.value
        if not value.keys().isdisjoint(ids):
            run: list[int] = []
            for at in [i for i, x in enumerate(ids) if x in value]:
                if run and at != run[-1] + 1:
                    self._spell_run(out, ids, run)
                    run = []
                run.append(at)
            self._spell_run(out, ids, run)
        return "".join(out)

    def _spell_run(self, out: list[str], ids: list[int], run: list[int]) -> None:
        out[run[0]] = _utf8(bytes(self.value[ids[i]] for i in run))


def _utf8(data: bytes) -> str:
    try:
        return data.decode()
    except UnicodeDecodeError:
        out, i = [], 0
        while i < len(data):
            for size in (1, 2, 3, 4):
                try:
                    out.append(data[i: i + size].decode())
                    break
                except UnicodeDecodeError:
                    continue
            else:
                out.append("�")
                size = 1
            i += size
        return "".join(out)


#: One encoder per worker process and model: its tables are made once.
_ENCODERS: dict[bytes, Pieces] = {}


class Encoder:
    """What a task runs; carries the model file's bytes (under 1 MB, fixed)."""

    def __init__(self, model: bytes):
        self.model = model

    def pieces(self) -> Pieces:
        at = hashlib.sha256(self.model).digest()
        if at not in _ENCODERS:
            _ENCODERS[at] = Pieces(Model(self.model))
        return _ENCODERS[at]

    def parts(self, batches: Iterator[pa.RecordBatch]):
        try:
            for batch in batches:
                for part in slices(batch, "data", BATCH_BYTES):
                    yield part.column("doc_id"), [x.decode("utf-8", "replace")
                                                  for x in part.column("data").to_pylist()]
        finally:
            self.pieces().known.clear()     # a worker lives on; what it remembered need not

    @no_cycle_collection
    def tokens(self, batches):
        pieces = self.pieces()
        for ids, texts in self.parts(batches):
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(list(pieces.encode_batch(texts)), pa.list_(pa.int32()))],
                names=["doc_id", "ids"])

    @no_cycle_collection
    def digests(self, batches):
        pieces = self.pieces()
        names = list(map(str, range(len(pieces.model.pieces))))
        sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
        for doc_ids, texts in self.parts(batches):
            n, a, b = [], [], []
            for ids in pieces.encode_batch(texts):
                n.append(len(ids))
                a.append(sha(" ".join(map(names.__getitem__, ids))))
                b.append(sha(pieces.decode(ids)))
            yield pa.RecordBatch.from_arrays(
                [doc_ids, pa.array(n, pa.int64()), pa.array(a), pa.array(b)],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    def decoded(self, batches):
        pieces = self.pieces()
        for batch in batches:
            texts = [None if x is None else pieces.decode(x) for x in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())],
                                             names=["doc_id", "text"])


def _encoder(model_path: str) -> Encoder:
    with open(model_path, "rb") as f:
        return Encoder(f.read())


def encode(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, ids: the piece ids of every whole text and the end id."""
    return ids_and_bytes(docs).mapInArrow(_encoder(model_path).tokens, TOKENS)


def decode(tokens: DataFrame, model_path: str) -> DataFrame:
    """doc_id, text: the texts that the ids stand for."""
    return tokens.select(F.col("doc_id").cast("long").alias("doc_id"), "ids").mapInArrow(
        _encoder(model_path).decoded, "doc_id long, text string")


def round_trip(docs: DataFrame, model_path: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256, decoded_sha256: encode and decode in one pass."""
    return ids_and_bytes(docs).mapInArrow(_encoder(model_path).digests, DIGESTS)
