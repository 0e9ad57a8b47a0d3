"""Grouping of spelling variants with PartEnum signatures over letter multisets.

1. Words. Every whole text is cut into maximal runs of letters, A-Z lower-cased, and
   each task counts its words before the shuffle. One (document, run) pair in
   ``NOISE`` loses a code point, told by a checksum of both.
2. Signatures. A word is the set of its numbered letters (the second e is an element
   of its own): a binary vector. Words that differ by one replaced code point are
   at a Hamming distance of two at most, by one inserted or deleted of one. The
   elements are dealt by hash into ``HALVES`` first-level parts, each into ``PARTS``
   second-level ones. Of two vectors at distance two, one first-level part differs
   in one element at most (pigeonhole), and that element lies in one of its second-level
   parts: so the two agree on all the others. Enumerating which one is left out gives
   HALVES * PARTS exact signatures, one of which every near pair shares.
3. Position. What the edit leaves alone is equal in both words as text: with M the longer
   one's length, either the first M // 2 code points or the last M - M // 2. Each
   signature is joined once with either, so a frequent letter set is no bucket: those
   who share a key share half of their text. Words of length M and M - 1 meet under M.
4. Join and check. Keys are equi-joined, words of length M on one side, and the edit
   distance is checked inside the join, so that only near pairs leave it.
5. Form: the near word of largest count, if it is ``RATIO`` times as frequent. Roots
   are found by pointer doubling: a form is at least five times as frequent as its word, so
   chains are as short as the logarithm of the largest count.

Defined results: a NULL text has no words; a NULL id counts as an empty string in the
checksum; rows that repeat an id and a text are counted each; a run of one code point
that loses it is no word; ties of form go to the least word in code-point order; an
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from strata.llm.common import ids_and_bytes, materialise, no_cycle_collection, slices

#: Letters in UTF-8, after A-Z are lower-cased: a-z and U+00C0 to U+00FF.
RUN = re.compile(rb"(?:[a-z]|\xc3[\x80-\xbf])+")
NOISE = 199
LEAST_LENGTH, LEAST_COUNT, RATIO = 6, 5, 5
HALVES, PARTS = 2, 3
HELD = 200_000                          # distinct words a task holds before it emits their counts
BATCH_BYTES = 2_000_000
COUNTED = "word string, n long"
KEYED = "key long, word string, full boolean"


def noisy(run: bytes, h: int) -> bytes:
    """The run without the code point that the checksum names."""
    text = run.decode()
    at = h % len(text)
    return (text[:at] + text[at + 1:]).encode()


@no_cycle_collection
def count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc_id, data) -> (word, n), partial counts."""
    counts: Counter[bytes] = Counter()

    def told():
        words = [w for w in counts if len(w) >= LEAST_LENGTH]
        yield pa.RecordBatch.from_arrays([
            pa.array(words, pa.binary()).cast(pa.string()),
            pa.array([counts[w] for w in words], pa.int64())], names=["word", "n"])
        counts.clear()

    crc, find = zlib.crc32, RUN.findall
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            for doc_id, data in zip(part.column("doc_id").to_pylist(), part.column("data").to_pylist()):
                start = crc(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                own = Counter(find(data.lower()))           # bytes.lower(): A-Z only
                for run in [r for r in own if crc(r, start) % NOISE == 0]:
                    counts[noisy(run, crc(run, start))] += own.pop(run)
                counts.update(own)
                if len(counts) > HELD:
                    yield from told()
    yield from told()


def vocabulary(docs: DataFrame) -> DataFrame:
    """word, n: the words of at least six code points and five occurrences."""
    counted = ids_and_bytes(docs).mapInArrow(count_words, COUNTED)
    return (counted.filter(F.char_length("word") >= LEAST_LENGTH).groupBy("word").agg(F.sum("n").alias("n"))
            .filter(F.col("n") >= LEAST_COUNT))


_ELEMENTS: dict[tuple[str, int], tuple[int, int, int]] = {}


def element(letter: str, number: int) -> tuple[int, int, int]:
    """(first-level part, second-level part, 64-bit hash) of a numbered letter."""
    import xxhash
    at = (letter, number)
    if at not in _ELEMENTS:
        h = xxhash.xxh3_64_intdigest(f"{number}:{letter}")
        _ELEMENTS[at] = (h % HALVES, h // HALVES % PARTS, xxhash.xxh3_64_intdigest(f"{letter}:{number}"))
    return _ELEMENTS[at]


def signatures(word: str) -> list[int]:
    """One signature for each first-level part and each of its second-level parts
    left out: the sum of the element hashes of the others."""
    sums = [[0] * PARTS for _ in range(HALVES)]
    seen: Counter[str] = Counter()
    for c in word:
        seen[c] += 1
        half, part, h = element(c, seen[c])
        sums[half][part] += h
    return [(sum(own) - own[left_out]) & 0xFFFFFFFFFFFFFFFF for own in sums for left_out in range(PARTS)]


def keys_of(word: str) -> list[tuple[int, bool]]:
    """(key, full): every key under which a word meets its near words; ``full`` if its
    length is the key's, not one less."""
    import xxhash
    out = []
    signed = signatures(word)
    for m, full in ((len(word), True), (len(word) + 1, False)):
        sides = word[: m // 2], word[len(word) - (m - m // 2):]
        for side, text in enumerate(sides):
            own = xxhash.xxh3_64_intdigest(f"{m}:{side}:{text}")
            out += [(xxhash.xxh3_64_intdigest(b"%d:%d:%d" % (own, i, s)), full) for i, s in enumerate(signed)]
    return out


@no_cycle_collection
def key_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word) -> (key, word, full)."""
    for batch in batches:
        for i in range(0, batch.num_rows, 2048):
            words = batch.column("word").slice(i, 2048)
            keys = [keys_of(w) for w in words.to_pylist()]
            flat = [k for own in keys for k in own]
            rows = np.repeat(np.arange(len(keys)), [len(own) for own in keys])
            yield pa.RecordBatch.from_arrays([
                pa.array(np.array([k for k, _ in flat], np.uint64).view(np.int64)),
                words.take(pa.array(rows)).cast(pa.string()),
                pa.array([f for _, f in flat], pa.bool_())], names=["key", "word", "full"])


def near_pairs(words: DataFrame) -> DataFrame:
    """(word, other): all pairs, both ways, that differ by one inserted, deleted or
    replaced code point."""
    keyed = materialise(words.select("word").mapInArrow(key_rows, KEYED), "spelling-keys")
    # a key that only one word has joins with nothing; both sides are dealt by the key
    a, b = keyed.filter("full").alias("a"), keyed.alias("b")
    met = a.join(b, (F.col("a.key") == F.col("b.key"))
                 & ((F.col("a.word") < F.col("b.word")) | ~F.col("b.full"))
                 & (F.levenshtein(F.col("a.word"), F.col("b.word"), 1) == 1))
    once = met.select(F.least("a.word", "b.word").alias("x"), F.greatest("a.word", "b.word").alias("y")).distinct()
    return once.select(F.explode(F.array(F.struct(F.col("x").alias("word"), F.col("y").alias("other")),
                                         F.struct(F.col("y").alias("word"), F.col("x").alias("other")))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, form) -> (word, root): forms followed to the last, by doubling."""
    point = materialise(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        ahead = point.select(F.col("word").alias("at"), F.col("root").alias("next"))
        joined = point.join(ahead, F.col("root") == F.col("at"), "left")
        longer = materialise(joined.select("word", F.coalesce("next", "root").alias("root"),
                                           F.col("next").isNotNull().alias("moved")), "roots")
        point = longer.select("word", "root")
        if not longer.filter("moved").limit(1).count():
            return point


def variants(docs: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n: one row per word."""
    words = materialise(vocabulary(docs), "words")
    others = words.select(F.col("word").alias("other"), F.col("n").alias("other_n"))
    pairs = near_pairs(words).join(others, "other")
    best = F.min(F.struct((-F.col("other_n")).alias("less"), F.col("other")))
    near = pairs.groupBy(F.col("word").alias("of")).agg(F.count("*").alias("n_near"), best.alias("best"))
    known = words.join(near, F.col("word") == F.col("of"), "left")
    enough = -F.col("best.less") >= RATIO * F.col("n")
    known = materialise(known.select("word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
                                     F.when(enough, F.col("best.other")).alias("form"),
                                     F.when(enough, -F.col("best.less")).alias("form_n")), "forms")
    last = roots(known.filter("form is not null")).select(F.col("word").alias("of"), F.col("root").alias("last"))
    return (known.join(last, F.col("word") == F.col("of"), "left")
            .select("word", "form", F.coalesce("last", "word").alias("root"), "n", "n_near", "form_n"))
