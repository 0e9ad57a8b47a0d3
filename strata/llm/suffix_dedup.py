"""Removal of repeated byte strings by suffix sorting of content-defined shards.

Every window of ``LENGTH`` bytes of every text is owned by its minimizer: the
least hash of the ``GRAM``-byte strings inside it. Equal windows have equal
minimizers wherever they stand, so shards by minimizer can be searched one by one
and together find every repeat of the corpus. Neighbouring windows of the same
minimizer are one segment; there is about one in 40 bytes.

1. Minimizers are counted (combined in each task and before the shuffle). Segments
   whose minimizer occurs once, nearly all, can hold no repeat and go no further.
2. Segments of equal bytes are grouped; the first one by (doc_id, start) stands for
   them, and the others are removed as a whole. So a passage that a third of all
   documents hold is one segment from here on.
3. Where a minimizer has several different segments, or one that repeats itself,
   its segments are suffix-sorted (``induced_sort``: external induced sorting that
   carries common prefixes). Windows with a common prefix of ``LENGTH`` are a
   group, of which all but the first are removed. Tasks sort minimizer after
   minimizer in shards of ``SHARD_BYTES``.
4. A minimizer of more than ``HOT_BYTES`` of different segments (a short phrase
   that very many texts hold, each going on in its own way) isn't gathered in one
   task: its windows are grouped one by one by their digest instead.
5. The removed intervals are joined to the texts and merged.

Only step 1's hashes and the segments of repeated minimizers travel, and the texts
themselves twice (to cut the segments, and to remove bytes).

Defined results: NULL and empty texts have nothing removed; rows that repeat an id
with an equal text count as one document and get the same result; rows that repeat
an id with another text are documents of their own (ordered by a hash of the
text); a NULL id comes before all others; an empty table gives an empty result;
other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strata.llm.common import joined_bytes, materialise, offsets, slices
from strata.llm.induced_sort import FIRST, SEPARATOR, shard_of, sort_suffixes

LENGTH, GRAM = 100, 20
SHARD_BYTES = 4_000_000
HOT_BYTES = 4_000_000
BLOCK = 1 << 17                 # windows hashed at a time
BATCH_BYTES = 4_000_000
POSITION_BITS = 20
COUNTS = "h long, n long"
SEGMENTS = "h long, dg long, id long, tag long, start long, n long, again boolean"
RANGES = "id long, tag long, start long, end long"
CUT = "h long, id long, tag long, start long, data binary"
WINDOWS = "wd binary, id long, tag long, start long"
RESULT = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
NO_ID = -(1 << 63)

_RNG = np.random.default_rng(2)
_BYTE = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE2 = _RNG.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B, _B2, _M1, _M2 = (int(x) | 1 for x in _RNG.integers(1 << 62, 1 << 63, 4))
_WORD = (1 << 64) - 1


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(_M1)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(_M2)
    return x ^ (x >> np.uint64(32))


def gram_hashes(data: np.ndarray, size: int = GRAM) -> np.ndarray:
    """Hash of each ``size``-byte string, by doubling."""
    n = len(data) - size + 1
    power = _BYTE[data]             # hashes of strings of a power of two
    out, done, width = None, 0, 1
    while True:
        if size & width:
            part = power[done: done + n]
            out = part.copy() if out is None else out * np.uint64(pow(_B, width, 1 << 64)) + part
            done += width
        if done == size:
            return _mix(out)
        power = power[:-width] * np.uint64(pow(_B, width, 1 << 64)) + power[width:]
        width *= 2


def sliding_least(x: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours, by doubling."""
    n, have = len(x) - width + 1, 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[:n], x[width - have: width - have + n]) if have < width else x[:n]


_POWER = np.cumprod(np.concatenate(([1], np.full(BLOCK + LENGTH, _B2))).astype(np.uint64), dtype=np.uint64)
_INVERSE = np.cumprod(np.concatenate(([1], np.full(BLOCK + LENGTH, pow(_B2, -1, 1 << 64)))).astype(np.uint64),
                      dtype=np.uint64)


def segments(data: np.ndarray, ends: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Segments of texts laid end to end: (minimizer, digest of the bytes, text,
    start in the text, windows, whether a window may repeat within)."""
    sizes = np.diff(np.concatenate(([0], ends)))
    begins = ends - sizes
    width = LENGTH - GRAM + 1
    positions = np.arange(BLOCK + LENGTH, dtype=np.uint64)
    low = np.uint64((1 << POSITION_BITS) - 1)
    for a in range(0, max(0, len(data) - LENGTH + 1), BLOCK):
        part = data[a: a + BLOCK + LENGTH - 1]
        grams = gram_hashes(part)
        n = len(part) - LENGTH + 1
        top = grams & ~low
        at = positions[:len(grams)]
        first = sliding_least(top | at, width) & low
        final = low - (sliding_least(top | (low - at), width) & low)
        minimizer = grams[first]
        text = np.searchsorted(ends, np.arange(a, a + n), side="right")
        valid = np.arange(a, a + n) + LENGTH <= ends[text]
        new = np.ones(n, bool)
        new[1:] = (minimizer[1:] != minimizer[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(new & valid)
        if not len(starts):
            continue
        # a segment's windows: up to the next start or the text's last window
        stop = np.append(np.flatnonzero(new)[1:], n)[np.searchsorted(np.flatnonzero(new), starts)]
        stop = np.minimum(stop, ends[text[starts]] - LENGTH + 1 - a)
        count = stop - starts
        ties = np.concatenate(([0], np.cumsum(first != final)))
        again = (count > width) | (ties[stop] > ties[starts])
        total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(_BYTE2[part] * _POWER[:len(part)], dtype=np.uint64)))
        close = stop + LENGTH - 1
        digest = _mix((total[close] - total[starts]) * _INVERSE[starts] + count.astype(np.uint64) * np.uint64(_M1))
        yield (minimizer[starts].view(np.int64), digest.view(np.int64), text[starts],
               starts + a - begins[text[starts]], count, again)


def _pieces(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            texts = part.column("data")
            yield part, segments(joined_bytes(texts), offsets(texts)[1:])


def count_minimizers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, found in _pieces(batches):
        got = [(h, again) for h, _, _, _, _, again in found]
        if got:
            h, where = np.unique(np.concatenate([h for h, _ in got]), return_inverse=True)
            n = np.bincount(where, np.concatenate([1 + a for _, a in got])).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(h), pa.array(n)], names=["h", "n"])


def list_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part, found in _pieces(batches):
        ids, tags = part.column("id").to_numpy(), part.column("tag").to_numpy()
        for h, digest, text, start, n, again in found:
            yield pa.RecordBatch.from_arrays(
                [pa.array(h), pa.array(digest), pa.array(ids[text]), pa.array(tags[text]), pa.array(start),
                 pa.array(n), pa.array(again)], names=["h", "dg", "id", "tag", "start", "n", "again"])


def cut_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts with their lists of (h, start, n) -> the segments' bytes."""
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            rows = [(s["h"], i, t, s["start"], data[s["start"]: s["start"] + s["n"] + LENGTH - 1])
                    for i, t, data, own in zip(*(part.column(c).to_pylist() for c in ("id", "tag", "data", "cuts")))
                    for s in own or ()]
            if rows:
                h, i, t, start, data = zip(*rows)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h, pa.int64()), pa.array(i, pa.int64()), pa.array(t, pa.int64()),
                     pa.array(start, pa.int64()), pa.array(data, pa.binary())],
                    names=["h", "id", "tag", "start", "data"])


def runs(text: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted removed windows -> (text, first byte, end) of their union, by text."""
    order = np.lexsort((start, text))
    text, start = text[order], start[order]
    new = np.ones(len(text), bool)
    new[1:] = (np.diff(text) != 0) | (np.diff(start) > LENGTH)
    at = np.flatnonzero(new)
    last = np.append(at[1:], len(text)) - 1
    return text[at], start[at], start[last] + LENGTH


def search_shard(h: np.ndarray, ids: np.ndarray, tags: np.ndarray, starts: np.ndarray, texts: list[bytes]):
    """Ranges to remove in a shard of segments, by suffix sorting."""
    shard = shard_of(texts)
    order, common = sort_suffixes(shard, LENGTH)
    sizes = np.array([len(t) for t in texts], np.int64) + 1         # with the separator
    ends = np.cumsum(sizes)
    of_place = np.append(np.repeat(np.arange(len(texts)), sizes), len(texts) - 1)
    segment = of_place[order]
    offset = order - (ends - sizes)[segment]
    window = offset + LENGTH < sizes[segment]                       # a whole window stands there
    # groups: suffixes that share LENGTH symbols; between two windows of a group stand only windows
    group = np.cumsum(common < LENGTH)
    row = np.flatnonzero(window)
    if not len(row):
        return row, row
    segment, offset, group = segment[row], offset[row], group[row]
    # the first of each group by (id, tag, start) stays: segments by id and tag, then a least start among those
    by_text = np.lexsort((tags, ids))
    new = np.ones(len(ids), bool)
    new[1:] = (np.diff(ids[by_text]) != 0) | (np.diff(tags[by_text]) != 0)
    rank = np.empty(len(ids), np.int64)
    rank[by_text] = np.cumsum(new)
    start = starts[segment] + offset
    at = np.flatnonzero(np.diff(group, prepend=-1))
    members = np.diff(at, append=len(group))
    own_rank = rank[segment]
    least = own_rank == np.repeat(np.minimum.reduceat(own_rank, at), members)
    start = np.where(least, start, np.iinfo(np.int64).max)
    first = np.flatnonzero(least & (start == np.repeat(np.minimum.reduceat(start, at), members)))
    first = first[np.diff(group[first], prepend=-1) != 0]          # one, where a row is repeated
    stays = np.zeros(len(group), bool)
    stays[first] = True
    return segment[~stays], offset[~stays]


def search_shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted by minimizer: whole minimizers are gathered up to a shard's size."""
    held: list[pa.RecordBatch] = []
    size = 0

    def search() -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(held).combine_chunks()
        ids, tags, starts = (rows[c].to_numpy() for c in ("id", "tag", "start"))
        segment, offset = search_shard(rows["h"].to_numpy(), ids, tags, starts, rows["data"].to_pylist())
        if len(segment):
            s, a, b = runs(segment, offset)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids[s]), pa.array(tags[s]), pa.array(starts[s] + a), pa.array(starts[s] + b)],
                names=["id", "tag", "start", "end"])

    for batch in batches:
        if not batch.num_rows:
            continue
        h = batch.column("h").to_numpy()
        edges = [0, *(np.flatnonzero(np.diff(h)) + 1).tolist(), len(h)]
        bytes_at = np.concatenate(([0], np.cumsum(np.diff(offsets(batch.column("data"))))))
        if held and held[-1].column("h")[held[-1].num_rows - 1].as_py() != h[0] and size >= SHARD_BYTES:
            yield from search()
            held, size = [], 0
        start = 0
        for edge in edges[1:-1]:
            if size + int(bytes_at[edge] - bytes_at[start]) >= SHARD_BYTES:
                held.append(batch.slice(start, edge - start))
                yield from search()
                held, size, start = [], 0, edge
        held.append(batch.slice(start))
        size += int(bytes_at[-1] - bytes_at[start])
    if held:
        yield from search()


def cut_windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every window of a segment with its digest."""
    for batch in batches:
        for i, t, start, data in zip(*(batch.column(c).to_pylist() for c in ("id", "tag", "start", "data"))):
            n = len(data) - LENGTH + 1
            for a in range(0, n, 10_000):
                own = range(a, min(n, a + 10_000))
                wd = [hashlib.blake2b(data[p: p + LENGTH], digest_size=16).digest() for p in own]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(wd, pa.binary()), pa.array([i] * len(wd), pa.int64()),
                     pa.array([t] * len(wd), pa.int64()), pa.array([start + p for p in own], pa.int64())],
                    names=["wd", "id", "tag", "start"])


def merged(ranges: list[dict], size: int) -> list[tuple[int, int]]:
    """Union of ranges, in order; touching ones are one."""
    out: list[tuple[int, int]] = []
    for a, b in sorted((r["start"], r["end"]) for r in ranges):
        if out and a <= out[-1][1]:
            out[-1] = out[-1][0], max(b, out[-1][1])
        else:
            out.append((a, b))
    return out


def kept(data: bytes, spans: list[tuple[int, int]]) -> bytes:
    at = [0, *(x for s in spans for x in s), len(data)]
    return b"".join(data[a:b] for a, b in zip(at[::2], at[1::2]))


def _result(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for part in slices(batch, "data", BATCH_BYTES):
            texts = part.column("data").to_pylist()
            spans = [merged(r or [], len(d)) for r, d in zip(part.column("ranges").to_pylist(), texts)]
            yield pa.RecordBatch.from_arrays([
                part.column("doc_id"), pa.array([len(d) for d in texts], pa.int64()),
                pa.array([sum(b - a for a, b in s) for s in spans], pa.int64()),
                pa.array([len(s) for s in spans], pa.int64()),
                pa.array([hashlib.sha256(kept(d, s)).hexdigest() for d, s in zip(texts, spans)], pa.string())],
                names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def _cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = part = batch.column("data").to_pylist()
        out = [kept(d, merged(r or [], len(d))) for r, d in zip(batch.column("ranges").to_pylist(), part)]
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(out, pa.binary())],
                                         names=["doc_id", "data"]) if texts else batch.select(["doc_id", "data"])


def _keyed(docs: DataFrame) -> DataFrame:
    data: Column = F.coalesce(docs["text"].cast("binary"), F.lit(b""))
    doc_id = docs["doc_id"].cast("long")
    return docs.select(doc_id.alias("doc_id"), F.coalesce(doc_id, F.lit(NO_ID)).alias("id"),
                       F.hash(data).cast("long").alias("tag"), data.alias("data"))


def removed_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(the keyed texts, dealt by document; their removed ranges, not yet merged)."""
    spark = docs.sparkSession
    keyed = _keyed(docs)
    repeated = (keyed.select("data").mapInArrow(count_minimizers, COUNTS).groupBy(F.col("h").alias("rh"))
                .agg(F.sum("n").alias("n")).filter("n > 1").select("rh"))
    hits = (keyed.select("id", "tag", "data").mapInArrow(list_segments, SEGMENTS)
            .join(repeated, F.col("h") == F.col("rh")).drop("rh"))
    hits = materialise(hits, "segments")
    # equal segments: the first by (id, tag, start) stands for all
    first = (hits.groupBy("h", "dg").agg(F.min(F.struct("id", "tag", "start", "n", "again")).alias("f")))
    first = materialise(first.select("h", "dg", "f.*"), "first-segments")
    f = first.select(F.col("h").alias("fh"), F.col("dg").alias("fd"), F.struct("id", "tag", "start").alias("f"))
    copies = (hits.join(f, (F.col("h") == F.col("fh")) & (F.col("dg") == F.col("fd")))
              .filter(F.struct("id", "tag", "start") != F.col("f"))
              .select("id", "tag", "start", (F.col("start") + F.col("n") + (LENGTH - 1)).alias("end")))
    shard = (first.groupBy(F.col("h").alias("sh"))
             .agg(F.sum(F.col("n") + (LENGTH - 1)).alias("size"), F.count("*").alias("different"),
                  F.max("again").alias("any_again"))
             .filter("different > 1 or any_again").select("sh", (F.col("size") > HOT_BYTES).alias("hot")))
    wanted = first.join(shard, F.col("h") == F.col("sh"))
    cuts = (wanted.groupBy(F.col("id").alias("ci"), F.col("tag").alias("ct"))
            .agg(F.collect_list(F.struct("h", "start", "n", "hot")).alias("all_cuts")))
    cuts = materialise(cuts, "cuts")
    # both joins deal the texts alike (same columns, same keys), so Spark shuffles them once
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    dealt = keyed.repartition(parts, "id", "tag")
    holding = dealt.join(cuts, (F.col("id") == F.col("ci")) & (F.col("tag") == F.col("ct")))
    cold = F.transform(F.filter("all_cuts", lambda s: ~s["hot"]), lambda s: F.struct(s["h"], s["start"], s["n"]))
    hot = F.transform(F.filter("all_cuts", lambda s: s["hot"]), lambda s: F.struct(s["h"], s["start"], s["n"]))
    sorted_ = (holding.select("doc_id", "id", "tag", "data", cold.alias("cuts")).mapInArrow(cut_segments, CUT)
               .repartition(parts, "h").sortWithinPartitions("h", "id", "tag", "start").mapInArrow(search_shards, RANGES))
    ranges = copies.select("id", "tag", "start", "end").union(sorted_)
    if shard.filter("hot").limit(1).count():
        windows = (holding.select("doc_id", "id", "tag", "data", hot.alias("cuts")).mapInArrow(cut_segments, CUT)
                   .mapInArrow(cut_windows, WINDOWS))
        windows = materialise(windows, "windows")
        least = windows.groupBy(F.col("wd").alias("lw")).agg(F.min(F.struct("id", "tag", "start")).alias("l"))
        ranges = ranges.union(windows.join(least, F.col("wd") == F.col("lw"))
                              .filter(F.struct("id", "tag", "start") != F.col("l"))
                              .select("id", "tag", "start", (F.col("start") + LENGTH).alias("end")))
    return dealt, ranges


def _with_ranges(docs: DataFrame) -> DataFrame:
    dealt, ranges = removed_ranges(docs)
    own = (ranges.groupBy(F.col("id").alias("ri"), F.col("tag").alias("rt"))
           .agg(F.collect_list(F.struct("start", "end")).alias("ranges")))
    return (dealt.join(own, (F.col("id") == F.col("ri")) & (F.col("tag") == F.col("rt")), "left")
            .select("doc_id", "data", "ranges"))


def repeated_bytes(docs: DataFrame) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256: one row per document."""
    return _with_ranges(docs).mapInArrow(_result, RESULT)


def without_repeats(docs: DataFrame) -> DataFrame:
    """doc_id, data: the bytes that stay."""
    return _with_ranges(docs).mapInArrow(_cleaned, "doc_id long, data binary")
