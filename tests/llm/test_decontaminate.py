import hashlib
import random

import numpy as np
import pytest

from strata.llm import decontaminate as D
from strata.llm.fm_index import FmIndex
from tests.llm.helpers import LONG, WORDS, by_text, collected, edge_rows, frame, lower


def brute(rows, items, k=10):
    phrases = {}
    for item, text in items:
        w = WORDS.findall(lower(text or ""))
        for j in range(max(1, len(w) - k + 1) if w else 0):
            phrases.setdefault(tuple(w[j: j + k]), set()).add("" if item is None else str(item))
    out = []
    for i, text in rows:
        w = WORDS.findall(lower(text or ""))
        hit, found = set(), set()
        for size in {len(p) for p in phrases}:
            for j in range(len(w) - size + 1):
                own = phrases.get(tuple(w[j: j + size]))
                if own:
                    hit.update(range(j, j + size))
                    found |= own
        out.append((i, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return out


def cases():
    rng = random.Random(4)
    make = lambda n: " ".join(rng.choice("ab") for _ in range(n))
    items = [(10, make(12)), (9, make(10)), (2, make(25)), (2, make(11)), (7, "delta gamma"), (5, None), (6, "!!"), (None, "no id"),
             (8, " ".join(LONG.split()[500:530])), (10, make(12))]
    rows = edge_rows() + [(100 + i, make(rng.randrange(80))) for i in range(60)]
    rows += [(300, items[0][1].upper().replace(" ", ", ") + "!")]
    return rows, items


@pytest.mark.parametrize("block", [D.BLOCK_BYTES, 40])      # 40: the benchmark in several blocks
def test_matches_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(D, "BLOCK_BYTES", block)
    monkeypatch.setattr(D, "SHARD_BYTES", 3000)
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(frame(spark, rows), bench).drop("spans", "items")
    assert by_text(collected(got)) == by_text(brute(rows, items))


def test_spans_are_merged_word_ranges(spark):
    bench = spark.createDataFrame([(1, "a b c d e f g h i j k")], "item_id long, text string")
    row = D.contamination(frame(spark, [(1, "x x a b c d e f g h i j k y")]), bench).collect()[0]
    assert [(s["start"], s["end"]) for s in row["spans"]] == [(2, 13)] and row["items"] == ["1"]


def test_clean_documents_stay_as_they_are(spark):
    rows, items = cases()
    bench = spark.createDataFrame(items, "item_id long, text string")
    df = frame(spark, rows)
    left = D.decontaminate(df, bench)
    assert left.columns == df.columns
    dirty = {(i, t) for (i, t), b in zip(rows, brute(rows, items)) if b[-1]}
    assert by_text((r["doc_id"], r["text"]) for r in left.collect()) == by_text(r for r in rows if r not in dirty)


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = collected(D.contamination(frame(spark, [(1, "a b")]), none).drop("spans", "items"))
    assert got == [(1, 2, 0, 0, hashlib.sha256(b"").hexdigest(), False)]
    assert collected(D.contamination(frame(spark, []), none)) == []


def test_index_finds_all_occurrences():
    rng = np.random.default_rng(5)
    for n in (1, 2, 50, 400):
        seq = rng.integers(1, 5, n)
        index = FmIndex(seq, 5)
        patterns = rng.integers(1, 5, (30, 4))
        lengths = rng.integers(1, 5, 30)
        for r, k in enumerate(lengths):
            patterns[r, : 4 - k] = 0
        phrase, ranges = index.find(patterns, lengths)
        got = {int(p): sorted(index.locate(np.arange(a, b)).tolist()) for p, (a, b) in zip(phrase, ranges)}
        for r, k in enumerate(lengths):
            own = patterns[r, 4 - k:].tolist()
            want = [i for i in range(n - k + 1) if seq[i: i + k].tolist() == own]
            assert got.get(r, []) == want
