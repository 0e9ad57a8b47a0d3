import hashlib
import random

import numpy as np
import pytest

from strata.llm import suffix_dedup as S
from strata.llm.induced_sort import shard_of, sort_suffixes
from tests.llm.helpers import by_text, collected, edge_rows, frame


def brute(rows):
    """In order of (id, text): every window but the first of its kind goes."""
    docs = sorted({(S.NO_ID if i is None else i, (t or "").encode()) for i, t in rows},
                  key=lambda d: (d[0], d[1]))
    seen, out = set(), {}
    for i, data in docs:
        gone = np.zeros(len(data) + 1, np.int64)
        for p in range(len(data) - S.LENGTH + 1):
            w = data[p: p + S.LENGTH]
            if w in seen:
                gone[p] += 1
                gone[p + S.LENGTH] -= 1
            seen.add(w)
        hit = np.cumsum(gone[:-1]) > 0
        edges = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
        kept = bytes(b for b, h in zip(data, hit) if not h)
        out[i, data] = (len(data), int(hit.sum()), len(edges) // 2, hashlib.sha256(kept).hexdigest())
    return [(i, *out[S.NO_ID if i is None else i, (t or "").encode()]) for i, t in rows]


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 9)))
    passages = [" ".join(word() for _ in range(n)) for n in (30, 60, 25, 200)]
    rows = []
    for i in range(60):
        parts = [rng.choice(passages) if rng.random() < 0.4 else " ".join(word() for _ in range(rng.randrange(60)))
                 for _ in range(rng.randrange(6))]
        rows.append((i * 3, rng.choice(["", "\n"]).join(parts)))
    rows += [(500, "ab" * 700), (501, "z" * 900), (502, "z" * 150), (503, rows[5][1]), (504, rows[5][1]),
             (1, passages[3][:99]), (2, passages[3][:100]), (4, passages[3][1:101])]
    return rows


@pytest.mark.parametrize("seed, hot", [(1, S.HOT_BYTES), (2, 300)])
def test_matches_brute_force(spark, monkeypatch, seed, hot):
    monkeypatch.setattr(S, "HOT_BYTES", hot)       # 300: nearly all minimizers take the way of the hot ones
    monkeypatch.setattr(S, "SHARD_BYTES", 2000)
    rows = corpus(seed)
    assert by_text(collected(S.repeated_bytes(frame(spark, rows).repartition(5)))) == by_text(brute(rows))


def test_edge_cases(spark):
    rows = [r for r in edge_rows() if r[0] != 4 or r[1] == "hello world"]   # one text an id: the order of others is a hash's
    rows = [r for r in rows if r[0] is not None] + [(None, "no id")]
    assert by_text(collected(S.repeated_bytes(frame(spark, rows)))) == by_text(brute(rows))


def test_without_repeats_is_what_stays(spark):
    p = " ".join(f"w{i}" for i in range(80))
    got = dict(collected(S.without_repeats(frame(spark, [(1, p), (2, "x" + p + "y"), (3, None)]))))
    assert {k: bytes(v) for k, v in got.items()} == {1: p.encode(), 2: b"xy", 3: b""}


def test_empty_table(spark):
    assert collected(S.repeated_bytes(frame(spark, []))) == []


@pytest.mark.parametrize("memory", [0, 1 << 20])    # 0: every queue is on disk
def test_induced_sort_orders_and_carries_common_prefixes(memory):
    rng = random.Random(memory)
    for _ in range(300):
        depth, letters = rng.choice([3, 8, 20]), rng.choice(["a", "ab", "abcdefgh"])
        texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(15))).encode() for _ in range(rng.randrange(1, 6))]
        shard = shard_of(texts)
        order, common = sort_suffixes(shard, depth, memory)
        flat = shard.tolist()
        assert len(set(order.tolist())) == len(order) >= len(flat) - 1
        for k in range(1, len(order)):
            a, b = flat[order[k - 1]:], flat[order[k]:]
            assert a[:depth] <= b[:depth]
            n = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
            assert common[k] == min(depth, n)
