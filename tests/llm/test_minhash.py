import random
from collections import Counter

import pytest

from strata.llm import minhash as M
from strata.llm.components import connected_components
from tests.llm.helpers import by_text, collected, edge_rows, frame


def brute(rows, k, percent):
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append(frozenset(tuple(w[j: j + k]) for j in range(len(w) - k + 1)) if len(w) >= k
                    else frozenset([tuple(w)] if w else []))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    having = {}
    for i, s in enumerate(sets):
        common = Counter(j for x in s for j in having.get(x, ()))
        for j, n in common.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                parent[find(i)] = find(j)
        for x in s:
            having.setdefault(x, []).append(i)
    least = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            least[find(i)] = min(least.get(find(i), d), d)
    return [(d, len(s), least.get(find(i)), d == least.get(find(i))) if s else (d, 0, d, True)
            for i, ((d, _), s) in enumerate(zip(rows, sets))]


def near_copies(n, seed):
    """One group whose members differ by a few words each: some pairs are links, most aren't."""
    rng = random.Random(seed)
    base = [f"w{rng.randrange(3000)}" for _ in range(150)]
    out = []
    for i in range(n):
        w = list(base)
        for _ in range(rng.randrange(9)):
            w[rng.randrange(150)] = f"x{rng.randrange(9999)}"
        out.append((10_000 + i, " ".join(w[: rng.choice([150, 150, 130])])))
    return out


@pytest.mark.parametrize("k, percent, block", [(3, 85, M.BLOCK), (3, 85, 2000), (5, 80, 5000)])
def test_matches_brute_force(spark, k, percent, block):
    rows = edge_rows() + near_copies(250, percent)
    got = collected(M.near_dedup(frame(spark, rows).repartition(6), k, percent, block))
    assert by_text(got) == by_text(brute(rows, k, percent))


def test_empty_table(spark):
    assert collected(M.near_dedup(frame(spark, []))) == []


def test_index_meets_all_pairs_with_at_most_one_error_in_a_chunk():
    import numpy as np
    import pyarrow as pa
    rng = np.random.default_rng(0)
    chunks = 5
    for _ in range(50):
        a = rng.integers(0, 1 << 16, (chunks, M.SYMBOLS)).astype(np.uint16)
        b = a.copy()
        errors = rng.permutation(chunks * M.SYMBOLS)[: 2 * chunks - 1]      # pigeonhole: a chunk has one at most
        b.reshape(-1)[errors] += 1
        keys = []
        for s in (a, b):
            batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([s.tobytes()])], names=["cid", "sig"])
            keys.append({k for out in M.IndexKeys(chunks)([batch]) for k in out.column("key").to_pylist()})
        assert keys[0] & keys[1]


def test_chunks_follow_the_similarity():
    assert (M.chunks_for(85), M.chunks_for(80), M.chunks_for(100)) == (10, 13, 1)


def test_components(spark):
    rng = random.Random(6)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(220)] + [(1000 + i, 1001 + i) for i in range(120)] + [(7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    want = {x: find(x) for e in edges for x in e if e[0] != e[1]}
    assert dict(collected(connected_components(spark.createDataFrame(edges, "a long, b long")))) == want


def test_one_id_and_text_of_a_component_stays_in_the_pipeline(spark):
    import corpus_pipeline
    from tests.llm.helpers import SF
    t = " ".join(f"word{i}" for i in range(60))
    u = " ".join(f"other{i}" for i in range(60))
    rows = [(3, t), (3, t + " tail"), (5, t), (5, u), (9, u), (9, u), (None, "one"), (None, "two"), (None, "two"), (7, None), (7, "")]
    df = frame(spark, rows).repartition(4)
    left = corpus_pipeline.near(spark, df, SF)
    assert left.columns == df.columns
    got = by_text((r["doc_id"], (r["text"] or "").removesuffix(" tail")) for r in left.collect())
    assert got == by_text([(3, t), (5, u), (None, "one"), (None, "two"), (7, "")])
