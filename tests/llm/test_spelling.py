import random
import re
import zlib
from collections import Counter

import pytest

from strata.llm import spelling as S
from tests.llm.helpers import by_text, collected, edge_rows, frame, lower

RUN = re.compile("[A-Za-zÀ-ÿ]+")


def near(a, b):
    if a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def brute(rows):
    counts = Counter()
    for i, t in rows:
        for run in RUN.findall(t or ""):
            run = lower(run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 199 == 0:
                at = h % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    n = {w: c for w, c in counts.items() if len(w) >= 6 and c >= 5}
    form, near_of = {}, {}
    for w in n:
        own = near_of[w] = [x for x in n if abs(len(x) - len(w)) < 2 and near(w, x)]
        best = min(own, key=lambda x: (-n[x], x), default=None)
        form[w] = best if best is not None and n[best] >= 5 * n[w] else None
    out = []
    for w in n:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, n[w], len(near_of[w]), n.get(form[w])))
    return out


def misspelt(rng, word):
    at = rng.randrange(len(word))
    kind = rng.randrange(3)
    c = rng.choice("aeinrstzéÿ×")
    return word[:at] + ("" if kind == 0 else c) + word[at + (kind != 1):]


def rows_with_variants(seed, n_words=40):
    rng = random.Random(seed)
    words = ["".join(rng.choice("aeinrsté") for _ in range(rng.randrange(5, 10))) for _ in range(n_words)]
    words += ["aaaaaa", "aaaaaaa", "aaaaaab", "baaaaaa", "straße", "strasse", "ÀÉÎÕÜÿ", "àéîõüÿ"]
    rows = []
    for i in range(300):
        own = [rng.choice(words[: 1 + int(len(words) * rng.random() ** 3)]) for _ in range(50)]
        own = [misspelt(rng, w) if rng.random() < 0.15 else w for w in own]
        rows.append((i * 7, rng.choice([" ", "\n", "1", "-"]).join(w.upper() if rng.random() < 0.1 else w for w in own)))
    return rows


@pytest.mark.parametrize("seed", [1, 2])
def test_matches_brute_force(spark, seed):
    rows = edge_rows() + rows_with_variants(seed) + [(None, "several several several several several severall " * 3), (7, None)]
    got = S.variants(frame(spark, rows).repartition(6))
    assert got.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    want = brute(rows)
    assert by_text(collected(got)) == by_text(want)
    assert sum(w[1] is not None for w in want) > 20


def test_chains_of_forms_end_at_the_last(spark):
    words = ["zzzzzzaaaaaa"]
    for i in range(5):
        words.append(words[-1][:i] + "q" + words[-1][i + 1:])
    rows = [(1, " ".join(w for k, w in enumerate(words) for _ in range(5 * 6 ** k)))]
    got = {r["word"]: r["root"] for r in S.variants(frame(spark, rows)).collect()}
    want = {w[0]: w[2] for w in brute(rows)}
    assert got == want and len(set(want.values())) < len(want)


def test_every_near_pair_shares_a_key():
    rng = random.Random(5)
    for _ in range(3000):
        word = "".join(rng.choice("abcdeé") for _ in range(rng.randrange(6, 12)))
        other = misspelt(rng, word)
        if near(word, other):
            a, b = S.keys_of(word), S.keys_of(other)
            assert {k for k, full in a if full} & {k for k, _ in b} or {k for k, full in b if full} & {k for k, _ in a}


def test_counts_are_told_in_pieces(spark, monkeypatch):
    import pyarrow as pa
    monkeypatch.setattr(S, "HELD", 10)
    rows = rows_with_variants(3)
    batch = pa.RecordBatch.from_pydict({"doc_id": [i for i, _ in rows], "data": pa.array([t.encode() for _, t in rows], pa.binary())})
    total = Counter()
    for b in S.count_words(iter([batch])):
        for r in b.to_pylist():
            total[r["word"]] += r["n"]
    assert {w: n for w, n in total.items() if len(w) >= 6 and n >= 5} == {w[0]: w[3] for w in brute(rows)}


def test_empty_table(spark):
    assert collected(S.variants(frame(spark, []))) == []
    assert collected(S.variants(frame(spark, [(1, None), (2, "short words only")]))) == []
