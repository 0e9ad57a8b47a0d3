import re
from itertools import permutations

import numpy as np

from strata.llm import filter_audit as A
from tests.llm.helpers import by_text, collected, edge_rows

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LABELS = "doc_id long, quality int, toxic int, text string, part string"


def failing(rows):
    """The filters that each (doc_id, text, source) fails, by the definition."""
    least = {}
    for i, t, _ in rows:
        if i is not None:
            least[t or ""] = min(i, least.get(t or "", i))
    out = []
    for i, t, _ in rows:
        t = t or ""
        w = WORD.findall(t)
        own = "A" if len(w) < 50 else ""
        own += "B" if 100 * len(set(w)) < 65 * len(w) else ""
        own += "C" if 100 * len(re.findall("[A-Z]", t)) > 5 * len(t) else ""
        own += "D" if re.search("[#$%&*|]", t) else ""
        own += "E" if i is not None and least[t] < i else ""
        out.append(own)
    return out


def brute(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, x in labels if x == 1 and i is not None}
    fails = failing(rows)
    out = []
    for part in {s or "" for _, _, s in rows}:
        own = [(i, f) for (i, _, s), f in zip(rows, fails) if (s or "") == part]
        told, total = [], dict.fromkeys("ABCDE", 0)
        for order in map("".join, permutations("ABCDE")):
            left = own
            for step, letter in enumerate(order, 1):
                gone = [(i, f) for i, f in left if letter in f]
                left = [(i, f) for i, f in left if letter not in f]
                total[letter] += len(gone)
                told.append((part, order, step, len(left), len(gone), sum(letter in f for _, f in own) - len(gone),
                             sum(f == letter for _, f in own), sum(i in good for i, _ in gone), sum(i in toxic for i, _ in gone)))
        out += [(*t, total[t[1][t[2] - 1]]) for t in told]
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "x", 1, 2, 3) for r in rows],
                                 "doc_id long, text string, source string, part string, mask int, label int, n long")


def label_frame(spark, labels):
    return spark.createDataFrame([(*r, "x", "y") for r in labels], LABELS)


def many_rows():
    texts = ["word " * 60, "Ab# " * 60, " ".join(f"w{i}" for i in range(70)), " ".join(f"w{i}" for i in range(70)) + " $",
             " ".join(f"W{i}" for i in range(70)), "ÀÉ " + " ".join(f"é{i}" for i in range(50)), "a\x1fb\x85c d " * 20]
    rows = [(i, t, f"s{(i or 0) % 3}") for i, t in edge_rows()]
    rows = [(i, t, None if i == 4 else s) for i, t, s in rows]
    rows += [(100 + i, texts[i % 7], ["s0", "hot", "hot", None, ""][i % 5]) for i in range(140)]
    return rows + [(100, texts[0], "s0"), (100, texts[0], "other"), (-5, "tail of a hot group", "hot"), (None, texts[2], "hot")]


def test_matches_brute_force(spark):
    rows = many_rows()
    labels = [(i, i % 2, i % 3 == 0) for i in range(0, 230, 2)]
    labels = [(i, q, int(x)) for i, q, x in labels] + [(100, None, 1), (102, 1, None), (102, 0, 0), (None, 1, 1), (9999, 1, 1)]
    got = A.audit(frame(spark, rows).repartition(5), label_frame(spark, labels))
    assert got.columns == ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost",
                           "toxic_lost", "shapley"]
    assert by_text(collected(got)) == by_text(brute(rows, labels))


def test_empty_tables(spark):
    assert collected(A.audit(frame(spark, []), label_frame(spark, []))) == []
    rows = many_rows()[:9]
    assert by_text(collected(A.audit(frame(spark, rows), label_frame(spark, [])))) == by_text(brute(rows, []))


def test_positional_popcount_counts_every_bit():
    rng = np.random.default_rng(2)
    for n in (0, 1, 2, 3, 4, 50, 1000, 4097):
        words = rng.integers(0, 1 << 32, n, dtype=np.uint32)
        want = [int(((words >> np.uint32(b)) & 1).sum()) for b in range(32)]
        assert A.positional_popcount(words).tolist() == want


def test_survival_words_are_truth_tables():
    words = A.survival_words()
    assert int(words[0]) == 0xFFFFFFFF and int(words[31]) == 1
    assert all((int(words[m]) >> s & 1) == (m & s == 0) for m in range(32) for s in range(32))


def test_many_parts_are_told_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(A, "HELD", 2)
    import pyarrow as pa
    batch = lambda k: pa.RecordBatch.from_pydict(
        {"part": [f"p{i}" for i in range(k)], "mask": pa.array([0] * k, pa.int32()), "label": pa.array([1] * k, pa.int32())})
    got = [r for b in A.count_subsets(iter([batch(3), batch(0), batch(2)])) for r in b.to_pylist()]
    assert sum(r["n"] for r in got if r["label"] == 0 and r["subset"] == 31) == 5
    assert sum(r["n"] for r in got if r["label"] == 2) == 0
