import hashlib
import random
import re
import time

from strata.llm import pii as X
from tests.llm.helpers import collected, edge_rows, frame

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def checks(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        v = int(c) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def brute(text):
    digits = lambda s: re.sub("[^0-9]", "", s)
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(int(x) <= 255 for x in m[0].split("."))]
    out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if 14 <= len(digits(m[0])) <= 19 and checks(digits(m[0]))]
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits(m[0])) <= 15]
    return sorted(out)


def samples():
    rng = random.Random(2)
    pieces = ["1", "0", ".", "2", "9", "255", "256", "4111111111111111", " ", "-", "+", "é", "@b.c", "a", "(", ")", "+1 (790) 555-2115"]
    return ["".join(rng.choice("a1.@+- 5(") for _ in range(rng.randrange(40))) for _ in range(4000)] + \
           ["".join(rng.choice(pieces) for _ in range(rng.randrange(25))) for _ in range(4000)]


def test_base_spans_are_the_patterns():
    for text in samples():
        assert X.base_spans(text) == brute(text), text


def test_rows(spark):
    rows = edge_rows() + [(1000 + i, t) for i, t in enumerate(samples()[:500] + [
        "mail me: jane.doe@example.com or 192.168.0.1", "call +1 (790) 555-2115 now", "card 4111 1111 1111 1111"])]
    got = X.find_pii(frame(spark, rows)).collect()
    assert len(got) == len(rows)
    want = {}
    for i, t in rows:
        base = brute(t or "")
        names = [f"{X.KINDS[k]}:{a}:{b}" for a, k, b in base]
        want.setdefault(i, []).append(([sum(k == j for _, k, _ in base) for j in range(4)],
                                       hashlib.sha256(",".join(names).encode()).hexdigest(), set(names)))
    for r in got:
        own = [w for w in want[r["doc_id"]] if w[1] == r["base_sha256"]]
        assert own and own[0][0] == [r["n_email"], r["n_ip"], r["n_card"], r["n_phone"]]
        spans = [s for s in r["spans"].split(",") if s]
        assert own[0][2] <= set(spans) and len(spans) == len(own[0][2]) + r["n_added"]       # base spans stay
        order = [(int(s.split(":")[1]), X.KINDS.index(s.split(":")[0])) for s in spans]
        assert order == sorted(order)


def test_empty_table(spark):
    assert collected(X.find_pii(frame(spark, []))) == []


def test_labels_follow_the_reliable_labelers():
    patterns = {"2|+++000|4": 500, "2|0+++00|4": 20, "2|0---00|4": 300, "2|0--0-0|4": 50, "2|++++00|4": 200}
    truth = X.label_model(patterns)
    model = X.SpanClassifier(patterns, truth)
    assert model.accepts("2|0+++00|4") and not model.accepts("2|0--0-0|4")


def test_numbers_swallowed_by_a_wider_match_are_added(spark):
    rows = [(i, f"text +1 (790) 555-{1000 + i} word 45{i:02d}") for i in range(60)]
    rows += [(100, "text +1 (826) 555-4081 190.137.223.9 more")]
    got = {r["doc_id"]: r for r in X.find_pii(frame(spark, rows)).collect()}
    assert got[100]["n_phone"] == 0 and got[100]["n_ip"] == 1 and "phone:8:22" in got[100]["spans"]


def test_long_runs_take_linear_time():
    began = time.time()
    for text in ("1" * 200_000, "a" * 200_000 + "@", "+1" * 100_000, "1." * 100_000, "1 " * 100_000, "a@b.c " * 20_000):
        X.Find.spans(text)
    assert time.time() - began < 30
