from strata.llm import license_scan as S
from tests.llm.helpers import WORDS, collected, edge_rows, frame, lower


def brute(text):
    def grams(t):
        w = WORDS.findall(lower(t))
        return set(zip(w, w[1:]))
    import re
    text = text or ""
    paragraphs, lines = re.split(r"\n[ \t\r]*\n", text), text.split("\n")
    units = [text] + (paragraphs if len(paragraphs) > 1 else []) + (lines if len(lines) > 1 else [])
    found = []
    for u in map(grams, units):
        dice = [(2.0 * len(u & t) / (len(u) + len(t)), name) for name, texts in S.TEMPLATES.items()
                for t in map(grams, texts) if u]
        dice = [d for d in dice if d[0] >= S.THRESHOLD]
        if dice:
            found.append(min(dice, key=lambda d: (-d[0], d[1])))
    best = min(found, key=lambda d: (-d[0], d[1]), default=(0.0, ""))
    return len(found), ",".join(sorted({n for _, n in found})), best[1], best[0]


def test_matches_brute_force(spark):
    rows = edge_rows()
    for k, (name, texts) in enumerate(S.TEMPLATES.items()):
        for j, t in enumerate(texts):
            words = t.split()
            rows += [(1000 + 10 * k + j, t), (2000 + 10 * k + j, "Intro line.\n" + t.upper() + "\n\nMore text here.\n" + t),
                     (3000 + 10 * k + j, " ".join(words[: len(words) * 2 // 3])), (4000 + 10 * k + j, t + " and then " + t)]
    got = collected(S.scan(frame(spark, rows)))
    assert sorted(map(repr, got)) == sorted(repr((i, *brute(t))) for i, t in rows)
    assert all(n > 0 for i, n, *_ in got if i is not None and 1000 <= i < 3000)


def test_full_texts_and_commented_file_headers(spark):
    from strata.llm.license_texts import TEXTS
    lines = lambda t, k: [" ".join(t.split()[i: i + k]) for i in range(0, len(t.split()), k)]
    rows, names = [], {}
    for name, texts in TEXTS.items():
        for text in texts:
            for form in ("Copyright (c) 2020 A. Holder\n\n" + "\n".join(lines(text, 11)),
                         "# Copyright 2020 A. Holder\n#\n" + "\n".join("# " + x for x in lines(text, 11)) + "\n\nimport os\n\nprint(os.name)\n"):
                names[len(rows)] = name
                rows.append((len(rows), form))
    got = {r["doc_id"]: r for r in S.scan(frame(spark, rows)).collect()}
    assert {i: r["best"] for i, r in got.items()} == names
    headers = {"Apache-2.0", "GPL-3.0", "BSD-3-Clause", "MIT", "MPL-2.0"}
    assert headers <= {r["best"] for r in got.values() if r["best_dice"] > 0.8}


def test_empty_table(spark):
    assert collected(S.scan(frame(spark, []))) == []
