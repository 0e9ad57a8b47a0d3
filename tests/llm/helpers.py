"""Small tables that hold every awkward case, and brute-force versions."""

import random
import re

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SF = "/root/testdata/sf0.001"
LONG = " ".join(f"word{i % 977}" for i in range(30_000))

#: (doc_id, text, lang, source, n_chars, and columns whose names clash with the operators' own)
SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, "
          "data string, kept boolean, score double, cid long, digest string, run int, label string, host string")


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def edge_rows():
    rng = random.Random(3)
    texts = [None, "", "   \n", "Hello World", "hello world", "HELLO WORLD", "a", "a b", "é", "日本語 テキスト", "x" * 5000, LONG,
             LONG + " end", "tab\tand\nline", "nul\x00byte", "1 2 3"]
    texts += [" ".join(rng.choice("alpha beta gamma delta".split()) for _ in range(rng.randrange(40))) for _ in range(20)]
    rows = [(i, t) for i, t in enumerate(texts)]
    rows += [(3, "Hello World"), (3, "Hello World"), (4, "another text of the same id"), (None, "no id"), (None, None)]
    return rows


def frame(spark, rows):
    full = [(i, t, None, None, None, "d", False, 0.5, 7, "g", 1, "l", "h") for i, t in rows]
    return spark.createDataFrame(full, SCHEMA)


def collected(df):
    return [tuple(r) for r in df.collect()]


def by_text(rows):
    return sorted(rows, key=repr)
