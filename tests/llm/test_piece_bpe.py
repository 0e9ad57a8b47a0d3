import hashlib
import random

import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from strata.llm import piece_bpe as B
from tests.llm.helpers import SF, by_text, collected, edge_rows, frame

PATH = P.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=PATH)


@pytest.fixture(scope="module")
def own():
    with open(PATH, "rb") as f:
        return B.Pieces(B.Model(f.read()))


AWKWARD = ["", " ", "   ", "\n", " a  b\n\t<s> é 日本 </s><0x0A>", "▁▁ x▁", "x" * 5000, "-" * 3000, " " * 9000 + "the",
           "ab" * 3000, "\x00nul", "🙂🙂 ok", "thethethethe" * 50, "=-" * 400, " " * 37 + "the" + " " * 19, "日本語" * 400,
           "é � ﻿​", "<unk>", "a b　c"]


def same(own, library, texts):
    want = library.encode(texts, add_eos=True, num_threads=1)
    got = list(own.encode_batch(texts))
    assert got == want
    assert [own.decode(x) for x in got] == library.decode(want)


def test_awkward_texts(own, library):
    same(own, library, AWKWARD)


@pytest.mark.parametrize("alphabet", [["the", " ", "  ", "a", "e", "i", "n", "g", "ing", "th", "日", "é", "\n", "🙂", "-", "="],
                                      list("etaoinsrhldcu "), list("-=_*#. ")])
def test_random_texts(own, library, alphabet):
    rng = random.Random(len(alphabet))
    same(own, library, ["".join(rng.choice(alphabet) for _ in range(rng.randrange(90))) for _ in range(1500)])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(max_size=60), min_size=1, max_size=8))
def test_any_text(own, library, texts):
    same(own, library, [t.encode("utf-8", "replace").decode() for t in texts])


def test_long_words_are_merged_alike_from_the_heap(own, library, monkeypatch):
    monkeypatch.setattr(B, "LONGEST", 4)
    own.known.clear()
    same(own, library, AWKWARD + ["thing thinking  the thethe 日本語日本"])
    own.known.clear()


def test_a_full_memory_is_emptied(own, library, monkeypatch):
    monkeypatch.setattr(B, "REMEMBERED", 3)
    own.known.clear()
    same(own, library, ["one two three four five", "six seven"])


def test_query_matches_the_library(spark, library):
    rows = edge_rows() + [(100 + i, t) for i, t in enumerate(AWKWARD)]
    rows += [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    sha = lambda t: hashlib.sha256(t.encode()).hexdigest()
    want = []
    for i, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids))))
    df = frame(spark, rows).repartition(5)
    assert by_text(collected(B.round_trip(df, PATH))) == by_text(want)
    back = B.decode(B.encode(df, PATH), PATH)
    assert by_text(collected(back)) == by_text((i, library.decode(library.encode(t or ""))) for i, t in rows)


def test_empty_table(spark):
    assert collected(B.round_trip(frame(spark, []), PATH)) == []


def test_other_models_are_refused():
    with open(PATH, "rb") as f:
        data = f.read()
    unigram = b"".join(_field(n, v if n != 2 else b"".join(_field(m, 1 if m == 3 else w) for m, w in B._fields(v)))
                       for n, v in B._fields(data))
    with pytest.raises(ValueError, match="BPE"):
        B.Model(unigram)


def _field(number, value):
    def varint(x):
        out = b""
        while x > 0x7F:
            out += bytes([x & 0x7F | 0x80])
            x >>= 7
        return out + bytes([x])
    if isinstance(value, bytes):
        return varint(number << 3 | 2) + varint(len(value)) + value
    return varint(number << 3) + varint(value)
