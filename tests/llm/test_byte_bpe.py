import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken

from strata.llm import byte_bpe as B
from strata.llm.queries import BPE_RANKS
from tests.llm.helpers import by_text, collected, edge_rows, frame

RANKS = P.path(BPE_RANKS)


@pytest.fixture(scope="module")
def reference():
    with open(RANKS, "rb") as f:
        tokens = B.read_ranks(f.read())
    return tiktoken.Encoding("own", pat_str=P.PATTERN, special_tokens={},
                             mergeable_ranks={t: i for i, t in enumerate(tokens)})


@pytest.fixture(scope="module")
def bpe():
    with open(RANKS, "rb") as f:
        return B.Bpe(B.read_ranks(f.read()), P.PATTERN)


def test_encodes_as_tiktoken_does(bpe, reference):
    rng = random.Random(0)
    kinds = [lambda: rng.randrange(32, 127), lambda: rng.randrange(0x3000), lambda: rng.choice([9, 10, 13, 32, 0x1C, 0xA0]),
             lambda: rng.randrange(0x1F300, 0x1F700), lambda: rng.randrange(97, 123)]
    texts = ["".join(chr(rng.choice(kinds)()) for _ in range(rng.randrange(200))) for _ in range(400)]
    texts += ["", "a" * 50_000, "ab" * 777, " " * 3000, "<|endoftext|> don't we'll", "1234" * 300, "é" * 200]
    for text, ids in zip(texts, bpe.encode_batch(texts)):
        assert ids == reference.encode_ordinary(text)
        assert bpe.decode(ids) == text.encode()


def test_the_long_way_and_the_batched_way_agree(bpe):
    rng = random.Random(1)
    pieces = [bytes(rng.choice(b"etaoin shr") for _ in range(rng.randrange(2, 65))) for _ in range(300)]
    assert bpe.merge_many(pieces, 64) == [bpe.merge_one(p) for p in pieces]


def test_forgetting_changes_nothing(monkeypatch, bpe):
    texts = [f"some words {i} more" for i in range(200)]
    want = list(bpe.encode_batch(texts))
    monkeypatch.setattr(B, "REMEMBERED", 10)
    assert [next(iter(bpe.encode_batch([t]))) for t in texts] == want


def test_round_trip_of_every_edge_case(spark, reference):
    rows = edge_rows()
    got = collected(B.round_trip(frame(spark, rows), RANKS, P.PATTERN))
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
            for i, t in rows for ids in [reference.encode_ordinary(t or "")]]
    assert by_text(got) == by_text(want)
    assert collected(B.round_trip(frame(spark, []), RANKS, P.PATTERN)) == []


def test_encode_then_decode(spark):
    rows = [(1, "Some text, naïve"), (2, ""), (3, None)]
    back = B.decode(B.encode(frame(spark, rows), RANKS, P.PATTERN), RANKS, P.PATTERN)
    assert {i: bytes(d) for i, d in collected(back)} == {1: "Some text, naïve".encode(), 2: b"", 3: b""}
