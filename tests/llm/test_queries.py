"""The registered queries: oracles on the smallest tables, and the pipeline by brute force."""

import hashlib
import os
import subprocess
import sys

import duckdb
import public_tokenizers as P
import pytest
import tiktoken

import corpus_pipeline
from strata.llm import byte_bpe, quality_fm
from strata.llm.common import table
from strata.llm.queries import BPE_RANKS, ORACLES, QUERIES
from tests.llm import test_decontaminate, test_minhash
from tests.llm.helpers import SF, collected, lower
from tools.check_oracles import TABLES, digest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


def test_all_are_registered():
    import __spark_entry__ as E
    assert set(QUERIES) | {"pipeline"} <= set(E.queries())
    assert set(ORACLES) <= set(E.oracle_sql())
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_oracle(spark, duck, name):
    df = QUERIES[name](spark, SF)
    rel = duck.sql(ORACLES[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert digest(df.columns, collected(df))[0] == digest(rel.columns, rel.fetchall())[0]


def test_pipeline_matches_brute_force(spark):
    docs = table(spark, SF, "documents")
    model = quality_fm.train(docs, table(spark, SF, "labels"))
    scores = {r["doc_id"]: r["predicted"] for r in quality_fm.score(docs, model).collect()}
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect() if scores[r["doc_id"]]]
    last = {}
    for i, t in rows:
        last[lower(t or "")] = max(i, last.get(lower(t or ""), i))
    rows = [(i, t) for i, t in rows if last[lower(t or "")] == i]
    rows = [r for r, b in zip(rows, test_minhash.brute(rows, 5, 80)) if b[3]]
    items = [tuple(r) for r in table(spark, SF, "benchmark").select("item_id", "text").collect()]
    rows = [r for r, b in zip(rows, test_decontaminate.brute(rows, items)) if not b[-1]]
    with open(P.path(BPE_RANKS), "rb") as f:
        ranks = {t: i for i, t in enumerate(byte_bpe.read_ranks(f.read()))}
    enc = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=ranks, special_tokens={})
    sha = lambda b: hashlib.sha256(b).hexdigest()
    want = [(i, len(ids), sha(",".join(map(str, ids)).encode()), sha((t or "").encode()))
            for i, t in rows for ids in [enc.encode_ordinary(t or "")]]
    assert sorted(collected(corpus_pipeline.run(spark, SF))) == sorted(want)


def test_stages_keep_the_columns(spark):
    docs = table(spark, SF, "documents").limit(40)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns, name


def test_the_rest_stands_without_this_subpackage(tmp_path):
    """A copy without the two folders and the pipeline imports and lists the other queries."""
    import shutil
    copy = tmp_path / "repo"
    shutil.copytree(ROOT, copy, ignore=shutil.ignore_patterns(".git", "llm", "corpus_pipeline.py", "__pycache__"))
    code = "import __spark_entry__ as E; q = E.queries(); assert q and 'pipeline' not in q and not any(n.startswith('op1') for n in q)"
    subprocess.run([sys.executable, "-c", code], cwd=copy, check=True, env={**os.environ, "PYTHONPATH": str(copy)})
