"""The corpus pipeline: quality, exact dedup, near-dedup, decontamination, tokens.

Each stage takes (spark, docs, sf_dir) and works on all the documents that the
one before kept; all but the last return the columns of ``documents``. ``run``
writes every stage's result to the shared checkpoint folder and reads it again,
so a lost executor costs a stage's tasks and not the pipeline.

A quality model without labels rejects nothing; of exact copies the row with the
largest doc_id stays, of near copies the one with the smallest, both told by id and
text: an id with several texts is judged text by text, and of rows that repeat an id
and a text one stays. Documents that hold a passage of the benchmark go as a whole.
Empty tables give empty results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from strata.llm import byte_bpe, decontaminate, exact_dedup, minhash, quality_fm
from strata.llm.common import materialise, table
from strata.llm.queries import BPE_RANKS


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = quality_fm.train(docs, table(spark, sf_dir, "labels"))
    return quality_fm.accepted(docs, model)


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs, exact_dedup.exact_dedup(docs, keep="largest"))


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_rows(docs, minhash.near_verdicts(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    import public_tokenizers
    return byte_bpe.round_trip(docs, public_tokenizers.path(BPE_RANKS), public_tokenizers.PATTERN)


STAGES = [("quality classifier", quality), ("exact dedup", exact), ("MinHash near-dedup", near),
          ("benchmark decontamination", decontaminated), ("byte-level BPE", tokens)]

#: The fitted classifier and the encoder can't be said in SQL; tests/llm has a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
    return docs
