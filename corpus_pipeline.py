"""The corpus pipeline: quality rules, exact dedup, near dedup, mixing and tokens, each stage over all its predecessor kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewright.llm.bpe import encode_documents
from candlewright.llm.common import small_batches, written
from candlewright.llm.exact_dedup import without_copies
from candlewright.llm.mixing import mix
from candlewright.llm.near_copies import without_near_copies
from candlewright.llm.quality import keep_good
from candlewright.llm.queries import tokenizer_path


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows whose text passes the base rules and the cutoffs certified for its language on all labels.

    Null, empty and short texts go; repeated rows and ids are judged row by row; a null language is a stratum of its own.
    """
    small_batches(spark)
    return keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def exact(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of rows with equal texts (A-Z lowered, null as empty) that with the largest doc_id stays, once; null ids rank last.

    Rows go one by one, so another text under the same id stays.
    """
    return without_copies(docs)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of texts whose five-word shingles have Jaccard similarity 0.8 or more the row of least id stays, once.

    Texts without words are copies of each other; null ids rank last; rows go one by one.
    """
    small_batches(spark)
    return without_near_copies(docs)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every row comes once at least; those of smaller sources come up to twice. A null source is a source of its own."""
    return mix(docs, keys=False)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Per row doc_id, n_tokens and digests of its ids and of the text decoded from them; a null text is empty."""
    small_batches(spark)
    return encode_documents(docs, tokenizer_path(), memo=80_000)


STAGES = [("quality", quality), ("exact_dedup", exact), ("near_dedup", near), ("mixing", mixing), ("tokens", tokens)]

#: XXH64 shingles, certified cutoffs and hashed permutations are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
