"""Corpus pipeline over ``documents``: each stage calls one operator of ``tidemark.llm``.

A stage takes (spark, docs, sf_dir) and returns what goes on; all but the last return the
columns of ``documents``.  Null and repeated identifiers, null and empty texts and extra
columns are treated as the operators' docstrings say; an empty table stays empty.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, decontaminate, exact_dedup, quality, simhash
from tidemark.llm.common import materialize
from tidemark.llm.queries import public_tokenizers, table, tokenizer_path


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier rejects (score below 0.7) go."""
    return quality.drop_low_quality(docs, quality.train(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal up to white space, the row with the smallest doc_id stays."""
    return exact_dedup.drop_exact_copies(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of linked fingerprints stays (3-word shingles, 2 bits)."""
    return simhash.drop_near_copies(docs, shingle=3, distance=2, unnamed="drop")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item (5-word shingles, containment 0.8) go."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, and digests of the ids and of what they decode to."""
    ranks = bpe.load_ranks(tokenizer_path("byte_bpe_50k.tiktoken"))
    out = bpe.encode_documents(docs, ranks, public_tokenizers().PATTERN, decoded=True, keep=("lang", "source"))
    return out.select(F.col("id").alias("doc_id"), "lang", "source", "ids",
                      F.size("ids").cast("long").alias("n_tokens"),
                      F.sha2(bpe.ids_text("ids"), 256).alias("ids_sha256"),
                      F.sha2("bytes", 256).alias("decoded_sha256"))


STAGES = [
    ("quality_classifier", keep_good),
    ("exact_dedup", drop_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("benchmark_decontamination", drop_leaks),
    ("byte_level_bpe", tokenize),
]

#: The classifier and the tokenizer have no SQL form; tests/llm compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each written before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
