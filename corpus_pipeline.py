"""The corpus pipeline: classify, deduplicate exactly and nearly, mix sources, pack.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written
as Parquet and read again as the next one's docs.  All but the last return the
columns of ``documents``.  It goes with the subpackage ``tidemark.llm``.

Edge cases: those of the operators that the stages call; an empty table passes
through every stage; other columns are carried along up to packing.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import exact_dedup, packing, quality, simhash, source_mix
from tidemark.llm.common import documents, intermediates_removed, shared_dir


def classify_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier (operator 6) doesn't reject."""
    return quality.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of equal texts (operator 7)."""
    return exact_dedup.keep_one(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies (operator 5): five-word shingles, similarity 0.8."""
    return simhash.keep_one_of_each(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources to their target weights (operator 1), in the order of its schedule."""
    return source_mix.mixed_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences (operator 10)."""
    return packing.pack(docs, packing.default_vocabulary())


STAGES = [
    ("quality classifier", classify_quality),
    ("exact dedup", drop_exact_copies),
    ("simhash near-dedup", drop_near_copies),
    ("source mix", mix_sources),
    ("packing", pack_sequences),
]

#: SQL has neither the classifier nor XXH64 nor the tokenizer: the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        path = shared_dir(spark, "stage")
        with intermediates_removed(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
