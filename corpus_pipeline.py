"""The corpus pipeline: quality, repeated passages, near-duplicates, mixture, tokens.

Each stage takes (spark, docs, sf_dir) and works on all that the one before it kept; run() writes each stage's documents
in the shared folder and reads them back for the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm import bpe, compression_quality, line_dedup, mixing, simhash_similar
from geoloom.llm.shared import drop_written, written


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the compression classifier accepts; it learns from labels outside the held-out quarter.

    Null and empty texts have a score like any other. Rows that share an id are judged each by its own text; repeated
    rows all stay or all go. Texts are read whole, however long. Other columns, whatever their names, stay as they are.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return compression_quality.kept(docs, compression_quality.fit(docs, labels, learn_from=compression_quality.learnable()))


def without_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without multi-line chunks, and passages of over 50 words, that stand elsewhere first.

    Null texts, and texts of rows without an id, stay as they are; a text that loses all its lines is empty. Of equal
    passages the one with the smallest (doc_id, line) stays; rows that repeat with their id are one place.
    """
    return line_dedup.deduplicated(docs, words=line_dedup.PASSAGE_WORDS)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group linked by a Jaccard of 0.8 or more over five-word shingles.

    Null, empty and blank texts are one group. Rows without an id belong to no group and stay; of rows that share an id
    one stays.
    """
    return simhash_similar.representatives(docs)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight draws them.

    A null source is a source of its own; null and empty texts have no words and are drawn like others of their source.
    Rows that share an id are drawn alike.
    """
    return mixing.mixed(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Numbers of tokens, and digests of ids and of the text they decode to; null and empty texts have no tokens."""
    return bpe.round_trip(docs)


STAGES = [
    ("quality", good_documents),
    ("line_dedup", without_repeated_passages),
    ("near_duplicates", one_of_each_group),
    ("mixing", mixture),
    ("bpe", tokens),
]

#: No SQL: trained dictionaries, similarities of shingles and BPE. tests/llm holds run() against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of a folder of tables; an empty table of documents gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), name)
        drop_written(docs)
        docs = after
    return STAGES[-1][1](spark, docs, sf_dir)


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The registered query."""
    return run(spark, sf_dir)


QUERIES = {"pipeline": pipeline}
ORACLES = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
