"""Corpus pipeline: removes toxic text, repeats and benchmark leaks, then mixes the sources.

Each stage takes (spark, docs, sf_dir), with ``docs`` what its predecessor kept, and returns the columns of
``documents``; only the last returns the mixture: the words taken of every remaining document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.llm.decontamination import remove_contaminated
from txlens.llm.line_dedup import line_dedup
from txlens.llm.mixing import mix_sources
from txlens.llm.near_dedup import keep_one_of_each
from txlens.llm.shared import read_table, stored
from txlens.llm.toxicity import remove_toxic


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier, trained on all labels, rejects go."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return remove_toxic(docs, labels)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines like an earlier line go; every document stays, with what is left of its text."""
    out = line_dedup(docs)
    if "n_chars" in docs.columns:
        n_chars = F.length("text").cast(docs.schema["n_chars"].dataType)
        out = out.withColumn("n_chars", F.when(F.col("n_removed") > 0, n_chars).otherwise(F.col("n_chars")))
    return out.select(*docs.columns)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with alike five-word shingles stays."""
    return keep_one_of_each(docs, shingle_words=5)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return remove_contaminated(docs, read_table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Words that the mixture takes from every remaining document."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("near dedup", drop_near_copies),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix),
]

# The classifier, the fuzzy stages and BM25 are beyond SQL; tests/llm holds brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name.replace(" ", "_"))
    return STAGES[-1][1](spark, docs, sf_dir)
