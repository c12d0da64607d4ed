"""Helpers shared by the training-data operators: table access, stored results, words."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from txlens.session import ensure_checkpoint_dir

# Fixed value: the characters that separate words, [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
WORD_GAP = r"[\x20\x09-\x0D]+"
NO_ID = 2**63 - 1  # stands for a null id where Python tasks and joins need a plain integer


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **figures: Column) -> DataFrame:
    """Write a result to the shared checkpoint folder and read it back: lineage ends here.

    The number of rows, and aggregates given as ``figures``, are observed while writing and kept in
    ``seen`` of the frame returned, so that later size checks need no job.

    A lost executor cannot change or lose the rows, and later steps read only the columns
    they need. Spark's checkpoint cleaner does not know these folders; a cluster empties its
    checkpoint folder between runs.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    path = f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"
    seen = Observation()
    extra = [value.alias(name) for name, value in figures.items()]
    df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *extra).write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.seen = {"n_rows": 0, **seen.get}
    return out


def seen_as(df: DataFrame, source: DataFrame) -> DataFrame:
    """``df``, known to have the rows of the stored frame ``source``."""
    df.seen = source.seen
    return df


def n_rows(df: DataFrame) -> int:
    """Rows of a stored frame."""
    return df.__dict__["seen"]["n_rows"] if "seen" in df.__dict__ else df.count()


def within(df: DataFrame, max_rows: int) -> bool:
    """Whether a frame has at most ``max_rows`` rows; known for stored frames, else counted so far."""
    if "seen" in df.__dict__:
        return n_rows(df) <= max_rows
    return df.limit(max_rows + 1).count() <= max_rows


def joined(left: DataFrame, right: DataFrame, on: list[str], how: str, max_rows: int) -> DataFrame:
    """Equi-join that broadcasts ``right`` only if it has at most ``max_rows`` rows.

    ``right`` must be stored, not an aggregate, so that Spark can split a skewed ``left``.
    """
    return left.join(F.broadcast(right) if within(right, max_rows) else right, on, how)


def id_or_last(doc_id: Column | str = "doc_id") -> Column:
    """The id as a long; null becomes the largest."""
    return F.coalesce((F.col(doc_id) if isinstance(doc_id, str) else doc_id).cast("long"), F.lit(NO_ID))


def id_or_null(number: Column | str) -> Column:
    number = F.col(number) if isinstance(number, str) else number
    return F.when(number != NO_ID, number)


def word_count(text: Column) -> Column:
    """Number of words; null counts as empty."""
    trimmed = F.regexp_replace(F.coalesce(text, F.lit("")), f"^{WORD_GAP}|{WORD_GAP}$", "")
    return F.when(trimmed == "", F.lit(0).cast("long")).otherwise(
        F.size(F.split(trimmed, WORD_GAP)).cast("long")
    )


def held_out(doc_id: Column, modulus: int, remainder: int) -> Column:
    """Fold rule: crc32 of the id as text, modulo. A null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus == remainder
