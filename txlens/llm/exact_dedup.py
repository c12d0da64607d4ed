"""Exact deduplication: a two-pass Bloom filter decides which rows have to be compared.

Pass 1 counts, for every text digest, two bits of one 64-bit word. Bits that were set by two
or more rows form the second filter. Pass 2 tests every digest against it: a digest with a
bit that only one row set occurs once, so its row passes straight through. Only the other rows
(all repeats and a few false positives) are shuffled and grouped by digest.

Texts never move: they are read once and reduced to SHA-256 digests.

Nulls and edge cases: a null text counts as empty and all empty texts are equal; a null id
sorts after all ids; rows that repeat both id and text share one decision; an empty table
gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.llm.shared import BLANKS, joined, n_rows, stored, within

BITS_PER_KEY = 16
MAX_FILTER_WORDS = 1_000_000  # broadcast bound: 16 bytes a word
MAX_GROUPS = 200_000  # broadcast bound: about 150 bytes a group


def normalised(text: Column) -> Column:
    """Text without blanks; null becomes empty."""
    out = F.coalesce(text, F.lit(""))
    for blank in BLANKS:
        out = F.replace(out, F.lit(blank), F.lit(""))
    return out


def digests(documents: DataFrame) -> DataFrame:
    """One small row per document: id, code points of the original text, SHA-256 digest."""
    return documents.select(
        "doc_id",
        F.length(F.coalesce("text", F.lit(""))).alias("n_points"),
        F.sha2(normalised(F.col("text")), 256).alias("text_sha256"),
    )


def _addressed(rows: DataFrame, n_words: int) -> DataFrame:
    """Filter word and two different bits of each digest."""
    spread = F.xxhash64("text_sha256", F.lit(1))
    first = F.pmod(spread, F.lit(64)).cast("int")
    step = F.pmod(F.shiftright(spread, 8), F.lit(63)).cast("int") + 1
    return rows.withColumns(
        {
            "_word": F.pmod(F.xxhash64("text_sha256"), F.lit(n_words)),
            "_bits": F.array(first, F.pmod(first + step, F.lit(64))),
        }
    )


def repeat_filter(rows: DataFrame, n_words: int) -> DataFrame:
    """Words of the second Bloom filter: bits set by at least two rows."""
    return (
        _addressed(rows, n_words)
        .select("_word", F.explode("_bits").alias("_bit"))
        .groupBy("_word", "_bit")
        .count()
        .filter("count > 1")
        .groupBy("_word")
        .agg(F.bit_or(F.expr("shiftleft(1L, _bit)")).alias("_set"))
    )


def exact_dedup(documents: DataFrame, bits_per_key: int = BITS_PER_KEY) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest id.
    """
    rows = stored(digests(documents), "digests")
    n_words = max(1, n_rows(rows) * bits_per_key // 64)
    repeated = stored(repeat_filter(rows, n_words), "repeats")
    if within(repeated, MAX_FILTER_WORDS):
        tested = _addressed(rows, n_words).join(F.broadcast(repeated), "_word", "left")
        mask = F.expr("shiftleft(1L, _bits[0]) | shiftleft(1L, _bits[1])")
        maybe = F.coalesce(F.col("_set").bitwiseAND(mask) == mask, F.lit(False))
        once, again = tested.filter(~maybe), tested.filter(maybe)
    else:  # the filter cannot be broadcast: every digest is compared, 50 bytes a row
        once, again = rows.limit(0), rows
    best = F.min(F.struct(-F.col("n_points"), F.col("doc_id").isNull(), F.col("doc_id")))
    groups = stored(
        again.groupBy("text_sha256").agg(
            best["doc_id"].alias("keep_id"), F.count(F.lit(1)).alias("group_size")
        ),
        "groups",
    )
    compared = joined(again, groups, ["text_sha256"], "inner", MAX_GROUPS)
    single = once.select("doc_id", "text_sha256", F.col("doc_id").alias("keep_id"))
    return (
        compared.select("doc_id", "text_sha256", "keep_id", "group_size")
        .unionByName(single.withColumn("group_size", F.lit(1).cast("long")))
        .select(
            "doc_id",
            "keep_id",
            "group_size",
            F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"),
            "text_sha256",
        )
    )


def op1_exact_dedup(spark, sf_dir):
    return exact_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))


SQL = r"""
WITH d AS (
  SELECT doc_id, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS text_sha256
  FROM documents),
k AS (
  SELECT *, first_value(doc_id) OVER (PARTITION BY text_sha256 ORDER BY n DESC, doc_id) AS keep_id,
         count(*) OVER (PARTITION BY text_sha256) AS group_size
  FROM d)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM k
"""
