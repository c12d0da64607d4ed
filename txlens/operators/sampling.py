"""Splits, draws and label noise driven by a hash of the row's id: repeatable and shuffle-free."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.functions.hashing import hash_int, hash_uniform
from txlens.functions.timeparts import epoch_millis
from txlens.operators.ordered import MAX_KEY_ROWS, join_null_safe, ordered_columns, sized_broadcast
from txlens.sources.tables import stage

# Noise rates of the fraud rules.
FALSE_POSITIVE_RATE = 0.005
FALSE_NEGATIVE_RATE = 0.08

SAMPLE_SIZE = 50_000


def strat_split(
    rows: DataFrame, key: str = "transaction_id", test_share: float = 0.2, seed: str = "42"
) -> DataFrame:
    """'test' or 'train' per row. Every label keeps ``test_share`` in expectation."""
    in_test = hash_uniform(F.col(key), seed) < test_share
    return rows.withColumn("split", F.when(in_test, "test").otherwise("train"))


def exact_split(
    rows: DataFrame,
    label: str = "is_fraud",
    key: str = "transaction_id",
    test_share: float = 0.2,
    seed: str = "42",
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """'test' or 'train' per row, with ``test_share`` of every label to one row; a null label is one too.

    Of each label the rows with the smallest hashes are the test set. A histogram of hash
    prefixes (at most 65 536 a label) says in which prefix the cut lies; all other rows are settled by
    their prefix, and only those of the cut's prefix are put in order. The table is never sorted.
    """
    hashed = rows.withColumn("_h", F.coalesce(hash_int(F.col(key), seed), F.lit(0).cast("bigint")))
    bucket = F.shiftright("_h", 16)
    order = Window.partitionBy(label).orderBy("_bucket")
    so_far = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(label)
    counts = hashed.groupBy(label, bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
    counts = counts.withColumns({"_upto": F.sum("_n").over(so_far), "_all": F.sum("_n").over(whole)})
    counts = counts.withColumn("_rest", F.floor(F.col("_all") * test_share + 0.5) - F.col("_upto") + F.col("_n"))
    cuts = counts.filter((F.col("_rest") > 0) & (F.col("_rest") <= F.col("_n")))
    cuts, _ = stage(cuts.select(label, F.col("_bucket").alias("_cut"), "_rest"), "cuts")
    placed = join_null_safe(hashed, sized_broadcast(cuts), [label], "left")
    at = F.coalesce(F.col("_cut"), F.lit(-1))  # without a cut the label has no test rows
    settled = placed.filter(bucket != at).withColumn("split", F.when(bucket < at, "test").otherwise("train"))
    near = ordered_columns(
        placed.filter(bucket == at), [label], ["_h", key], running={"_p": ("sum", F.lit(1))}, max_key_rows=max_key_rows
    )
    near = near.withColumn("split", F.when(F.col("_p") <= F.col("_rest"), "test").otherwise("train")).drop("_p")
    return settled.unionByName(near).drop("_h", "_cut", "_rest")


def oot_split(rows: DataFrame, train_share: float = 0.75, ts: str = "timestamp") -> DataFrame:
    """Out-of-time split: the last part of the time span is the test set; rows without a time are in neither (null)."""
    ms = epoch_millis(F.col(ts))
    cut = rows.agg(F.min(ms) + (F.max(ms) - F.min(ms)) * F.lit(train_share)).scalar()
    return rows.withColumn("split", F.when(ms < cut, "train").when(ms >= cut, "test"))


def balanced_sample(
    rows: DataFrame,
    label: str = "is_fraud",
    key: str = "transaction_id",
    negatives: int = SAMPLE_SIZE,
    seed: str = "sample",
) -> DataFrame:
    """All positives and the ``negatives`` negatives with the smallest hashes.

    A histogram of hash prefixes finds where the cut lies, so only about ``negatives`` rows
    reach the final ordering.
    """
    y = F.col(label).cast("int")
    positive = rows.filter(y == 1)
    negative = rows.filter(y == 0).withColumn("_h", hash_int(F.col(key), seed))
    bucket = F.shiftright("_h", 16)  # at most 65 536 buckets
    before = Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    cut = (
        negative.groupBy(bucket.alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0)))
        .filter(F.col("before") < negatives)
        .agg(F.max("bucket"))
        .scalar()
    )
    chosen = negative.filter(bucket <= cut).orderBy("_h", key).limit(negatives).drop("_h")
    return positive.unionByName(chosen)


def weighted_draw(
    rows: DataFrame, weights: dict[str, float], key: str = "transaction_id", seed: str = "draw", into: str = "choice"
) -> DataFrame:
    """Assign a variant to each row with probability proportional to its weight."""
    total = float(sum(weights.values()))
    u = hash_uniform(F.col(key), seed) * F.lit(total)
    names = list(weights)
    choice: Column = F.lit(names[-1])
    upto = total - weights[names[-1]]
    for name in reversed(names[:-1]):
        choice = F.when(u < upto, F.lit(name)).otherwise(choice)
        upto -= weights[name]
    return rows.withColumn(into, choice)


def label_noise(
    rows: DataFrame,
    truth: str = "fraud_target",
    key: str = "transaction_id",
    fn_rate: float = FALSE_NEGATIVE_RATE,
    fp_rate: float = FALSE_POSITIVE_RATE,
    seed: str = "noise",
) -> DataFrame:
    """Noisy label and its reason: 'fn' hides a fraud, 'fp' accuses a legitimate payment."""
    target = F.col(truth).cast("int") == 1
    missed = target & (hash_uniform(F.col(key), f"{seed}-fn") < fn_rate)
    accused = ~target & (hash_uniform(F.col(key), f"{seed}-fp") < fp_rate)
    return rows.withColumns(
        {
            "noisy_label": F.when(missed, 0).when(accused, 1).otherwise(target.cast("int")),
            "label_noise": F.when(missed, "fn").when(accused, "fp").otherwise("none"),
        }
    )


def union_parts(first: DataFrame, *others: DataFrame) -> DataFrame:
    """All rows of same-schema parts."""
    for part in others:
        first = first.unionByName(part)
    return first
