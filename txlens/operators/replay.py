"""Batch twins of the live features, and the tables that warm up the live state.

The live features look only at the past, per card (customer for the z-score), and differ
from the sequence features on purpose: 60 s burst of more than three payments, one-step
escalation, velocity cap 1 000, first gap 0.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.functions.numeric import degrees_km, flag
from txlens.functions.timeparts import epoch_micros
from txlens.operators.ordered import (
    MAX_KEY_ROWS,
    ordered_columns,
    running_moments,
    sliding_count,
)

BURST_SECONDS = 60
BURST_LIMIT = 3
MAX_LIVE_VELOCITY = 1_000.0
HISTORY_LENGTH = 10
MICROS = 1_000_000


def stream_zscore(tx: DataFrame, *, max_key_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """z-score of each amount against the customer's earlier payments (population std).

    Equal earlier amounts have no deviation, so their z-score is 0.
    """
    rows = tx.select(
        "transaction_id", "customer_id", "amount", epoch_micros(F.col("timestamp")).alias("_us")
    )
    rows = running_moments(
        rows, ["customer_id"], ["_us", "transaction_id"], "amount", max_key_rows=max_key_rows
    )
    differ = (F.col("count_before") > 1) & (F.col("low_before") < F.col("high_before"))
    std = F.when(differ, F.sqrt("var_before")).otherwise(F.lit(0.0))
    z = F.when(F.col("std_before") > 0, (F.col("amount") - F.col("mean_before")) / F.col("std_before"))
    return (
        rows.withColumns({"mean_before": F.coalesce("mean_before", F.lit(0.0)), "std_before": std})
        .withColumn("amount_deviation_z_score", F.coalesce(z, F.lit(0.0)))
        .select(
            "transaction_id", "customer_id", "count_before", "mean_before", "std_before",
            "amount_deviation_z_score",
        )
    )


def stream_card_features(tx: DataFrame, *, max_key_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """Gap, sequence number, category switch, escalation and velocity per card."""
    rows = tx.select(
        "transaction_id", "card_id", "amount", "merchant_category", "location_lat",
        "location_long", epoch_micros(F.col("timestamp")).alias("_us"),
    )
    rows = ordered_columns(
        rows,
        ["card_id"],
        ["_us", "transaction_id"],
        lags={
            "_prev_us": ("_us", 1),
            "_prev_amount": ("amount", 1),
            "_prev_category": ("merchant_category", 1),
            "_prev_lat": ("location_lat", 1),
            "_prev_lon": ("location_long", 1),
        },
        running={"transaction_sequence_number": ("sum", F.lit(1))},
        max_key_rows=max_key_rows,
    )
    gap = (F.col("_us") - F.col("_prev_us")) / F.lit(float(MICROS))
    km = degrees_km(
        F.col("location_lat"), F.col("location_long"), F.col("_prev_lat"), F.col("_prev_lon")
    )
    velocity = F.when(gap > 0, F.least(km / (gap / F.lit(3600.0)), F.lit(MAX_LIVE_VELOCITY)))

    def or_zero(condition):
        return F.coalesce(flag(condition), F.lit(0))

    return rows.select(
        "transaction_id",
        "card_id",
        F.coalesce(gap, F.lit(0.0)).alias("time_since_last_transaction"),
        "transaction_sequence_number",
        or_zero(F.col("_prev_category") != F.col("merchant_category")).alias(
            "merchant_category_switch_flag"
        ),
        or_zero(F.col("amount") > F.col("_prev_amount")).alias("escalating_amounts_flag"),
        F.coalesce(velocity, F.lit(0.0)).alias("spatial_velocity"),
    )


def stream_burst(
    tx: DataFrame, seconds: int = BURST_SECONDS, limit: int = BURST_LIMIT, *, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """Payments of the card in the last 60 s, this one included, and the burst flag."""
    rows = tx.select("transaction_id", "card_id", epoch_micros(F.col("timestamp")).alias("_us"))
    counted = sliding_count(
        rows, ["card_id"], "_us", "transaction_id", seconds * MICROS, "burst_count",
        max_key_rows=max_key_rows,
    )
    return counted.select(
        "transaction_id",
        "card_id",
        "burst_count",
        flag(F.col("burst_count") > limit).alias("rapid_fire_transaction_flag"),
    )


def card_history(tx: DataFrame, length: int = HISTORY_LENGTH) -> DataFrame:
    """Latest payments per card. The rank limit is applied before the shuffle."""
    latest = Window.partitionBy("card_id").orderBy(F.desc("timestamp"), F.desc("transaction_id"))
    return (
        tx.select(
            "card_id", "transaction_id", "merchant_category", "amount", "timestamp",
            "location_lat", "location_long",
        )
        .withColumn("rn", F.row_number().over(latest))
        .filter(F.col("rn") <= length)
    )


def card_last_state(tx: DataFrame) -> DataFrame:
    """Last time, place, category, amount and true payment count per card."""
    last = F.max(
        F.struct(
            "timestamp", "transaction_id", "location_lat", "location_long", "merchant_category", "amount"
        )
    )
    return (
        tx.groupBy("card_id")
        .agg(last.alias("last"), F.count(F.lit(1)).alias("seq"))
        .select(
            "card_id",
            F.col("last.timestamp").alias("last_ts"),
            F.col("last.location_lat").alias("last_lat"),
            F.col("last.location_long").alias("last_lon"),
            F.col("last.merchant_category").alias("last_category"),
            F.col("last.amount").alias("last_amount"),
            "seq",
        )
    )


def welford_seed(tx: DataFrame) -> DataFrame:
    """Count, mean and sum of squared deviations per customer."""
    return tx.groupBy("customer_id").agg(
        F.count("amount").alias("count"),
        F.avg("amount").alias("mean"),
        (F.var_pop("amount") * F.count("amount")).alias("m2"),
    )


def customer_agg_seed(gold: DataFrame) -> DataFrame:
    return gold.groupBy("customer_id").agg(
        F.max("cf_fraud_rate").alias("fraud_rate"), F.max("cf_night_tx_ratio").alias("night_ratio")
    )


def merchant_agg_seed(gold: DataFrame) -> DataFrame:
    return gold.groupBy("merchant_id").agg(F.avg(F.col("is_fraud").cast("int")).alias("fraud_rate"))
