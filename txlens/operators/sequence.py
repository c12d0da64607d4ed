"""Per-payment sequence features, ordered by time within a customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.numeric import degrees_km, flag, is_round_amount
from txlens.functions.timeparts import epoch_millis, hours_since_midnight, is_weekend
from txlens.operators.ordered import MAX_KEY_ROWS, ordered_columns, running_moments

RAPID_FIRE_MS = 300_000
MAX_VELOCITY_KMH = 10_000.0
MS_PER_HOUR = 3_600_000.0

CARRIED = [
    "transaction_id", "card_id", "account_id", "customer_id", "merchant_id",
    "merchant_category", "amount", "timestamp", "transaction_channel", "card_present",
    "user_agent", "ip_address", "is_fraud",
]

# Columns that exist for the schema only; no rule computes them.
STUBS = {
    "same_day_transaction_count": "bigint", "is_holiday": "int", "is_foreign": "int",
    "is_cross_border": "int", "is_ip_mismatch": "int",
}

FLAGS = [
    "rapid_fire_transaction_flag", "escalating_amounts_flag", "merchant_category_switch_flag",
    "amount_round_number_flag",
]


def _norms_before(rows: DataFrame, keys: list[str], order: list[str], max_key_rows: int) -> DataFrame:
    """Mean hour, mean and sample deviation of the amount over the customer's earlier payments only."""
    rows = running_moments(rows, keys, order, "amount", max_key_rows=max_key_rows)
    n = F.col("count_before").cast("double")
    spread = F.when(F.col("low_before") == F.col("high_before"), 0.0).otherwise(F.sqrt(F.col("var_before") * n / (n - 1)))
    hours = F.col("_hours") - F.coalesce("_hour", F.lit(0.0))
    timed = F.col("_n_hours") - F.col("_hour").isNotNull().cast("int")
    return rows.withColumns(
        {
            "_mean_hour": F.when(timed > 0, hours / timed),
            "_mean_amount": F.col("mean_before"),
            "_std_amount": F.when(n > 1, spread),
        }
    )


def sequence_features(
    tx: DataFrame, *, as_of: bool = False, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """Gaps, velocity, deviations and pattern flags.

    Deviations are taken from the customer's whole history, or, ``as_of`` each payment, from the earlier
    payments only: then nothing a model learns from lies in the payment's future.

    Early rows keep nulls (first gap, z-score of a single payment, escalation without two
    predecessors); ``to_silver`` turns them into zeros.
    """
    carried = [c for c in CARRIED if c in tx.columns]
    rows = tx.select(*carried, "location_lat", "location_long").withColumns(
        {
            "_ms": epoch_millis(F.col("timestamp")),
            "_hour": F.hour("timestamp").cast("double"),
        }
    )
    keys, order = ["customer_id"], ["_ms", "transaction_id"]
    norms = {
        "_mean_hour": F.avg("_hour"),
        "_mean_amount": F.avg("amount"),
        "_std_amount": F.stddev_samp("amount"),
    }
    sums = {
        "_hours": ("sum", F.coalesce("_hour", F.lit(0.0))),
        "_n_hours": ("sum", F.col("_hour").isNotNull().cast("int")),
    }
    rows = ordered_columns(
        rows,
        keys,
        order,
        lags={
            "_prev_ms": ("_ms", 1),
            "_prev_lat": ("location_lat", 1),
            "_prev_lon": ("location_long", 1),
            "_prev_category": ("merchant_category", 1),
            "_prev_amount": ("amount", 1),
            "_prev2_amount": ("amount", 2),
        },
        whole=None if as_of else norms,
        running={"transaction_sequence_number": ("sum", F.lit(1))} | (sums if as_of else {}),
        max_key_rows=max_key_rows,
    )
    if as_of:
        rows = _norms_before(rows, keys, order, max_key_rows)
    amount, gap = F.col("amount"), F.col("_ms") - F.col("_prev_ms")
    prev, prev2, category = F.col("_prev_amount"), F.col("_prev2_amount"), F.col("_prev_category")
    km = degrees_km(
        F.col("location_lat"), F.col("location_long"), F.col("_prev_lat"), F.col("_prev_lon")
    )
    # No gap: any distance is the cap, no distance is 0. First payment: 0.
    velocity = (
        F.when(gap > 0, F.least(km / (gap / F.lit(MS_PER_HOUR)), F.lit(MAX_VELOCITY_KMH)))
        .when((gap == 0) & (km > 0), F.lit(MAX_VELOCITY_KMH))
        .otherwise(F.lit(0.0))
    )
    std = F.col("_std_amount")
    z_score = F.when(std == 0, F.lit(0.0)).when(std > 0, (amount - F.col("_mean_amount")) / std)
    return rows.select(
        *carried,
        (gap / F.lit(1000.0)).alias("time_since_last_transaction"),
        "transaction_sequence_number",
        hours_since_midnight(F.col("timestamp")).alias("hours_since_midnight"),
        is_weekend(F.col("timestamp")).alias("is_weekend"),
        F.coalesce(velocity, F.lit(0.0)).alias("spatial_velocity"),
        F.abs(F.col("_hour") - F.col("_mean_hour")).alias("hour_deviation_from_norm"),
        is_round_amount(amount).alias("amount_round_number_flag"),
        z_score.alias("amount_deviation_z_score"),
        flag(gap.isNotNull() & (gap <= RAPID_FIRE_MS)).alias("rapid_fire_transaction_flag"),
        flag((prev2 < prev) & (prev < amount)).alias("escalating_amounts_flag"),
        flag(category.isNotNull() & (category != F.col("merchant_category"))).alias(
            "merchant_category_switch_flag"
        ),
        *[F.lit(0).cast(kind).alias(name) for name, kind in STUBS.items()],
    )


def with_fraud_metadata(features: DataFrame, metadata: DataFrame) -> DataFrame:
    """Left-join the sparse ground truth; absent payments are legitimate."""
    flags = ["fraud_target", "geo_anomaly", "device_anomaly", "ip_anomaly"]
    side = metadata.select(
        "transaction_id", *[F.col(c).cast("int") for c in flags], "fraud_type", "campaign_id"
    )
    filled = {c: F.coalesce(F.col(c), F.lit(0)) for c in flags}
    filled["fraud_type"] = F.coalesce("fraud_type", F.lit("none"))
    return features.join(side, "transaction_id", "left").withColumns(filled)


def to_silver(features: DataFrame) -> DataFrame:
    """Landing form: the warehouse columns are not nullable, so nulls become zero."""
    zero = {c: 0 for c in FLAGS} | {
        "time_since_last_transaction": 0.0,
        "amount_deviation_z_score": 0.0,
        "hour_deviation_from_norm": 0.0,
    }
    return features.na.fill(zero)
