"""Fraud campaigns: payments labelled fraud, cut into sessions by a 48 h gap."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.functions.numeric import n_unique
from txlens.functions.timeparts import epoch_millis
from txlens.operators.ordered import (
    MAX_KEY_ROWS,
    join_unique,
    plain_columns,
    sliced_columns,
    split_hot,
)

CAMPAIGN_GAP_MS = 172_800_000

_KEY, _ORDER, _SESSION = ["customer_id"], ["_ms", "transaction_id"], ["customer_id", "_seq"]


def _totals_by_window(sessions: DataFrame) -> DataFrame:
    """Totals inside the customer's own partition: no further shuffle.

    A merchant counts once per campaign, at its first payment.
    """
    visits = Window.partitionBy(*_SESSION, "merchant_id").orderBy(*_ORDER)
    campaign = Window.partitionBy(*_SESSION)
    return sessions.withColumn(
        "_first", (F.row_number().over(visits) == 1).cast("int")
    ).withColumns(
        {
            "campaign_txn_count": F.count(F.lit(1)).over(campaign),
            "campaign_total_amount": F.sum("amount").over(campaign),
            "campaign_merchant_diversity": F.sum("_first").over(campaign),
        }
    ).drop("_first")


def _totals_by_join(sessions: DataFrame, max_key_rows: int) -> DataFrame:
    """Totals of campaigns too large for one task: aggregated on the map side, joined back."""
    totals = sessions.groupBy(*_SESSION).agg(
        F.count(F.lit(1)).alias("campaign_txn_count"),
        F.sum("amount").alias("campaign_total_amount"),
        n_unique("merchant_id").alias("campaign_merchant_diversity"),
    )
    return join_unique(sessions, totals, _SESSION, max_key_rows=max_key_rows)


def campaign_features(
    tx: DataFrame, gap_ms: int = CAMPAIGN_GAP_MS, *, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """Size, amount and merchant diversity of each fraud payment's campaign."""
    fraud = tx.filter(F.col("is_fraud").cast("int") == 1).select(
        "transaction_id",
        "customer_id",
        "merchant_id",
        "amount",
        epoch_millis(F.col("timestamp")).alias("_ms"),
    )
    gap = F.col("_ms") - F.col("_prev_ms")
    starts = (gap.isNull() | (gap > gap_ms)).cast("int")
    spec = {"lags": {"_prev_ms": ("_ms", 1)}, "running": {"_seq": ("sum", starts)}}
    split = split_hot(fraud, _KEY, max_key_rows)
    if split is None:
        out = _totals_by_window(plain_columns(fraud, _KEY, _ORDER, **spec))
    else:
        hot = sliced_columns(split, _KEY, _ORDER, **spec, max_key_rows=max_key_rows)
        cold = plain_columns(split.cold, _KEY, _ORDER, **spec)
        out = _totals_by_window(cold).unionByName(_totals_by_join(hot, max_key_rows))
    campaign_id = F.concat(
        F.col("customer_id").cast("string"), F.lit("-"), F.col("_seq").cast("string")
    )
    return out.select(
        "transaction_id",
        campaign_id.alias("campaign_id"),
        "campaign_txn_count",
        "campaign_total_amount",
        "campaign_merchant_diversity",
    )
