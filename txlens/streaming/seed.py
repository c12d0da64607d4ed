"""Warm start: the live state rebuilt from stored payments."""

from __future__ import annotations

from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F

from txlens.functions.timeparts import epoch_micros
from txlens.operators.ordered import join_unique
from txlens.operators.replay import BURST_SECONDS, MICROS, card_history, card_last_state, welford_seed


def warm_start(tx: DataFrame) -> GroupedData:
    """One row per (customer, card), grouped by customer for the stateful operator.

    The history is the last 10 payments of a card; the burst window is refilled with all
    payments of the card's last minute, however many. No list grows with the table.
    """
    by_time = F.struct(F.col("rn"), epoch_micros(F.col("timestamp")).alias("us"),
                       F.col("transaction_id").cast("string").alias("id"))
    latest = (
        card_history(tx)
        .groupBy("card_id")
        .agg(F.sort_array(F.collect_list(by_time)).alias("latest"))
    )
    owners = tx.groupBy("card_id").agg(F.max("customer_id").alias("customer_id"))
    times = tx.select("card_id", epoch_micros(F.col("timestamp")).alias("us")).filter("us IS NOT NULL")
    newest = times.groupBy("card_id").agg(F.max("us").alias("newest"))
    recent = (
        join_unique(times, newest, ["card_id"])
        .filter(F.col("us") > F.col("newest") - BURST_SECONDS * MICROS)
        .groupBy("card_id")
        .agg(F.sort_array(F.collect_list("us")).alias("recent_us"))
    )
    cards = (
        card_last_state(tx)
        .join(latest, "card_id")
        .join(recent, "card_id")
        .join(owners, "card_id")
        .select(
            F.col("customer_id").cast("string").alias("customer_id"),
            F.col("card_id").cast("string").alias("card_id"),
            epoch_micros(F.col("last_ts")).alias("last_us"),
            "last_lat",
            "last_lon",
            "last_category",
            "last_amount",
            "seq",
            "recent_us",
            F.transform("latest", lambda p: p["id"]).alias("history"),
        )
    )
    stats = welford_seed(tx).select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("count").alias("count_seen"),
        "mean",
        "m2",
    )
    return cards.join(stats, "customer_id").groupBy("customer_id")
