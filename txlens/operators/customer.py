"""Customer profile: behaviour aggregates and account counts on the customer dimension."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.numeric import n_unique, safe_div
from txlens.functions.timeparts import is_night, is_weekend


def customer_activity(tx: DataFrame) -> DataFrame:
    ts = F.col("timestamp")
    out = tx.groupBy("customer_id").agg(
        F.count(F.lit(1)).alias("total_transactions"),
        F.sum(F.col("is_fraud").cast("int")).alias("total_fraud_transactions"),
        F.avg("amount").alias("avg_transaction_amount"),
        F.stddev_samp("amount").alias("std_transaction_amount"),
        n_unique("merchant_id").alias("unique_merchants_count"),
        n_unique("merchant_category").alias("unique_merchant_categories_count"),
        n_unique("merchant_country").alias("unique_countries_count"),
        F.sum(is_night(ts)).alias("night_tx_count"),
        F.sum(is_weekend(ts)).alias("weekend_tx_count"),
        F.min(ts).alias("first_transaction_ts"),
        F.max(ts).alias("last_transaction_ts"),
    )
    total = F.col("total_transactions")
    return out.withColumns(
        {
            "fraud_rate": safe_div(F.col("total_fraud_transactions"), total),
            "night_transaction_ratio": safe_div(F.col("night_tx_count"), total),
            "weekend_transaction_ratio": safe_div(F.col("weekend_tx_count"), total),
        }
    )


def customer_features(tx: DataFrame, customers: DataFrame, accounts: DataFrame) -> DataFrame:
    """Customers with account count and activity; only three columns are null-filled."""
    account_count = accounts.groupBy("customer_id").agg(F.count(F.lit(1)).alias("account_count"))
    dims = customers
    if "is_fraud" in dims.columns:
        dims = dims.withColumn("is_fraud", F.col("is_fraud").cast("int"))
    return (
        dims.join(account_count, "customer_id", "left")
        .join(customer_activity(tx), "customer_id", "left")
        .na.fill({"fraud_rate": 0.0, "total_transactions": 0, "account_count": 0})
    )
