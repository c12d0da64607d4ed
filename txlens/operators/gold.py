"""Gold: one model-ready row per payment."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.operators.ordered import MAX_KEY_ROWS, join_entities

# Columns of the shipping gold table that stay zero until their signals are trusted.
ZEROED = {
    "ip_fraud_rate": 0.0, "ip_degree": 0, "dev_fraud_rate": 0.0, "dev_degree": 0,
    "suspicious_cluster_member": 0, "campaign_txn_count": 0, "campaign_total_amount": 0.0,
    "campaign_merchant_diversity": 0,
}

# Zeroed columns of the variant built without network and campaign inputs.
ZEROED_FULL = {
    "shared_entity_fraud_rate": 0.0, "degree": 0, "suspicious_cluster_member": 0,
    "campaign_txn_count": 0, "campaign_total_amount": 0.0, "campaign_merchant_diversity": 0,
}

FACT_COLUMNS = [
    "transaction_id", "timestamp", "amount", "merchant_id", "customer_id", "merchant_category",
    "transaction_channel", "card_present", "is_fraud",
]

SEQUENCE_COLUMNS = [
    "fraud_target", "fraud_type", "time_since_last_transaction", "transaction_sequence_number",
    "spatial_velocity", "hour_deviation_from_norm", "amount_deviation_z_score",
    "rapid_fire_transaction_flag", "escalating_amounts_flag", "merchant_category_switch_flag",
    "geo_anomaly", "device_anomaly", "ip_anomaly",
]


def _one_per_key(df: DataFrame, key: str, columns: dict[str, str]) -> DataFrame:
    """One row per entity even if the silver table was appended to twice."""
    return df.groupBy(key).agg(*[F.max(c).alias(name) for name, c in columns.items()])


def _customer_side(customer: DataFrame) -> DataFrame:
    columns = {"cf_fraud_rate": "fraud_rate", "cf_night_tx_ratio": "night_transaction_ratio"}
    return _one_per_key(customer, "customer_id", columns)


def _merchant_side(merchant: DataFrame) -> DataFrame:
    return _one_per_key(merchant, "merchant_id", {"mf_fraud_rate": "merchant_fraud_rate"})


def _zeros(columns: dict[str, float]) -> dict:
    return {name: F.lit(value) for name, value in columns.items()}


def _with_rates(
    rows: DataFrame, counted: DataFrame, customer: DataFrame, merchant: DataFrame, max_key_rows: int
) -> DataFrame:
    """Customer and merchant rates. Either entity may own a large share of the payments."""
    sides = [
        (_customer_side(customer), ["customer_id"]),
        (_merchant_side(merchant), ["merchant_id"]),
    ]
    return join_entities(rows, sides, counted=counted, max_key_rows=max_key_rows)


def gold_master(
    silver: DataFrame,
    customer: DataFrame,
    merchant: DataFrame,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Shipping form: silver plus customer and merchant rates; unmatched entities get 0."""
    return (
        _with_rates(silver, silver, customer, merchant, max_key_rows)
        .na.fill(0.0, ["cf_fraud_rate", "cf_night_tx_ratio", "mf_fraud_rate"])
        .withColumns(_zeros(ZEROED) | {"feature_calculated_at": F.current_timestamp()})
    )


def gold_full(
    tx: DataFrame,
    sequence: DataFrame,
    customer: DataFrame,
    merchant: DataFrame,
    network: DataFrame | None = None,
    campaign: DataFrame | None = None,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Full form. The joins on transaction_id come first and share one partitioning.

    Without ``network`` and ``campaign`` their columns are zero.
    """
    seq = sequence.select(
        "transaction_id", *SEQUENCE_COLUMNS, F.col("campaign_id").alias("simulation_campaign_id")
    )
    out = tx.select(*FACT_COLUMNS).join(seq, "transaction_id", "left")
    if network is not None:
        columns = ["shared_entity_fraud_rate", "degree", "suspicious_cluster_member"]
        out = out.join(network.select("transaction_id", *columns), "transaction_id", "left")
    if campaign is not None:
        columns = ["campaign_txn_count", "campaign_total_amount", "campaign_merchant_diversity"]
        out = out.join(campaign.select("transaction_id", *columns), "transaction_id", "left")
    out = _with_rates(out, tx, customer, merchant, max_key_rows)
    missing = {name: value for name, value in ZEROED_FULL.items() if name not in out.columns}
    filled = {name: value for name, value in ZEROED_FULL.items() if name not in missing}
    out = out.na.fill(filled) if filled else out
    return out.withColumns(_zeros(missing) | {"feature_calculated_at": F.current_timestamp()})


def gold_master_wide(
    tx: DataFrame,
    sequence: DataFrame,
    campaign: DataFrame,
    customer: DataFrame,
    merchant: DataFrame,
    device: DataFrame,
    network_rollup: DataFrame,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Library form: every silver table joined as is, nulls kept.

    Columns another side already provides are taken from the left.
    """
    out = tx
    for side in (sequence, campaign):
        new = [c for c in side.columns if c not in out.columns]
        out = out.join(side.select("transaction_id", *new), "transaction_id", "left")
    seen, sides = set(out.columns), []
    for side, key in (
        (customer, "customer_id"),
        (network_rollup, "customer_id"),
        (merchant, "merchant_id"),
        (device, "user_agent"),
    ):
        sides.append((side.select(key, *[c for c in side.columns if c not in seen]), [key]))
        seen |= set(side.columns)
    out = join_entities(out, sides, counted=tx, max_key_rows=max_key_rows)
    return out.withColumn("feature_calculated_at", F.current_timestamp())


def gold_validate(gold: DataFrame) -> DataFrame:
    """One row of integrity figures."""
    return gold.agg(
        F.count(F.lit(1)).alias("total"),
        F.count_if(F.col("ip_fraud_rate") > 0).alias("net_hits"),
        F.avg("ip_fraud_rate").alias("avg_ip_risk"),
        F.avg("dev_degree").alias("avg_dev_degree"),
    )
