"""Column selections between layers and for the model."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from txlens.functions.timeparts import parse_rfc3339
from txlens.sources.schema import LABEL_COLUMNS

# The operational feature list; identifiers, labels and ground truth are absent.
OPERATIONAL_FEATURES = [
    "time_since_last_transaction", "transaction_sequence_number", "spatial_velocity",
    "hour_deviation_from_norm", "amount_deviation_z_score", "rapid_fire_transaction_flag",
    "escalating_amounts_flag", "merchant_category_switch_flag", "transaction_channel",
    "card_present", "merchant_category", "suspicious_cluster_member",
]


def bronze_transactions(raw: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Typed bronze rows: the time text becomes a UTC millisecond timestamp."""
    return raw.withColumn(ts, parse_rfc3339(F.col(ts)))


def bronze_projection(tx: DataFrame, columns: list[str], flags: list[str]) -> DataFrame:
    """Only the columns a stage needs, its 0/1 columns as integers."""
    return tx.select(*[F.col(c).cast("int").alias(c) if c in flags else F.col(c) for c in columns])


def unlabeled_projection(tx: DataFrame) -> DataFrame:
    """What a live feed may see: no label, no chargeback."""
    return tx.drop(*LABEL_COLUMNS)


def operational_features(gold: DataFrame, features: list[str] = OPERATIONAL_FEATURES) -> DataFrame:
    return gold.select([c for c in features if c in gold.columns])


def align_features(rows: DataFrame, spec: dict[str, str], keep: tuple[str, ...] = ()) -> DataFrame:
    """The model's columns in its order and types; a column that is absent becomes 0."""
    have = set(rows.columns)
    return rows.select(
        *keep,
        *[
            (F.col(name) if name in have else F.lit(0.0)).cast(kind).alias(name)
            for name, kind in spec.items()
        ],
    )
