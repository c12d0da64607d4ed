"""Scoring of live features and the score table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from txlens.operators.evaluation import SCORE_THRESHOLD, score_flag
from txlens.operators.model import FEATURE_SPEC
from txlens.operators.projection import align_features

SHOWN = ("cf_night_tx_ratio",)  # looked up for whoever reviews a score; not a model feature
KEPT = ("transaction_id", "card_id", "customer_id", "amount", "timestamp", "received_at")


def with_customer_aggregates(features: DataFrame, customer_agg: DataFrame) -> DataFrame:
    """Stream-static left join of the customers' night ratio; unknown customers get 0."""
    side = customer_agg.select(
        F.col("customer_id").cast("string").alias("customer_id"),
        F.col("night_ratio").alias("cf_night_tx_ratio"),
    )
    return features.join(side, "customer_id", "left").na.fill({"cf_night_tx_ratio": 0.0})


def score(features: DataFrame, model: PipelineModel, threshold: float = SCORE_THRESHOLD) -> DataFrame:
    """The score table's columns. A failing batch fails; nothing is scored 0 instead."""
    shown = [c for c in SHOWN if c in features.columns]
    rows = align_features(features, FEATURE_SPEC, keep=(*KEPT, *shown))
    scored = model.transform(rows).withColumn(
        "fraud_probability", vector_to_array("probability")[1]
    )
    return score_flag(scored, threshold).select(
        "transaction_id",
        "card_id",
        "customer_id",
        "amount",
        "timestamp",
        F.col("received_at").alias("kafka_received_at"),
        *shown,
        "fraud_probability",
        "flagged",
        F.current_timestamp().alias("scored_at"),
    )


def batch_writer(
    path: str, model: PipelineModel | None = None, lookup: Callable[[], DataFrame] | None = None
) -> Callable[[DataFrame, int], None]:
    """foreachBatch sink: one folder per batch id, overwritten when a batch is replayed.

    ``lookup`` gives the customer aggregates; it is asked anew for every batch, so that a batch sees the
    newest version of that table.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        if lookup is not None:
            batch = with_customer_aggregates(batch, lookup())
        rows = score(batch, model) if model is not None else batch
        rows.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def start_scoring(
    features: DataFrame,
    path: str,
    checkpoint: str,
    model: PipelineModel | None = None,
    available_now: bool = False,
    lookup: Callable[[], DataFrame] | None = None,
) -> StreamingQuery:
    writer = features.writeStream.foreachBatch(batch_writer(path, model, lookup)).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


def start_quarantine(
    bad: DataFrame, path: str, checkpoint: str, available_now: bool = False
) -> StreamingQuery:
    """Messages that did not decode, as they came (JSON lines with key and arrival time)."""
    writer = bad.writeStream.format("json").option("path", path).option(
        "checkpointLocation", checkpoint
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()
