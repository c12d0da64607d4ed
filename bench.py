"""Headline timings as one JSON line.

Catalogue queries run on $BENCH_SF_DIR (median of three warm runs, all rows produced). The
bronze, silver and gold jobs also run on a three-million-payment copy of the events, the
size of the published stress run, and report rows per second.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

ROOT = os.path.dirname(os.path.abspath(__file__))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

from pyspark.sql import functions as F  # noqa: E402

from txlens.plans import jobs  # noqa: E402
from txlens.plans.catalog import QUERIES  # noqa: E402
from txlens.session import build_session  # noqa: E402
from txlens.sources import fixtures as fx  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
STRESS_ROWS = int(os.environ.get("BENCH_STRESS_ROWS", "3000000"))
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINES = [
    "sequence_features", "customer_features", "merchant_features", "campaign_features",
    "device_features", "gold_master", "gold_full", "network_tx_features", "classify_nodes",
    "spatial_join", "district_summary", "locality_match", "roc_auc", "pr_thresholds",
    "amount_profile", "category_overrep", "balanced_sample", "stream_zscore",
    "stream_card_features", "stream_burst", "card_history", "event_json_decode",
]


def run(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def timed(action) -> float:
    start = time.perf_counter()
    action()
    return time.perf_counter() - start


def stress_inputs(spark, folder: str) -> int:
    """Payments multiplied to the stress size: two customer groups, shifted in time."""
    tx = fx.payments(spark, SF_DIR)
    base = tx.count()
    copies = max(1, round(STRESS_ROWS / base))
    tx = tx.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    group = (F.col("copy") % 2) * 1_000_000
    shifted = F.timestamp_add("DAY", (F.col("copy") / 2).cast("int") * 30, F.col("timestamp"))
    tx.select(
        (F.col("transaction_id") + F.col("copy") * 10_000_000).cast("string").alias("transaction_id"),
        *[
            (F.col(c) + group).cast("string").alias(c)
            for c in ("card_id", "account_id", "customer_id")
        ],
        F.col("merchant_id").cast("string").alias("merchant_id"),
        F.concat(F.lit("Shop "), "merchant_id").alias("merchant_name"),
        "merchant_category", "merchant_country", "amount",
        F.date_format(shifted, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX").alias("timestamp"),
        "transaction_channel", (F.col("card_present") == 1).alias("card_present"), "user_agent",
        "ip_address", (F.col("is_fraud") == 1).alias("is_fraud"),
        (F.col("chargeback") == 1).alias("chargeback"), "chargeback_days", "location_lat",
        "location_long",
    ).repartition(16).write.mode("overwrite").parquet(f"{folder}/transactions.parquet")
    written = spark.read.parquet(f"{folder}/transactions.parquet")
    written.filter("is_fraud").select(
        "transaction_id", F.lit(True).alias("fraud_target"), F.lit("upi_scam").alias("fraud_type")
    ).write.mode("overwrite").parquet(f"{folder}/fraud_metadata.parquet")
    people = written.select("customer_id", "account_id").distinct()
    people.write.mode("overwrite").parquet(f"{folder}/accounts.parquet")
    people.select("customer_id", F.lit("x").alias("name")).write.mode("overwrite").parquet(
        f"{folder}/customers.parquet"
    )
    written.select("card_id", "account_id", "customer_id").distinct().write.mode("overwrite").parquet(
        f"{folder}/cards.parquet"
    )
    return base * copies


def main() -> None:
    spark = build_session(
        "txlens-bench",
        f"local[{CPUS}]",
        **{
            "spark.sql.shuffle.partitions": str(2 * int(CPUS)),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds: dict[str, float] = {}
    for name in HEADLINES:
        run(QUERIES[name](spark, SF_DIR))  # warm-up
        seconds[name] = statistics.median(
            timed(lambda: run(QUERIES[name](spark, SF_DIR))) for _ in range(RUNS)
        )
    folder = tempfile.mkdtemp(prefix="run-")
    rows = stress_inputs(spark, folder)
    warehouse = jobs.Warehouse(spark, folder, f"{folder}/warehouse")
    rates = {}
    for name, job in (
        ("stress_bronze", jobs.ingest),
        ("stress_silver", jobs.silver_core),
        ("stress_gold", jobs.gold_master),
    ):
        seconds[name] = timed(lambda: job(warehouse))
        rates[name] = round(rows / seconds[name])
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total wall time of headline queries and stress jobs",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": {k: round(v, 3) for k, v in seconds.items()},
                "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"),
                "stress_rows": rows,
                "rows_per_sec": rates,
                "cpus": int(CPUS),
            }
        )
    )


if __name__ == "__main__":
    main()
