"""The jobs end to end on the small tables, run twice: a rerun replaces, never appends."""

import tempfile

import pytest
from pyspark.sql import functions as F

from txlens.plans import jobs
from txlens.sources import fixtures as fx
from txlens.sources import lookups, schema
from txlens.sources.tables import enforce, read_table, write_csv, write_table

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def warehouse(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    ids = ["transaction_id", "card_id", "account_id", "customer_id", "merchant_id"]
    tx = fx.payments(spark, SMALL).withColumns({c: F.col(c).cast("string") for c in ids})
    text = F.date_format("timestamp", "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")
    raw = {
        "transactions": enforce(tx.withColumn("timestamp", text), schema.TRANSACTIONS),
        "fraud_metadata": enforce(fx.fraud_metadata(spark, SMALL), schema.FRAUD_METADATA),
        "customers": enforce(fx.customers(spark, SMALL), schema.CUSTOMERS),
        "accounts": enforce(fx.accounts(spark, SMALL), schema.ACCOUNTS),
        "cards": enforce(tx.select("card_id", "account_id", "customer_id").distinct(), schema.CARDS),
        "map_nodes": fx.map_nodes(spark, SMALL),
        "map_relations": fx.map_relations(spark, SMALL),
        "state_boundaries": fx.state_boundaries(spark, SMALL),
        "district_boundaries": fx.district_boundaries(spark, SMALL),
    }
    for name, table in raw.items():
        write_table(table, f"{folder}/raw/{name}.parquet")
    return jobs.Warehouse(spark, f"{folder}/raw", f"{folder}/wh")


def run(warehouse, *names):
    for name in names:
        jobs.JOBS[name](warehouse)


def test_medallion(warehouse):
    steps = ["ingest", "silver-all", "gold-master", "gold-full", "gold-validate"]
    run(warehouse, *steps)
    run(warehouse, *steps)
    n = warehouse.raw("transactions").count()
    for layer, name in (("bronze", "transactions"), ("silver", "transactions"),
                        ("gold", "transactions"), ("gold", "transactions_full")):
        assert warehouse.read(layer, name).count() == n
    assert warehouse.read("silver", "customer_features").count() == warehouse.raw("customers").count()
    gold = warehouse.read("gold", "transactions")
    assert gold.filter("cf_fraud_rate IS NULL OR mf_fraud_rate IS NULL").count() == 0
    assert dict(gold.dtypes)["timestamp"] == "timestamp"
    frauds = warehouse.read("silver", "campaign_features")
    assert frauds.count() == warehouse.read("bronze", "transactions").filter("is_fraud").count()


def test_marts_with_other_lists(warehouse, spark):
    """Lists given as CSV replace those of the library; a kind that is not listed falls back as before."""
    folder = tempfile.mkdtemp(prefix="lists-")
    kinds = spark.createDataFrame([(" Clothes", "TAILOR", "HIGH")], lookups.CATEGORY_SCHEMA)
    states = spark.createDataFrame([("mh", "Maharashtra!")], lookups.STATE_SCHEMA)
    write_csv(kinds, f"{folder}/category_map.csv")
    write_csv(states, f"{folder}/state_map.csv")
    run(warehouse, "extract-nodes")
    other = jobs.Warehouse(spark, warehouse.raw_root, warehouse.root, lookups=folder)
    run(other, "build-marts")
    shops = other.read("marts", "merchants").select("merchant_category", "risk_level").distinct()
    assert sorted(map(tuple, shops.collect())) == [("GENERAL_RETAIL", "LOW"), ("TAILOR", "HIGH")]
    given = other.lookup("state_map", lookups.STATE_SCHEMA, lookups.state_map)
    assert [tuple(r) for r in given.collect()] == [("mh", "Maharashtra!")]


def test_further_payments_replace_by_id(warehouse):
    """A later file with corrected and new payments, loaded twice."""
    run(warehouse, "ingest")
    raw = warehouse.raw("transactions")
    n = raw.count()
    some = raw.limit(30)
    fresh = raw.limit(7).withColumn("transaction_id", F.concat(F.lit("new-"), "transaction_id"))
    lost = raw.limit(2).withColumn("transaction_id", F.lit(None).cast("string"))
    more = some.withColumn("amount", F.lit(-5.0)).unionByName(fresh).unionByName(lost)
    write_table(more, f"{warehouse.raw_root}/transactions_more.parquet")
    for _ in range(2):
        run(warehouse, "ingest-more")
        landed = warehouse.read("bronze", "transactions")
        assert landed.count() == n + 7 and landed.filter("amount = -5").count() == 30
    run(warehouse, "ingest")
    assert warehouse.read("bronze", "transactions").count() == n


def test_geography(warehouse):
    run(
        warehouse, "extract-nodes", "map-city-state", "normalize-states", "parse-districts",
        "map-state-districts", "compare-city-district", "build-marts", "export-references",
    )
    shops = warehouse.read("reference", "raw_merchants").count()
    assert warehouse.read("marts", "merchants").count() >= shops
    summary = warehouse.read("marts", "district_summary")
    total = summary.agg(F.sum("merchant_nodes")).first()[0]
    assert total == warehouse.read("marts", "merchants").count()
    for name in ("residential", "merchants", "financial"):
        assert warehouse.read("references", f"ref_{name}").count() > 0


def test_live_jobs(warehouse, monkeypatch):
    monkeypatch.setattr(jobs.model, "train", lambda rows: jobs.model.classifier(trees=3, depth=2).fit(rows))
    run(warehouse, "ingest", "silver-core", "gold-master", "train-model", "test-model",
        "leakage-audit", "attribution", "publish", "publish")
    damaged = warehouse.spark.createDataFrame([("{oops",)], "value string")
    damaged.write.text(f"{warehouse.path('live', 'events')}/damaged")
    run(warehouse, "score-live")
    n = warehouse.read("bronze", "transactions").count()
    assert warehouse.read("live", "fraud_scores").count() == n
    assert warehouse.spark.read.text(warehouse.path("live", "quarantine")).count() == 1
    truth = warehouse.spark.read.csv(warehouse.path("live", "ground_truth"), header=True)
    assert truth.count() == n


def test_live_jobs_from_a_time_on(warehouse, monkeypatch):
    """The state starts from the payments before, the events are those from then on."""
    seen = []
    monkeypatch.setattr(warehouse, "since", "2024-01-14 00:00:00")
    monkeypatch.setattr(warehouse, "root", warehouse.root)
    started = jobs.seed.warm_start
    monkeypatch.setattr(jobs.seed, "warm_start", lambda tx: seen.append(tx.agg(F.max("timestamp")).first()[0]) or started(tx))
    live = f"{tempfile.mkdtemp(prefix='run-')}"
    path = warehouse.path
    monkeypatch.setattr(warehouse, "path", lambda layer, name: f"{live}/{name}" if layer == "live" else path(layer, name))
    run(warehouse, "publish", "score-live")
    late = warehouse.read("bronze", "transactions").filter("timestamp >= '2024-01-14'")
    assert 0 < late.count() == warehouse.read("live", "fraud_scores").count()
    assert str(seen[0]) < "2024-01-14"


def test_schema_is_enforced(spark):
    df = enforce(spark.range(2).withColumnRenamed("id", "transaction_id"), schema.TRANSACTIONS)
    found = [(f.name, f.dataType) for f in df.schema]
    assert found == [(f.name, f.dataType) for f in schema.TRANSACTIONS]


def test_rows_per_file(spark):
    folder = tempfile.mkdtemp(prefix="run-")
    write_table(spark.range(100).coalesce(1), f"{folder}/t", rows_per_file=30)
    back = read_table(spark, f"{folder}/t")
    assert back.count() == 100 and len(back.inputFiles()) == 4
