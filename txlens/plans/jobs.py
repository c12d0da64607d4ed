"""Medallion and geography jobs over a warehouse folder, and their command line.

    python -m txlens.plans.jobs silver-all --raw RAW --warehouse WAREHOUSE

Every job reads whole tables, runs one chain of operators and replaces its target table.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.operators import (
    campaign,
    cards,
    customer,
    entity,
    evaluation,
    gold,
    marts,
    model,
    nodes,
    projection,
    replay,
    sampling,
    sequence,
)
from txlens.session import build_session
from txlens.sources import landing, lookups, schema
from txlens.sources.tables import (
    ROWS_PER_FILE,
    read_newest,
    read_table,
    stage,
    write_csv,
    write_table,
    write_version,
)
from txlens.streaming import codec, score, seed, state


class Warehouse:
    """Table locations: raw landing files and the bronze, silver and gold layers."""

    def __init__(
        self,
        spark: SparkSession,
        raw: str,
        root: str,
        since: str | None = None,
        kafka: str | None = None,
        as_of: bool = False,
        lookups: str | None = None,
    ):
        self.spark, self.raw_root, self.root = spark, raw, root
        self.since, self.kafka, self.as_of, self.lookups = since, kafka, as_of, lookups

    def raw(self, name: str, kind=None) -> DataFrame:
        return read_table(self.spark, f"{self.raw_root}/{name}.parquet", kind)

    def lookup(self, name: str, kind: str, built_in: Callable[[SparkSession], DataFrame]) -> DataFrame:
        """The CSV list of that name if a folder of lists is given, else the list that comes with the library."""
        if self.lookups is None:
            return built_in(self.spark)
        return lookups.read_lookup(self.spark, f"{self.lookups}/{name}.csv", kind)

    def path(self, layer: str, name: str) -> str:
        return f"{self.root}/{layer}/{name}"

    def read(self, layer: str, name: str) -> DataFrame:
        return read_table(self.spark, self.path(layer, name)).drop(landing.DAY)

    def payments(self, since: str | None = None, until: str | None = None) -> DataFrame:
        """Landed payments of a period; only its days are read."""
        return landing.read_landing(self.spark, self.path("bronze", "transactions"), since, until)


# --- bronze, silver, gold -----------------------------------------------------------------


def ingest(w: Warehouse) -> None:
    """Typed landing tables; payments lie in a folder for each day."""
    tx = projection.bronze_transactions(w.raw("transactions", schema.TRANSACTIONS))
    undated = F.count_if(F.col("timestamp").isNull())
    landed = landing.write_by_day(tx, w.path("bronze", "transactions"), undated=undated)
    metadata = w.raw("fraud_metadata", schema.FRAUD_METADATA)
    write_table(metadata, w.path("bronze", "fraud_metadata"))
    people = cards.registration_parts(w.raw("customers", schema.CUSTOMERS))
    write_table(people, w.path("bronze", "customers"))
    accounts = w.raw("accounts", schema.ACCOUNTS)
    dated = accounts.withColumn("creation_date", F.col("creation_date").cast("date"))
    write_table(dated, w.path("bronze", "accounts"))
    dates = ["issue_date", "activation_date", "expiry_date"]
    held = w.raw("cards", schema.CARDS).withColumns({c: F.col(c).cast("date") for c in dates})
    write_table(held, w.path("bronze", "cards"))
    print(f"payments landed: {landed['n_rows']}, of which without a readable time: {landed.get('undated', 0)}")


def ingest_more(w: Warehouse) -> None:
    """Bring further payments into the landing table by id; a repeated run changes nothing."""
    tx = projection.bronze_transactions(w.raw("transactions_more", schema.TRANSACTIONS))
    figures = landing.upsert(w.spark, w.path("bronze", "transactions"), tx, "transaction_id")
    print(f"days written: {figures['days']}, payments without an id left out: {figures['without_key']}")


def silver_customer(w: Warehouse) -> None:
    out = customer.customer_features(
        w.read("bronze", "transactions"), w.read("bronze", "customers"), w.read("bronze", "accounts")
    )
    write_table(out, w.path("silver", "customer_features"))


def silver_merchant(w: Warehouse) -> None:
    out = entity.merchant_features(w.read("bronze", "transactions"), with_profile=True)
    write_table(out, w.path("silver", "merchant_features"))


def silver_sequence(w: Warehouse) -> None:
    tx = w.read("bronze", "transactions").withColumns(
        {c: F.col(c).cast("int") for c in ("is_fraud", "card_present")}
    )
    features = sequence.to_silver(sequence.sequence_features(tx, as_of=w.as_of))
    out = sequence.with_fraud_metadata(features, w.read("bronze", "fraud_metadata"))
    write_table(out, w.path("silver", "transactions"))


def silver_campaign(w: Warehouse) -> None:
    out = campaign.campaign_features(w.read("bronze", "transactions"))
    write_table(out, w.path("silver", "campaign_features"))


def silver_device_ip(w: Warehouse) -> None:
    out = entity.device_features(w.read("bronze", "transactions"))
    write_table(out, w.path("silver", "device_intelligence"))


def silver_network(w: Warehouse) -> None:
    tx = w.read("bronze", "transactions")
    write_table(entity.ip_reputation(tx), w.path("silver", "ip_features"))
    write_table(entity.device_reputation(tx), w.path("silver", "device_features"))
    network = entity.network_tx_features(
        tx, w.read("silver", "ip_features"), w.read("silver", "device_features")
    )
    write_table(network, w.path("silver", "network_features"))


def silver_all(w: Warehouse) -> None:
    """Independent tables, submitted together so that small stages share the cluster."""
    stages = [
        silver_sequence, silver_customer, silver_merchant, silver_campaign, silver_device_ip,
        silver_network,
    ]
    run_together(w, stages)


def silver_core(w: Warehouse) -> None:
    """The three tables the shipping gold table needs."""
    run_together(w, [silver_sequence, silver_customer, silver_merchant])


def run_together(w: Warehouse, stages) -> None:
    with ThreadPoolExecutor(len(stages)) as pool:
        for done in [pool.submit(stage, w) for stage in stages]:
            done.result()


def gold_master(w: Warehouse) -> None:
    out = gold.gold_master(
        w.read("silver", "transactions"),
        w.read("silver", "customer_features"),
        w.read("silver", "merchant_features"),
    )
    # Sorted inside files: range cuts would compute the joins twice, once for the sample.
    landed = write_table(out.sortWithinPartitions("timestamp"), w.path("gold", "transactions"))
    print(f"gold payments: {landed['n_rows']}")


def gold_full(w: Warehouse) -> None:
    out = gold.gold_full(
        w.read("bronze", "transactions"),
        w.read("silver", "transactions"),
        w.read("silver", "customer_features"),
        w.read("silver", "merchant_features"),
        w.read("silver", "network_features"),
        w.read("silver", "campaign_features"),
    )
    write_table(out, w.path("gold", "transactions_full"), ROWS_PER_FILE)


def gold_validate(w: Warehouse) -> None:
    """Print the integrity figures; an empty gold table is an error."""
    figures = gold.gold_validate(w.read("gold", "transactions")).first()
    print(figures.asDict())
    if figures["total"] == 0:
        raise ValueError("gold table is empty")


# --- geography --------------------------------------------------------------------------------


def extract_nodes(w: Warehouse) -> None:
    """One pass over the raw tags; the three tables are cut from its compact result."""
    some_role = "kind IS NOT NULL OR category IS NOT NULL OR is_residential"
    write_table(
        nodes.classify_nodes(w.raw("map_nodes", schema.MAP_NODES)).filter(some_role), w.path("reference", "nodes")
    )
    classified = w.read("reference", "nodes")
    write_table(nodes.financial_nodes(classified), w.path("reference", "raw_financial"))
    write_table(nodes.merchant_nodes(classified), w.path("reference", "raw_merchants"))
    write_table(nodes.residential_nodes(classified), w.path("reference", "raw_residential"))


def map_city_state(w: Warehouse) -> None:
    counts = nodes.city_state_counts(w.raw("map_nodes", schema.MAP_NODES))
    write_table(nodes.report_order(counts), w.path("reference", "city_state"))


def normalize_states(w: Warehouse) -> None:
    counts = nodes.city_state_clean(w.read("reference", "city_state"))
    write_table(nodes.report_order(counts), w.path("reference", "city_state_clean"))


def parse_districts(w: Warehouse) -> None:
    out = nodes.state_districts(w.raw("map_relations", schema.MAP_RELATIONS))
    write_table(out, w.path("reference", "state_districts"))


def map_state_districts(w: Warehouse) -> None:
    out = nodes.relation_districts(w.raw("map_relations", schema.MAP_RELATIONS))
    write_table(out, w.path("reference", "relation_districts"))


def compare_city_district(w: Warehouse) -> None:
    out = nodes.city_district_intersect(
        w.read("reference", "city_state_clean"), w.read("reference", "state_districts")
    )
    write_table(out, w.path("reference", "city_is_district"))


def build_marts(w: Warehouse) -> None:
    layers = marts.boundary_layers(w.raw("state_boundaries"), w.raw("district_boundaries"))
    kinds = w.lookup("category_map", lookups.CATEGORY_SCHEMA, lookups.category_map)
    states = w.lookup("state_map", lookups.STATE_SCHEMA, lookups.state_map)
    shops = marts.stage_merchants(w.read("reference", "raw_merchants"), kinds)
    known = lookups.unique_lookup(states, "raw_name")
    homes = marts.stage_residential(w.read("reference", "raw_residential"), known)
    write_table(marts.mart_merchants(shops, layers), w.path("marts", "merchants"))
    write_table(marts.mart_residential(homes, layers), w.path("marts", "residential"))
    summary = marts.district_summary(w.read("marts", "residential"), w.read("marts", "merchants"))
    write_table(summary, w.path("marts", "district_summary"))


def export_references(w: Warehouse) -> None:
    """Reference extracts with the marts' own column names."""
    homes = w.read("marts", "residential").select(
        "osm_id", "h3_index", "latitude", "longitude", "city", F.col("pincode").alias("postcode"), "state"
    )
    shops = w.read("marts", "merchants").select(
        "osm_id", "h3_index", "merchant_name", "latitude", "longitude", "merchant_category",
        "risk_level", "state",
    )
    banks = w.read("reference", "raw_financial").select(
        "osm_id", "h3_index", "kind", "operator", "lat", "lon"
    )
    for name, table in (("residential", homes), ("merchants", shops), ("financial", banks)):
        write_table(table, w.path("references", f"ref_{name}"))


# --- model -------------------------------------------------------------------------------------


def train_model(w: Warehouse) -> None:
    gold = sampling.strat_split(w.read("gold", "transactions"))
    rows = model.training_rows(gold, learned=gold.filter("split = 'train'"))
    fitted = model.train(rows.filter("split = 'train'"))
    fitted.write().overwrite().save(w.path("model", "classifier"))
    write_table(model.feature_spec(w.spark, fitted), w.path("model", "feature_spec"))
    scored = model.predict(fitted, rows.filter("split = 'test'"))
    evaluation.roc_auc(scored).show()
    model.feature_importance(w.spark, fitted).show()


def _scored_gold(w: Warehouse) -> DataFrame:
    """All of gold with its scores: written once, as several audits read it."""
    fitted = PipelineModel.load(w.path("model", "classifier"))
    rows = model.training_rows(w.read("gold", "transactions"))
    model.check_spec(rows, w.read("model", "feature_spec"))
    scored = model.predict(fitted, rows).drop("features", "rawPrediction", "probability")
    return stage(scored, "scored")[0]


def test_model(w: Warehouse) -> None:
    scored = _scored_gold(w)
    for table in (
        evaluation.roc_auc(scored), evaluation.class_report(scored), evaluation.confusion(scored),
        evaluation.pr_thresholds(scored),
    ):
        table.show()


def leakage_audit(w: Warehouse) -> None:
    evaluation.category_overrep(_scored_gold(w)).show()


def attribution(w: Warehouse) -> None:
    """Permutation importance and, by fraud type, path contributions.

    On all frauds and up to 50 000 legitimate payments.
    """
    fitted = PipelineModel.load(w.path("model", "classifier"))
    rows = sampling.balanced_sample(model.training_rows(w.read("gold", "transactions")))
    model.permutation_importance(fitted, rows).orderBy(F.desc("importance")).show()
    parts = model.path_contributions(fitted, rows, keep=("fraud_type",))
    write_table(parts, w.path("model", "contributions"))
    per_type = w.read("model", "contributions")
    evaluation.segment_top_features(per_type, "fraud_type", list(model.FEATURE_SPEC)).show()


# --- live --------------------------------------------------------------------------------------


def publish(w: Warehouse) -> None:
    """Unlabelled events from ``since`` on as JSON lines, and their true labels on the side."""
    tx = w.payments(since=w.since)
    messages = codec.encode_events(projection.unlabeled_projection(tx))
    if w.kafka:
        codec.publish_kafka(messages, w.kafka)
    else:
        codec.publish_files(messages, w.path("live", "events"))
    write_csv(tx.select("transaction_id", "is_fraud"), w.path("live", "ground_truth"))


def score_live(w: Warehouse) -> None:
    """Score what has arrived.

    The state starts from the payments before ``since``, never from those that are published;
    without ``since`` it starts empty. Files are read once, a message topic continuously. The customers' shown
    aggregates are those of the payments before ``since``, in a versioned table that is read anew for
    every micro-batch: a newer version shows in the next one.
    """
    warm = seed.warm_start(w.payments(until=w.since)) if w.since else None
    messages = (
        codec.read_kafka(w.spark, w.kafka) if w.kafka else codec.read_files(w.spark, w.path("live", "events"))
    )
    good, bad = codec.split_quarantine(codec.decode_events(messages))
    features = state.live_features(good, warm)
    known, aggregates = w.read("gold", "transactions"), w.path("live", "customer_agg")
    if w.since:
        known = known.filter(F.col("timestamp") < F.lit(w.since).cast("timestamp"))
    write_version(replay.customer_agg_seed(known), aggregates)
    once = not w.kafka
    fitted = PipelineModel.load(w.path("model", "classifier"))
    live = w.path("live", "")
    running = [
        score.start_quarantine(bad, f"{live}quarantine", f"{live}checkpoint_bad", once),
        score.start_scoring(
            features, f"{live}fraud_scores", f"{live}checkpoint", fitted, once, lambda: read_newest(w.spark, aggregates)
        ),
    ]
    await_all(w.spark, running)


def await_all(spark: SparkSession, running: list) -> None:
    """Wait until every query has ended; when one fails, stop the others and raise its error."""
    try:
        while any(q.isActive for q in running):
            spark.streams.awaitAnyTermination()
            spark.streams.resetTerminated()
        for q in running:
            q.awaitTermination()
    finally:
        for q in running:
            q.stop()


JOBS = {
    f.__name__.replace("_", "-"): f
    for f in (
        ingest, ingest_more, silver_all, silver_core, silver_customer, silver_merchant, silver_sequence,
        silver_campaign, silver_device_ip, silver_network, gold_master, gold_full, gold_validate,
        extract_nodes, map_city_state, normalize_states, parse_districts, map_state_districts,
        compare_city_district, build_marts, export_references, train_model, test_model,
        leakage_audit, attribution, publish, score_live,
    )
}


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="txlens")
    parser.add_argument("job", choices=sorted(JOBS))
    parser.add_argument("--raw", required=True, help="folder with the raw tables")
    parser.add_argument("--warehouse", required=True, help="folder for bronze, silver, gold")
    parser.add_argument("--since", help="publish payments from this time on; score-live starts from those before")
    parser.add_argument("--kafka", help="bootstrap servers; without them the live jobs use files")
    parser.add_argument("--lookups", help="folder with category_map.csv and state_map.csv for build-marts")
    parser.add_argument("--as-of", action="store_true", help="silver features look at earlier payments only")
    args = parser.parse_args(argv)
    spark = build_session()
    JOBS[args.job](
        Warehouse(spark, args.raw, args.warehouse, args.since, args.kafka, args.as_of, args.lookups)
    )


if __name__ == "__main__":
    main()
