"""The query catalogue: one entry per operator, each over whole driver tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.functions import cells, names
from txlens.functions.timeparts import epoch_millis, parse_rfc3339
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
    spatial,
)
from txlens.session import use_utc
from txlens.sources import fixtures as fx
from txlens.sources import landing, lookups
from txlens.sources.tables import scratch, stage, write_csv
from txlens.streaming import codec

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}

# Metro cities of the demo data, amount bins and draw weights used by the queries below.
METRO = ["Mumbai", "New Delhi", "Chennai", "Bengaluru"]
BIN_EDGES = [5.0, 20.0, 60.0, 150.0]
BIN_NAMES = ["micro", "low", "medium", "high", "very_high"]
SUSPICIOUS_RATE = 0.06
WIDE_SECONDS = 6 * 3600
PERIOD = ("2024-01-09 18:30:00", "2024-01-12 06:00:00")
QUANTILES = {"median": 0.5, "p75": 0.75, "p95": 0.95}
FRAUD_MIX = {
    "upi_scam": 0.35,
    "account_takeover": 0.25,
    "velocity_abuse": 0.15,
    "card_not_present": 0.15,
    "friendly_fraud": 0.10,
}
MODEL_SPEC = {
    "amount": "float",
    "card_present": "int",
    "merchant_category": "string",
    "spatial_velocity": "float",
    "suspicious_cluster_member": "int",
}


def settle(df: DataFrame) -> DataFrame:
    """Round doubles to 6 places so that summation order does not show.

    The small shift keeps exact decimal halves (a mean over 32 amounts, say) off the
    rounding edge.
    """
    rounded = {
        f.name: F.round(F.col(f.name) + F.lit(0.0000003), 6)
        for f in df.schema.fields
        if isinstance(f.dataType, T.DoubleType)
    }
    return df.withColumns(rounded) if rounded else df


def query(build: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return settle(build(use_utc(spark), sf_dir))

    run.__doc__ = build.__doc__
    run.__name__ = build.__name__
    QUERIES[build.__name__] = run
    return run


# --- shared inputs ------------------------------------------------------------------


def _sequence(spark, d):
    return sequence.sequence_features(fx.payments(spark, d))


def _silver(spark, d):
    features = sequence.to_silver(_sequence(spark, d))
    return sequence.with_fraud_metadata(features, fx.fraud_metadata(spark, d))


def _customers(spark, d):
    return customer.customer_features(
        fx.payments(spark, d), fx.customers(spark, d), fx.accounts(spark, d)
    )


def _network(spark, d):
    tx = fx.payments(spark, d)
    return entity.network_tx_features(
        tx, entity.ip_reputation(tx), entity.device_reputation(tx), SUSPICIOUS_RATE
    )


def _gold(spark, d):
    tx = fx.payments(spark, d)
    return gold.gold_master(
        _silver(spark, d), customer.customer_activity(tx), entity.merchant_features(tx)
    )


def _classified(spark, d):
    return nodes.classify_nodes(fx.map_nodes(spark, d))


def _staged_merchants(spark, d):
    return marts.stage_merchants(
        nodes.merchant_nodes(_classified(spark, d)), lookups.category_map(spark)
    )


def _staged_residential(spark, d):
    states = lookups.unique_lookup(lookups.state_map(spark), "raw_name")
    return marts.stage_residential(nodes.residential_nodes(_classified(spark, d)), states)


def _layers(spark, d):
    return marts.boundary_layers(fx.state_boundaries(spark, d), fx.district_boundaries(spark, d))


def _mart_merchants(spark, d):
    return marts.mart_merchants(_staged_merchants(spark, d), _layers(spark, d))


def _report(spark, d, **options):
    path = scratch(spark, "report")
    nodes.write_report(nodes.city_state_counts(fx.map_nodes(spark, d)), path)
    return nodes.read_report(spark, path, **options)


def _drawn(spark, d, **options):
    residents = nodes.residential_nodes(_classified(spark, d)).select("osm_id", "h3_index", "state")
    places = marts.locality_places(_staged_merchants(spark, d), **options)
    return marts.draw_merchant(residents, places, **options).drop("h3_index", "state")


def _millis(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: epoch_millis(F.col(c)) for c in columns})


# --- entities -----------------------------------------------------------------------


@query
def merchant_features(spark, d):
    return entity.merchant_features(fx.payments(spark, d))


@query
def category_baselines(spark, d):
    return entity.category_baselines(fx.payments(spark, d))


@query
def device_features(spark, d):
    return entity.device_features(fx.payments(spark, d))


@query
def ip_reputation(spark, d):
    return entity.ip_reputation(fx.payments(spark, d))


@query
def device_reputation(spark, d):
    return entity.device_reputation(fx.payments(spark, d))


@query
def bronze_projection(spark, d):
    columns = ["transaction_id", "customer_id", "merchant_id", "amount", "card_present", "is_fraud"]
    return projection.bronze_projection(
        fx.payments(spark, d), columns, flags=["card_present", "is_fraud"]
    )


@query
def parse_timestamps(spark, d):
    text = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("+05:30"))
    raw = fx.table(spark, d, "events").select("event_id", text.alias("timestamp"))
    parsed = projection.bronze_transactions(raw)
    return parsed.select("event_id", epoch_millis(F.col("timestamp")).alias("ts_ms"))


# --- landing ------------------------------------------------------------------------


@query
def landing_period(spark, d):
    """A period of a landing table written by day and read back."""
    path = scratch(spark, "landing")
    landing.write_by_day(fx.payments(spark, d), path)
    kept = landing.read_landing(spark, path, *PERIOD)
    return _millis(kept.select("transaction_id", "customer_id", "amount", "timestamp"), "timestamp")


@query
def landing_in_parts(spark, d):
    """Three loads, the second twice; the third corrects some payments of the first, a day later."""
    path = scratch(spark, "landing")
    tx = fx.payments(spark, d).select("transaction_id", "customer_id", "amount", "timestamp")
    first, second, third = (tx.filter(F.col("transaction_id") % 3 == n) for n in range(3))
    later = F.col("timestamp") + F.expr("INTERVAL 1 DAY")
    corrected = first.filter(F.col("transaction_id") % 30 == 0).withColumns(
        {"amount": F.col("amount") + 1, "timestamp": later}
    )
    for part in (first, second, second, third.unionByName(corrected)):
        landing.upsert(spark, path, part, "transaction_id")
    return _millis(landing.read_landing(spark, path), "timestamp")


# --- customer, sequence, campaign ----------------------------------------------------


@query
def customer_features(spark, d):
    return _millis(_customers(spark, d), "first_transaction_ts", "last_transaction_ts")


@query
def customer_features_gaps(spark, d):
    """Missing merchants, categories and countries each count as one value."""
    out = customer.customer_features(fx.payments_with_gaps(spark, d), fx.customers(spark, d), fx.accounts(spark, d))
    return _millis(out, "first_transaction_ts", "last_transaction_ts")


@query
def merchant_features_gaps(spark, d):
    """Payments without a merchant form a group of their own."""
    return entity.merchant_features(fx.payments_with_gaps(spark, d))


@query
def campaign_features_gaps(spark, d):
    return campaign.campaign_features(fx.payments_with_gaps(spark, d))


@query
def sequence_features(spark, d):
    return _millis(_sequence(spark, d), "timestamp")


@query
def sequence_features_as_of(spark, d):
    return _millis(sequence.sequence_features(fx.payments(spark, d), as_of=True), "timestamp")


@query
def sequence_with_metadata(spark, d):
    keep = [
        "transaction_id", "customer_id", "transaction_sequence_number", "fraud_target",
        "fraud_type", "geo_anomaly", "device_anomaly", "ip_anomaly", "campaign_id",
    ]
    return sequence.with_fraud_metadata(_sequence(spark, d), fx.fraud_metadata(spark, d)).select(keep)


@query
def campaign_features(spark, d):
    return campaign.campaign_features(fx.payments(spark, d))


# --- gold -----------------------------------------------------------------------------


@query
def gold_master(spark, d):
    return _millis(_gold(spark, d).drop("feature_calculated_at"), "timestamp")


@query
def gold_full(spark, d):
    tx = fx.payments(spark, d)
    out = gold.gold_full(
        tx,
        _silver(spark, d),
        customer.customer_activity(tx),
        entity.merchant_features(tx),
        _network(spark, d),
        campaign.campaign_features(tx),
    )
    return _millis(out.drop("feature_calculated_at"), "timestamp")


def _some_sides(spark, d):
    """Customers known from card payments and merchants known from domestic ones; the others are strangers."""
    tx = fx.payments(spark, d)
    by_card = customer.customer_activity(tx.filter("transaction_channel = 'cards'"))
    return by_card, entity.merchant_features(tx.filter("merchant_country = 'IN'"))


@query
def gold_master_strangers(spark, d):
    """Payments of customers and merchants that have no features yet: their rates become 0."""
    return _millis(gold.gold_master(_silver(spark, d), *_some_sides(spark, d)).drop("feature_calculated_at"), "timestamp")


@query
def gold_full_strangers(spark, d):
    """The same in the full form: rates stay null, network and campaign figures become 0."""
    tx = fx.payments(spark, d)
    known = _network(spark, d).join(tx.filter("card_present = 1").select("transaction_id"), "transaction_id")
    out = gold.gold_full(
        tx, _silver(spark, d), *_some_sides(spark, d), known, campaign.campaign_features(tx)
    )
    return _millis(out.drop("feature_calculated_at"), "timestamp")


@query
def gold_wide(spark, d):
    tx = fx.payments(spark, d)
    out = gold.gold_master_wide(
        tx.select("transaction_id", "customer_id", "merchant_id", "user_agent", "amount"),
        _sequence(spark, d).select("transaction_id", "spatial_velocity"),
        campaign.campaign_features(tx),
        customer.customer_activity(tx).select("customer_id", "fraud_rate", "total_transactions"),
        entity.merchant_features(tx).select("merchant_id", "merchant_fraud_rate"),
        entity.device_features(tx).select("user_agent", "device_fraud_rate"),
        entity.network_customer_rollup(_network(spark, d)),
    )
    return out.drop("feature_calculated_at")


@query
def gold_validate(spark, d):
    tx = fx.payments(spark, d)
    checked = tx.join(entity.ip_reputation(tx), "ip_address", "left").join(
        entity.device_reputation(tx), "user_agent", "left"
    )
    return gold.gold_validate(checked)


@query
def network_tx_features(spark, d):
    return _network(spark, d)


@query
def network_customer_rollup(spark, d):
    return entity.network_customer_rollup(_network(spark, d))


# --- geography --------------------------------------------------------------------------


@query
def normalize_city(spark, d):
    city = names.normalize_city(F.col("tags")["addr:city"])
    return fx.map_nodes(spark, d).select("id", city.alias("city"))


@query
def normalize_state(spark, d):
    raw = fx.map_nodes(spark, d).select("id", F.col("tags")["addr:state"].alias("raw"))
    return nodes.normalize_state(raw, "raw", "state").select("id", "state")


@query
def title_words(spark, d):
    return fx.table(spark, d, "part").select(
        "p_partkey", names.title_words(F.concat(F.lit("  mcX  "), "p_name", F.lit(" of"))).alias("title")
    )


@query
def clean_pincode(spark, d):
    code = names.clean_pincode(F.col("tags")["addr:postcode"])
    return fx.map_nodes(spark, d).select("id", code.alias("pincode"))


@query
def stg_category_map(spark, d):
    return _staged_merchants(spark, d)


@query
def stg_state_map(spark, d):
    return _staged_residential(spark, d)


@query
def stg_state_map_repeated_key(spark, d):
    """The lookup as given: nodes of a state listed twice appear twice."""
    residential = nodes.residential_nodes(_classified(spark, d))
    staged = marts.stage_residential(residential, lookups.state_map(spark))
    return staged.select("osm_id", "state_standardized")


@query
def mcc_enrich(spark, d):
    return marts.mcc_enrich(_staged_merchants(spark, d)).select("osm_id", "merchant_category", "mcc")


@query
def classify_nodes(spark, d):
    role = F.col("role")
    return nodes.node_roles(_classified(spark, d)).select(
        F.col("osm_id").alias("id"),
        "role",
        F.when(role == "merchant", F.col("category")).alias("category"),
        F.when(role == "merchant", F.col("sub_category"))
        .when(role == "financial", F.col("kind"))
        .alias("sub_category"),
        F.when(role == "merchant", F.col("name"))
        .when(role == "financial", F.col("operator"))
        .alias("label"),
    )


@query
def financial_nodes(spark, d):
    return nodes.financial_nodes(_classified(spark, d))


@query
def city_state_counts(spark, d):
    return nodes.report_order(nodes.city_state_counts(fx.map_nodes(spark, d)))


@query
def city_state_totals(spark, d):
    return nodes.state_totals(nodes.city_state_counts(fx.map_nodes(spark, d)))


@query
def city_state_clean(spark, d):
    return nodes.city_state_clean(nodes.city_state_counts(fx.map_nodes(spark, d)))


@query
def city_state_report(spark, d):
    """The counts written as a text report and read back, headings carried to their lines."""
    return _report(spark, d)


@query
def state_districts(spark, d):
    return nodes.state_districts(fx.map_relations(spark, d))


@query
def relation_districts(spark, d):
    return nodes.relation_districts(fx.map_relations(spark, d))


@query
def city_district_intersect(spark, d):
    cities = nodes.city_state_clean(nodes.city_state_counts(fx.map_nodes(spark, d)))
    return nodes.city_district_intersect(cities, nodes.state_districts(fx.map_relations(spark, d)))


@query
def lookup_from_csv(spark, d):
    """Customers by region over a list of nations kept as CSV, written by one job and read by another."""
    listed = fx.table(spark, d, "nation").join(fx.table(spark, d, "region"), F.expr("n_regionkey = r_regionkey"))
    names = listed.select(F.concat(F.lit(" "), F.lower("n_name")).alias("name"), F.col("r_name").alias("region"))
    path = scratch(spark, "nations")
    write_csv(names.unionByName(listed.select(F.col("n_name").alias("name"), F.col("r_name").alias("region"))), path)
    known = lookups.unique_lookup(lookups.read_lookup(spark, path, "name string, region string"), "name")
    nations = fx.table(spark, d, "nation").select("n_nationkey", F.upper("n_name").alias("name"))
    homes = fx.table(spark, d, "customer").select(F.col("c_nationkey").alias("n_nationkey"))
    return homes.join(nations, "n_nationkey").join(known, "name").groupBy("region").agg(F.count(F.lit(1)).alias("customers"))


@query
def cell_parent(spark, d):
    h3 = F.col("h3_index")
    return fx.map_nodes(spark, d).select(
        "id", "h3_index", *[cells.cell_parent(h3, r).alias(f"cell{r}") for r in (6, 4)]
    )


@query
def node_cells(spark, d):
    """Nodes that come without a cell id get the square cell of their coordinates, and its parents."""
    found = nodes.classify_nodes(fx.map_nodes(spark, d).drop("h3_index"))
    h3 = F.col("h3_index")
    return found.select("osm_id", "h3_index", *[cells.cell_parent(h3, r).alias(f"cell{r}") for r in (6, 4)])


@query
def grid_cell(spark, d):
    lat, lon = F.col("location_lat"), F.col("location_long")
    return fx.payments(spark, d).select(
        "transaction_id", cells.grid_cell(lat, lon, 8).alias("grid8"), cells.grid_cell(lat, lon, 5).alias("grid5")
    )


@query
def locality_index(spark, d):
    return marts.locality_index(_staged_merchants(spark, d))


@query
def locality_match(spark, d):
    residents = nodes.residential_nodes(_classified(spark, d)).select("osm_id", "h3_index", "state")
    index = marts.locality_index(_staged_merchants(spark, d))
    return marts.locality_match(residents, index).drop("h3_index", "state")


@query
def merchant_draw(spark, d):
    return _drawn(spark, d)


@query
def location_type(spark, d):
    city = F.trim(F.col("tags")["addr:city"])
    given = F.element_at(F.array(F.lit("Rural"), F.lit("Suburban")), (F.col("id") % 2 + 1).cast("int"))
    return fx.map_nodes(spark, d).select(
        "id", names.location_type(city, given, METRO).alias("location_type")
    )


@query
def address_line(spark, d):
    tag = F.col("tags")
    line = names.address_line(
        F.col("id").cast("string"), F.lit("MG Road"), tag["addr:city"],
        F.coalesce(tag["addr:state"], F.lit("Unknown")), tag["addr:postcode"],
    )
    return fx.map_nodes(spark, d).select("id", line.alias("location"))


@query
def spatial_join(spark, d):
    points = fx.payments(spark, d).select("transaction_id", "location_lat", "location_long")
    states = fx.state_boundaries(spark, d).withColumnRenamed("st_nm", "state")
    districts = fx.district_boundaries(spark, d).drop("st_nm")
    for layer in (states, districts):
        points = spatial.spatial_join(
            points, spatial.shape_index(layer), lat="location_lat", lon="location_long"
        )
    return points


@query
def mart_merchants(spark, d):
    return _mart_merchants(spark, d)


@query
def mart_residential(spark, d):
    return marts.mart_residential(_staged_residential(spark, d), _layers(spark, d))


@query
def district_summary(spark, d):
    layers = _layers(spark, d)
    out = marts.district_summary(
        marts.mart_residential(_staged_residential(spark, d), layers),
        marts.mart_merchants(_staged_merchants(spark, d), layers),
    )
    ratio = F.col("merchant_to_residential_ratio").cast("double")
    return out.withColumn("merchant_to_residential_ratio", ratio)


@query
def export_refs(spark, d):
    return _mart_merchants(spark, d).select(
        "osm_id", "h3_index", "merchant_name", "latitude", "longitude", "merchant_category", "risk_level"
    )


# --- evaluation ---------------------------------------------------------------------------


@query
def strat_split(spark, d):
    return sampling.strat_split(fx.payments(spark, d)).select("transaction_id", "is_fraud", "split")


@query
def strat_split_exact(spark, d):
    return sampling.exact_split(fx.payments(spark, d)).select("transaction_id", "is_fraud", "split")


@query
def oot_split(spark, d):
    return sampling.oot_split(fx.payments(spark, d)).select("transaction_id", "split")


@query
def class_weight(spark, d):
    return evaluation.class_weight(fx.payments(spark, d))


@query
def roc_auc(spark, d):
    return evaluation.roc_auc(fx.scores(spark, d))


@query
def confusion(spark, d):
    return evaluation.confusion(fx.scores(spark, d))


@query
def class_report(spark, d):
    return evaluation.class_report(fx.scores(spark, d))


@query
def pr_curve(spark, d):
    return evaluation.pr_curve(fx.scores(spark, d))


@query
def pr_thresholds(spark, d):
    return evaluation.pr_thresholds(fx.scores(spark, d))


@query
def category_overrep(spark, d):
    return evaluation.category_overrep(fx.scores(spark, d))


@query
def amount_profile(spark, d):
    return evaluation.amount_profile(fx.payments(spark, d))


@query
def amount_sketches(spark, d):
    """Sketches per label and day, merged per label: whether the true ranks keep the stated error."""
    tx = fx.payments(spark, d).withColumn("day", F.to_date("timestamp"))
    daily = evaluation.amount_sketches(tx, ["is_fraud", "day"])
    found = evaluation.sketch_quantiles(evaluation.merge_sketches(daily, ["is_fraud"]), QUANTILES)
    off = evaluation.rank_errors(tx, found, "is_fraud", QUANTILES).withColumnsRenamed({n: f"{n}_off" for n in QUANTILES})
    allowed = evaluation.SKETCH_ERROR + 1 / F.col("payments")
    fits = [(F.col(f"{n}_off") <= allowed).cast("int").alias(f"{n}_fits") for n in QUANTILES]
    return found.join(off, "is_fraud").select("is_fraud", "payments", *fits)


@query
def amount_bins(spark, d):
    rows = fx.payments(spark, d).select("transaction_id", "amount")
    return evaluation.amount_bins(rows, BIN_EDGES, BIN_NAMES)


@query
def operating_mode(spark, d):
    return evaluation.operating_mode(fx.scores(spark, d).select("transaction_id", "score"))


@query
def balanced_sample(spark, d):
    rows = fx.payments(spark, d).select("transaction_id", "is_fraud", "amount")
    return sampling.balanced_sample(rows, negatives=500)


@query
def segment_top_features(spark, d):
    features = ["time_since_last_transaction", "spatial_velocity", "hour_deviation_from_norm",
                "amount_deviation_z_score"]
    return evaluation.segment_top_features(_silver(spark, d), "fraud_type", features)


@query
def score_vs_truth(spark, d):
    scored = fx.scores(spark, d).select("transaction_id", "score")
    truth = fx.fraud_metadata(spark, d).select("transaction_id", "fraud_target")
    return evaluation.score_vs_truth(scored, truth)


@query
def operational_features(spark, d):
    return projection.operational_features(_gold(spark, d))


@query
def score_flag(spark, d):
    scored = fx.scores(spark, d).select("transaction_id", F.col("score").alias("fraud_probability"))
    return evaluation.score_flag(scored)


# --- sampling, cards ------------------------------------------------------------------------


@query
def weighted_draw(spark, d):
    rows = fx.payments(spark, d).select("transaction_id")
    return sampling.weighted_draw(rows, FRAUD_MIX, into="fraud_type")


@query
def label_noise(spark, d):
    rows = fx.payments(spark, d).select("transaction_id", F.col("is_fraud").alias("fraud_target"))
    return sampling.label_noise(rows)


@query
def card_status(spark, d):
    issued = fx.accounts(spark, d).select(
        F.col("account_id").alias("card_id"), F.col("creation_date").alias("issue_date")
    )
    out = cards.card_status(issued, F.lit("2001-06-30").cast("date"))
    return out.withColumns(
        {c: F.date_format(c, "yyyy-MM-dd") for c in ("issue_date", "activation_date", "expiry_date")}
    )


@query
def registration_parts(spark, d):
    rows = fx.accounts(spark, d).select(
        "account_id", F.col("creation_date").cast("string").alias("registration_date")
    )
    return cards.registration_parts(rows).drop("registration_date")


@query
def union_parts(spark, d):
    tx = fx.payments(spark, d).select("transaction_id", "customer_id", "amount")
    low, high = tx.filter("amount <= 20"), tx.filter("amount > 20")
    return sampling.union_parts(low, high)


# --- live features, replayed ------------------------------------------------------------------


@query
def stream_zscore(spark, d):
    return replay.stream_zscore(fx.payments(spark, d))


@query
def stream_card_features(spark, d):
    return replay.stream_card_features(fx.payments(spark, d))


@query
def stream_burst(spark, d):
    return replay.stream_burst(fx.payments(spark, d))


@query
def stream_burst_wide(spark, d):
    """The same count over six hours, where cards do repeat."""
    return replay.stream_burst(fx.payments(spark, d), seconds=WIDE_SECONDS)


@query
def card_history(spark, d):
    return _millis(replay.card_history(fx.payments(spark, d)), "timestamp")


@query
def card_last_state(spark, d):
    return _millis(replay.card_last_state(fx.payments(spark, d)), "last_ts")


@query
def welford_seed(spark, d):
    return replay.welford_seed(fx.payments(spark, d))


@query
def customer_agg_seed(spark, d):
    return replay.customer_agg_seed(_gold(spark, d))


@query
def merchant_agg_seed(spark, d):
    return replay.merchant_agg_seed(fx.payments(spark, d))


@query
def unlabeled_projection(spark, d):
    return _millis(projection.unlabeled_projection(fx.payments(spark, d)), "timestamp")


@query
def align_features(spark, d):
    rows = fx.payments(spark, d).select(
        "transaction_id", "merchant_category", "amount", "card_present", "customer_id"
    )
    out = projection.align_features(rows, MODEL_SPEC, keep=("transaction_id",))
    return out.withColumn("amount", F.col("amount").cast("double"))


def _messages(spark, d):
    return codec.encode_events(projection.unlabeled_projection(fx.payments(spark, d)))


@query
def event_json_encode(spark, d):
    """Published messages, read back field by field."""
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return _messages(spark, d).select(
        "key",
        field("customer_id").cast("bigint").alias("customer_id"),
        field("amount").cast("double").alias("amount"),
        field("merchant_category").alias("merchant_category"),
        epoch_millis(parse_rfc3339(field("timestamp"))).alias("ts_ms"),
        field("is_fraud").alias("is_fraud"),
    )


@query
def event_json_decode(spark, d):
    """Messages decoded with the fixed schema; every 13th is damaged and goes to quarantine."""
    damaged = F.when(
        F.col("key").cast("bigint") % 13 == 0, F.concat(F.lit("#"), "value")
    ).otherwise(F.col("value"))
    decoded = codec.decode_events(_messages(spark, d).withColumn("value", damaged))
    return decoded.select(
        F.col("key").alias("message_key"),
        "transaction_id",
        "card_id",
        "amount",
        epoch_millis(F.col("timestamp")).alias("ts_ms"),
        F.col("_bad").cast("int").alias("bad"),
    )


# --- model ------------------------------------------------------------------------------------


def _split_gold(spark, d):
    """Training and hold-out rows. The features are stored: weights, levels, bins and scores each read them anew."""
    features, _ = stage(_gold(spark, d).select("transaction_id", "is_fraud", *model.FEATURE_SPEC), "features")
    rows = sampling.strat_split(model.training_rows(features))
    return rows.filter("split = 'train'"), rows.filter("split = 'test'")


@query
def train_gbt(spark, d):
    """Hold-out AUC and the ten most important features of the trained classifier."""
    train, test = _split_gold(spark, d)
    fitted = model.train(train)
    auc = evaluation.roc_auc(model.predict(fitted, test)).select(
        F.lit("holdout_auc").alias("name"), F.col("auc").alias("value")
    )
    gains = model.feature_importance(spark, fitted).select(
        F.concat(F.lit("importance:"), "feature").alias("name"), F.col("importance").alias("value")
    )
    return auc.unionByName(gains)


@query
def path_contributions(spark, d):
    """Hold-out payments whose contributions and base add up to the classifier's margin."""
    train, test = _split_gold(spark, d)
    parts = model.path_contributions(model.train(train, trees=8, depth=4), test)
    total = reduce(Column.__add__, [F.col(n) for n in model.FEATURE_SPEC], F.col("base"))
    exact = F.min((F.abs(total - F.col("margin")) < 1e-6).cast("int"))
    return parts.agg(F.count(F.lit(1)).alias("payments"), exact.alias("exact"))


@query
def feature_spec(spark, d):
    """The spec stored with a classifier: types, and the category levels by falling frequency."""
    train, _ = _split_gold(spark, d)
    spec = model.feature_spec(spark, model.train(train, trees=1, depth=1))
    return spec.select("feature", "type", F.array_join("levels", ",").alias("levels"))


@query
def model_checks(spark, d):
    """What must hold for any training run: a useful hold-out AUC, importances that sum to 1."""
    train, test = _split_gold(spark, d)
    fitted = model.train(train, trees=8, depth=4)
    auc = evaluation.roc_auc(model.predict(fitted, test)).select(
        F.lit("auc_above_0.9").alias("name"), (F.col("auc") > 0.9).cast("int").alias("holds")
    )
    gains = model.feature_importance(spark, fitted, top=len(model.FEATURE_SPEC))
    whole = gains.agg((F.abs(F.sum("importance") - 1) < 1e-6).cast("int").alias("holds"))
    return auc.unionByName(whole.select(F.lit("importances_sum_to_1").alias("name"), "holds"))


@query
def perm_importance(spark, d):
    """AUC lost per permuted feature on the hold-out rows, for a smaller model."""
    train, test = _split_gold(spark, d)
    return model.permutation_importance(model.train(train, trees=20, depth=4), test)


# --- the same queries with keys split from a few rows on ---------------------------------

FEW = 12


def sliced(build: Query) -> Query:
    """Register ``build`` as the small-switch form of the query it is named after."""
    build.__name__ = f"{build.__name__}_sliced"
    return query(build)


def _gold_sliced(spark, d):
    tx = fx.payments(spark, d)
    return gold.gold_master(
        _silver(spark, d), customer.customer_activity(tx), entity.merchant_features(tx), max_key_rows=FEW
    )


_sliced_forms = {
    "sequence_features": lambda s, d: _millis(
        sequence.sequence_features(fx.payments(s, d), max_key_rows=FEW), "timestamp"
    ),
    "sequence_features_as_of": lambda s, d: _millis(
        sequence.sequence_features(fx.payments(s, d), as_of=True, max_key_rows=FEW), "timestamp"
    ),
    "campaign_features": lambda s, d: campaign.campaign_features(fx.payments(s, d), max_key_rows=FEW),
    "gold_master": lambda s, d: _millis(_gold_sliced(s, d).drop("feature_calculated_at"), "timestamp"),
    "roc_auc": lambda s, d: evaluation.roc_auc(fx.scores(s, d), max_key_rows=50),
    "pr_curve": lambda s, d: evaluation.pr_curve(fx.scores(s, d), max_key_rows=50),
    "amount_profile": lambda s, d: evaluation.amount_profile(fx.payments(s, d), max_key_rows=50),
    "stream_zscore": lambda s, d: replay.stream_zscore(fx.payments(s, d), max_key_rows=FEW),
    "stream_card_features": lambda s, d: replay.stream_card_features(fx.payments(s, d), max_key_rows=FEW),
    "stream_burst": lambda s, d: replay.stream_burst(fx.payments(s, d), max_key_rows=FEW),
    "strat_split_exact": lambda s, d: sampling.exact_split(fx.payments(s, d), max_key_rows=1).select(
        "transaction_id", "is_fraud", "split"
    ),
    "city_state_report": lambda s, d: _report(s, d, max_key_rows=7),
    "merchant_draw": lambda s, d: _drawn(s, d, max_key_rows=50),
    "locality_match": lambda s, d: marts.locality_match(
        nodes.residential_nodes(_classified(s, d)).select("osm_id", "h3_index", "state"),
        marts.locality_index(_staged_merchants(s, d)),
        max_key_rows=50,
    ).drop("h3_index", "state"),
}
for _name, _build in _sliced_forms.items():
    _build.__name__ = _name
    sliced(_build)
SLICED = tuple(_sliced_forms)
