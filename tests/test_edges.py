"""Hand-computed rules the driver data cannot exercise."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from txlens.functions import cells, names, numeric, timeparts
from txlens.operators import campaign, customer, entity, evaluation, gold, marts, nodes, projection
from txlens.operators import replay, sampling, sequence, spatial
from txlens.sources import lookups

TX_SCHEMA = (
    "transaction_id long, customer_id string, card_id string, merchant_id string,"
    " merchant_category string, amount double, timestamp timestamp, location_lat double,"
    " location_long double, is_fraud int"
)
MONDAY = dt.datetime(2024, 1, 1, 12, tzinfo=dt.timezone.utc)


def payments(spark, rows):
    """rows: (customer, ms after Monday noon, amount, category, lat)."""
    data = [
        (i, c, c, "m", cat, float(a), MONDAY + dt.timedelta(milliseconds=ms), lat, 0.0, 1)
        for i, (c, ms, a, cat, lat) in enumerate(rows)
    ]
    return spark.createDataFrame(data, TX_SCHEMA)


def by_id(df, *columns):
    return [tuple(r) for r in df.orderBy("transaction_id").select(*columns).collect()]


def test_single_payment(spark):
    out = sequence.sequence_features(payments(spark, [("a", 0, 7.5, "x", 1.0)]))
    row = out.first()
    assert row.time_since_last_transaction is None and row.amount_deviation_z_score is None
    assert row.escalating_amounts_flag is None
    assert row.spatial_velocity == 0 and row.transaction_sequence_number == 1
    silver = sequence.to_silver(out).first()
    assert silver.time_since_last_transaction == 0 and silver.escalating_amounts_flag == 0


def test_zero_gap_velocity(spark):
    tx = payments(spark, [("a", 0, 1, "x", 1.0), ("a", 0, 1, "x", 1.0), ("a", 0, 1, "x", 2.0)])
    out = by_id(sequence.sequence_features(tx), "spatial_velocity", "amount_deviation_z_score")
    assert out == [(0.0, 0.0), (0.0, 0.0), (10000.0, 0.0)]


def test_velocity_cap_and_gap(spark):
    tx = payments(spark, [("a", 0, 1, "x", 0.0), ("a", 3_600_000, 2, "x", 1.0), ("a", 3_600_001, 3, "x", 2.0)])
    out = by_id(sequence.sequence_features(tx), "spatial_velocity", "time_since_last_transaction")
    assert out == [(0.0, None), (111.0, 3600.0), (10000.0, 0.001)]


def test_rapid_fire_limit_and_escalation(spark):
    tx = payments(
        spark,
        [("a", 0, 1, "x", 0.0), ("a", 300_000, 2, None, 0.0), ("a", 600_001, 3, "y", 0.0), ("a", 600_002, 3, "z", 0.0)],
    )
    out = by_id(
        sequence.sequence_features(tx),
        "rapid_fire_transaction_flag", "escalating_amounts_flag", "merchant_category_switch_flag",
    )
    assert out == [(0, None, 0), (1, None, None), (0, 1, 0), (1, 0, 1)]


def test_escalation_second_row_false_when_not_rising(spark):
    tx = payments(spark, [("a", 0, 5, "x", 0.0), ("a", 1, 4, "x", 0.0)])
    assert by_id(sequence.sequence_features(tx), "escalating_amounts_flag") == [(None,), (0,)]


def test_round_amounts(spark):
    tx = payments(spark, [("a", 0, 5, "x", 0.0), ("a", 1, 7, "x", 0.0), ("a", 2, 7.25, "x", 0.0)])
    assert by_id(sequence.sequence_features(tx), "amount_round_number_flag") == [(1,), (1,), (0,)]


def test_night_and_weekend(spark):
    stamps = ["2024-01-05 21:59:00", "2024-01-05 22:00:00", "2024-01-06 05:59:00", "2024-01-07 06:00:00",
              "2024-01-08 00:00:00"]  # Friday to Monday
    df = spark.createDataFrame([(s,) for s in stamps], "s string").select(F.col("s").cast("timestamp").alias("t"))
    out = df.select(timeparts.is_night(F.col("t")), timeparts.is_weekend(F.col("t"))).collect()
    assert [tuple(r) for r in out] == [(0, 0), (1, 0), (1, 1), (0, 1), (1, 0)]


def test_campaign_gap_boundary(spark):
    day2 = campaign.CAMPAIGN_GAP_MS
    tx = payments(
        spark,
        [("a", 0, 1, "x", 0.0), ("b", 5, 9, "x", 0.0), ("a", day2, 2, "x", 0.0), ("a", 2 * day2 + 1, 4, "x", 0.0)],
    )
    out = by_id(campaign.campaign_features(tx), "campaign_id", "campaign_txn_count", "campaign_total_amount")
    assert out == [("a-1", 2, 3.0), ("b-1", 1, 9.0), ("a-1", 2, 3.0), ("a-2", 1, 4.0)]


def test_unique_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", "x"), ("a", None), ("b", None), ("c", "x"), ("c", "x")], "k string, v string")
    out = df.groupBy("k").agg(numeric.n_unique("v").alias("n")).orderBy("k").collect()
    assert [r.n for r in out] == [2, 1, 1]


def test_range_text(spark):
    df = spark.createDataFrame([("1.5_to_4.0", "12"), ("x_to_2", "a")], "r string, n string")
    row = df.select(numeric.range_bounds(F.col("r"), 0.8, 1.2).alias("b"), numeric.int_or_zero(F.col("n")).alias("n"))
    assert [(r.b.low, r.b.high, r.n) for r in row.collect()] == [(1.5, 4.0, 12), (0.8, 2.0, 0)]


def test_cells_of_coordinates(spark):
    """A known cell id is kept, a missing one comes from the coordinates; parents are prefixes."""
    rows = [(1, 12.9, 77.6, "88618925c1fffff"), (2, 12.9, 77.6, None), (3, 12.9001, 77.6001, None), (4, 90.0, 180.0, None)]
    found = nodes.classify_nodes(
        spark.createDataFrame(rows, "id long, lat double, lon double, h3_index string").withColumn(
            "tags", F.create_map(F.lit("shop"), F.lit("books"))
        )
    )
    h3 = F.col("h3_index")
    out = {r.osm_id: r for r in found.select("osm_id", "h3_index", cells.cell_parent(h3, 4).alias("up")).collect()}
    assert out[1].h3_index == "88618925c1fffff" and out[1].up == "8461893ffffffff"
    assert out[2].h3_index == out[3].h3_index and len(out[2].h3_index) == 16
    assert out[2].up == out[2].h3_index[:10] and out[4].h3_index == "q" + "3" * 15
    null = spark.range(1).select(cells.location_cell(F.lit(None).cast("double"), F.lit(1.0)).alias("c"))
    assert null.first().c is None


def test_rows_without_a_time_are_in_neither_part(spark):
    rows = spark.sql("SELECT id, IF(id = 5, NULL, timestamp_seconds(id)) AS timestamp FROM range(9)")
    split = {r.id: r.split for r in sampling.oot_split(rows, 0.5).collect()}
    assert [split[i] for i in range(9)] == ["train"] * 4 + ["test", None] + ["test"] * 3


def test_scaled_amount_limits(spark):
    df = spark.createDataFrame([(100.0,), (0.5,), (9e5,)], "a double")
    out = df.select(numeric.scaled_amount(F.col("a"), F.lit(1.5))).collect()
    assert [r[0] for r in out] == [150.0, 1.0, 500000.0]


def test_empty_table(spark):
    tx = payments(spark, [("a", 0, 1, "x", 0.0)]).filter("false")
    assert sequence.sequence_features(tx).count() == 0
    assert campaign.campaign_features(tx).count() == 0
    assert entity.merchant_features(tx).count() == 0


def test_merchant_profile(spark):
    tx = payments(spark, [("a", 0, 1, "x", 0.0), ("b", 1, 2, "y", 0.0)])
    row = entity.merchant_features(tx.withColumn("merchant_name", F.lit("Shop")), with_profile=True).first()
    assert (row.total_amount, row.merchant_name, row.merchant_category) == (3.0, "Shop", "y")
    assert (row.unique_customers_count, row.merchant_fraud_rate) == (2, 1.0)


def test_customers_without_payments(spark):
    people = spark.createDataFrame([("a",), ("z",)], "customer_id string")
    accounts = spark.createDataFrame([("1", "a"), ("2", "a")], "account_id string, customer_id string")
    tx = payments(spark, [("a", 0, 1, "x", 0.0)]).withColumn("merchant_country", F.lit("IN"))
    a, z = customer.customer_features(tx, people, accounts).orderBy("customer_id").collect()
    assert (a.account_count, a.total_transactions, a.std_transaction_amount) == (2, 1, None)
    assert (z.account_count, z.total_transactions, z.fraud_rate) == (0, 0, 0.0)
    assert z.night_transaction_ratio is None


def test_gold_fills_unmatched_and_ignores_repeated_entities(spark):
    tx = payments(spark, [("a", 0, 1, "x", 0.0), ("b", 1, 1, "x", 0.0)])
    silver = sequence.to_silver(sequence.sequence_features(tx))
    side = spark.createDataFrame(
        [("a", 0.5, 0.25), ("a", 0.5, 0.25)], "customer_id string, fraud_rate double, night_transaction_ratio double"
    )
    shops = spark.createDataFrame([("other", 0.5)], "merchant_id string, merchant_fraud_rate double")
    out = by_id(gold.gold_master(silver, side, shops), "cf_fraud_rate", "cf_night_tx_ratio", "mf_fraud_rate")
    assert out == [(0.5, 0.25, 0.0), (0.0, 0.0, 0.0)]


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("Pune India", "PUNE"), ("Secunderabad-26", "SECUNDERABAD"), ("X, Y", "X"), (None, None),
        ("navi mumbai maharashtra", "NAVI MUMBAI"), ("PUNE", "PUNE"), ("a-b,c", "A"), (" x ", "X"),
    ],
)
def test_city(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "c string")
    assert df.select(names.normalize_city(F.col("c"))).first()[0] == clean


@pytest.mark.parametrize(
    "raw, clean",
    [
        ("AP", "Andhra Pradesh"), ("delhi-nct", "Delhi"), ("j and k", "Jammu and Kashmir"),
        ("தமிழ்நாடு", "Tamil Nadu"), ("daman and diu", "Dadra and Nagar Haveli and Daman and Diu"),
        ("some  new   state", "Some New State"), ("mcDonald land", "McDonald Land"), ("", ""),
    ],
)
def test_state_names(spark, raw, clean):
    df = spark.createDataFrame([(raw,)], "s string")
    assert nodes.normalize_state(df, "s", "out").first()["out"] == clean


def test_alias_table_size():
    assert len(lookups.STATE_ALIASES) == 35
    assert len(lookups.csv_rows(lookups.CATEGORY_MAP)) == 100
    assert len(lookups.csv_rows(lookups.STATE_MAP)) == 82


def test_pincode(spark):
    df = spark.createDataFrame([("560 001",), (None,), ("PIN-4x",)], "p string")
    out = df.select(names.clean_pincode(F.col("p"))).collect()
    assert [r[0] for r in out] == ["560001", None, "4"]


def test_state_lookup(spark):
    raw = spark.createDataFrame(
        [(1, " punjab "), (2, "Punjab, India"), (3, "nowhere"), (4, None)], "osm_id int, state string"
    ).selectExpr("osm_id", "'h' AS h3_index", "0d AS lat", "0d AS lon", "'c' AS city", "'p' AS postcode", "state")
    states = lookups.state_map(spark)

    def result(table):
        rows = marts.stage_residential(raw, table).orderBy("osm_id").collect()
        return [(r.osm_id, r.state_standardized) for r in rows]

    unique = lookups.unique_lookup(states, "raw_name")
    assert result(unique) == [(1, "Punjab"), (2, "Punjab"), (3, "nowhere"), (4, "Unknown")]
    assert [i for i, _ in result(states)] == [1, 1, 2, 3, 4]


def node(i, lat=10.0, **tags):
    return (i, lat, 70.0, {k.replace("__", ":"): v for k, v in tags.items()}, "h")


def test_node_roles(spark):
    rows = [
        node(1, shop="books"), node(2, amenity="atm", shop="car"), node(3, amenity="atm"),
        node(4, amenity="restaurant"), node(5, amenity="school", tourism="hotel"),
        node(6, tourism="motel"), node(7, building="residential", addr__street="s"),
        node(8, shop="yes", addr__housenumber="1"), node(9, lat=95.0, shop="books"),
        node(10, addr__street="s"), node(11, building="yes"),
    ]
    df = spark.createDataFrame(rows, "id long, lat double, lon double, tags map<string,string>, h3_index string")
    roles = nodes.node_roles(nodes.classify_nodes(df)).select("osm_id", "role").collect()
    assert sorted((r.osm_id, r.role) for r in roles) == [
        (1, "merchant"), (2, "financial"), (2, "merchant"), (3, "financial"), (4, "merchant"),
        (6, "merchant"), (7, "residential"), (8, "merchant"), (10, "residential"),
    ]


def test_districts(spark):
    base = {"boundary": "administrative", "admin_level": "5"}
    four = {"boundary": "administrative", "admin_level": "4", "ISO3166-2": "IN-KA"}
    rows = [
        (1, base | {"name": "A", "ISO3166-2": "IN-KA"}, []),
        (2, base | {"name": "B", "ISO3166-2": "IN-KA-X"}, []),
        (3, base | {"ref:LGD:1": "5"}, []),
        (4, base | {"name": "D", "mdds:code": "1", "addr:state": "Goa"}, []),
        (5, base | {"name": "E", "is_in:state": "Bihar"}, []),
        (6, base | {"name": "F"}, []),
        (7, base | {"name:en": "G", "addr:country": "IN", "ISO3166-2": "plain"}, []),
        (20, four | {"name": "Zeta"}, [("relation", 1), ("relation", 2), ("node", 5)]),
        (21, four | {"name": "Alpha"}, [("relation", 2), ("relation", 99)]),
    ]
    schema = "id long, tags map<string,string>, members array<struct<type:string,ref:bigint>>"
    df = spark.createDataFrame(rows, schema)
    tags = {(r.state, r.district) for r in nodes.state_districts(df).collect()}
    assert tags == {
        ("IN-KA", "A"), ("IN-KA", "B"), ("Unknown State", "Unnamed District"), ("Goa", "D"),
        ("Bihar", "E"), ("Unknown State", "G"),
    }
    members = {(r.state, r.district) for r in nodes.relation_districts(df).collect()}
    assert members == {("Zeta", "A"), ("Alpha", "B")}


def ring(*points):
    return [{"lon": float(x), "lat": float(y)} for x, y in points]


SQUARE = ring((0, 0), (4, 0), (4, 4), (0, 4), (0, 0))
HOLE = ring((1, 1), (2, 1), (2, 2), (1, 2))
ISLAND = ring((10, 0), (11, 0), (11, 1), (10, 1), (10, 0))
NEXT_DOOR = ring((4, 0), (8, 0), (8, 4), (4, 4), (4, 0))


@pytest.mark.parametrize("size", [0.5, 3.0])
@pytest.mark.parametrize(
    "x, y, inside",
    [
        (3.0, 3.0, {"a"}), (1.5, 1.5, set()), (0.0, 2.0, {"a"}), (0.0, 0.0, {"a"}),
        (1.0, 1.5, {"a"}), (4.0, 2.0, {"a", "b"}), (10.5, 0.5, {"a"}), (9.0, 0.5, set()),
        (-0.1, 0.0, set()), (6.0, 2.0, {"b"}),
    ],
)
def test_point_in_polygon(spark, size, x, y, inside):
    schema = "name string, rings array<array<struct<lon:double,lat:double>>>"
    shapes = spark.createDataFrame([("a", [SQUARE, HOLE, ISLAND]), ("b", [NEXT_DOOR])], schema)
    point = spark.createDataFrame([(y, x)], "latitude double, longitude double")
    out = spatial.spatial_join(point, spatial.shape_index(shapes, size), size=size).collect()
    assert {r.name for r in out if r.name} == inside and len(out) == max(1, len(inside))


def test_polygon_against_brute_force(spark):
    """A ragged star: cells must not change any answer of the plain edge test."""
    import math

    star = [
        {"lon": (2 + i % 2 * 3) * math.cos(i / 6), "lat": (2 + i % 2 * 3) * math.sin(i / 6)}
        for i in range(37)
    ]
    schema = "name string, rings array<array<struct<lon:double,lat:double>>>"
    shapes = spark.createDataFrame([("s", [star])], schema)
    points = spark.range(2000).selectExpr(
        "id", "(id % 50) / 4.0d - 6.01d AS longitude", "cast(floor(id / 50) AS double) / 3d - 6d AS latitude"
    )
    got = {r.id for r in spatial.spatial_join(points, spatial.shape_index(shapes)).filter("name IS NOT NULL").collect()}
    edges = list(zip(star, star[1:] + star[:1]))

    def inside(x, y):
        odd = False
        for a, b in edges:
            if (a["lat"] > y) != (b["lat"] > y):
                t = (y - a["lat"]) / (b["lat"] - a["lat"])
                odd ^= x < a["lon"] + t * (b["lon"] - a["lon"])
        return odd

    assert got == {r.id for r in points.collect() if inside(r.longitude, r.latitude)}


def test_cell_parents(spark):
    df = spark.createDataFrame([("8828308281fffff",)], "h string")
    row = df.select(*[cells.cell_parent(F.col("h"), r) for r in (6, 4, 8)]).first()
    assert tuple(row) == ("86283082fffffff", "8428309ffffffff", "8828308281fffff")


def test_grid_cells_nest(spark):
    df = spark.createDataFrame([(12.9, 77.6), (-90.0, -180.0), (90.0, 180.0)], "lat double, lon double")
    lat, lon = F.col("lat"), F.col("lon")
    out = df.select(cells.grid_cell(lat, lon, 9).alias("f"), cells.grid_cell(lat, lon, 4).alias("c")).collect()
    assert all(r.f.startswith(r.c) and len(r.f) == 9 for r in out)


def test_district_summary_nulls_and_rounding(spark):
    homes = spark.createDataFrame([("S", "D")] * 8 + [(None, None)], "state string, district_name string")
    shops = spark.createDataFrame(
        [("S", "D", "HIGH")] + [(None, None, "VERY_HIGH")] * 2 + [("T", "E", "LOW")],
        "state string, district_name string, risk_level string",
    )
    rows = marts.district_summary(homes, shops).collect()
    seen = {
        (r.state, r.residential_nodes, r.merchant_nodes, r.high_risk_merchants, r.medium_high_risk_merchants,
         float(r.merchant_to_residential_ratio)) for r in rows
    }
    assert seen == {
        ("S", 8, 1, 0, 1, 0.13), (None, 1, 0, 0, 0, 0.0), (None, 0, 2, 2, 0, 0.0), ("T", 0, 1, 0, 0, 0.0),
    }


def scored(spark, rows):
    return spark.createDataFrame(rows, "score double, label int")


@pytest.mark.parametrize(
    "rows, auc",
    [
        ([(0.1, 0), (0.9, 1)], 1.0), ([(0.9, 0), (0.1, 1)], 0.0), ([(0.5, 0), (0.5, 1)], 0.5),
        ([(0.5, 1), (0.7, 1)], None), ([(0.2, 0), (0.5, 1), (0.5, 0), (0.9, 1)], 0.875),
    ],
)
def test_auc(spark, rows, auc):
    assert evaluation.roc_auc(scored(spark, rows)).first()["auc"] == auc


def test_recall_targets(spark):
    rows = [(0.9, 1), (0.8, 0), (0.7, 1), (0.6, 0), (0.5, 0)]
    out = evaluation.pr_thresholds(scored(spark, rows), targets=[0.5, 1.0, 0.2]).collect()
    # Recall is .5 at .9 and .8; the lower threshold wins. Recall 0 is nearest to .2.
    assert [(r.target_recall, r.threshold, r.recall) for r in out] == [(0.5, 0.8, 0.5), (1.0, 0.5, 1.0)]


def test_label_noise_rates(spark):
    df = spark.range(400).selectExpr("id AS transaction_id", "cast(id % 2 AS int) AS fraud_target")
    flipped = sampling.label_noise(df, fn_rate=1.0, fp_rate=1.0)
    assert flipped.filter("noisy_label = fraud_target").count() == 0
    kept = sampling.label_noise(df, fn_rate=0.0, fp_rate=0.0)
    assert kept.filter("noisy_label <> fraud_target OR label_noise <> 'none'").count() == 0


def test_split_is_complete_and_disjoint(spark):
    df = spark.range(5000).withColumnRenamed("id", "transaction_id")
    out = sampling.strat_split(df)
    shares = {r["split"]: r["count"] for r in out.groupBy("split").count().collect()}
    assert shares["train"] + shares["test"] == 5000 and 900 < shares["test"] < 1100


def test_balanced_sample_is_the_global_smallest(spark):
    df = spark.range(3000).selectExpr("id AS transaction_id", "cast(id % 10 = 0 AS int) AS is_fraud")
    out = sampling.balanced_sample(df, negatives=37)
    assert out.filter("is_fraud = 1").count() == 300 and out.filter("is_fraud = 0").count() == 37
    assert sampling.balanced_sample(df, negatives=10_000).count() == 3000


def test_history_limit(spark):
    tx = payments(spark, [("a", i * 1000, i, "x", 0.0) for i in range(11)])
    out = replay.card_history(tx).select("transaction_id").collect()
    assert sorted(r.transaction_id for r in out) == list(range(1, 11))


def test_constant_amounts_have_no_deviation(spark):
    tx = payments(spark, [("a", i, 0.1, "x", 0.0) for i in range(7)] + [("a", 8, 0.3, "x", 0.0)])
    out = by_id(replay.stream_zscore(tx), "std_before", "amount_deviation_z_score")
    assert out == [(0.0, 0.0)] * 8


def test_unparsable_time_is_null(spark):
    df = spark.createDataFrame([("2024-01-01T00:00:00.123456789Z",), ("x",)], "timestamp string")
    out = projection.bronze_transactions(df).select(timeparts.epoch_millis(F.col("timestamp"))).collect()
    assert [r[0] for r in out] == [1704067200123, None]
