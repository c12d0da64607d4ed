"""A key with a third of all rows gives the same result through the sliced path."""

import pytest
from compare import rows_of
from pyspark.sql import functions as F

from txlens.operators import (
    campaign,
    customer,
    entity,
    evaluation,
    gold,
    marts,
    nodes,
    ordered,
    replay,
    sequence,
)
from txlens.plans.catalog import settle
from txlens.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the payments belong to customer 3 and card 31; some to nobody."""
    hot = F.col("transaction_id") % 3 == 0
    tx = fx.payments(spark, SMALL).withColumns(
        {
            "customer_id": F.when(hot, F.lit(3))
            .when(F.col("transaction_id") % 7 == 1, F.lit(None))
            .otherwise(F.col("customer_id")),
            "card_id": F.when(hot, F.lit(31)).otherwise(F.col("card_id")),
        }
    )
    return tx


def same(plain, sliced):
    a = rows_of(plain.columns, [tuple(r) for r in settle(plain).collect()])
    b = rows_of(sliced.columns, [tuple(r) for r in settle(sliced).select(plain.columns).collect()])
    assert a == b


@pytest.mark.parametrize(
    "operator",
    [
        sequence.sequence_features,
        campaign.campaign_features,
        replay.stream_zscore,
        replay.stream_card_features,
        replay.stream_burst,
    ],
    ids=lambda f: f.__name__,
)
def test_sliced_equals_plain(skewed, operator):
    same(operator(skewed), operator(skewed, max_key_rows=20))


def test_burst_counts_crowded_seconds(spark):
    rows = spark.range(600).select(
        F.col("id").alias("transaction_id"),
        (F.col("id") % 2).alias("card_id"),
        F.timestamp_micros(1_700_000_000_000_000 + F.col("id") * 500_000).alias("timestamp"),
    )
    plain = replay.stream_burst(rows)
    assert plain.agg(F.max("burst_count")).first()[0] == 60
    same(plain, replay.stream_burst(rows, max_key_rows=25))


def test_identical_times_split_by_id(spark):
    """All rows of one key at one instant: only the id can cut them."""
    rows = spark.range(500).select(
        F.lit("c").alias("k"), F.lit(0).alias("t"), F.col("id"), (F.col("id") % 5).alias("v")
    )
    spec = {"lags": {"p": ("v", 1), "p2": ("v", 2)}, "running": {"s": ("sum", F.col("v"))}}
    plain = ordered.ordered_columns(rows, ["k"], ["t", "id"], **spec)
    same(plain, ordered.ordered_columns(rows, ["k"], ["t", "id"], **spec, max_key_rows=40))


@pytest.mark.parametrize(
    "report",
    [
        lambda s, n: evaluation.roc_auc(s, max_key_rows=n),
        lambda s, n: evaluation.pr_curve(s, max_key_rows=n),
        lambda s, n: evaluation.pr_thresholds(s, max_key_rows=n),
    ],
    ids=["roc_auc", "pr_curve", "pr_thresholds"],
)
def test_ranked_reports_in_slices(spark, report):
    scores = fx.scores(spark, SMALL)
    same(report(scores, ordered.MAX_KEY_ROWS), report(scores, 50))


def test_quantiles_in_slices(spark):
    tx = fx.payments(spark, SMALL)
    same(evaluation.amount_profile(tx), evaluation.amount_profile(tx, max_key_rows=60))


def test_rows_are_kept(skewed):
    out = sequence.sequence_features(skewed, max_key_rows=20)
    assert out.count() == skewed.count()
    assert out.select("transaction_id").distinct().count() == skewed.count()


def test_hot_rows_really_are_spread(spark, skewed):
    split = ordered.split_hot(skewed, ["customer_id"], 90)
    assert split.n_keys == 2  # customer 3 and the null key
    slices = ordered._slices(split.hot, ["customer_id", "timestamp", "transaction_id"], split.n_rows, 100)
    sizes = [r["count"] for r in slices.groupBy("_slice").count().collect()]
    assert len(sizes) >= 3 and max(sizes) < split.n_rows * 0.6


def test_small_limits_do_not_make_a_task_of_every_few_rows(spark):
    """The number of slices stays low until they are large; the rows are those of plain windows."""
    rows = spark.range(900).select(
        (F.col("id") % 3).alias("k"), (F.col("id") % 50).alias("t"), F.col("id"), (F.col("id") % 7).cast("double").alias("v")
    )
    slices = ordered._slices(rows, ["k", "t", "id"], 900, 2)
    assert slices.rdd.getNumPartitions() == ordered.FEW_SLICES
    assert ordered._n_slices(36_000_000, 12) == 36_000_000 / ordered.MIN_SLICE_ROWS
    assert ordered._n_slices(36_000_000, ordered.MAX_KEY_ROWS) == 8
    spec = {"lags": {"p": ("v", 1)}, "running": {"s": ("sum", F.col("v"))}}
    plain = ordered.ordered_columns(rows, ["k"], ["t", "id"], **spec)
    same(plain, ordered.ordered_columns(rows, ["k"], ["t", "id"], **spec, max_key_rows=2))
    moments = [ordered.running_moments(rows, ["k"], ["t", "id"], "v", max_key_rows=n) for n in (10**6, 2)]
    same(*moments)


def test_entity_joins_with_hot_entities(spark, skewed):
    """Customer 3 owns a third of the rows, and each of 17 addresses many more than 20."""
    silver = sequence.to_silver(sequence.sequence_features(skewed))
    sides = customer.customer_activity(skewed), entity.merchant_features(skewed)
    drop = "feature_calculated_at"
    same(
        gold.gold_master(silver, *sides).drop(drop),
        gold.gold_master(silver, *sides, max_key_rows=20).drop(drop),
    )
    sides = entity.ip_reputation(skewed), entity.device_reputation(skewed)
    same(
        entity.network_tx_features(skewed, *sides),
        entity.network_tx_features(skewed, *sides, max_key_rows=20),
    )


def test_hot_sides_do_not_multiply_the_left_side(spark, skewed):
    """Each joined table adds its own scans only, whether it has hot keys or not."""
    rows = skewed.select("transaction_id", "customer_id", "card_id").checkpoint()
    side = spark.range(50).select(F.col("id").alias("customer_id"), F.lit(1).alias("v")).checkpoint()
    other = spark.range(50).select(F.col("id").alias("card_id"), F.lit(2).alias("w")).checkpoint()
    sides = [(side, ["customer_id"]), (other, ["card_id"])]

    def scans(out):
        return out._jdf.queryExecution().optimizedPlan().collectLeaves().size()

    plain, split = (ordered.join_entities(rows, sides, max_key_rows=n) for n in (10**6, 20))
    assert scans(plain) == 3 and scans(split) == 7  # two more small ones per hot side
    same(plain, split)
    text = split._jdf.queryExecution().optimizedPlan().toString()
    assert "Union" not in text


def _reads(spark, build):
    """Result of ``build`` and how often its source row was computed, by an accumulator in the source."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    out = build(count)
    rows = out.collect()
    return len(rows), seen.value


def test_places_and_tiers_read_their_rows_once(spark):
    """However many tiers have hot localities, the (costly) classified nodes are computed once."""
    nodes_ = spark.range(200).select(
        F.col("id").alias("osm_id"),
        F.lit("88608b5a81fffff").alias("h3_index"),
        F.when(F.col("id") % 2 == 0, "MH").alias("state"),
    )
    index = marts.locality_index(nodes_)
    n, read = _reads(
        spark, lambda f: marts.locality_match(nodes_.mapInPandas(f, nodes_.schema), index, max_key_rows=20)
    )
    assert n == 200 and read == 200
    n, read = _reads(
        spark, lambda f: marts.locality_places(nodes_.mapInPandas(f, nodes_.schema), max_key_rows=20)
    )
    assert n == 700 and read == 200
    places = marts.locality_places(nodes_)
    n, read = _reads(
        spark, lambda f: marts.draw_merchant(nodes_.mapInPandas(f, nodes_.schema), places, max_key_rows=5)
    )
    assert n == 200 and read == 200


def test_rows_without_a_time(spark):
    """They have no burst, count in no other, and stay."""
    second = F.timestamp_micros(1_700_000_000_000_000 + F.col("id") * 1_000_000)
    rows = spark.range(300).select(
        (F.col("id") % 290).alias("transaction_id"),
        F.when(F.col("id") % 2 == 0, 1).alias("card_id"),
        F.when(F.col("id") % 10 != 0, second).alias("timestamp"),
    )
    plain = replay.stream_burst(rows)
    assert plain.filter("burst_count = 0").count() == 30
    same(plain, replay.stream_burst(rows, max_key_rows=50))


def test_sums_over_stretches_of_nulls(spark):
    value = F.when((F.col("id") / 30).cast("int") % 2 == 1, F.col("id"))
    rows = spark.range(200).select(F.lit(1).alias("k"), "id", value.alias("v"))
    spec = {"running": {"s": ("sum", F.col("v")), "low": ("min", F.col("v"))}}
    plain = ordered.ordered_columns(rows, ["k"], ["id"], **spec)
    assert plain.filter("s IS NULL").count() == 30
    same(plain, ordered.ordered_columns(rows, ["k"], ["id"], **spec, max_key_rows=17))


def test_missing_scores_are_at_no_threshold(spark):
    rows = spark.range(40).select(
        F.when(F.col("id") % 4 != 0, F.col("id") / 40).alias("score"), (F.col("id") % 3 == 0).cast("int").alias("label")
    )
    known = rows.filter("score IS NOT NULL")
    for report in (evaluation.roc_auc, evaluation.pr_curve):
        same(report(known), report(rows))
        same(report(known), report(rows, max_key_rows=7))


def test_locality_with_a_hot_state(spark):
    from txlens.plans import catalog

    residents = nodes.residential_nodes(catalog._classified(spark, SMALL)).select(
        "osm_id", "h3_index", F.lit("MH").alias("state")
    )
    index = marts.locality_index(catalog._staged_merchants(spark, SMALL))
    same(marts.locality_match(residents, index), marts.locality_match(residents, index, max_key_rows=15))
