"""Plan shape: what must not appear, and how often the data is shuffled."""

import re

import pytest

from txlens.operators import replay, sequence
from txlens.plans.catalog import QUERIES
from txlens.sources import fixtures as fx

SMALL = "/root/testdata/sf0.001"
MODELS = {"train_gbt", "perm_importance", "path_contributions", "feature_spec", "model_checks"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(QUERIES) - MODELS))
def test_no_product_and_no_python(spark, name):
    text = plan(QUERIES[name](spark, SMALL))
    assert "CartesianProduct" not in text
    assert "BroadcastNestedLoopJoin" not in text
    assert "Python" not in text and "Pandas" not in text


def test_sequence_shuffles_and_sorts_once(spark):
    text = plan(sequence.sequence_features(fx.payments(spark, SMALL)))
    assert text.count("Exchange") == 1 and len(re.findall(r"\bSort\b", text)) == 1


def test_campaign_shuffles_once(spark):
    text = plan(QUERIES["campaign_features"](spark, SMALL))
    assert text.count("Exchange") == 1


def test_merchant_scan_is_pruned(spark):
    text = plan(QUERIES["category_baselines"](spark, SMALL))
    columns = re.search(r"FileScan parquet \[([^\]]*)\]", text).group(1)
    assert {c.split("#")[0] for c in columns.split(",")} == {"event_type", "value"}


def test_filters_reach_the_scan(spark):
    text = plan(QUERIES["campaign_features"](spark, SMALL))
    assert "event_type" in re.search(r"DataFilters: \[(.*?)\], Format", text).group(1)


def test_history_is_limited_before_the_shuffle(spark):
    text = plan(replay.card_history(fx.payments(spark, SMALL)))
    before = text.split("Exchange")[1]
    assert "WindowGroupLimit" in before and "Partial" in before


def test_broadcasts_follow_the_counted_size(spark):
    from txlens.operators.ordered import sized_broadcast

    big, small = spark.range(1000), spark.range(10)
    assert sized_broadcast(big, 100) is big
    assert sized_broadcast(small, 100) is not small


def test_crowded_cell_is_split_when_cells_are_not_broadcast(spark, monkeypatch):
    """All points in one cell and no broadcast: the point side of that cell is cut."""
    from pyspark.sql import functions as F

    from txlens.operators import spatial

    monkeypatch.setattr(spatial, "MAX_BROADCAST_EDGES", 0)
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "4k",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "4k",
    }
    before = {k: spark.conf.get(k, None) for k in small}
    try:
        for key, value in small.items():
            spark.conf.set(key, value)
        layer = fx.district_boundaries(spark, SMALL).drop("st_nm")
        points = spark.range(0, 20000, 1, 8).select(
            "id",
            (9.1 + (F.col("id") % 100) / 1000.0).alias("latitude"),
            (69.1 + (F.col("id") % 70) / 1000.0).alias("longitude"),
        )
        out = spatial.spatial_join(points, spatial.shape_index(layer))
        rows = out.groupBy("district").count().collect()
        assert [(r["district"], r["count"]) for r in rows] == [("NATION_0", 20000)]
        joined = spatial.spatial_join(points, spatial.shape_index(layer))
        assert len(joined.collect()) == 20000
        final = plan(joined)
        assert "SortMergeJoin(skew=true)" in final, final[:3000]
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
