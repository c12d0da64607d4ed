"""The classifier learns a separable rule, and its audit finds the feature that carries it."""

import pytest
from compare import rows_of
from pyspark.sql import functions as F

from txlens.operators import evaluation, model
from txlens.plans.catalog import settle


@pytest.fixture(scope="module")
def rows(spark):
    """Fraud exactly when the velocity is high; every other feature is noise."""
    noise = {
        name: F.lit("a") if kind == "string" else (F.col("id") * 7 % 11).cast("double")
        for name, kind in model.FEATURE_SPEC.items()
    }
    table = spark.range(600).select(F.col("id").alias("transaction_id"), "id").withColumns(noise)
    table = table.withColumn("spatial_velocity", (F.col("id") % 30).cast("double"))
    labelled = table.withColumn("is_fraud", (F.col("spatial_velocity") > 24).cast("int"))
    return model.training_rows(labelled.drop("id"))


@pytest.fixture(scope="module")
def fitted(rows):
    return model.train(rows, trees=5, depth=3)


def test_weight_balances_the_classes(rows):
    sums = {r["label"]: r["w"] for r in rows.groupBy("label").agg(F.sum("weight").alias("w")).collect()}
    assert sums[0.0] == pytest.approx(sums[1.0])


def test_learns(spark, rows, fitted):
    assert evaluation.roc_auc(model.predict(fitted, rows)).first()["auc"] > 0.99
    assert model.feature_importance(spark, fitted).first()["feature"] == "spatial_velocity"


def test_unseen_category_is_scored(rows, fitted):
    odd = rows.limit(3).withColumn("merchant_category", F.lit("never seen"))
    assert model.predict(fitted, odd).filter("score IS NULL").count() == 0


def test_permutation_audit_and_its_slices(rows, fitted):
    plain = model.permutation_importance(fitted, rows)
    ranked = plain.orderBy(F.desc("importance")).collect()
    assert ranked[0]["feature"] == "spatial_velocity" and ranked[0]["importance"] > 0.2
    assert len(ranked) == len(model.FEATURE_SPEC)
    sliced = model.permutation_importance(fitted, rows, max_key_rows=100)
    both = [rows_of(df.columns, [tuple(r) for r in settle(df).collect()]) for df in (plain, sliced)]
    assert both[0] == both[1]


def test_scores_and_split_read_stored_rows(spark, rows, fitted):
    """The trees are not walked, nor the gold joins computed, anew by every pass over the rows."""
    from txlens.plans import catalog

    for part in catalog._split_gold(spark, "/root/testdata/sf0.001"):
        assert part.inputFiles() and not [f for f in part.inputFiles() if "events" in f]
    audit = model.permutation_importance(fitted, rows)
    assert any("/scores-" in f for f in audit.inputFiles())
