"""Fraud classifier: boosted trees on the operational features, and its audit."""

from __future__ import annotations

from functools import reduce

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txlens.functions.hashing import hash_int
from txlens.functions.numeric import safe_div
from txlens.operators.evaluation import class_weight, score_steps
from txlens.operators.ordered import MAX_BROADCAST_ROWS, MAX_KEY_ROWS, ordered_columns
from txlens.sources.tables import scratch, stage

# One list for training and live scoring, with the type each feature is cast to.
FEATURE_SPEC = {
    "time_since_last_transaction": "double",
    "transaction_sequence_number": "double",
    "spatial_velocity": "double",
    "hour_deviation_from_norm": "double",
    "amount_deviation_z_score": "double",
    "rapid_fire_transaction_flag": "double",
    "escalating_amounts_flag": "double",
    "merchant_category_switch_flag": "double",
    "transaction_channel": "string",
    "card_present": "double",
    "merchant_category": "string",
    "suspicious_cluster_member": "double",
}
CATEGORICAL = [name for name, kind in FEATURE_SPEC.items() if kind == "string"]

# Trees, depth and learning rate.
TREES, DEPTH, STEP = 100, 6, 0.1


def classifier(trees: int = TREES, depth: int = DEPTH, step: float = STEP, max_bins: int = 64) -> Pipeline:
    """Index the categories, assemble, boost. Unseen categories get their own index."""
    indexed = [f"{c}_index" for c in CATEGORICAL]
    stages = [StringIndexer(inputCols=CATEGORICAL, outputCols=indexed, handleInvalid="keep")]
    inputs = [f"{c}_index" if c in CATEGORICAL else c for c in FEATURE_SPEC]
    stages.append(VectorAssembler(inputCols=inputs, outputCol="features", handleInvalid="keep"))
    stages.append(
        GBTClassifier(
            featuresCol="features", labelCol="label", weightCol="weight", maxIter=trees,
            maxDepth=depth, stepSize=step, maxBins=max_bins, seed=42,
        )
    )
    return Pipeline(stages=stages)


def training_rows(gold: DataFrame, label: str = "is_fraud", learned: DataFrame | None = None) -> DataFrame:
    """Label, class weight and features; the positive weight is legitimate / fraud.

    ``learned`` holds the rows that the model may learn from, if those are not all of ``gold``.
    """
    weight = class_weight(gold if learned is None else learned, label).first()["scale_pos_weight"]
    y = F.col(label).cast("double")
    return gold.withColumns(
        {"label": y, "weight": F.when(y == 1, F.lit(weight or 1.0)).otherwise(F.lit(1.0))}
    )


def train(rows: DataFrame, **settings) -> PipelineModel:
    return classifier(**settings).fit(rows)


def predict(model: PipelineModel, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn("score", vector_to_array("probability")[1])


def feature_importance(spark: SparkSession, model: PipelineModel, top: int = 10) -> DataFrame:
    """Features by importance (one row per feature; the list is the model's)."""
    gains = model.stages[-1].featureImportances.toArray()
    rows = [(name, float(gain)) for name, gain in zip(FEATURE_SPEC, gains)]
    table = spark.createDataFrame(rows, "feature string, importance double")
    return table.orderBy(F.desc("importance"), "feature").limit(top)


def feature_spec(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Name, type and category levels of each feature, kept next to the model."""
    levels = dict(zip(CATEGORICAL, model.stages[0].labelsArray))
    rows = [(name, kind, list(levels.get(name, []))) for name, kind in FEATURE_SPEC.items()]
    return spark.createDataFrame(rows, "feature string, type string, levels array<string>")


def check_spec(rows: DataFrame, spec: DataFrame) -> None:
    """Raise if rows cannot be scored under a stored feature spec: a feature is missing or of another kind.

    Category values the spec does not list are no drift; they get the index of unseen values.
    """
    stored = {r.feature: r.type for r in spec.select("feature", "type").collect()}  # one row a feature
    if stored != FEATURE_SPEC:
        raise ValueError(f"the stored spec differs from this library's: {set(stored.items()) ^ set(FEATURE_SPEC.items())}")
    kinds = {f.name: f.dataType for f in rows.schema}
    missing = [n for n in stored if n not in kinds]
    wrong = [n for n, kind in stored.items() if n in kinds and (kind == "string") != isinstance(kinds[n], T.StringType)]
    if missing or wrong:
        raise ValueError(f"features missing: {missing}, of another kind: {wrong}")


def unseen_levels(rows: DataFrame, spec: DataFrame) -> DataFrame:
    """(feature, level, n): category values that the spec does not list, with their number of rows."""
    values = F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("level")) for c in CATEGORICAL])
    counts = rows.select(F.inline(values)).groupBy("feature", "level").agg(F.count(F.lit(1)).alias("n"))
    known = spec.select("feature", F.explode("levels").alias("level"))
    return counts.join(F.broadcast(known), ["feature", "level"], "left_anti")  # the spec's own few levels


def node_table(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """The trees as rows: tree, node, feature, where to go from there, and what the step changes.

    ``weight`` is the tree's; a leaf has feature -1 and leads to itself.
    """
    trees = model.stages[-1]
    path = scratch(spark, "trees")
    trees.save(path)
    weights = spark.createDataFrame([(i, float(w)) for i, w in enumerate(trees.treeWeights)], "tree int, weight double")
    nodes = spark.read.parquet(f"{path}/data").select(
        F.col("treeID").alias("tree"),
        F.col("nodeData.id").alias("node"),
        F.col("nodeData.prediction").alias("value"),
        F.col("nodeData.split.featureIndex").alias("feature"),
        (F.col("nodeData.split.numCategories") >= 0).alias("by_category"),
        F.col("nodeData.split.leftCategoriesOrThreshold").alias("split"),
        F.col("nodeData.leftChild").alias("left"),
        F.col("nodeData.rightChild").alias("right"),
    )
    child = nodes.select("tree", F.col("node").alias("_child"), F.col("value").alias("_value"))
    for side in ("left", "right"):
        step = child.withColumnsRenamed({"_child": side, "_value": f"_{side}"})
        nodes = nodes.join(step, ["tree", side], "left")
    inner = F.col("feature") >= 0
    return nodes.join(weights, "tree").select(
        "tree", "node", "value", "weight", "by_category", "split",
        F.when(inner, F.col("feature")).otherwise(-1).alias("feature"),
        F.when(inner, F.col("left")).otherwise(F.col("node")).alias("left"),
        F.when(inner, F.col("right")).otherwise(F.col("node")).alias("right"),
        F.when(inner, F.col("_left") - F.col("value")).otherwise(0.0).alias("left_step"),
        F.when(inner, F.col("_right") - F.col("value")).otherwise(0.0).alias("right_step"),
    )


def path_contributions(
    model: PipelineModel, rows: DataFrame, key: str = "transaction_id", keep: tuple[str, ...] = ()
) -> DataFrame:
    """What each feature adds to each row's margin: key, keep, base, margin and a column a feature.

    Every row walks down every tree. A step from a node to its child changes the expected value; the
    change, times the tree's weight, is credited to the feature that the node splits on. So base (the
    roots' values) plus contributions is the margin. Nodes are looked up by joins with the node table, whose size is the
    model's, depth by depth; the sums over a row's trees combine before their shuffle. ``key`` must be unique.
    """
    spark = rows.sparkSession
    nodes, seen = stage(node_table(spark, model), "nodes")
    side = F.broadcast(nodes) if seen["n_rows"] <= MAX_BROADCAST_ROWS else nodes
    trees = model.stages[-1]
    depth = max(t.depth for t in trees.trees)
    scored = model.transform(rows).select(
        key, *keep, vector_to_array("rawPrediction")[1].alias("margin"), vector_to_array("features").alias("_x")
    )
    walk = scored.withColumn("tree", F.explode(F.sequence(F.lit(0), F.lit(trees.getNumTrees - 1))))
    walk = walk.withColumn("node", F.lit(0))
    names = list(FEATURE_SPEC)
    for level in range(depth + 1):
        walk = walk.join(side, ["tree", "node"], "left")
        x = F.get("_x", F.greatest(F.col("feature"), F.lit(0)))
        goes_left = F.when(F.col("by_category"), F.array_contains("split", x)).otherwise(x <= F.get("split", F.lit(0)))
        walk = walk.withColumns(
            {
                f"_f{level}": F.col("feature"),
                f"_s{level}": F.col("weight") * F.when(goes_left, F.col("left_step")).otherwise(F.col("right_step")),
                "node": F.when(goes_left, F.col("left")).otherwise(F.col("right")),
                **({"_root": F.col("weight") * F.col("value")} if level == 0 else {}),
            }
        ).drop("value", "weight", "by_category", "split", "feature", "left", "right", "left_step", "right_step")

    def credited(i: int) -> Column:
        steps = [F.when(F.col(f"_f{n}") == i, F.col(f"_s{n}")).otherwise(0.0) for n in range(depth + 1)]
        return F.sum(reduce(Column.__add__, steps))

    return walk.groupBy(key).agg(
        *[F.first(c).alias(c) for c in keep],
        F.sum("_root").alias("base"),
        F.first("margin").alias("margin"),
        *[credited(i).alias(n) for i, n in enumerate(names)],
    )


def permutation_importance(
    model: PipelineModel,
    rows: DataFrame,
    key: str = "transaction_id",
    seed: str = "perm",
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """AUC lost when one feature's values are exchanged between rows.

    Two hash orders of the rows give a permutation: the row at position p of the first takes
    its replacement values from the row at position p of the second. All features are scored
    in one pass over rows x (features + 1) variants.
    """

    def positioned(df: DataFrame, name: str) -> DataFrame:
        hashed = df.withColumn("_h", hash_int(F.col(key), f"{seed}-{name}"))
        return ordered_columns(
            hashed, [], ["_h", key], running={"_p": ("sum", F.lit(1))}, max_key_rows=max_key_rows
        ).drop("_h")

    names = list(FEATURE_SPEC)
    base = positioned(rows.select(key, "label", *names), "a")
    other = positioned(rows.select(key, *names), "b").drop(key)
    other = other.withColumnsRenamed({n: f"_other_{n}" for n in names})
    variants = F.array(F.lit("none"), *[F.lit(n) for n in names])
    mixed = base.join(other, "_p").withColumn("variant", F.explode(variants))
    mixed = mixed.withColumns(
        {n: F.when(F.col("variant") == n, F.col(f"_other_{n}")).otherwise(F.col(n)) for n in names}
    )
    scored = predict(model, mixed.select("variant", "label", *names)).select("variant", "label", "score")
    scored, _ = stage(scored, "scores")  # counted per variant, then ranked: walk the trees once
    steps = score_steps(scored, by=["variant"], max_key_rows=max_key_rows)
    below = (F.col("neg_upto") - F.col("neg")).cast("double")
    auc = safe_div(
        F.sum(F.col("pos") * (below + F.col("neg") / 2.0)),
        F.sum("pos").cast("double") * F.sum("neg"),
    )
    per = steps.groupBy("variant").agg(auc.alias("auc"))
    # One row per feature by now.
    intact = F.max(F.when(F.col("variant") == "none", F.col("auc"))).over(Window.partitionBy(F.lit(1)))
    return (
        per.withColumn("base_auc", intact)
        .filter("variant <> 'none'")
        .select(
            F.col("variant").alias("feature"),
            "base_auc",
            "auc",
            (F.col("base_auc") - F.col("auc")).alias("importance"),
        )
    )
