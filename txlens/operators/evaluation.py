"""Classifier evaluation and leakage audit.

Ranked figures first aggregate to one row per distinct score, then take running totals
over the score order; ``ordered_columns`` cuts that order into slices when there are many
distinct scores, so nothing is ranked in a single task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.functions.numeric import flag, safe_div
from txlens.operators.ordered import MAX_KEY_ROWS, join_null_safe, ordered_columns, sized_broadcast

# Audit threshold, recall targets, operating points, scorer threshold.
AUDIT_THRESHOLD = 0.957
RECALL_TARGETS = [0.60, 0.55, 0.50, 0.45, 0.40]
OPERATING_MODES = [
    ("Detection Layer", 0.495),
    ("Triage", 0.645),
    ("Investigation", 0.736),
    ("High Confidence", 0.842),
    ("Blocking", 0.945),
]
SCORE_THRESHOLD = 0.85


def score_steps(
    scored: DataFrame,
    score: str = "score",
    label: str = "label",
    *,
    by: list[str] | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """One row per distinct score (per ``by``) with positives/negatives at and up to it.

    Rows without a score or a label are left out: they are at no threshold.
    """
    positive, by = F.col(label).cast("int"), by or []
    known = scored.filter(F.col(score).isNotNull() & positive.isNotNull())
    steps = known.groupBy(*by, F.col(score).alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    )
    return ordered_columns(
        steps,
        by,
        ["score"],
        running={"pos_upto": ("sum", F.col("pos")), "neg_upto": ("sum", F.col("neg"))},
        max_key_rows=max_key_rows,
    )


def roc_auc(
    scored: DataFrame, score: str = "score", label: str = "label", *, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """Exact area under the ROC curve with tied scores counted half; null for one class."""
    steps = score_steps(scored, score, label, max_key_rows=max_key_rows)
    below = F.col("neg_upto") - F.col("neg")
    won = F.sum(F.col("pos") * (below.cast("double") + F.col("neg") / 2.0))
    return steps.agg(
        F.sum("pos").alias("positives"), F.sum("neg").alias("negatives"), won.alias("_won")
    ).select(
        "positives",
        "negatives",
        safe_div(F.col("_won"), F.col("positives").cast("double") * F.col("negatives")).alias("auc"),
    )


def pr_curve(
    scored: DataFrame, score: str = "score", label: str = "label", *, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """Precision and recall of 'score >= threshold' at every distinct score."""
    # Order by the negated score: running totals then count scores at or above it.
    flipped = scored.select((-F.col(score)).alias("score"), F.col(label).alias("label"))
    steps = score_steps(flipped, max_key_rows=max_key_rows)
    all_pos = scored.filter(F.col(score).isNotNull()).agg(F.sum(F.col(label).cast("int"))).scalar()
    flagged = F.col("pos_upto") + F.col("neg_upto")
    return steps.select(
        (-F.col("score")).alias("threshold"),
        safe_div(F.col("pos_upto"), flagged).alias("precision"),
        safe_div(F.col("pos_upto"), all_pos).alias("recall"),
    )


def pr_thresholds(
    scored: DataFrame,
    targets: list[float] = RECALL_TARGETS,
    score: str = "score",
    label: str = "label",
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """The threshold whose recall is nearest to each target; the lowest wins a tie.

    A target closer to recall 0 than to any threshold's recall has no row.
    """
    curve = pr_curve(scored, score, label, max_key_rows=max_key_rows)

    def nearest(target: float) -> Column:
        gap = F.abs(F.col("recall") - target)
        return F.min(F.struct(gap.alias("gap"), "threshold", "precision", "recall"))

    best = curve.agg(
        F.array(
            *[
                F.struct(F.lit(t).alias("target_recall"), nearest(t).alias("best"))
                for t in targets
            ]
        ).alias("rows")
    )
    p, r = F.col("best.precision"), F.col("best.recall")
    return (
        best.select(F.inline("rows"))
        .filter(F.col("best.gap") <= F.col("target_recall"))
        .select(
            "target_recall",
            F.col("best.threshold").alias("threshold"),
            p.alias("precision"),
            r.alias("recall"),
            safe_div(2 * p * r, p + r, 0.0).alias("f1"),
        )
    )


def confusion(
    scored: DataFrame, cut: float = 0.5, score: str = "score", label: str = "label"
) -> DataFrame:
    predicted = flag(F.col(score) > cut)
    return scored.groupBy(F.col(label).alias("actual"), predicted.alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def class_report(
    scored: DataFrame, cut: float = 0.5, score: str = "score", label: str = "label"
) -> DataFrame:
    """Precision, recall, F1 and support of both classes."""
    cells = confusion(scored, cut, score, label)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0))

    actual, predicted = F.col("actual"), F.col("predicted")
    rows = [
        F.struct(
            F.lit(c).alias("label"),
            total((actual == c) & (predicted == c)).alias("hit"),
            total(predicted == c).alias("predicted"),
            total(actual == c).alias("support"),
        )
        for c in (0, 1)
    ]
    p = safe_div(F.col("hit"), F.col("predicted"), 0.0)
    r = safe_div(F.col("hit"), F.col("support"), 0.0)
    return (
        cells.agg(F.array(*rows).alias("rows"))
        .select(F.inline("rows"))
        .select(
            "label",
            p.alias("precision"),
            r.alias("recall"),
            safe_div(2 * p * r, p + r, 0.0).alias("f1"),
            "support",
        )
    )


def category_overrep(
    scored: DataFrame,
    threshold: float = AUDIT_THRESHOLD,
    category: str = "merchant_category",
    score: str = "score",
    label: str | None = "label",
) -> DataFrame:
    """Flag share over global share per category, and the true rate among flags.

    One pass over the rows; the totals are taken over the per-category counts.
    """
    flagged = F.col(score) >= threshold
    hits = [F.sum(F.when(flagged, F.col(label).cast("int"))).alias("_hits")] if label else []
    per = scored.groupBy(category).agg(
        F.count(F.lit(1)).alias("count"), F.count_if(flagged).alias("flag_count"), *hits
    )
    everything = Window.partitionBy(F.lit(1))  # one row per category by now
    per = per.withColumns(
        {"_all": F.sum("count").over(everything), "_flags": F.sum("flag_count").over(everything)}
    )
    global_share = safe_div(F.col("count"), F.col("_all"))
    flag_share = safe_div(F.col("flag_count"), F.col("_flags"), 0.0)
    columns = [
        F.col(category),
        "count",
        "flag_count",
        global_share.alias("global_share"),
        flag_share.alias("flag_share"),
        safe_div(flag_share, global_share, 0.0).alias("index"),
    ]
    if label:
        columns.append(safe_div(F.col("_hits"), F.col("flag_count")).alias("verified_fraud_rate"))
    return per.select(*columns).orderBy(F.desc("index"), category)


def class_weight(rows: DataFrame, label: str = "is_fraud") -> DataFrame:
    """Legitimate count over fraud count, the weight of the positive class."""
    y = F.col(label).cast("int")
    return rows.agg(F.sum(y).alias("fraud"), F.sum(1 - y).alias("legitimate")).withColumn(
        "scale_pos_weight", safe_div(F.col("legitimate"), F.col("fraud"))
    )


def amount_profile(
    rows: DataFrame,
    label: str = "is_fraud",
    amount: str = "amount",
    quantiles: dict[str, float] | None = None,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Mean and exact interpolated quantiles of the amount per label.

    Built from counts per distinct amount and their running totals, because a label may
    hold nearly all rows.
    """
    quantiles = quantiles or {"median": 0.5, "p75": 0.75, "p95": 0.95}
    counts = (
        rows.filter(F.col(amount).isNotNull())
        .groupBy(F.col(label).cast("int").alias(label), F.col(amount).alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    weighted = F.sum(F.col("value") * F.col("n"))
    placed = ordered_columns(
        counts,
        [label],
        ["value"],
        running={"upto": ("sum", F.col("n"))},
        whole={"total": F.sum("n"), "weighted": weighted},
        max_key_rows=max_key_rows,
    )

    def at_rank(rank: Column) -> Column:
        """The value that covers a 0-based rank."""
        covers = (F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank)
        return F.max(F.when(covers, F.col("value")))

    picks = []
    for name, q in quantiles.items():
        rank = (F.col("total") - 1) * q
        picks += [
            at_rank(F.floor(rank)).alias(f"_{name}_low"),
            at_rank(F.ceil(rank)).alias(f"_{name}_high"),
        ]
    out = placed.groupBy(label).agg(
        F.max("total").alias("total"), F.max("weighted").alias("weighted"), *picks
    )
    values = []
    for name, q in quantiles.items():
        rank = (F.col("total") - 1) * q
        low, high = F.col(f"_{name}_low"), F.col(f"_{name}_high")
        values.append((low + (high - low) * (rank - F.floor(rank))).alias(name))
    mean = safe_div(F.col("weighted"), F.col("total")).alias("mean")
    return out.select(label, F.col("total").alias("payments"), mean, *values)


# A sketch of parameter k has a rank error of about 2.3 / k**0.9021 (99 % of the time); 0.0133 for 300.
SKETCH_K = 300
SKETCH_ERROR = 0.0133


def amount_sketches(
    rows: DataFrame, by: list[str], amount: str = "amount", k: int = SKETCH_K
) -> DataFrame:
    """(by, sketch): a mergeable quantile sketch of the amounts, a few kilobytes a group.

    Sketches may be kept per day, say, and merged for any period with ``merge_sketches``.
    """
    known = rows.filter(F.col(amount).isNotNull() & ~F.isnan(amount))
    return known.groupBy(*by).agg(F.kll_sketch_agg_double(F.col(amount).cast("double"), k).alias("sketch"))


def merge_sketches(sketches: DataFrame, by: list[str], k: int = SKETCH_K) -> DataFrame:
    return sketches.groupBy(*by).agg(F.kll_merge_agg_double("sketch", k).alias("sketch"))


def sketch_quantiles(sketches: DataFrame, quantiles: dict[str, float]) -> DataFrame:
    """The sketches' number of payments and quantiles as columns."""
    picks = [F.kll_sketch_get_quantile_double("sketch", F.lit(q)).alias(n) for n, q in quantiles.items()]
    others = [c for c in sketches.columns if c != "sketch"]
    return sketches.select(*others, F.kll_sketch_get_n_double("sketch").alias("payments"), *picks)


def rank_errors(
    rows: DataFrame, found: DataFrame, by: str, quantiles: dict[str, float], amount: str = "amount"
) -> DataFrame:
    """How far each quantile's true rank in ``rows`` is from the rank asked for, as a share of the rows.

    ``found`` has one row a value of ``by`` and must be small: it is broadcast.
    """
    side = sized_broadcast(found.select(by, *[F.col(n).alias(f"_{n}") for n in quantiles]))
    joined = join_null_safe(rows.select(by, amount).filter(F.col(amount).isNotNull()), side, [by], "inner")

    def error(name: str, q: float) -> Column:
        # A value that many rows share covers a span of ranks; the nearest of them counts.
        n = F.count(F.lit(1)).cast("double")
        below, upto = F.count_if(F.col(amount) < F.col(f"_{name}")) / n, F.count_if(F.col(amount) <= F.col(f"_{name}")) / n
        return F.greatest(F.lit(q) - upto, below - F.lit(q), F.lit(0.0)).alias(name)

    return joined.groupBy(by).agg(*[error(n, q) for n, q in quantiles.items()])


def segment_top_features(
    values: DataFrame, segment: str, features: list[str], top: int = 3
) -> DataFrame:
    """Features with the largest mean absolute value per segment.

    Averages the wide table first, so only segments x features rows are ranked.
    """
    wide = values.groupBy(segment).agg(*[F.avg(F.abs(f)).alias(f) for f in features])
    long = wide.unpivot([segment], features, "feature", "mean_abs")
    rank = Window.partitionBy(segment).orderBy(F.desc("mean_abs"), "feature")
    return long.withColumn("rank", F.row_number().over(rank)).filter(F.col("rank") <= top)


def score_vs_truth(scores: DataFrame, truth: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Scores joined to the captured ground truth."""
    return scores.join(truth, key)


def amount_bins(rows: DataFrame, edges: list[float], names: list[str], amount: str = "amount") -> DataFrame:
    """Label each amount with the first bin whose upper edge it does not exceed."""
    bin_name = F.lit(names[-1])
    for edge, name in reversed(list(zip(edges, names))):
        bin_name = F.when(F.col(amount) <= edge, F.lit(name)).otherwise(bin_name)
    return rows.withColumn("amount_bin", F.when(F.col(amount).isNotNull(), bin_name))


def operating_mode(
    scored: DataFrame, modes: list[tuple[str, float]] = OPERATING_MODES, score: str = "score"
) -> DataFrame:
    """The strictest operating mode whose threshold the score reaches."""
    mode = F.lit("None")
    for name, threshold in modes:
        mode = F.when(F.col(score) >= threshold, F.lit(name)).otherwise(mode)
    return scored.withColumn("operating_mode", mode)


def score_flag(
    scored: DataFrame, threshold: float = SCORE_THRESHOLD, probability: str = "fraud_probability"
) -> DataFrame:
    return scored.withColumn("flagged", flag(F.col(probability) > threshold))
