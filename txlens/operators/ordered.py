"""Per-key ordered columns and entity joins that survive a hot key.

A plain window puts all rows of a key into one task. That is the right plan while
every key is small, and the wrong one when a single customer, card or null key holds
a large share of the table. The functions here count rows per key first:

* keys of at most ``max_key_rows`` rows use ordinary windows (one shuffle);
* larger keys are range-partitioned on (key, order) into slices of about
  ``max_key_rows`` rows, or, beyond ``FEW_SLICES`` slices, of at least ``MIN_SLICE_ROWS``.
  Each slice is processed by its own task and the slices are stitched together with their
  totals. Slices are checkpointed to the shared folder, so a lost executor cannot change
  where the cuts are.

The order columns must identify a row within its key.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from txlens.session import ensure_checkpoint_dir

MAX_KEY_ROWS = 5_000_000
MAX_BROADCAST_ROWS = 500_000
MAX_SINGLE_ROWS = 250_000  # without a key a window is one task for the whole table
# A slice is a task and a file in every pass: more than a few of them must be worth it.
FEW_SLICES, MIN_SLICE_ROWS = 64, 100_000

_SLICE, _POS = "_slice", "_pos"
_SALTS = 4096
_MERGE = {
    "sum": F.sum,
    "min": F.min,
    "max": F.max,
    "last": lambda value: F.last(value, ignorenulls=True),
}


def sized_broadcast(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast only if the side is proven to have at most ``max_rows`` rows."""
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str) -> DataFrame:
    """Equi-join in which null keys meet each other; the right copies of the keys are dropped."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    match = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on])
    joined = left.join(renamed, match, how)
    return joined if how in ("left_semi", "left_anti") else joined.drop(*[f"_r_{c}" for c in on])


@dataclass
class Split:
    """Rows of ordinary keys, rows of hot keys, and the hot keys with their counts."""

    cold: DataFrame | None
    hot: DataFrame
    hot_keys: DataFrame | None
    n_keys: int
    n_rows: int


def split_hot(df: DataFrame, keys: list[str], max_key_rows: int) -> Split | None:
    """Separate keys above ``max_key_rows`` rows; None when there are none."""
    if not keys:
        rows = df.count()
        return Split(None, df, None, 1, rows) if rows > max_key_rows else None
    counts = (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > max_key_rows)
    )
    counts = counts.persist()  # read twice; the hot keys only
    try:
        found = counts.agg(F.count(F.lit(1)).alias("keys"), F.sum("_n").alias("rows")).first()
        if found["keys"] == 0:
            return None
        ensure_checkpoint_dir(df.sparkSession)
        hot_keys = counts.checkpoint()
    finally:
        counts.unpersist()
    # There are at most (rows / max_key_rows) hot keys; the count is known here.
    side = hot_keys.select(*keys)
    if found["keys"] <= MAX_BROADCAST_ROWS:
        side = F.broadcast(side)
    cold = join_null_safe(df, side, keys, "left_anti")
    hot = join_null_safe(df, side, keys, "left_semi")
    return Split(cold, hot, hot_keys, found["keys"], found["rows"])


def join_unique(
    left: DataFrame,
    right: DataFrame,
    keys: list[str],
    *,
    counted: DataFrame | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Left join to a table with at most one row per key, safe for hot keys on the left.

    The run-time skew split does not apply when the right side is an aggregate, so hot keys
    are handled here: their right rows, one per hot key, are broadcast to all rows. The shuffled
    join that follows is for the others; a salt, which the right side has not, deals the hot
    rows out evenly. The left side is read once, however many tables are joined. ``counted`` may
    name a cheaper frame with the same keys and row counts as ``left``.
    """
    split = split_hot(left if counted is None else counted, keys, max_key_rows)
    if split is None:
        return left.join(right, keys, "left")
    values = [c for c in right.columns if c not in keys]
    few = split.hot_keys.select(*keys).join(right, keys, "left")
    few = few.select(*keys, F.struct(*values).alias("_few"), F.lit(True).alias("_hot"))
    if split.n_keys <= MAX_BROADCAST_ROWS:
        few = F.broadcast(few)
    plain = [f.name for f in left.schema if not isinstance(f.dataType, (T.MapType, T.VariantType))]
    spread = F.pmod(F.xxhash64(*plain), F.lit(_SALTS)) + 1
    marked = join_null_safe(left, few, keys, "left").withColumn(
        "_salt", F.when(F.col("_hot"), spread).otherwise(F.lit(0).cast("long"))
    )
    out = marked.join(right.withColumn("_salt", F.lit(0).cast("long")), [*keys, "_salt"], "left")
    found = {c: F.when(F.col("_hot"), F.col("_few")[c]).otherwise(F.col(c)) for c in values}
    return out.withColumns(found).drop("_salt", "_few", "_hot")


def join_entities(
    left: DataFrame,
    sides: list[tuple[DataFrame, list[str]]],
    *,
    counted: DataFrame | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """``join_unique`` with several tables, looking for hot keys of all of them in one pass.

    ``counted`` may name a cheaper frame with the same keys and row counts as ``left``.
    Keys are counted by hash, so a collision can only cause a needless second look.
    """
    counted = left if counted is None else counted  # before any join, which adds no rows
    marks = F.array(
        *[
            F.struct(F.lit(i).alias("side"), F.xxhash64(*keys).alias("key"))
            for i, (_, keys) in enumerate(sides)
        ]
    )
    busy = (
        counted.select(F.inline(marks))
        .groupBy("side", "key")
        .agg(F.count(F.lit(1)).alias("n"))
        .filter(F.col("n") > max_key_rows)
    )
    hot = {row["side"] for row in busy.select("side").distinct().collect()}  # one row per side
    for i, (right, keys) in enumerate(sides):
        if i in hot:
            left = join_unique(left, right, keys, counted=counted, max_key_rows=max_key_rows)
        else:
            left = left.join(right, keys, "left")
    return left


def _n_slices(rows: int, max_rows: int) -> int:
    """Slices of ``max_rows`` rows, as long as they are few or not small."""
    enough = max(FEW_SLICES, math.ceil(rows / MIN_SLICE_ROWS))
    return max(2, min(math.ceil(rows / max_rows), enough))


def _slices(df: DataFrame, order: list[str], rows: int, max_rows: int) -> DataFrame:
    """Range-partition by ``order`` and fix the partition number as a column."""
    ensure_checkpoint_dir(df.sparkSession)
    ranged = df.repartitionByRange(_n_slices(rows, max_rows), *[F.col(c) for c in order])
    return ranged.withColumn(_SLICE, F.spark_partition_id()).checkpoint()


def _running_over_slices(
    parts: DataFrame,
    keys: list[str],
    order: list[str],
    running: dict[str, tuple[str, Column]],
    n_totals: int,
) -> DataFrame:
    """Running values inside each slice, combined with the totals of earlier slices."""
    local = Window.partitionBy(*keys, _SLICE).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, Window.currentRow
    )
    earlier = Window.partitionBy(*keys).orderBy(_SLICE).rowsBetween(
        Window.unboundedPreceding, -1
    )
    # One total per (key, slice): at most (number of slices + number of hot keys) rows.
    def total(how: str, value: Column) -> Column:
        if how != "last":
            return _MERGE[how](value)
        return F.max_by(value, F.when(value.isNotNull(), F.struct(*order)))

    totals = parts.groupBy(*keys, _SLICE).agg(
        *[total(how, value).alias(f"_t_{name}") for name, (how, value) in running.items()]
    )
    before = totals.select(
        *keys,
        _SLICE,
        *[
            _MERGE[how](f"_t_{name}").over(earlier).alias(f"_b_{name}")
            for name, (how, _) in running.items()
        ],
    )
    if n_totals <= MAX_BROADCAST_ROWS:
        before = F.broadcast(before)
    out = parts.withColumns(
        {name: _MERGE[how](value).over(local) for name, (how, value) in running.items()}
    )
    out = join_null_safe(out, before, [*keys, _SLICE], "left")
    combine = {
        # As in a window, a sum over nothing but nulls is null.
        "sum": lambda a, b: F.coalesce(a + b, a, b),
        "min": lambda a, b: F.least(a, b),
        "max": lambda a, b: F.greatest(a, b),
        "last": lambda a, b: F.coalesce(a, b),
    }
    out = out.withColumns(
        {
            name: combine[how](F.col(name), F.col(f"_b_{name}"))
            for name, (how, _) in running.items()
        }
    )
    return out.drop(*[f"_b_{name}" for name in running])


def _lags_over_slices(
    parts: DataFrame,
    keys: list[str],
    order: list[str],
    lags: dict[str, tuple[str, int]],
    n_totals: int,
) -> DataFrame:
    """Lags inside each slice; the first rows of a slice look into the end of earlier ones.

    Only the last few rows of each (key, slice) can be looked up across a cut. They are
    found by their position in the key and broadcast.
    """
    depth = max(k for _, k in lags.values())
    local = Window.partitionBy(*keys, _SLICE).orderBy(*order)
    whole = local.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    parts = parts.withColumns(
        {name: F.lag(col, k).over(local) for name, (col, k) in lags.items()}
        | {"_rn": F.row_number().over(local), "_size": F.count(F.lit(1)).over(whole)}
    )
    parts = _running_over_slices(parts, keys, order, {_POS: ("sum", F.lit(1))}, n_totals)
    sources = sorted({col for col, _ in lags.values()})
    tails = parts.filter(F.col("_size") - F.col("_rn") < depth).select(*keys, _POS, *sources)
    for k in sorted({k for _, k in lags.values()}):
        names = {name: col for name, (col, j) in lags.items() if j == k}
        back = tails.select(
            *keys, (F.col(_POS) + k).alias(_POS), *[F.col(c).alias(f"_x_{n}") for n, c in names.items()]
        )
        if n_totals * depth <= MAX_BROADCAST_ROWS:
            back = F.broadcast(back)
        parts = join_null_safe(parts, back, [*keys, _POS], "left").withColumns(
            {n: F.when(F.col("_rn") > k, F.col(n)).otherwise(F.col(f"_x_{n}")) for n in names}
        )
        parts = parts.drop(*[f"_x_{n}" for n in names])
    return parts.drop(_POS, "_rn", "_size")


def plain_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    lags: dict[str, tuple[str, int]] | None = None,
    running: dict[str, tuple[str, Column]] | None = None,
    whole: dict[str, Column] | None = None,
) -> DataFrame:
    """The columns of ``ordered_columns`` by windows: one task handles all rows of a key."""
    lags, running, whole = lags or {}, running or {}, whole or {}
    ordered = Window.partitionBy(*keys).orderBy(*order)
    # The same order as the other columns, so that one sort serves them all.
    group = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    first = {name: F.lag(col, k).over(ordered) for name, (col, k) in lags.items()}
    first |= {name: agg.over(group) for name, agg in whole.items()}
    df = df.withColumns(first) if first else df
    then = {name: _MERGE[how](value).over(so_far) for name, (how, value) in running.items()}
    return df.withColumns(then) if then else df


def sliced_columns(
    split: Split,
    keys: list[str],
    order: list[str],
    *,
    lags: dict[str, tuple[str, int]] | None = None,
    running: dict[str, tuple[str, Column]] | None = None,
    whole: dict[str, Column] | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """The columns of ``ordered_columns`` for hot keys, slice by slice."""
    lags, running, whole = lags or {}, running or {}, whole or {}
    rows = split.hot
    if whole:
        stats = rows.groupBy(*keys).agg(*[agg.alias(name) for name, agg in whole.items()])
        if split.n_keys <= MAX_BROADCAST_ROWS:
            stats = F.broadcast(stats)
        rows = join_null_safe(rows, stats, keys, "left")
    parts = _slices(rows, [*keys, *order], split.n_rows, max_key_rows)
    n_totals = _n_slices(split.n_rows, max_key_rows) + split.n_keys
    if lags:
        parts = _lags_over_slices(parts, keys, order, lags, n_totals)
    if running:
        parts = _running_over_slices(parts, keys, order, running, n_totals)
    return parts.drop(_SLICE)


def ordered_columns(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    *,
    lags: dict[str, tuple[str, int]] | None = None,
    running: dict[str, tuple[str, Column]] | None = None,
    whole: dict[str, Column] | None = None,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Add ordered columns per key.

    lags     name -> (column, k): the value k rows back
    whole    name -> aggregate over all rows of the key
    running  name -> ("sum" | "min" | "max" | "last", value): up to and including this row, "last"
             carries the latest value that is not null; the value may use columns added by ``lags``
             and ``whole``

    Without keys the table is one order; it is cut into slices from ``MAX_SINGLE_ROWS`` rows on.
    """
    max_key_rows = max_key_rows if keys else min(max_key_rows, MAX_SINGLE_ROWS)
    if whole and not keys:
        raise ValueError("whole-key aggregates need a key; aggregate the table instead")
    spec = {"lags": lags, "running": running, "whole": whole}
    split = split_hot(df, keys, max_key_rows)
    if split is None:
        return plain_columns(df, keys, order, **spec)
    hot = sliced_columns(split, keys, order, **spec, max_key_rows=max_key_rows)
    if split.cold is None:
        return hot
    return plain_columns(split.cold, keys, order, **spec).unionByName(hot)


def _moments_before(df: DataFrame, keys: list[str], order: list[str], value: str) -> DataFrame:
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return df.withColumns(
        {
            "count_before": F.count(value).over(before),
            "mean_before": F.avg(value).over(before),
            "var_before": F.var_pop(value).over(before),
            "low_before": F.min(value).over(before),
            "high_before": F.max(value).over(before),
        }
    )


def _moments_over_slices(
    split: Split, keys: list[str], order: list[str], value: str, max_key_rows: int
) -> DataFrame:
    """Moments inside each slice merged with those of the earlier slices of the key."""
    parts = _slices(split.hot, [*keys, *order], split.n_rows, max_key_rows)
    n_totals = _n_slices(split.n_rows, max_key_rows) + split.n_keys
    ranked = Window.partitionBy(*keys).orderBy(_SLICE)
    earlier = ranked.rowsBetween(Window.unboundedPreceding, -1)
    totals = parts.groupBy(*keys, _SLICE).agg(
        F.count(value).alias("n"),
        F.avg(value).alias("mean"),
        F.var_pop(value).alias("var"),
        F.min(value).alias("low"),
        F.max(value).alias("high"),
    )
    # Means are taken from the first slice's, which keeps the sums well conditioned.
    totals = totals.withColumn("_c", F.first("mean", ignorenulls=True).over(ranked))
    n, d = F.col("n"), F.col("mean") - F.col("_c")
    before = totals.select(
        *keys,
        _SLICE,
        "_c",
        F.sum(n).over(earlier).alias("_n"),
        F.sum(n * d).over(earlier).alias("_s"),
        F.sum(n * F.col("var") + n * d * d).over(earlier).alias("_q"),
        F.min("low").over(earlier).alias("_low"),
        F.max("high").over(earlier).alias("_high"),
    )
    if n_totals <= MAX_BROADCAST_ROWS:
        before = F.broadcast(before)
    out = join_null_safe(
        _moments_before(parts, [*keys, _SLICE], order, value), before, [*keys, _SLICE], "left"
    )
    na, nb = F.coalesce(F.col("_n"), F.lit(0)).cast("double"), F.col("count_before").cast("double")
    mean_a = F.col("_c") + F.col("_s") / na
    m2_a = F.greatest(F.col("_q") - F.col("_s") * F.col("_s") / na, F.lit(0.0))
    delta = F.col("mean_before") - mean_a
    m2 = m2_a + F.col("var_before") * nb + delta * delta * na * nb / (na + nb)
    merged = {
        "mean_before": F.when(na == 0, F.col("mean_before"))
        .when(nb == 0, mean_a)
        .otherwise(mean_a + delta * nb / (na + nb)),
        "var_before": F.when(na == 0, F.col("var_before"))
        .when(nb == 0, m2_a / na)
        .otherwise(m2 / (na + nb)),
        "count_before": F.col("count_before") + F.coalesce(F.col("_n"), F.lit(0)),
        "low_before": F.least("low_before", "_low"),
        "high_before": F.greatest("high_before", "_high"),
    }
    return out.withColumns(merged).drop(_SLICE, "_c", "_n", "_s", "_q", "_low", "_high")


def running_moments(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    value: str,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Count, mean, population variance, smallest and largest of the key's earlier values."""
    split = split_hot(df, keys, max_key_rows)
    if split is None:
        return _moments_before(df, keys, order, value)
    hot = _moments_over_slices(split, keys, order, value, max_key_rows)
    return _moments_before(split.cold, keys, order, value).unionByName(hot)


def sliding_count(
    df: DataFrame,
    keys: list[str],
    micros: str,
    row_id: str,
    width: int,
    name: str,
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Rows of the key with time in (t - width, t]; ``micros`` is an epoch column.

    A row without a time counts nothing and is counted by none. Row ids may repeat.
    """
    split = split_hot(df, keys, max_key_rows)
    span = Window.partitionBy(*keys).orderBy(micros).rangeBetween(-(width - 1), Window.currentRow)
    in_span = F.when(F.col(micros).isNotNull(), F.count(F.lit(1)).over(span)).otherwise(F.lit(0))
    if split is None:
        return df.withColumn(name, in_span)
    # Hot keys: the count is (rows up to t) - (rows up to t - width). Both are running
    # counts, read by two probe rows per payment that sort after the rows they count.
    t = F.col(micros)
    probes = F.array(
        F.struct(t.alias("at"), F.lit(0).alias("probe")),
        F.struct(t.alias("at"), F.lit(1).alias("probe")),
        F.struct((t - width).alias("at"), F.lit(2).alias("probe")),
    )
    timed = split.hot.filter(F.col(micros).isNotNull())
    marks = timed.select(*keys, row_id, t.alias("_own"), F.inline(probes))
    counted = ordered_columns(
        marks,
        keys,
        ["at", "probe", row_id],
        running={"_upto": ("sum", (F.col("probe") == 0).cast("bigint"))},
        max_key_rows=max_key_rows,
    )
    counts = (
        counted.filter("probe > 0")
        .groupBy(*keys, row_id, F.col("_own").alias(micros))
        .agg(
            (
                F.max(F.when(F.col("probe") == 1, F.col("_upto")))
                - F.max(F.when(F.col("probe") == 2, F.col("_upto")))
            ).alias(name)
        )
    )
    hot = join_null_safe(split.hot, counts, [*keys, row_id, micros], "left")
    hot = hot.withColumn(name, F.coalesce(name, F.lit(0).cast("long")))
    return split.cold.withColumn(name, in_span).unionByName(hot)
