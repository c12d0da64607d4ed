"""Hard-negative mining with exact integer inner products by Kronecker packing.

Components become integers, floor(``scale`` * x). The candidates of a block are biased to be at least zero
and laid out, one dimension at a time, as fields of one wide integer. For an anchor every wide integer is
multiplied once, by the anchor's component of that dimension; the sum holds the inner products with all
candidates of the block, each in its own field. A field is wide enough for the largest sum the block and
its anchors can give, so no carry ever reaches a neighbour and the scores are exact.

The query set (``anchors``) is laid against all rows in a grid of blocks: ``ANCHORS`` anchors and
``CANDIDATES`` candidates a cell, dealt by a row number that is fixed when the rows are stored. So the cells are
of one size whatever the labels and ids are. The first pass over the grid gives each anchor's positives, the
second, with the windows that their scores set, its negatives; a cell passes on only as many of
each as can be returned.

Nulls and edge cases: rows with a null label, a null vector, or a null, NaN or infinite component take no
part; missing last components of shorter vectors count as zero; a row with a null id is no anchor and comes last
among ties; rows that repeat an id are rows of their own, and positives or negatives of each other; an
anchor without positives and a positive without negatives give no rows; components and scores beyond the
range of a long count as its ends; an empty table gives an empty result; other columns are not looked at.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.llm.shared import id_or_last, id_or_null, n_rows, read_table, stored

ANCHORS = 4096  # of a cell
CANDIDATES = 8192  # of a cell
SCALE = 256
POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90  # per cent of the positive's score

_LEAST, _MOST = -(2**63), 2**63 - 1


class Packed:
    """Vectors packed for products with any vector whose absolute components sum to ``reach`` at most."""

    def __init__(self, vectors: np.ndarray, reach: int):
        self.n = len(vectors)
        low, high = (int(vectors.min()), int(vectors.max())) if vectors.size else (0, 0)
        self.bias = max(0, -low)
        self.top = high + self.bias
        self.width = next(w for w in (4, 8, 16, 24) if 4 * reach * max(self.top, self.bias) < 1 << 8 * w)
        self.ones = int.from_bytes((b"\1" + bytes(self.width - 1)) * self.n, "little")
        self.columns = [int.from_bytes(self._fields(v), "little") for v in vectors.T]

    def _fields(self, column: np.ndarray) -> bytes:
        if self.width <= 8:
            return (column + self.bias).astype(f"<u{self.width}").tobytes()
        return b"".join((int(v) + self.bias).to_bytes(self.width, "little") for v in column)

    def scores(self, anchor: np.ndarray) -> np.ndarray:
        """Inner products with all packed vectors, as longs."""
        parts = [int(a) for a in anchor]
        offset = sum(map(abs, parts)) * self.top  # keeps every field at zero or more
        total = offset * self.ones
        for a, column in zip(parts, self.columns):
            if a:
                total += a * column
        data = total.to_bytes(self.n * self.width, "little")
        back = offset + self.bias * sum(parts)
        if self.width == 4:
            return np.frombuffer(data, "<u4").astype(np.int64) - back
        fields = (data[i : i + self.width] for i in range(0, len(data), self.width))
        if self.width == 8:
            return np.frombuffer(data, "<i8") - back
        return np.array([min(max(int.from_bytes(f, "little") - back, _LEAST), _MOST) for f in fields], np.int64)


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    lists = column.combine_chunks()
    sizes = np.diff(lists.offsets.to_numpy())
    out = np.zeros((len(lists), width), np.int64)
    out[np.arange(width) < sizes[:, None]] = lists.flatten().to_numpy()
    return out


def _width(*tables: pa.Table) -> int:
    return max((int(np.diff(c.offsets.to_numpy()).max()) for t in tables for c in t.column("x").chunks if len(c)), default=0)


def _packed(anchors: pa.Table, rows: pa.Table) -> tuple[np.ndarray, Packed]:
    width = _width(anchors, rows)
    x = _matrix(anchors.column("x"), width)
    reach = max((sum(abs(int(v)) for v in a) for a in x), default=0)
    return x, Packed(_matrix(rows.column("x"), width), reach)


def first_of(at: np.ndarray, scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """The ``k`` places of ``at`` with the highest scores, ties by smaller id."""
    if len(at) > k:
        s = scores[at]
        at = at[s >= np.partition(s, len(s) - k)[len(s) - k]]
    return at[np.lexsort((ids[at], ~scores[at]))][:k]  # ~s falls as s rises, without overflow


_BEST = "n long, other long, other_id long, score long"
_FOUND = "n long, other long, negative_id long, score long"


def _positives(k: int):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        x, packed = _packed(anchors, rows)
        number, ids, label = (rows.column(c).to_numpy() for c in ("n", "id", "label"))
        out = [np.zeros((0, 4), np.int64)]
        for a, n, own in zip(x, anchors.column("n").to_pylist(), anchors.column("label").to_pylist()):
            scores = packed.scores(a)
            best = first_of(np.flatnonzero((label == own) & (number != n)), scores, ids, k)
            out.append(np.column_stack([np.full(len(best), n), number[best], ids[best], scores[best]]))
        return _table(out, _BEST)

    return find


def _negatives(k: int, low: int, high: int):
    def find(anchors: pa.Table, rows: pa.Table) -> pa.Table:
        x, packed = _packed(anchors, rows)
        ids, label = (rows.column(c).to_numpy() for c in ("id", "label"))
        out = [np.zeros((0, 4), np.int64)]
        for a, n, own, windows in zip(x, *(anchors.column(c).to_pylist() for c in ("n", "label", "windows"))):
            scores = packed.scores(a)
            other = np.flatnonzero(label != own)
            s = scores[other]
            for w in windows:
                least, most = -(-low * w["score"] // 100), high * w["score"] // 100
                best = first_of(other[(s >= least) & (s <= most)], scores, ids, k)
                out.append(np.column_stack([np.full(len(best), n), np.full(len(best), w["other"]), ids[best], scores[best]]))
        return _table(out, _FOUND)

    return find


def _table(parts: list[np.ndarray], kind: str) -> pa.Table:
    rows = np.concatenate(parts).astype(np.int64)
    return pa.table({name.split()[0]: rows[:, i] for i, name in enumerate(kind.split(", "))})


def integers(vector: Column, scale: int = SCALE) -> Column:
    return F.transform(vector, lambda x: F.floor(scale * x.cast("double")))


def _usable(vector: Column) -> Column:
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(finite(x.cast("double")), F.lit(False)))


def mine_hard_negatives(
    rows: DataFrame,
    anchor: Column,
    vector: str = "embedding",
    label: Column | str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: int = SCALE,
    row_id: str = "vec_id",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``anchor`` says which rows are anchors. The negatives of an anchor and one of its positives are rows of
    other labels with a score from ``low`` to ``high`` per cent of the positive's.
    """
    label = F.col(label) if isinstance(label, str) else label
    table = rows.select(
        F.monotonically_increasing_id().alias("n"),
        id_or_last(row_id).alias("id"),
        label.cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        F.when(_usable(F.col(vector)), integers(F.col(vector), scale)).alias("x"),
    ).filter("x IS NOT NULL AND label IS NOT NULL")
    table = stored(table, "vectors", n_anchors=F.count_if("anchor"))
    high_blocks = max(1, -(-(table.seen.get("n_anchors") or 0) // ANCHORS))
    wide_blocks = max(1, -(-n_rows(table) // CANDIDATES))

    def dealt(df: DataFrame, blocks: int, own: str, others: int, other: str) -> DataFrame:
        copies = F.explode(F.sequence(F.lit(0), F.lit(others - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64("n"), F.lit(blocks)).cast("int")).withColumn(other, copies)

    cells = dealt(table.select("n", "id", "label", "x"), wide_blocks, "c", high_blocks, "a").groupBy("a", "c")

    def over_grid(queries: DataFrame, find, kind: str) -> DataFrame:
        laid = dealt(queries, high_blocks, "a", wide_blocks, "c").groupBy("a", "c")
        return laid.cogroup(cells).applyInArrow(find, kind)

    def first(found: DataFrame, keys: list[str], tie: str, k: int) -> DataFrame:
        order = Window.partitionBy(*keys).orderBy(F.col("score").desc(), tie)
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)

    queries = table.filter("anchor").select("n", "id", "label", "x")
    best = first(over_grid(queries.select("n", "label", "x"), _positives(positives), _BEST), ["n"], "other_id", positives)
    best = stored(best.drop("rank"), "positives")
    windows = best.groupBy("n").agg(F.collect_list(F.struct("other", "score")).alias("windows"))
    queries = stored(queries.join(windows, "n"), "anchors")
    found = over_grid(queries.select("n", "label", "x", "windows"), _negatives(negatives, low, high), _FOUND)
    found = first(found, ["n", "other"], "negative_id", negatives)
    pairs = best.withColumnRenamed("score", "positive_score").join(queries.select("n", "id"), "n")
    return found.join(pairs, ["n", "other"]).select(
        F.col("id").alias("anchor_id"),
        id_or_null("other_id").alias("positive_id"),
        "rank",
        id_or_null("negative_id").alias("negative_id"),
        "positive_score",
        F.col("score").alias("negative_score"),
    )


def op11_hard_negatives(spark, sf_dir):
    rows = read_table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(rows, F.col("vec_id") % 100 == 0, label=label)


SQL = r"""
WITH r AS (
  SELECT row_number() OVER () AS n, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
        AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)),
s AS (
  SELECT a.n AS an, a.vec_id AS anchor_id, b.n AS bn, b.vec_id AS other_id, a.label = b.label AS same,
         coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda p: coalesce(p[1] * p[2], 0))), 0)::BIGINT AS score
  FROM r a JOIN r b ON a.n <> b.n WHERE a.vec_id % 100 = 0),
p AS (
  SELECT an, anchor_id, bn AS pn, other_id AS positive_id, score AS positive_score
  FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY an ORDER BY score DESC, other_id NULLS LAST) <= 5)
SELECT p.anchor_id, positive_id,
       (row_number() OVER (PARTITION BY p.an, pn ORDER BY score DESC, other_id NULLS LAST))::INT AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s ON p.an = s.an
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""
