"""Mixing sources to target weights by Sainte-Lague apportionment of equal-token blocks.

1. Each source's target is its share of the mixture by weight, at most ``max_repeats`` times
   its size; what a full source cannot take is reshared by weight (water filling).
2. The mixture is a number of blocks of ``block_tokens`` words. Blocks go to sources by highest
   quotient target / (2k + 1), and within a source to its shards by the shards' sizes.
3. Every shard lays out its documents in a seeded order and takes its quota of blocks, from a
   seeded block onwards, around its end if need be. A document's ``taken`` is its overlap with
   the blocks taken.

Shards split a source that holds most rows; a shard's running total is the only window over
documents. The highest quotients need no list of all blocks: a divisor slightly too large
gives all but a few blocks, and only the last candidates (at most five per party) are ranked.

Nulls and edge cases: a null text has size 0, null sources are one source, sorted last; a null
id is ordered by the empty text; repeated rows are documents of their own, told apart by their
place in the order; an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.llm.shared import seen_as, stored, within, word_count

BLOCK_TOKENS = 64
SHARD_TOKENS = 100_000
MAX_SHARDS = 4096  # of one source; larger sources have larger shards
MAX_SOURCES = 100_000  # broadcast bound, about 100 bytes each
SEED = 17


def water_fill(sources: DataFrame, share: float, max_repeats: int) -> DataFrame:
    """Adds ``target`` to rows of (source, source_size, weight, rank).

    In the order of size per weight the full sources come first; each row compares its cap with
    what the level would be if it and all later sources shared what is left. The first source that
    stays below its cap has the true level; later ones, which assume more full sources, lower ones.
    """
    cap = F.col("source_size") * max_repeats
    order = Window.orderBy(cap / F.col("weight"), "rank")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everyone = Window.partitionBy()
    left = F.sum("source_size").over(everyone) * share - F.coalesce(F.sum(cap).over(before), F.lit(0))
    level = left / F.sum("weight").over(after)
    lifted = sources.withColumns({"_cap": cap.cast("double"), "_level": level})
    free = F.when(F.col("_cap") >= F.col("weight") * F.col("_level"), F.col("_level"))
    return (
        lifted.withColumn("_open", F.max(free).over(everyone))
        .withColumn("target", F.least("_cap", F.coalesce(F.col("weight") * F.col("_open"), F.col("_cap"))))
        .drop("_cap", "_level", "_open")
    )


def sainte_lague(parties: DataFrame, group: list[str], weight: str, seats: Column, tie: str) -> DataFrame:
    """Adds ``quota``: the seats of each group dealt to its parties by highest quotients.

    With W the group's weight and m its parties, a party gets at least floor(w (N - m) / W) and
    at most w (N + m) / W + 1.5 of N seats, so only the seats between have to be ranked.
    """
    within_group = Window.partitionBy(*group)
    share = F.col(weight) / F.sum(weight).over(within_group)
    low = F.floor(share * (F.col("_seats") - F.col("_m")))
    high = F.floor(share * (F.col("_seats") + F.col("_m")) + 0.5) + 1
    bounded = (
        parties.filter(F.col(weight) > 0)
        .withColumns({"_seats": seats.cast("long"), "_m": F.count(F.lit(1)).over(within_group)})
        .withColumns({"_low": F.greatest(low, F.lit(0)), "_high": F.greatest(high, F.lit(0))})
        .withColumn("_rest", F.col("_seats") - F.sum("_low").over(within_group))
    )
    seat = F.explode(F.sequence(F.col("_low") + 1, F.greatest(F.col("_high"), F.col("_low") + 1)))
    quotient = F.col(weight) / (2 * F.col("_seat") - 1)
    ranked = bounded.withColumn("_seat", seat).withColumn(
        "_place", F.row_number().over(within_group.orderBy(quotient.desc(), tie))
    )
    won = F.count(F.when(F.col("_place") <= F.col("_rest"), 1))
    names = list(dict.fromkeys([*group, *parties.columns]))
    return (
        ranked.groupBy(*names, "_low").agg(won.alias("_won"))
        .withColumn("quota", F.col("_low") + F.col("_won"))
        .drop("_low", "_won")
    )


def mix_sources(
    documents: DataFrame,
    weights: tuple[float, ...] = (3, 1, 2),
    share: float = 1.5,
    max_repeats: int = 2,
    block_tokens: int = BLOCK_TOKENS,
    seed: int = SEED,
) -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken.

    ``weights`` are given to the sources in code-point order, null last, repeating.
    """
    mark = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(f":{seed}")))
    sizes = stored(
        documents.select("doc_id", "source", word_count(F.col("text")).alias("size"), mark.alias("mark")),
        "sizes",
    )
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    rank = F.row_number().over(Window.orderBy(F.col("source").isNull(), "source")) - 1
    weight = F.element_at(F.lit(list(map(float, weights))), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = water_fill(totals.withColumn("rank", rank).withColumn("weight", weight), share, max_repeats)
    blocks = F.floor(F.sum("target").over(Window.partitionBy()) / block_tokens + 0.5)
    shards = F.least(F.ceil(F.col("source_size") / SHARD_TOKENS), F.lit(MAX_SHARDS))
    quotas = sainte_lague(sources, [], "target", blocks, "rank").select("rank", F.col("quota").alias("n_blocks"))
    sources = stored(
        sources.join(quotas, "rank", "left")
        .fillna(0, ["n_blocks"])
        .withColumn("n_shards", F.greatest(shards, F.lit(1)))
        .select("source", "rank", "source_size", "target", "n_blocks", "n_shards"),
        "sources",
    )
    side = seen_as(sources.withColumnRenamed("source", "_source"), sources)
    if within(side, MAX_SOURCES):
        side = F.broadcast(side)
    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("long")
    dealt = sizes.join(side, F.col("source").eqNullSafe(F.col("_source"))).withColumn(
        "shard", number % F.col("n_shards")
    )
    shard_sizes = dealt.groupBy("rank", "shard").agg(
        F.sum("size").alias("shard_size"), F.first("n_blocks").alias("n_blocks")
    )
    start = F.md5(F.concat_ws(":", "rank", "shard", F.lit(seed)))
    start = F.conv(F.substring(start, 1, 8), 16, 10).cast("long")
    n_starts = F.ceil(F.col("shard_size") / block_tokens)
    shard_quotas = stored(
        sainte_lague(shard_sizes, ["rank"], "shard_size", F.col("n_blocks"), "shard").select(
            "rank",
            "shard",
            "shard_size",
            F.least(F.col("quota") * block_tokens, F.col("shard_size") * max_repeats).alias("wanted"),
            (start % n_starts * block_tokens).alias("start"),
        ),
        "quotas",
    )
    order = Window.partitionBy("rank", "shard").orderBy("mark", "doc_id", "size")
    placed = dealt.withColumn("end", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    few = F.broadcast(shard_quotas) if within(shard_quotas, MAX_SOURCES) else shard_quotas
    placed = placed.join(few, ["rank", "shard"], "left").withColumns(
        {
            "begin": F.col("end") - F.col("size"),
            "rest": F.col("wanted") % F.col("shard_size"),
            "full": F.floor(F.col("wanted") / F.col("shard_size")),
        }
    )

    def overlap(a: Column, b: Column) -> Column:
        both = F.least(F.col("end"), b) - F.greatest(F.col("begin"), a)
        return F.greatest(both, F.lit(0))

    stop = F.col("start") + F.col("rest")
    taken = (
        F.col("full") * F.col("size")
        + overlap(F.col("start"), F.least(stop, F.col("shard_size")))
        + overlap(F.lit(0), stop - F.col("shard_size"))
    )
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        F.coalesce(taken, F.lit(0)).cast("long").alias("taken"),
    )


def op9_mix_sources(spark, sf_dir):
    return mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet")).drop("source")


SQL = r"""
WITH s AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
         md5(coalesce(doc_id::VARCHAR, '') || ':17') AS mark
  FROM documents),
t AS (SELECT source, sum(size)::BIGINT AS source_size FROM s GROUP BY source),
w AS (
  SELECT *, row_number() OVER (ORDER BY source IS NULL, source) - 1 AS rank FROM t),
v AS (SELECT *, ([3.0::DOUBLE, 1.0, 2.0])[(rank % 3 + 1)::INT] AS weight, source_size * 2 AS cap FROM w),
l AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE * 1.5 - coalesce((sum(cap) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE, 0))
            / sum(weight) OVER (ORDER BY cap / weight, rank
                ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM v),
o AS (SELECT *, max(CASE WHEN cap >= weight * level THEN level END) OVER () AS open FROM l),
g AS (SELECT *, least(cap::DOUBLE, coalesce(weight * open, cap::DOUBLE)) AS target FROM o),
n AS (SELECT *, floor(sum(target) OVER () / 64 + 0.5)::BIGINT AS seats, count(*) FILTER (target > 0) OVER () AS m,
             sum(target) OVER () AS total FROM g),
b AS (SELECT *, greatest(floor(target / total * (seats - m)), 0)::BIGINT AS low,
             (floor(target / total * (seats + m) + 0.5) + 1)::BIGINT AS high FROM n WHERE target > 0),
c AS (SELECT rank, target, seats - sum(low) OVER () AS rest, unnest(range(low + 1, greatest(high, low + 1) + 1)) AS seat
      FROM b),
p AS (SELECT rank, rest, row_number() OVER (ORDER BY target / (2 * seat - 1) DESC, rank) AS place FROM c),
q AS (SELECT b.rank, any_value(low) + count(*) FILTER (place <= rest) AS n_blocks
      FROM b JOIN p ON b.rank = p.rank GROUP BY b.rank),
src AS (SELECT g.*, coalesce(n_blocks, 0) AS n_blocks,
               greatest(least(ceil(source_size / 100000), 4096), 1)::BIGINT AS n_shards
        FROM g LEFT JOIN q USING (rank)),
d AS (SELECT s.doc_id, s.size, s.mark, src.rank, src.source_size, src.target, src.n_blocks,
             ('0x' || mark[1:8])::BIGINT % n_shards AS shard
      FROM s JOIN src ON s.source IS NOT DISTINCT FROM src.source),
h AS (SELECT rank, shard, sum(size)::BIGINT AS shard_size, any_value(n_blocks) AS seats FROM d GROUP BY rank, shard),
h2 AS (SELECT *, count(*) OVER (PARTITION BY rank) AS m, sum(shard_size) OVER (PARTITION BY rank) AS total
       FROM h WHERE shard_size > 0),
h3 AS (SELECT *, greatest(floor(shard_size / total * (seats - m)), 0)::BIGINT AS low,
              greatest(floor(shard_size / total * (seats + m) + 0.5) + 1, 0)::BIGINT AS high FROM h2),
h4 AS (SELECT rank, shard, shard_size, seats - sum(low) OVER (PARTITION BY rank) AS rest, low, high FROM h3),
h5 AS (SELECT *, unnest(range(low + 1, greatest(high, low + 1) + 1)) AS seat FROM h4),
h6 AS (SELECT *, row_number() OVER (PARTITION BY rank ORDER BY shard_size / (2 * seat - 1) DESC, shard) AS place FROM h5),
z AS (SELECT rank, shard, shard_size,
             least((low + count(*) FILTER (place <= rest)) * 64, shard_size * 2) AS wanted,
             ('0x' || md5(rank || ':' || shard || ':17')[1:8])::BIGINT % ceil(shard_size / 64)::BIGINT * 64 AS start
      FROM h6 GROUP BY rank, shard, shard_size, low),
e AS (SELECT *, sum(size) OVER (PARTITION BY rank, shard ORDER BY mark, doc_id, size
                                ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)::BIGINT AS stop FROM d),
f AS (SELECT e.*, z.shard_size, z.start, wanted // z.shard_size AS full_turns,
             z.start + wanted % z.shard_size AS until
      FROM e LEFT JOIN z ON e.rank = z.rank AND e.shard = z.shard)
SELECT doc_id, size::BIGINT AS size, source_size, target,
       coalesce(full_turns * size
         + greatest(least(stop, until, shard_size) - greatest(stop - size, start), 0)
         + greatest(least(stop, until - shard_size) - (stop - size), 0), 0)::BIGINT AS taken
FROM f
"""
