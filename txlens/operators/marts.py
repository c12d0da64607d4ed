"""Geography marts: staging joins, official state and district, district summary."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.functions.cells import cell_parent
from txlens.functions.hashing import hash_int, hash_uniform
from txlens.functions.names import clean_pincode, normalize_city
from txlens.operators.ordered import (
    MAX_KEY_ROWS,
    join_entities,
    join_unique,
    ordered_columns,
    sized_broadcast,
)
from txlens.operators.spatial import shape_index, spatial_join
from txlens.sources import lookups
from txlens.sources.tables import stage


def stage_merchants(raw: DataFrame, categories: DataFrame) -> DataFrame:
    """Standard category and risk level by shop kind; unknown kinds are low-risk retail."""
    side = sized_broadcast(
        categories.select(
            F.trim(F.lower("sub_category")).alias("_kind"), "standardized_category", "risk_level"
        )
    )
    return raw.join(side, F.trim(F.lower("sub_category")) == F.col("_kind"), "left").select(
        "osm_id",
        "h3_index",
        F.col("name").alias("merchant_name"),
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "city",
        "postcode",
        "state",
        F.coalesce("standardized_category", F.lit("GENERAL_RETAIL")).alias("merchant_category"),
        F.coalesce("risk_level", F.lit("LOW")).alias("risk_level"),
    )


def stage_residential(raw: DataFrame, states: DataFrame) -> DataFrame:
    """Standard state name: lookup, else the raw name, else 'Unknown'.

    A key listed twice in ``states`` doubles its rows; pass ``unique_lookup(states, "raw_name")``
    for one row per node.
    """
    side = sized_broadcast(states.select(F.trim(F.upper("raw_name")).alias("_raw"), "clean_name"))
    return raw.join(side, F.trim(F.upper("state")) == F.col("_raw"), "left").select(
        "osm_id",
        "h3_index",
        F.col("lat").alias("latitude"),
        F.col("lon").alias("longitude"),
        "city",
        "postcode",
        F.coalesce("clean_name", "state", F.lit("Unknown")).alias("state_standardized"),
    )


def boundary_layers(states: DataFrame, districts: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Cell indexes of the official state and district outlines, shared by both marts."""
    return (
        shape_index(states.select(F.col("st_nm").alias("_state"), "rings")),
        shape_index(districts.select(F.col("district").alias("district_name"), "rings")),
    )


def _official(staged: DataFrame, layers: tuple[DataFrame, DataFrame]) -> DataFrame:
    """Official state and district from the boundary layers."""
    for layer in layers:
        staged = spatial_join(staged, layer)
    return staged


def _place() -> list[Column]:
    return [
        normalize_city(F.col("city")).alias("city"),
        clean_pincode(F.col("postcode")).alias("pincode"),
        F.col("_state").alias("state"),
        F.col("district_name"),
    ]


def mart_merchants(staged: DataFrame, layers: tuple[DataFrame, DataFrame]) -> DataFrame:
    return _official(staged, layers).select(
        "osm_id", "h3_index", "latitude", "longitude", "merchant_name", "merchant_category",
        "risk_level", *_place(),
    )


def mart_residential(staged: DataFrame, layers: tuple[DataFrame, DataFrame]) -> DataFrame:
    return _official(staged, layers).select(
        "osm_id", "h3_index", "latitude", "longitude", *_place()
    )


def district_summary(residential: DataFrame, merchants: DataFrame) -> DataFrame:
    """Node counts per district from both marts; null places never match each other."""
    homes = residential.groupBy("state", "district_name").agg(
        F.count(F.lit(1)).alias("residential_nodes")
    )
    shops = merchants.groupBy("state", "district_name").agg(
        F.count(F.lit(1)).alias("merchant_nodes"),
        F.count_if(F.col("risk_level") == "VERY_HIGH").alias("high_risk_merchants"),
        F.count_if(F.col("risk_level") == "HIGH").alias("medium_high_risk_merchants"),
    )
    counts = [
        "residential_nodes", "merchant_nodes", "high_risk_merchants", "medium_high_risk_merchants",
    ]
    joined = homes.join(shops, ["state", "district_name"], "full_outer").na.fill(0, counts)
    homes_n, shops_n = F.col("residential_nodes"), F.col("merchant_nodes")
    ratio = F.when(
        homes_n > 0,
        F.round(shops_n.cast("decimal(20,0)") / F.when(homes_n > 0, homes_n).cast("decimal(20,0)"), 2),
    ).otherwise(F.lit(0))
    return joined.withColumn(
        "merchant_to_residential_ratio", ratio.cast("decimal(20,2)")
    ).orderBy("state", F.desc("merchant_nodes"))


def mcc_enrich(df: DataFrame, category: str = "merchant_category") -> DataFrame:
    """Merchant category code by category; the 17-row table is fixed, so it is broadcast."""
    codes = F.broadcast(lookups.merchant_codes(df.sparkSession))
    return (
        df.join(codes.withColumnRenamed("category", "_category"), F.col(category) == F.col("_category"), "left")
        .withColumn("mcc", F.coalesce("mcc", F.lit(lookups.DEFAULT_MERCHANT_CODE)))
        .drop("_category")
    )


# --- locality -----------------------------------------------------------------------

TIERS = ["cell6", "cell4", "state"]


def _tiers(state: str) -> dict[str, Column]:
    return {
        "cell6": cell_parent(F.col("h3_index"), 6),
        "cell4": cell_parent(F.col("h3_index"), 4),
        "state": F.col(state),
    }


def locality_index(merchants: DataFrame, state: str = "state") -> DataFrame:
    """Merchants per locality: fine cell, coarse cell and state in one pass.

    Counts only; listing the members of a large state would build one huge row.
    """
    pairs = F.array(
        *[F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in _tiers(state).items()]
    )
    return (
        merchants.select(F.inline(pairs))
        .filter(F.col("key").isNotNull())
        .groupBy("tier", "key")
        .agg(F.count(F.lit(1)).alias("merchants"))
    )


def locality_match(
    residents: DataFrame,
    index: DataFrame,
    state: str = "state",
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Nearest tier that has merchants for each resident, else 'global'.

    The index is stored first: three joins read it, and it must not be counted three times. So are
    the residents, which are read for the sizes of their localities and then joined.
    """
    tiers = _tiers(state)
    index, _ = stage(index, "locality")
    out, _ = stage(residents.withColumns({f"_{t}": key for t, key in tiers.items()}), "residents")
    sides = []
    for tier in TIERS:
        side = index.filter(F.col("tier") == tier).select(
            F.col("key").alias(f"_{tier}"), F.col("merchants").alias(f"{tier}_merchants")
        )
        sides.append((side, [f"_{tier}"]))
    out = join_entities(out, sides, max_key_rows=max_key_rows)
    best = F.coalesce(
        *[F.when(F.col(f"{t}_merchants") > 0, F.lit(t)) for t in TIERS], F.lit("global")
    )
    return out.withColumn("match_tier", best).drop(*[f"_{t}" for t in TIERS])


# How often a merchant is drawn from each tier; the rest is drawn from all merchants.
TIER_SHARES = {"cell6": 0.80, "cell4": 0.15, "state": 0.03}
EVERYWHERE = "global"


def locality_places(
    merchants: DataFrame, merchant: str = "osm_id", state: str = "state", *, max_key_rows: int = MAX_KEY_ROWS
) -> DataFrame:
    """(tier, key, place, merchant): every merchant's place from 0 on in each of its localities and in the whole.

    Places are running counts, cut into slices for a locality (the whole, above all) with very many merchants;
    no list of members is built.
    """
    keys = {**_tiers(state), EVERYWHERE: F.lit("")}
    pairs = F.array(*[F.struct(F.lit(t).alias("tier"), k.alias("key")) for t, k in keys.items()])
    rows = merchants.select(F.col(merchant).alias("merchant"), F.inline(pairs)).filter(F.col("key").isNotNull())
    rows, _ = stage(rows, "localities")  # counted per locality, then placed
    placed = ordered_columns(
        rows, ["tier", "key"], ["merchant"], running={"place": ("sum", F.lit(1))}, max_key_rows=max_key_rows
    )
    return placed.withColumn("place", F.col("place") - 1)


def draw_merchant(
    residents: DataFrame,
    places: DataFrame,
    key: str = "osm_id",
    state: str = "state",
    seed: str = "draw",
    *,
    max_key_rows: int = MAX_KEY_ROWS,
) -> DataFrame:
    """Adds drawn_tier, tier and merchant: a merchant from the resident's drawn tier, or from all if that is empty.

    The place drawn is a hash modulo the number of merchants there, looked up by equality.
    """
    u = hash_uniform(F.col(key), f"{seed}-tier")
    tier, local, upto = F.lit(EVERYWHERE), F.lit(""), sum(TIER_SHARES.values())
    for name in reversed(TIER_SHARES):
        tier = F.when(u < upto, F.lit(name)).otherwise(tier)
        local = F.when(u < upto, _tiers(state)[name]).otherwise(local)
        upto = round(upto - TIER_SHARES[name], 6)
    drawn, _ = stage(residents.withColumns({"drawn_tier": tier, "_tier": tier, "_key": local}), "residents")
    places, seen = stage(places, "places", merchants=F.count_if(F.col("tier") == EVERYWHERE))
    every = F.lit(seen.get("merchants") or None).cast("long")
    sizes, _ = stage(places.groupBy("tier", "key").agg(F.count(F.lit(1)).alias("n")), "sizes")
    named = {"tier": "_tier", "key": "_key", "n": "_n"}
    drawn = join_unique(drawn, sizes.withColumnsRenamed(named), ["_tier", "_key"], max_key_rows=max_key_rows)
    empty = F.col("_n").isNull()
    drawn = drawn.withColumns(
        {
            "_tier": F.when(empty, EVERYWHERE).otherwise(F.col("_tier")),
            "_key": F.when(empty, "").otherwise(F.col("_key")),
            "_place": hash_int(F.col(key), f"{seed}-place") % F.coalesce(F.col("_n"), every),
        }
    )
    side = places.withColumnsRenamed({"tier": "_tier", "key": "_key", "place": "_place"})
    out = join_unique(drawn, side, ["_tier", "_key", "_place"], max_key_rows=max_key_rows)
    return out.withColumnRenamed("_tier", "tier").drop("_key", "_place", "_n")
