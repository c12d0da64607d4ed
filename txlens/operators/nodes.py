"""Map nodes and admin relations: classification, counts and district lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from txlens.functions.cells import location_cell
from txlens.functions.names import title_words
from txlens.operators.ordered import MAX_KEY_ROWS, ordered_columns
from txlens.sources import lookups

# Tag values that make a node a merchant or a bank.
MERCHANT_AMENITIES = [
    "restaurant", "cafe", "fast_food", "bar", "pub", "fuel", "cinema", "pharmacy",
]
MERCHANT_TOURISM = ["hotel", "motel", "guest_house"]
FINANCIAL_AMENITIES = ["atm", "bank"]


def _tag(name: str) -> Column:
    return F.col("tags")[name]


def classify_nodes(nodes: DataFrame) -> DataFrame:
    """Merchant category, financial kind and residential flag of each valid node.

    The tag map is unpacked here once; the three outputs below only filter and project. A node without a cell id
    gets the square cell of its coordinates.
    """
    shop, amenity, tourism = _tag("shop"), _tag("amenity"), _tag("tourism")
    # A present but unlisted amenity hides the tourism tag.
    category = (
        F.when(shop.isNotNull(), "shop")
        .when(amenity.isNotNull(), F.when(amenity.isin(MERCHANT_AMENITIES), "amenity"))
        .when(tourism.isin(MERCHANT_TOURISM), "tourism")
    )
    has_address = _tag("addr:housenumber").isNotNull() | _tag("addr:street").isNotNull()
    homes = F.coalesce(_tag("building") == "residential", F.lit(False)) | F.coalesce(
        _tag("landuse") == "residential", F.lit(False)
    )
    cell = location_cell(F.col("lat"), F.col("lon"))
    if "h3_index" in nodes.columns:
        cell = F.coalesce("h3_index", cell)
    valid = F.col("lat").between(-90, 90) & F.col("lon").between(-180, 180)
    chosen = (
        F.when(F.col("category") == "shop", shop)
        .when(F.col("category") == "amenity", amenity)
        .when(F.col("category") == "tourism", tourism)
    )
    return (
        nodes.filter(valid)
        .withColumn("category", category)
        .select(
            F.col("id").alias("osm_id"),
            cell.alias("h3_index"),
            "lat",
            "lon",
            F.coalesce(_tag("name"), F.lit("Unknown Merchant")).alias("name"),
            F.coalesce(_tag("operator"), _tag("brand")).alias("operator"),
            "category",
            chosen.alias("sub_category"),
            F.when(amenity.isin(FINANCIAL_AMENITIES), amenity).alias("kind"),
            (F.col("category").isNull() & (homes | has_address)).alias("is_residential"),
            _tag("addr:city").alias("city"),
            _tag("addr:postcode").alias("postcode"),
            _tag("addr:state").alias("state"),
        )
    )


_POSITION = ["osm_id", "h3_index", "lat", "lon"]
_ADDRESS = ["city", "postcode", "state"]


def financial_nodes(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("kind").isNotNull()).select(
        *_POSITION, "kind", "operator", *_ADDRESS
    )


def merchant_nodes(classified: DataFrame) -> DataFrame:
    return classified.filter(F.col("category").isNotNull()).select(
        *_POSITION, "name", "category", "sub_category", *_ADDRESS
    )


def residential_nodes(classified: DataFrame) -> DataFrame:
    return classified.filter("is_residential").select(*_POSITION, *_ADDRESS)


def node_roles(classified: DataFrame) -> DataFrame:
    """One row per (node, role); a node can be financial and merchant at once."""
    roles = F.array_compact(
        F.array(
            F.when(F.col("kind").isNotNull(), "financial"),
            F.when(F.col("category").isNotNull(), "merchant"),
            F.when(F.col("is_residential"), "residential"),
        )
    )
    return classified.withColumn("role", F.explode(roles))


def city_state_counts(nodes: DataFrame) -> DataFrame:
    """Nodes per (state, city), both trimmed and non-empty."""
    state, city = F.trim(_tag("addr:state")), F.trim(_tag("addr:city"))
    return (
        nodes.select(state.alias("state"), city.alias("city"))
        .filter((F.col("state") != "") & (F.col("city") != ""))
        .groupBy("state", "city")
        .agg(F.count(F.lit(1)).alias("nodes"))
    )


def state_totals(counts: DataFrame) -> DataFrame:
    """Cities and nodes per state, for report headings."""
    return counts.groupBy("state").agg(
        F.count(F.lit(1)).alias("unique_cities"), F.sum("nodes").alias("total_nodes")
    )


def report_order(counts: DataFrame) -> DataFrame:
    """Report order: states by name, cities by falling count."""
    return counts.orderBy("state", F.desc("nodes"), "city")


_HEADER, _LINE = "State: ", r"^- (.*): ([0-9]+)$"


def write_report(counts: DataFrame, path: str) -> None:
    """The counts as text, in report order: a heading for each state, then a line for each city."""
    rank = Window.partitionBy("state").orderBy(F.desc("nodes"), "city")
    first = report_order(counts.withColumn("_first", F.row_number().over(rank) == 1))
    heading = F.when(F.col("_first"), F.concat(F.lit(_HEADER), "state"))
    line = F.concat(F.lit("- "), "city", F.lit(": "), F.col("nodes").cast("string"))
    first.select(F.explode(F.array_compact(F.array(heading, line))).alias("value")).write.mode("overwrite").text(path)


def read_report(spark: SparkSession, path: str, *, max_key_rows: int = MAX_KEY_ROWS) -> DataFrame:
    """(state, city, nodes) of a report: a line belongs to the last heading before it.

    Lines are ordered by file, by the file's split and within it, so a heading is carried over splits and files;
    long reports are cut into slices, each of which takes the last heading of the slices before.
    """
    lines = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_start"),
        F.monotonically_increasing_id().alias("_at"),
    )
    heading = F.when(F.startswith("value", F.lit(_HEADER)), F.substr("value", F.lit(len(_HEADER) + 1)))
    carried = ordered_columns(
        lines, [], ["_file", "_start", "_at"], running={"state": ("last", heading)}, max_key_rows=max_key_rows
    )
    return carried.filter(F.rlike("value", F.lit(_LINE))).select(
        "state",
        F.regexp_extract("value", _LINE, 1).alias("city"),
        F.regexp_extract("value", _LINE, 2).cast("bigint").alias("nodes"),
    )


def normalize_state(df: DataFrame, column: str, into: str) -> DataFrame:
    """Canonical state name: alias table first, otherwise title words.

    The alias table is a fixed list of 68 rows, so it is always broadcast.
    """
    aliases = F.broadcast(lookups.state_aliases(df.sparkSession))
    return (
        df.join(aliases, F.lower(column) == F.col("alias"), "left")
        .withColumn(into, F.coalesce("canonical", title_words(F.col(column))))
        .drop("alias", "canonical")
    )


def city_state_clean(counts: DataFrame) -> DataFrame:
    """City counts again, after the state names are made canonical."""
    return (
        normalize_state(counts, "state", "state")
        .groupBy("state", "city")
        .agg(F.sum("nodes").alias("nodes"))
    )


def _in_country() -> Column:
    return F.coalesce(_tag("ISO3166-2").startswith("IN-"), F.lit(False)) | F.coalesce(
        _tag("is_in:country_code") == "IN", F.lit(False)
    )


def _district_name() -> Column:
    return F.coalesce(_tag("name"), _tag("name:en"), F.lit("Unnamed District"))


def state_districts(relations: DataFrame) -> DataFrame:
    """District names per state from level-5 relations and their own tags."""
    keys = F.map_keys("tags")
    in_country = (
        _in_country()
        | F.coalesce(_tag("addr:country") == "IN", F.lit(False))
        | F.exists(keys, lambda k: k.startswith("ref:LGD"))
        | F.exists(keys, lambda k: k.startswith("mdds:"))
        | _tag("is_in:state").isNotNull()
    )
    parts = F.split(_tag("ISO3166-2"), "-")
    iso_state = F.when(F.size(parts) >= 2, F.concat_ws("-", parts[0], F.get(parts, F.lit(1))))
    state = F.coalesce(
        _tag("is_in:state"), _tag("addr:state"), iso_state, F.lit("Unknown State")
    )
    return (
        relations.filter(
            (_tag("boundary") == "administrative") & (_tag("admin_level") == "5") & in_country
        )
        .select(state.alias("state"), _district_name().alias("district"))
        .distinct()
    )


def relation_districts(relations: DataFrame) -> DataFrame:
    """District names per state from the member lists of level-4 relations.

    A district listed by two states goes to the first state name, so the result does not
    depend on read order.
    """
    states = relations.filter(
        (_tag("boundary") == "administrative") & (_tag("admin_level") == "4") & _in_country()
    )
    parent = (
        states.select(
            F.coalesce(_tag("name"), F.lit("Unnamed State")).alias("state"),
            F.explode("members").alias("member"),
        )
        .filter(F.col("member.type") == "relation")
        .groupBy(F.col("member.ref").alias("id"))
        .agg(F.min("state").alias("state"))
    )
    return (
        relations.filter(_tag("admin_level") == "5")
        .select("id", _district_name().alias("district"))
        .join(parent, "id")
        .select("state", "district")
        .distinct()
    )


def read_names(df: DataFrame, column: str = "value") -> DataFrame:
    """A list of names: trimmed, lower-cased, non-empty, distinct."""
    name = F.lower(F.trim(column))
    return df.select(name.alias("name")).filter(F.col("name") != "").distinct()


def city_district_intersect(cities: DataFrame, districts: DataFrame) -> DataFrame:
    """City names that are also district names."""
    return read_names(cities, "city").intersect(read_names(districts, "district"))
