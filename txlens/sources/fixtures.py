"""Adapters from the driver's generic tables to payment tables.

Each adapter is one SQL text that Spark and DuckDB both run unchanged (``{name}`` marks a
table), so a query and its check start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

PAYMENTS = """
SELECT event_id AS transaction_id,
  user_id * 10 + event_id % 3 AS card_id,
  user_id * 10 AS account_id,
  user_id AS customer_id,
  k AS merchant_id,
  event_type AS merchant_category,
  CASE WHEN k % 10 = 0 THEN 'PK' ELSE 'IN' END AS merchant_country,
  value AS amount,
  CAST(ts AS TIMESTAMP) AS tx_ts,
  CASE WHEN event_id % 5 = 0 THEN 'cards' WHEN event_id % 5 < 3 THEN 'upi' ELSE 'online' END
    AS transaction_channel,
  CASE WHEN event_id % 3 = 0 THEN 1 ELSE 0 END AS card_present,
  concat('ua-', CAST(user_id % 11 AS STRING)) AS user_agent,
  concat('10.0.0.', CAST(user_id % 17 AS STRING)) AS ip_address,
  CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS is_fraud,
  CASE WHEN event_type = 'error' AND value > 90 THEN 1 ELSE 0 END AS chargeback,
  CASE WHEN event_type = 'error' AND value > 90 THEN CAST(event_id % 60 AS INT) END
    AS chargeback_days,
  8.0E0 + CAST((k * 29) % 2900 AS DOUBLE) / 100 AS location_lat,
  68.0E0 + CAST((k * 71) % 2900 AS DOUBLE) / 100 AS location_long
FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM {events}) e
"""

# Foreign merchants are not named, upi payments over the counter have no category, online ones no country.
PAYMENTS_WITH_GAPS = f"""
SELECT transaction_id, card_id, account_id, customer_id,
  CASE WHEN merchant_country = 'IN' THEN merchant_id END AS merchant_id,
  CASE WHEN transaction_channel <> 'upi' OR card_present = 0 THEN merchant_category END AS merchant_category,
  CASE WHEN transaction_channel <> 'online' THEN merchant_country END AS merchant_country,
  amount, tx_ts, transaction_channel, card_present, user_agent, ip_address, is_fraud, chargeback,
  chargeback_days, location_lat, location_long
FROM ({PAYMENTS}) p
"""

FRAUD_METADATA = """
SELECT event_id AS transaction_id,
  CASE WHEN value > 60 THEN 1 ELSE 0 END AS fraud_target,
  CASE event_id % 5 WHEN 0 THEN 'upi_scam' WHEN 1 THEN 'account_takeover'
    WHEN 2 THEN 'velocity_abuse' WHEN 3 THEN 'card_not_present' ELSE 'friendly_fraud' END
    AS fraud_type,
  CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END AS geo_anomaly,
  CASE WHEN event_id % 6 = 0 THEN 1 ELSE 0 END AS device_anomaly,
  CASE WHEN event_id % 7 = 0 THEN 1 ELSE 0 END AS ip_anomaly,
  CASE WHEN event_id % 9 = 0 THEN concat('camp-', CAST(user_id AS STRING)) END AS campaign_id
FROM {events} WHERE event_type = 'error'
"""

CUSTOMERS = """
SELECT c_custkey AS customer_id, c_name AS name, c_mktsegment AS location_type,
  8.0E0 + CAST((c_custkey * 29) % 2900 AS DOUBLE) / 100 AS home_latitude,
  68.0E0 + CAST((c_custkey * 71) % 2900 AS DOUBLE) / 100 AS home_longitude
FROM {customer}
"""

ACCOUNTS = """
SELECT o_orderkey AS account_id, o_custkey AS customer_id, o_totalprice AS balance,
  CAST(o_orderdate AS DATE) AS creation_date
FROM {orders}
"""

SCORES = """
SELECT event_id AS transaction_id, user_id AS customer_id, event_type AS merchant_category,
  value AS amount, value / (value + 10.0E0) AS score,
  CASE WHEN event_type = 'error' AND value > 60 THEN 1 ELSE 0 END AS label
FROM {events}
"""

# Map nodes: one per event. Tag columns are null where the tag is absent. The value lists
# cover every branch of the node rules, mapped and unmapped shop kinds, padded and aliased
# state names, and city names with the noise the normaliser removes.
NODES = """
SELECT event_id AS id,
  CASE WHEN event_id % 97 = 5 THEN 95.0E0 + lat ELSE lat END AS lat, lon,
  CASE WHEN event_id % 5 = 0 OR event_id % 77 = 1 THEN
    CASE k % 12 WHEN 0 THEN 'clothes' WHEN 1 THEN ' Jewelry ' WHEN 2 THEN 'convenience'
      WHEN 3 THEN 'mobile_phone' WHEN 4 THEN 'unheard_of' WHEN 5 THEN 'car' WHEN 6 THEN 'alcohol'
      WHEN 7 THEN 'LOTTERY' WHEN 8 THEN 'books' WHEN 9 THEN 'bakery' WHEN 10 THEN 'yes'
      ELSE 'watches' END END AS shop,
  CASE WHEN event_id % 5 = 1 THEN
    CASE k % 8 WHEN 0 THEN 'restaurant' WHEN 1 THEN 'atm' WHEN 2 THEN 'bank' WHEN 3 THEN 'school'
      WHEN 4 THEN 'fuel' WHEN 5 THEN 'cafe' WHEN 6 THEN 'pharmacy' ELSE 'cinema' END END AS amenity,
  CASE WHEN event_id % 5 = 2 OR event_id % 35 = 1 THEN
    CASE k % 4 WHEN 0 THEN 'hotel' WHEN 1 THEN 'motel' WHEN 2 THEN 'guest_house'
      ELSE 'museum' END END AS tourism,
  CASE WHEN event_id % 5 = 3 THEN
    CASE WHEN k % 2 = 0 THEN 'residential' ELSE 'yes' END END AS building,
  CASE WHEN event_id % 5 = 4 AND k % 3 = 0 THEN 'residential' END AS landuse,
  CASE WHEN event_id % 7 = 0 THEN CAST(k AS STRING) END AS housenumber,
  CASE WHEN event_id % 11 = 0 THEN 'MG Road' END AS street,
  CASE WHEN event_id % 6 <> 0 THEN concat('Place ', CAST(event_id AS STRING)) END AS name,
  CASE WHEN event_id % 3 = 0 THEN 'State Bank' END AS operator,
  CASE WHEN event_id % 4 = 0 THEN 'CashPoint' END AS brand,
  CASE user_id % 11 WHEN 0 THEN 'Pune India' WHEN 1 THEN ' Mumbai ' WHEN 2 THEN 'Secunderabad-26'
    WHEN 3 THEN 'Hitech City, Hyderabad' WHEN 4 THEN 'bengaluru karnataka' WHEN 5 THEN ''
    WHEN 6 THEN 'New Delhi' WHEN 7 THEN 'Chennai tamil nadu' WHEN 8 THEN 'nation_7'
    WHEN 9 THEN 'NATION_12' END AS city,
  CASE user_id % 13 WHEN 0 THEN 'MH' WHEN 1 THEN ' maharashtra ' WHEN 2 THEN 'Punjab'
    WHEN 3 THEN 'Punjab, India' WHEN 4 THEN 'tamilnadu' WHEN 5 THEN 'தமிழ்நாடு'
    WHEN 6 THEN 'j and k' WHEN 7 THEN 'some  new   state' WHEN 8 THEN 'mcDonald land'
    WHEN 9 THEN 'NCR' WHEN 10 THEN '' WHEN 11 THEN 'daman and diu' END AS state,
  CASE WHEN event_id % 8 = 0 THEN concat('560 0', CAST(k AS STRING))
    WHEN event_id % 8 < 5 THEN concat('PIN-', CAST(400000 + k AS STRING)) END AS postcode,
  -- a level-8 hexagon cell id: mode 1, level 8, base cell, eight base-7 digits, padding
  612489549324484607 + (k % 20) * 35184372088832
    + (k % 7) * 4398046511104 + (k % 6) * 549755813888 + (k % 3) * 68719476736
    + (event_id % 5) * 8589934592 + (user_id % 7) * 1073741824 + (event_id % 7) * 134217728
    + (event_id % 6) * 16777216 + (event_id % 4) * 2097152 AS cell_bits
FROM (
  SELECT *, 8.0E0 + CAST((k * 29) % 2900 AS DOUBLE) / 100 AS lat,
    68.0E0 + CAST((k * 71) % 2900 AS DOUBLE) / 100 AS lon
  FROM (SELECT *, CAST(regexp_extract(props, '([0-9]+)', 1) AS BIGINT) AS k FROM {events}) a
) e
"""

# Admin relations. Level 5 (districts): one per customer. Level 4 (states): one per
# supplier, whose members are 16 consecutive customers, so neighbours share one member.
DISTRICT_RELATIONS = """
SELECT c_custkey AS id,
  CASE WHEN c_custkey % 10 <> 9 THEN 'administrative' ELSE 'historic' END AS boundary,
  CASE WHEN c_custkey % 8 <> 7 THEN '5' ELSE '6' END AS admin_level,
  CASE c_custkey % 5 WHEN 0 THEN concat('NATION_', CAST(c_nationkey AS STRING))
    WHEN 1 THEN concat('District ', CAST(c_nationkey AS STRING)) WHEN 2 THEN c_mktsegment END AS name,
  CASE WHEN c_custkey % 5 = 3 THEN concat('En ', c_mktsegment) END AS name_en,
  CASE c_custkey % 6 WHEN 0 THEN 'IN-KA' WHEN 1 THEN 'IN-MH-X' WHEN 2 THEN 'PK-PB'
    WHEN 3 THEN 'nohyphen' END AS iso,
  CASE WHEN c_custkey % 7 = 1 THEN 'IN' END AS is_in_country,
  CASE WHEN c_custkey % 7 = 2 THEN 'IN' END AS addr_country,
  CASE WHEN c_custkey % 7 = 3 THEN '512' END AS ref_lgd,
  CASE WHEN c_custkey % 7 = 4 THEN '29' END AS mdds,
  CASE WHEN c_custkey % 7 = 5 THEN concat('State ', CAST(c_nationkey % 4 AS STRING)) END AS is_in_state,
  CASE WHEN c_custkey % 9 = 4 THEN 'Goa' END AS addr_state
FROM {customer}
"""

STATE_RELATIONS = """
SELECT 1000000000 + s_suppkey AS id,
  CASE WHEN s_suppkey % 9 <> 8 THEN 'administrative' ELSE 'historic' END AS boundary,
  CASE WHEN s_suppkey % 10 <> 9 THEN '4' ELSE '3' END AS admin_level,
  CASE WHEN s_suppkey % 12 <> 7 THEN concat('State ', CAST(s_nationkey AS STRING)) END AS name,
  CASE WHEN s_suppkey % 2 = 0 THEN 'IN-KA' WHEN s_suppkey % 7 = 3 THEN 'PK-PB' END AS iso,
  CASE WHEN s_suppkey % 2 = 1 AND s_suppkey % 7 <> 3 THEN 'IN' END AS is_in_country,
  s_suppkey * 15 AS first_member
FROM {supplier}
"""

# Boundaries: five state strips (one per region) and 25 district cells (one per nation)
# that share borders. Districts with n % 3 = 0 have a square hole; n % 3 = 1 a slanted top.
STATE_SHAPES = """
SELECT r_name AS st_nm, 68.0E0 + 5.8E0 * r_regionkey AS x0,
  68.0E0 + 5.8E0 * (r_regionkey + 1) AS x1
FROM {region}
"""

DISTRICT_SHAPES = """
SELECT n_name AS district, concat('REGION_', CAST(n_regionkey AS STRING)) AS st_nm,
  n_nationkey % 3 AS kind,
  68.0E0 + 5.8E0 * (n_nationkey % 5) AS x0,
  68.0E0 + 5.8E0 * (n_nationkey % 5 + 1) AS x1,
  8.0E0 + 5.8E0 * CAST(floor(n_nationkey / 5) AS INT) AS y0,
  8.0E0 + 5.8E0 * (CAST(floor(n_nationkey / 5) AS INT) + 1) AS y1
FROM {nation}
"""


def sql_for_oracle(text: str) -> str:
    """The adapter with plain table names."""
    return re.sub(r"\{(\w+)\}", r"\1", text).strip()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def adapt(spark: SparkSession, sf_dir: str, text: str) -> DataFrame:
    names = set(re.findall(r"\{(\w+)\}", text))
    return spark.sql(text, **{name: table(spark, sf_dir, name) for name in names})


def payments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, PAYMENTS).withColumnRenamed("tx_ts", "timestamp")


def payments_with_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All payments, of which some lack merchant, category or country."""
    return adapt(spark, sf_dir, PAYMENTS_WITH_GAPS).withColumnRenamed("tx_ts", "timestamp")


def fraud_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, FRAUD_METADATA)


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, CUSTOMERS)


def accounts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, ACCOUNTS)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return adapt(spark, sf_dir, SCORES)


def _tags(pairs: dict[str, str]):
    """Map of the tags that are present."""
    entries = F.array(
        *[F.struct(F.lit(tag).alias("k"), F.col(column).alias("v")) for tag, column in pairs.items()]
    )
    return F.map_from_entries(F.filter(entries, lambda e: e["v"].isNotNull()))


def map_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tags = {
        "shop": "shop", "amenity": "amenity", "tourism": "tourism", "building": "building",
        "landuse": "landuse", "addr:housenumber": "housenumber", "addr:street": "street",
        "name": "name", "operator": "operator", "brand": "brand", "addr:city": "city",
        "addr:state": "state", "addr:postcode": "postcode",
    }
    cell = F.lower(F.hex("cell_bits")).alias("h3_index")
    return adapt(spark, sf_dir, NODES).select("id", "lat", "lon", _tags(tags).alias("tags"), cell)


def map_relations(spark: SparkSession, sf_dir: str) -> DataFrame:
    common = {
        "boundary": "boundary", "admin_level": "admin_level", "name": "name",
        "ISO3166-2": "iso", "is_in:country_code": "is_in_country",
    }
    extra = {
        "name:en": "name_en", "addr:country": "addr_country", "ref:LGD:x": "ref_lgd",
        "mdds:code": "mdds", "is_in:state": "is_in_state", "addr:state": "addr_state",
    }
    member = "array<struct<type:string,ref:bigint>>"
    districts = adapt(spark, sf_dir, DISTRICT_RELATIONS).select(
        "id", _tags(common | extra).alias("tags"), F.array().cast(member).alias("members")
    )
    refs = F.sequence(F.col("first_member"), F.col("first_member") + 15)
    states = adapt(spark, sf_dir, STATE_RELATIONS).select(
        "id",
        _tags(common).alias("tags"),
        F.transform(
            refs,
            lambda ref: F.struct(
                F.when(ref % 13 == 0, "node").otherwise("relation").alias("type"), ref.alias("ref")
            ),
        ).cast(member).alias("members"),
    )
    return districts.unionByName(states)


def _ring(*points):
    return F.array(*[F.struct(x.alias("lon"), y.alias("lat")) for x, y in points])


def state_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0, x1, y0, y1 = F.col("x0"), F.col("x1"), F.lit(8.0), F.lit(37.0)
    square = _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    return adapt(spark, sf_dir, STATE_SHAPES).select("st_nm", F.array(square).alias("rings"))


def district_boundaries(spark: SparkSession, sf_dir: str) -> DataFrame:
    x0, x1, y0, y1 = F.col("x0"), F.col("x1"), F.col("y0"), F.col("y1")
    square = _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1), (x0, y0))
    slanted = _ring((x0, y0), (x1, y0), (x1, y1), (x0, y1 - 2.0), (x0, y0))
    hole = _ring(
        (x0 + 2.0, y0 + 2.0), (x0 + 3.0, y0 + 2.0), (x0 + 3.0, y0 + 3.0),
        (x0 + 2.0, y0 + 3.0), (x0 + 2.0, y0 + 2.0),
    )
    rings = (
        F.when(F.col("kind") == 0, F.array(square, hole))
        .when(F.col("kind") == 1, F.array(slanted))
        .otherwise(F.array(square))
    )
    return adapt(spark, sf_dir, DISTRICT_SHAPES).select("st_nm", "district", rings.alias("rings"))
