"""Plain SQL twin of every catalogue query that SQL can express, for an independent check.

Milliseconds are truncated (``epoch_us // 1000``), as Spark's ``unix_millis`` does.
"""

from __future__ import annotations

from txlens.functions.names import CITY_NOISE
from txlens.operators.evaluation import OPERATING_MODES, RECALL_TARGETS
from txlens.operators.model import CATEGORICAL, FEATURE_SPEC
from txlens.plans.catalog import (
    BIN_EDGES,
    BIN_NAMES,
    FRAUD_MIX,
    METRO,
    PERIOD,
    SUSPICIOUS_RATE,
    WIDE_SECONDS,
    SLICED,
)
from txlens.sources import fixtures as fx
from txlens.sources import lookups

ORACLES: dict[str, str] = {}


def _quote(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _values(rows) -> str:
    return ", ".join("(" + ", ".join(_quote(v) for v in row) + ")" for row in rows)


TX = f"tx AS ({fx.sql_for_oracle(fx.PAYMENTS)})"
META = f"meta AS ({fx.sql_for_oracle(fx.FRAUD_METADATA)})"
CUST = f"cust AS ({fx.sql_for_oracle(fx.CUSTOMERS)})"
ACC = f"acc AS ({fx.sql_for_oracle(fx.ACCOUNTS)})"
SCORED = f"scored AS ({fx.sql_for_oracle(fx.SCORES)})"
NODES = f"nodes AS ({fx.sql_for_oracle(fx.NODES)})"
ALIASES = (
    "aliases(alias, canonical) AS (VALUES "
    + _values((a, name) for name, spellings in lookups.STATE_ALIASES.items() for a in spellings)
    + ")"
)
CATEGORIES = f"categories(kind, category, risk) AS (VALUES {_values(lookups.csv_rows(lookups.CATEGORY_MAP))})"
STATES = f"states_raw(raw_name, clean_name) AS (VALUES {_values(lookups.csv_rows(lookups.STATE_MAP))})"
CODES = f"codes(category, mcc) AS (VALUES {_values(lookups.MERCHANT_CODES.items())})"


def oracle(name: str, sql: str, *ctes: str, settle: tuple[str, ...] = ()) -> None:
    """Register; ``settle`` names the double columns rounded like the catalogue does."""
    text = f"WITH {', '.join(ctes)} {sql}" if ctes else sql
    if settle:
        fixes = ", ".join(f'round(CAST("{c}" AS DOUBLE) + 0.0000003, 6) AS "{c}"' for c in settle)
        text = f"SELECT * REPLACE ({fixes}) FROM ({text}) AS settled"
    ORACLES[name] = text


# --- entities -----------------------------------------------------------------------

MERCHANT = """merchant AS (SELECT merchant_id, count(*) AS total_transactions,
  CAST(sum(is_fraud) AS BIGINT) AS total_fraud_transactions,
  count(DISTINCT customer_id) AS unique_customers_count, avg(amount) AS avg_transaction_amount,
  stddev_samp(amount) AS std_transaction_amount,
  CAST(sum(is_fraud) AS DOUBLE) / count(*) AS merchant_fraud_rate FROM tx GROUP BY merchant_id)"""
IP = """ip AS (SELECT ip_address, avg(is_fraud) AS ip_fraud_rate,
  count(DISTINCT customer_id) AS ip_degree FROM tx GROUP BY ip_address)"""
DEV = """dev AS (SELECT user_agent, avg(is_fraud) AS dev_fraud_rate,
  count(DISTINCT customer_id) AS dev_degree FROM tx GROUP BY user_agent)"""

oracle(
    "merchant_features", "SELECT * FROM merchant", TX, MERCHANT,
    settle=("avg_transaction_amount", "std_transaction_amount", "merchant_fraud_rate"),
)
oracle(
    "category_baselines",
    """SELECT merchant_category, avg(amount) AS category_avg_amount,
    avg(is_fraud) AS category_fraud_baseline FROM tx GROUP BY merchant_category""",
    TX,
    settle=("category_avg_amount", "category_fraud_baseline"),
)
GAPS = f"tx AS ({fx.sql_for_oracle(fx.PAYMENTS_WITH_GAPS)})"
oracle(
    "merchant_features_gaps", "SELECT * FROM merchant", GAPS, MERCHANT,
    settle=("avg_transaction_amount", "std_transaction_amount", "merchant_fraud_rate"),
)
DEVICE = """device AS (SELECT user_agent, count(*) AS transaction_count,
  CAST(sum(is_fraud) AS BIGINT) AS fraud_tx_count,
  count(DISTINCT customer_id) AS unique_customers_per_device,
  count(DISTINCT merchant_country) AS countries_accessed_from,
  CAST(sum(is_fraud) AS DOUBLE) / count(*) AS device_fraud_rate FROM tx GROUP BY user_agent)"""
oracle("device_features", "SELECT * FROM device", TX, DEVICE, settle=("device_fraud_rate",))
oracle("ip_reputation", "SELECT * FROM ip", TX, IP, settle=("ip_fraud_rate",))
oracle("device_reputation", "SELECT * FROM dev", TX, DEV, settle=("dev_fraud_rate",))
oracle(
    "bronze_projection",
    "SELECT transaction_id, customer_id, merchant_id, amount, card_present, is_fraud FROM tx",
    TX,
    settle=("amount",),
)
oracle(
    "parse_timestamps",
    "SELECT event_id, (epoch_us(CAST(ts AS TIMESTAMP)) // 1000) - 19800000 AS ts_ms FROM events",
)

# --- customer, sequence, campaign ----------------------------------------------------

ACTIVITY = """activity AS (SELECT *,
  CAST(total_fraud_transactions AS DOUBLE) / total_transactions AS fraud_rate,
  CAST(night_tx_count AS DOUBLE) / total_transactions AS night_transaction_ratio,
  CAST(weekend_tx_count AS DOUBLE) / total_transactions AS weekend_transaction_ratio
  FROM (SELECT customer_id, count(*) AS total_transactions,
    CAST(sum(is_fraud) AS BIGINT) AS total_fraud_transactions,
    avg(amount) AS avg_transaction_amount, stddev_samp(amount) AS std_transaction_amount,
    count(DISTINCT merchant_id) AS unique_merchants_count,
    count(DISTINCT merchant_category) AS unique_merchant_categories_count,
    count(DISTINCT merchant_country) AS unique_countries_count,
    CAST(sum(CASE WHEN extract(hour FROM tx_ts) >= 22 OR extract(hour FROM tx_ts) < 6
      THEN 1 ELSE 0 END) AS BIGINT) AS night_tx_count,
    CAST(sum(CASE WHEN isodow(tx_ts) >= 6 THEN 1 ELSE 0 END) AS BIGINT) AS weekend_tx_count,
    (epoch_us(min(tx_ts)) // 1000) AS first_transaction_ts, (epoch_us(max(tx_ts)) // 1000) AS last_transaction_ts
    FROM tx GROUP BY customer_id) a)"""
CUSTOMER = """SELECT cust.*, coalesce(n, 0) AS account_count, activity.* EXCLUDE (customer_id)
    REPLACE (coalesce(fraud_rate, 0) AS fraud_rate, coalesce(total_transactions, 0) AS total_transactions)
    FROM cust LEFT JOIN (SELECT customer_id, count(*) AS n FROM acc GROUP BY customer_id) acc
      ON cust.customer_id = acc.customer_id
    LEFT JOIN activity ON cust.customer_id = activity.customer_id"""
CUSTOMER_DOUBLES = (
    "home_latitude", "home_longitude", "fraud_rate", "avg_transaction_amount",
    "std_transaction_amount", "night_transaction_ratio", "weekend_transaction_ratio",
)
oracle("customer_features", CUSTOMER, TX, CUST, ACC, ACTIVITY, settle=CUSTOMER_DOUBLES)
# A missing value counts as one value.
ACTIVITY_GAPS = ACTIVITY
for _name in ("merchant_id", "merchant_category", "merchant_country"):
    _distinct = f"count(DISTINCT {_name})"
    ACTIVITY_GAPS = ACTIVITY_GAPS.replace(_distinct, f"{_distinct} + max(CASE WHEN {_name} IS NULL THEN 1 ELSE 0 END)")
oracle("customer_features_gaps", CUSTOMER, GAPS, CUST, ACC, ACTIVITY_GAPS, settle=CUSTOMER_DOUBLES)

SEQ = """lagged AS (SELECT *, (epoch_us(tx_ts) // 1000) AS ms, CAST(extract(hour FROM tx_ts) AS DOUBLE) AS h,
    lag((epoch_us(tx_ts) // 1000)) OVER w AS p_ms, lag(location_lat) OVER w AS p_lat,
    lag(location_long) OVER w AS p_lon, lag(merchant_category) OVER w AS p_cat,
    lag(amount) OVER w AS p1, lag(amount, 2) OVER w AS p2, row_number() OVER w AS rn,
    avg(CAST(extract(hour FROM tx_ts) AS DOUBLE)) OVER (PARTITION BY customer_id) AS mean_h,
    avg(amount) OVER (PARTITION BY customer_id) AS mean_a,
    stddev_samp(amount) OVER (PARTITION BY customer_id) AS std_a
  FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY (epoch_us(tx_ts) // 1000), transaction_id)),
moved AS (SELECT *, sqrt((location_lat - p_lat) * (location_lat - p_lat)
    + (location_long - p_lon) * (location_long - p_lon)) * 111 AS km FROM lagged),
seq AS (SELECT transaction_id, card_id, account_id, customer_id, merchant_id, merchant_category,
  amount, ms AS "timestamp", transaction_channel, card_present, user_agent, ip_address, is_fraud,
  (ms - p_ms) / 1000.0 AS time_since_last_transaction, rn AS transaction_sequence_number,
  extract(hour FROM tx_ts) + extract(minute FROM tx_ts) / 60.0
    + CAST(floor(extract(second FROM tx_ts)) AS DOUBLE) / 3600.0 AS hours_since_midnight,
  CASE WHEN isodow(tx_ts) >= 6 THEN 1 ELSE 0 END AS is_weekend,
  CASE WHEN p_ms IS NULL THEN 0 WHEN ms > p_ms THEN least(km / ((ms - p_ms) / 3600000.0), 10000)
    WHEN km > 0 THEN 10000 ELSE 0 END AS spatial_velocity,
  abs(h - mean_h) AS hour_deviation_from_norm,
  CASE WHEN amount % 1 = 0 OR amount % 5 = 0 OR amount % 10 = 0 THEN 1 ELSE 0 END
    AS amount_round_number_flag,
  CASE WHEN std_a = 0 THEN 0 ELSE (amount - mean_a) / std_a END AS amount_deviation_z_score,
  CASE WHEN p_ms IS NOT NULL AND ms - p_ms <= 300000 THEN 1 ELSE 0 END AS rapid_fire_transaction_flag,
  CAST(p2 < p1 AND p1 < amount AS INT) AS escalating_amounts_flag,
  CASE WHEN p_cat IS NOT NULL AND p_cat <> merchant_category THEN 1 ELSE 0 END
    AS merchant_category_switch_flag,
  CAST(0 AS BIGINT) AS same_day_transaction_count, 0 AS is_holiday, 0 AS is_foreign, 0 AS is_cross_border,
  0 AS is_ip_mismatch FROM moved)"""
SEQ_DOUBLES = (
    "amount", "time_since_last_transaction", "hours_since_midnight", "spatial_velocity",
    "hour_deviation_from_norm", "amount_deviation_z_score",
)
oracle("sequence_features", "SELECT * FROM seq", TX, SEQ, settle=SEQ_DOUBLES)
SEQ_BEFORE = SEQ
for _a, _b in (
    ("avg(CAST(extract(hour FROM tx_ts) AS DOUBLE)) OVER (PARTITION BY customer_id)", "avg(CAST(extract(hour FROM tx_ts) AS DOUBLE)) OVER b"),
    ("avg(amount) OVER (PARTITION BY customer_id)", "avg(amount) OVER b"),
    (
        "stddev_samp(amount) OVER (PARTITION BY customer_id)",
        "CASE WHEN count(*) OVER b > 1 AND min(amount) OVER b = max(amount) OVER b THEN 0 ELSE stddev_samp(amount) OVER b END",
    ),
    (
        "ORDER BY (epoch_us(tx_ts) // 1000), transaction_id))",
        "ORDER BY (epoch_us(tx_ts) // 1000), transaction_id), b AS (PARTITION BY customer_id"
        " ORDER BY (epoch_us(tx_ts) // 1000), transaction_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))",
    ),
):
    assert _a in SEQ_BEFORE
    SEQ_BEFORE = SEQ_BEFORE.replace(_a, _b)
oracle("sequence_features_as_of", "SELECT * FROM seq", TX, SEQ_BEFORE, settle=SEQ_DOUBLES)
SILVER = """silver AS (SELECT seq.* REPLACE (
    coalesce(time_since_last_transaction, 0) AS time_since_last_transaction,
    coalesce(amount_deviation_z_score, 0) AS amount_deviation_z_score,
    coalesce(escalating_amounts_flag, 0) AS escalating_amounts_flag),
  coalesce(fraud_target, 0) AS fraud_target, coalesce(fraud_type, 'none') AS fraud_type,
  coalesce(geo_anomaly, 0) AS geo_anomaly, coalesce(device_anomaly, 0) AS device_anomaly,
  coalesce(ip_anomaly, 0) AS ip_anomaly, meta.campaign_id
  FROM seq LEFT JOIN meta ON seq.transaction_id = meta.transaction_id)"""
oracle(
    "sequence_with_metadata",
    """SELECT transaction_id, customer_id, transaction_sequence_number, fraud_target, fraud_type,
    geo_anomaly, device_anomaly, ip_anomaly, campaign_id FROM silver""",
    TX, META, SEQ, SILVER,
)
CAMPAIGN = """fraud AS (SELECT *, (epoch_us(tx_ts) // 1000) AS ms, lag((epoch_us(tx_ts) // 1000)) OVER
    (PARTITION BY customer_id ORDER BY (epoch_us(tx_ts) // 1000), transaction_id) AS p FROM tx WHERE is_fraud = 1),
sessions AS (SELECT *, customer_id || '-' || sum(CASE WHEN p IS NULL OR ms - p > 172800000 THEN 1 ELSE 0 END)
    OVER (PARTITION BY customer_id ORDER BY ms, transaction_id ROWS UNBOUNDED PRECEDING) AS campaign_id
  FROM fraud),
camp AS (SELECT transaction_id, campaign_id, n AS campaign_txn_count, total AS campaign_total_amount,
    merchants AS campaign_merchant_diversity FROM sessions JOIN (SELECT campaign_id, count(*) AS n,
    sum(amount) AS total, count(DISTINCT merchant_id) AS merchants FROM sessions GROUP BY campaign_id) t
  USING (campaign_id))"""
oracle("campaign_features", "SELECT * FROM camp", TX, CAMPAIGN, settle=("campaign_total_amount",))
_diversity = "count(DISTINCT merchant_id)"
CAMPAIGN_GAPS = CAMPAIGN.replace(_diversity, f"{_diversity} + max(CASE WHEN merchant_id IS NULL THEN 1 ELSE 0 END)")
oracle("campaign_features_gaps", "SELECT * FROM camp", GAPS, CAMPAIGN_GAPS, settle=("campaign_total_amount",))

# --- gold -----------------------------------------------------------------------------

GOLD = """gold AS (SELECT silver.*, coalesce(c.fraud_rate, 0) AS cf_fraud_rate,
  coalesce(c.night_transaction_ratio, 0) AS cf_night_tx_ratio,
  coalesce(m.merchant_fraud_rate, 0) AS mf_fraud_rate,
  0.0E0 AS ip_fraud_rate, 0 AS ip_degree, 0.0E0 AS dev_fraud_rate, 0 AS dev_degree,
  0 AS suspicious_cluster_member, 0 AS campaign_txn_count, 0.0E0 AS campaign_total_amount,
  0 AS campaign_merchant_diversity
  FROM silver LEFT JOIN activity c ON silver.customer_id = c.customer_id
  LEFT JOIN merchant m ON silver.merchant_id = m.merchant_id)"""
GOLD_CTES = (TX, META, SEQ, SILVER, ACTIVITY, MERCHANT, GOLD)
oracle(
    "gold_master", "SELECT * FROM gold", *GOLD_CTES,
    settle=(*SEQ_DOUBLES, "cf_fraud_rate", "cf_night_tx_ratio", "mf_fraud_rate"),
)
# Customers known from card payments and merchants known from domestic ones.
SOME_ACTIVITY = ACTIVITY.replace("FROM tx GROUP", "FROM tx WHERE transaction_channel = 'cards' GROUP")
SOME_MERCHANT = MERCHANT.replace("FROM tx GROUP", "FROM tx WHERE merchant_country = 'IN' GROUP")
oracle(
    "gold_master_strangers", "SELECT * FROM gold", TX, META, SEQ, SILVER, SOME_ACTIVITY, SOME_MERCHANT, GOLD,
    settle=(*SEQ_DOUBLES, "cf_fraud_rate", "cf_night_tx_ratio", "mf_fraud_rate"),
)
NET = f"""net AS (SELECT transaction_id, customer_id,
  greatest(ip_fraud_rate, dev_fraud_rate) AS shared_entity_fraud_rate,
  greatest(ip_degree, dev_degree) AS degree,
  CASE WHEN greatest(ip_fraud_rate, dev_fraud_rate) >= {SUSPICIOUS_RATE} AND greatest(ip_degree, dev_degree) > 1
    THEN 1 ELSE 0 END AS suspicious_cluster_member
  FROM tx JOIN ip USING (ip_address) JOIN dev USING (user_agent))"""
ROLLUP = """rollup_net AS (SELECT customer_id, max(suspicious_cluster_member) AS net_suspicious_cluster_member,
  avg(shared_entity_fraud_rate) AS net_avg_shared_entity_fraud_rate FROM net GROUP BY customer_id)"""
GOLD_FULL = """SELECT t.transaction_id, (epoch_us(t.tx_ts) // 1000) AS "timestamp", t.amount, t.merchant_id,
    t.customer_id, t.merchant_category, t.transaction_channel, t.card_present, t.is_fraud,
    s.fraud_target, s.fraud_type, s.time_since_last_transaction, s.transaction_sequence_number,
    s.spatial_velocity, s.hour_deviation_from_norm, s.amount_deviation_z_score,
    s.rapid_fire_transaction_flag, s.escalating_amounts_flag, s.merchant_category_switch_flag,
    s.geo_anomaly, s.device_anomaly, s.ip_anomaly, s.campaign_id AS simulation_campaign_id,
    coalesce(n.shared_entity_fraud_rate, 0) AS shared_entity_fraud_rate,
    coalesce(n.degree, 0) AS degree, coalesce(n.suspicious_cluster_member, 0) AS suspicious_cluster_member,
    coalesce(k.campaign_txn_count, 0) AS campaign_txn_count,
    coalesce(k.campaign_total_amount, 0) AS campaign_total_amount,
    coalesce(k.campaign_merchant_diversity, 0) AS campaign_merchant_diversity,
    c.fraud_rate AS cf_fraud_rate, c.night_transaction_ratio AS cf_night_tx_ratio,
    m.merchant_fraud_rate AS mf_fraud_rate
    FROM tx t LEFT JOIN silver s ON t.transaction_id = s.transaction_id
    LEFT JOIN net n ON t.transaction_id = n.transaction_id
    LEFT JOIN camp k ON t.transaction_id = k.transaction_id
    LEFT JOIN activity c ON t.customer_id = c.customer_id
    LEFT JOIN merchant m ON t.merchant_id = m.merchant_id"""
GOLD_FULL_DOUBLES = (
    "amount", "time_since_last_transaction", "spatial_velocity", "hour_deviation_from_norm",
    "amount_deviation_z_score", "shared_entity_fraud_rate", "campaign_total_amount",
    "cf_fraud_rate", "cf_night_tx_ratio", "mf_fraud_rate",
)
oracle(
    "gold_full", GOLD_FULL, TX, META, SEQ, SILVER, ACTIVITY, MERCHANT, IP, DEV, NET, CAMPAIGN,
    settle=GOLD_FULL_DOUBLES,
)
SOME_NET = f"all_{NET}, net AS (SELECT all_net.* FROM all_net JOIN tx USING (transaction_id) WHERE tx.card_present = 1)"
oracle(
    "gold_full_strangers", GOLD_FULL, TX, META, SEQ, SILVER, SOME_ACTIVITY, SOME_MERCHANT, IP, DEV, SOME_NET, CAMPAIGN,
    settle=GOLD_FULL_DOUBLES,
)
oracle(
    "gold_wide",
    """SELECT t.transaction_id, t.customer_id, t.merchant_id, t.user_agent, t.amount, s.spatial_velocity,
    k.campaign_id, k.campaign_txn_count, k.campaign_total_amount, k.campaign_merchant_diversity,
    c.fraud_rate, c.total_transactions, r.net_suspicious_cluster_member,
    r.net_avg_shared_entity_fraud_rate, m.merchant_fraud_rate, v.device_fraud_rate
    FROM tx t LEFT JOIN seq s ON t.transaction_id = s.transaction_id
    LEFT JOIN camp k ON t.transaction_id = k.transaction_id
    LEFT JOIN activity c ON t.customer_id = c.customer_id
    LEFT JOIN rollup_net r ON t.customer_id = r.customer_id
    LEFT JOIN merchant m ON t.merchant_id = m.merchant_id
    LEFT JOIN device v ON t.user_agent = v.user_agent""",
    TX, SEQ, ACTIVITY, MERCHANT, DEVICE, IP, DEV, NET, ROLLUP, CAMPAIGN,
    settle=(
        "amount", "spatial_velocity", "campaign_total_amount", "fraud_rate",
        "net_avg_shared_entity_fraud_rate", "merchant_fraud_rate", "device_fraud_rate",
    ),
)
oracle(
    "gold_validate",
    """SELECT count(*) AS total, count(CASE WHEN ip_fraud_rate > 0 THEN 1 END) AS net_hits,
    avg(ip_fraud_rate) AS avg_ip_risk, avg(dev_degree) AS avg_dev_degree
    FROM tx JOIN ip USING (ip_address) JOIN dev USING (user_agent)""",
    TX, IP, DEV, settle=("avg_ip_risk", "avg_dev_degree"),
)
oracle("network_tx_features", "SELECT * FROM net", TX, IP, DEV, NET, settle=("shared_entity_fraud_rate",))
oracle(
    "network_customer_rollup", "SELECT * FROM rollup_net", TX, IP, DEV, NET, ROLLUP,
    settle=("net_avg_shared_entity_fraud_rate",),
)

# --- geography --------------------------------------------------------------------------


def _city(column: str) -> str:
    noise = "|".join(CITY_NOISE)
    return (
        f"trim(upper(split_part(split_part(regexp_replace({column}, ' ({noise})$', '', 'gi'),"
        f" '-', 1), ',', 1)))"
    )


def _title(column: str) -> str:
    return (
        f"array_to_string(list_transform(list_filter(string_split_regex({column}, '\\s+'),"
        f" lambda w: w <> ''), lambda w: upper(w[1]) || w[2:]), ' ')"
    )


oracle("normalize_city", f"SELECT id, {_city('city')} AS city FROM nodes", NODES)
oracle(
    "normalize_state",
    f"SELECT id, coalesce(canonical, {_title('state')}) AS state FROM nodes"
    " LEFT JOIN aliases ON lower(state) = alias",
    NODES, ALIASES,
)
oracle(
    "title_words",
    f"SELECT p_partkey, {_title('t')} AS title FROM (SELECT p_partkey, '  mcX  ' || p_name || ' of' AS t FROM part) p",
)
oracle("clean_pincode", "SELECT id, regexp_replace(postcode, '[^0-9]', '', 'g') AS pincode FROM nodes", NODES)
VALID = """valid AS (SELECT *, lower(hex(cell_bits)) AS h3_index,
  CASE WHEN shop IS NOT NULL THEN 'shop'
    WHEN amenity IS NOT NULL THEN CASE WHEN amenity IN ('restaurant', 'cafe', 'fast_food', 'bar', 'pub',
      'fuel', 'cinema', 'pharmacy') THEN 'amenity' END
    WHEN tourism IN ('hotel', 'motel', 'guest_house') THEN 'tourism' END AS category
  FROM nodes WHERE lat BETWEEN -90 AND 90 AND lon BETWEEN -180 AND 180),
shops AS (SELECT id AS osm_id, h3_index, coalesce(name, 'Unknown Merchant') AS name, lat, lon, category,
  CASE category WHEN 'shop' THEN shop WHEN 'amenity' THEN amenity ELSE tourism END AS sub_category,
  city, postcode, state FROM valid WHERE category IS NOT NULL),
homes AS (SELECT id AS osm_id, h3_index, lat, lon, city, postcode, state FROM valid
  WHERE category IS NULL AND (coalesce(building = 'residential', false)
    OR coalesce(landuse = 'residential', false) OR housenumber IS NOT NULL OR street IS NOT NULL)),
banks AS (SELECT id AS osm_id, h3_index, lat, lon, amenity AS kind, coalesce(operator, brand) AS operator,
  city, postcode, state FROM valid WHERE amenity IN ('atm', 'bank'))"""
STAGED = """staged AS (SELECT osm_id, h3_index, name AS merchant_name, lat AS latitude, lon AS longitude, city,
  postcode, state, coalesce(c.category, 'GENERAL_RETAIL') AS merchant_category,
  coalesce(risk, 'LOW') AS risk_level FROM shops LEFT JOIN categories c
  ON trim(lower(shops.sub_category)) = trim(lower(c.kind)))"""
STAGED_HOMES = """lookup AS (SELECT trim(upper(raw_name)) AS raw_key, min(trim(clean_name)) AS clean
  FROM states_raw GROUP BY 1),
staged_homes AS (SELECT osm_id, h3_index, lat AS latitude, lon AS longitude, city, postcode,
  coalesce(clean, state, 'Unknown') AS state_standardized FROM homes
  LEFT JOIN lookup ON trim(upper(state)) = raw_key)"""
LATLON = ("latitude", "longitude")
oracle("stg_category_map", "SELECT * FROM staged", NODES, VALID, CATEGORIES, STAGED, settle=LATLON)
oracle("stg_state_map", "SELECT * FROM staged_homes", NODES, VALID, STATES, STAGED_HOMES, settle=LATLON)
oracle(
    "stg_state_map_repeated_key",
    """SELECT osm_id, coalesce(clean_name, state, 'Unknown') AS state_standardized FROM homes
    LEFT JOIN states_raw ON trim(upper(state)) = trim(upper(raw_name))""",
    NODES, VALID, STATES,
)
oracle(
    "mcc_enrich",
    """SELECT osm_id, merchant_category, coalesce(mcc, '5999') AS mcc FROM staged
    LEFT JOIN codes ON merchant_category = codes.category""",
    NODES, VALID, CATEGORIES, STAGED, CODES,
)
oracle(
    "classify_nodes",
    """SELECT osm_id AS id, 'financial' AS role, NULL AS category, kind AS sub_category, operator AS label
    FROM banks
    UNION ALL SELECT osm_id, 'merchant', category, sub_category, name FROM shops
    UNION ALL SELECT osm_id, 'residential', NULL, NULL, NULL FROM homes""",
    NODES, VALID,
)
oracle("financial_nodes", "SELECT * FROM banks", NODES, VALID, settle=("lat", "lon"))
COUNTS = """counts AS (SELECT trim(state) AS state, trim(city) AS city, count(*) AS nodes FROM nodes
  WHERE trim(state) <> '' AND trim(city) <> '' GROUP BY 1, 2)"""
CLEAN = f"""clean AS (SELECT coalesce(canonical, {_title('state')}) AS state, city,
  CAST(sum(counts.nodes) AS BIGINT) AS nodes FROM counts LEFT JOIN aliases ON lower(state) = alias
  GROUP BY 1, 2)"""
oracle("city_state_counts", "SELECT * FROM counts", NODES, COUNTS)
oracle(
    "city_state_totals",
    """SELECT state, count(*) AS unique_cities, CAST(sum(counts.nodes) AS BIGINT) AS total_nodes
    FROM counts GROUP BY state""",
    NODES, COUNTS,
)
oracle("city_state_report", "SELECT * FROM counts", NODES, COUNTS)
oracle("city_state_clean", "SELECT * FROM clean", NODES, COUNTS, ALIASES, CLEAN)
DISTRICTS = f"""level5 AS ({fx.sql_for_oracle(fx.DISTRICT_RELATIONS)}),
by_tags AS (SELECT DISTINCT coalesce(is_in_state, addr_state,
    CASE WHEN iso LIKE '%-%' THEN split_part(iso, '-', 1) || '-' || split_part(iso, '-', 2) END,
    'Unknown State') AS state, coalesce(name, name_en, 'Unnamed District') AS district
  FROM level5 WHERE boundary = 'administrative' AND admin_level = '5' AND (coalesce(iso LIKE 'IN-%', false)
    OR coalesce(is_in_country = 'IN', false) OR coalesce(addr_country = 'IN', false)
    OR ref_lgd IS NOT NULL OR mdds IS NOT NULL OR is_in_state IS NOT NULL))"""
oracle("state_districts", "SELECT * FROM by_tags", DISTRICTS)
oracle(
    "relation_districts",
    """SELECT DISTINCT parent.state, coalesce(level5.name, level5.name_en, 'Unnamed District') AS district
    FROM level5 JOIN (SELECT ref, min(state) AS state FROM (
        SELECT coalesce(name, 'Unnamed State') AS state,
          unnest(generate_series(first_member, first_member + 15)) AS ref FROM level4
        WHERE boundary = 'administrative' AND admin_level = '4'
          AND (coalesce(iso LIKE 'IN-%', false) OR coalesce(is_in_country = 'IN', false))) m
      WHERE ref % 13 <> 0 GROUP BY ref) parent ON level5.id = parent.ref WHERE admin_level = '5'""",
    DISTRICTS, f"level4 AS ({fx.sql_for_oracle(fx.STATE_RELATIONS)})",
)
oracle(
    "city_district_intersect",
    """SELECT lower(trim(city)) AS name FROM clean WHERE trim(city) <> ''
    INTERSECT SELECT lower(trim(district)) FROM by_tags WHERE trim(district) <> ''""",
    NODES, COUNTS, ALIASES, CLEAN, DISTRICTS,
)


def _parent(bits: str, level: int) -> str:
    unused = (1 << (3 * (15 - level))) - 1
    keep = ~(0xF << 52) & ((1 << 63) - 1)
    return f"lower(hex(({bits} & {keep}) | {level << 52} | {unused}))"


oracle(
    "lookup_from_csv",
    """SELECT r_name AS region, count(*) AS customers FROM customer JOIN nation ON c_nationkey = n_nationkey
    JOIN region ON n_regionkey = r_regionkey GROUP BY r_name""",
)
oracle(
    "cell_parent",
    f"""SELECT id, lower(hex(cell_bits)) AS h3_index, {_parent('cell_bits', 6)} AS cell6,
    {_parent('cell_bits', 4)} AS cell4 FROM nodes""",
    NODES,
)


def _quadkey(level: int, lat: str = "location_lat", lon: str = "location_long") -> str:
    x = f"CAST(least(floor(({lon} + 180.0) / 360.0 * {1 << level}), {(1 << level) - 1}) AS BIGINT)"
    y = f"CAST(least(floor(({lat} + 90.0) / 180.0 * {1 << level}), {(1 << level) - 1}) AS BIGINT)"
    return " || ".join(
        f"CAST((({x} >> {s}) & 1) + 2 * (({y} >> {s}) & 1) AS VARCHAR)" for s in range(level - 1, -1, -1)
    )


oracle("grid_cell", f"SELECT transaction_id, {_quadkey(8)} AS grid8, {_quadkey(5)} AS grid5 FROM tx", TX)
oracle(
    "node_cells",
    f"""SELECT id AS osm_id, 'q' || q AS h3_index, 'q' || left(q, 12) AS cell6, 'q' || left(q, 9) AS cell4
    FROM (SELECT id, {_quadkey(15, 'lat', 'lon')} AS q FROM valid) v""",
    NODES, VALID,
)
INDEX = f"""cells AS (SELECT *, ('0x' || h3_index)::BIGINT AS bits FROM staged),
idx AS (SELECT tier, "key", count(*) AS merchants FROM (
  SELECT 'cell6' AS tier, {_parent('bits', 6)} AS "key" FROM cells
  UNION ALL SELECT 'cell4', {_parent('bits', 4)} FROM cells
  UNION ALL SELECT 'state', state FROM cells) u WHERE "key" IS NOT NULL GROUP BY 1, 2)"""
oracle("locality_index", "SELECT * FROM idx", NODES, VALID, CATEGORIES, STAGED, INDEX)
oracle(
    "locality_match",
    """SELECT osm_id, a.merchants AS cell6_merchants, b.merchants AS cell4_merchants,
    c.merchants AS state_merchants, CASE WHEN a.merchants > 0 THEN 'cell6' WHEN b.merchants > 0 THEN 'cell4'
      WHEN c.merchants > 0 THEN 'state' ELSE 'global' END AS match_tier
    FROM residents r LEFT JOIN idx a ON a.tier = 'cell6' AND a."key" = r.c6
    LEFT JOIN idx b ON b.tier = 'cell4' AND b."key" = r.c4
    LEFT JOIN idx c ON c.tier = 'state' AND c."key" = r.state""",
    NODES, VALID, CATEGORIES, STAGED, INDEX,
    f"""residents AS (SELECT osm_id, state, {_parent('bits', 6)} AS c6, {_parent('bits', 4)} AS c4
    FROM (SELECT *, ('0x' || h3_index)::BIGINT AS bits FROM homes) h)""",
)
oracle(
    "location_type",
    f"""SELECT id, CASE WHEN lower(coalesce(trim(city), '')) IN
      ({', '.join(_quote(m.lower()) for m in METRO)}) THEN 'Metro'
    WHEN coalesce(trim(city), '') <> '' THEN 'Urban'
    WHEN id % 2 = 0 THEN 'Rural' ELSE 'Suburban' END AS location_type FROM nodes""",
    NODES,
)
oracle(
    "address_line",
    """SELECT id, 'No. ' || id || ', MG Road, ' || coalesce(city, coalesce(state, 'Unknown') || ' Region')
    || coalesce(' - ' || postcode, '') AS location FROM nodes""",
    NODES,
)


def _edge_rows(names: str, table: str, corners: list[str], condition: str = "true") -> str:
    """Edges of one closed ring given its corners as 'x, y' expressions."""
    return " UNION ALL ".join(
        f"SELECT {names}, {a.split(', ')[0]} AS ax, {a.split(', ')[1]} AS ay,"
        f" {b.split(', ')[0]} AS bx, {b.split(', ')[1]} AS by_ FROM {table} WHERE {condition}"
        for a, b in zip(corners, corners[1:] + corners[:1])
    )


_BOX = ["x0, y0", "x1, y0", "x1, y1", "x0, y1"]
_STATE_EDGES = _edge_rows("st_nm AS area", "st", ["x0, 8.0E0", "x1, 8.0E0", "x1, 37.0E0", "x0, 37.0E0"])
_DISTRICT_EDGES = " UNION ALL ".join(
    [
        _edge_rows("district AS area", "di", _BOX, "kind <> 1"),
        _edge_rows("district AS area", "di", [*_BOX[:3], "x0, y1 - 2.0E0"], "kind = 1"),
        _edge_rows(
            "district AS area",
            "di",
            ["x0 + 2.0E0, y0 + 2.0E0", "x0 + 3.0E0, y0 + 2.0E0", "x0 + 3.0E0, y0 + 3.0E0", "x0 + 2.0E0, y0 + 3.0E0"],
            "kind = 0",
        ),
    ]
)


def _within(name: str, edges: str) -> str:
    """(x, y, area) of every distinct point inside or on an area's outline."""
    side = "((bx - ax) * (y - ay) - (x - ax) * (by_ - ay))"
    return f"""{name} AS (SELECT x, y, area FROM places, {edges}
  GROUP BY x, y, area HAVING bool_or({side} = 0 AND x BETWEEN least(ax, bx) AND greatest(ax, bx)
      AND y BETWEEN least(ay, by_) AND greatest(ay, by_))
    OR sum(CASE WHEN ((ay > y) <> (by_ > y)) AND (({side} > 0) = (by_ > ay)) THEN 1 ELSE 0 END) % 2 = 1)"""


AREAS = f"""st AS ({fx.sql_for_oracle(fx.STATE_SHAPES)}), di AS ({fx.sql_for_oracle(fx.DISTRICT_SHAPES)}),
state_edges AS ({_STATE_EDGES}), district_edges AS ({_DISTRICT_EDGES}),
{_within('in_state', 'state_edges')}, {_within('in_district', 'district_edges')}"""
oracle(
    "spatial_join",
    """SELECT transaction_id, location_lat, location_long, s.area AS state, d.area AS district FROM tx
    LEFT JOIN in_state s ON s.x = location_long AND s.y = location_lat
    LEFT JOIN in_district d ON d.x = location_long AND d.y = location_lat""",
    TX, "places AS (SELECT DISTINCT location_long AS x, location_lat AS y FROM tx)", AREAS,
    settle=("location_lat", "location_long"),
)
MARTS = f"""places AS (SELECT DISTINCT lon AS x, lat AS y FROM valid), {AREAS},
mart_m AS (SELECT osm_id, h3_index, latitude, longitude, merchant_name, merchant_category, risk_level,
  {_city('city')} AS city, regexp_replace(postcode, '[^0-9]', '', 'g') AS pincode, s.area AS state,
  d.area AS district_name FROM staged LEFT JOIN in_state s ON s.x = longitude AND s.y = latitude
  LEFT JOIN in_district d ON d.x = longitude AND d.y = latitude),
mart_r AS (SELECT osm_id, h3_index, latitude, longitude, {_city('city')} AS city,
  regexp_replace(postcode, '[^0-9]', '', 'g') AS pincode, s.area AS state, d.area AS district_name
  FROM staged_homes LEFT JOIN in_state s ON s.x = longitude AND s.y = latitude
  LEFT JOIN in_district d ON d.x = longitude AND d.y = latitude)"""
MART_CTES = (NODES, VALID, CATEGORIES, STAGED, STATES, STAGED_HOMES, MARTS)
oracle("mart_merchants", "SELECT * FROM mart_m", *MART_CTES, settle=LATLON)
oracle("mart_residential", "SELECT * FROM mart_r", *MART_CTES, settle=LATLON)
oracle(
    "district_summary",
    """SELECT coalesce(r.state, m.state) AS state, coalesce(r.district_name, m.district_name) AS district_name,
    coalesce(n, 0) AS residential_nodes, coalesce(k, 0) AS merchant_nodes,
    coalesce(very_high, 0) AS high_risk_merchants, coalesce(high, 0) AS medium_high_risk_merchants,
    CASE WHEN coalesce(n, 0) > 0 THEN round(CAST(coalesce(k, 0) AS DECIMAL(18, 0)) * 100 / n) / 100 ELSE 0 END
      AS merchant_to_residential_ratio
    FROM (SELECT state, district_name, count(*) AS n FROM mart_r GROUP BY 1, 2) r
    FULL OUTER JOIN (SELECT state, district_name, count(*) AS k,
      count(CASE WHEN risk_level = 'VERY_HIGH' THEN 1 END) AS very_high,
      count(CASE WHEN risk_level = 'HIGH' THEN 1 END) AS high FROM mart_m GROUP BY 1, 2) m
    ON r.state = m.state AND r.district_name = m.district_name""",
    *MART_CTES,
    settle=("merchant_to_residential_ratio",),
)
oracle(
    "export_refs",
    """SELECT osm_id, h3_index, merchant_name, latitude, longitude, merchant_category, risk_level
    FROM mart_m""",
    *MART_CTES,
    settle=LATLON,
)

# --- landing ------------------------------------------------------------------------------

oracle(
    "landing_period",
    f"""SELECT transaction_id, customer_id, amount, epoch_us(tx_ts) // 1000 AS "timestamp" FROM tx
    WHERE tx_ts >= TIMESTAMP '{PERIOD[0]}' AND tx_ts < TIMESTAMP '{PERIOD[1]}'""",
    TX,
    settle=("amount",),
)
oracle(
    "landing_in_parts",
    """SELECT transaction_id, customer_id, CASE WHEN transaction_id % 30 = 0 THEN amount + 1 ELSE amount END AS amount,
    epoch_us(CASE WHEN transaction_id % 30 = 0 THEN tx_ts + INTERVAL 1 DAY ELSE tx_ts END) // 1000 AS "timestamp" FROM tx""",
    TX,
    settle=("amount",),
)

# --- evaluation ---------------------------------------------------------------------------


def _hash(key: str, seed: str) -> str:
    return f"('0x' || substr(md5('{seed}:' || {key}), 1, 8))::BIGINT"


def _uniform(key: str, seed: str) -> str:
    return f"({_hash(key, seed)} / 4294967296.0E0)"


oracle(
    "strat_split",
    f"""SELECT transaction_id, is_fraud, CASE WHEN {_uniform('transaction_id', '42')} < 0.2
    THEN 'test' ELSE 'train' END AS split FROM tx""",
    TX,
)
oracle(
    "strat_split_exact",
    f"""SELECT transaction_id, is_fraud, CASE WHEN row_number() OVER (PARTITION BY is_fraud
      ORDER BY {_hash('transaction_id', '42')}, transaction_id)
      <= floor(count(*) OVER (PARTITION BY is_fraud) * 0.2E0 + 0.5E0) THEN 'test' ELSE 'train' END AS split FROM tx""",
    TX,
)
oracle(
    "amount_sketches",
    """SELECT is_fraud, count(*) AS payments, 1 AS median_fits, 1 AS p75_fits, 1 AS p95_fits
    FROM tx WHERE amount IS NOT NULL GROUP BY is_fraud""",
    TX,
)
oracle(
    "merchant_draw",
    f"""SELECT r.osm_id, drawn_tier, p.tier, merchant FROM (
      SELECT *, CASE WHEN drawn_n IS NULL THEN 'global' ELSE drawn_tier END AS used_tier,
        CASE WHEN drawn_n IS NULL THEN '' ELSE drawn_key END AS used_key,
        {_hash('osm_id', 'draw-place')} % coalesce(drawn_n, (SELECT n FROM sizes WHERE tier = 'global')) AS used_place
      FROM drawn LEFT JOIN (SELECT tier, "key", n AS drawn_n FROM sizes) z
      ON z.tier = drawn_tier AND z."key" = drawn_key) r
    LEFT JOIN places p ON p.tier = used_tier AND p."key" = used_key AND p.place = used_place""",
    NODES, VALID, CATEGORIES, STAGED, INDEX,
    f"""places AS (SELECT tier, "key", osm_id AS merchant,
      row_number() OVER (PARTITION BY tier, "key" ORDER BY osm_id) - 1 AS place FROM (
      SELECT 'cell6' AS tier, {_parent('bits', 6)} AS "key", osm_id FROM cells
      UNION ALL SELECT 'cell4', {_parent('bits', 4)}, osm_id FROM cells
      UNION ALL SELECT 'state', state, osm_id FROM cells
      UNION ALL SELECT 'global', '', osm_id FROM cells) u WHERE "key" IS NOT NULL)""",
    "sizes AS (SELECT tier, \"key\", count(*) AS n FROM places GROUP BY 1, 2)",
    f"""drawn AS (SELECT osm_id, drawn_tier, CASE drawn_tier WHEN 'cell6' THEN {_parent('bits', 6)}
      WHEN 'cell4' THEN {_parent('bits', 4)} WHEN 'state' THEN state ELSE '' END AS drawn_key
      FROM (SELECT *, CASE WHEN u < 0.80E0 THEN 'cell6' WHEN u < 0.95E0 THEN 'cell4' WHEN u < 0.98E0 THEN 'state'
        ELSE 'global' END AS drawn_tier
        FROM (SELECT *, ('0x' || h3_index)::BIGINT AS bits, {_uniform('osm_id', 'draw-tier')} AS u FROM homes) h) g)""",
)
oracle(
    "oot_split",
    """SELECT transaction_id, CASE WHEN (epoch_us(tx_ts) // 1000) < (SELECT min((epoch_us(tx_ts) // 1000))
      + (max((epoch_us(tx_ts) // 1000)) - min((epoch_us(tx_ts) // 1000))) * 0.75E0 FROM tx)
    THEN 'train' ELSE 'test' END AS split FROM tx""",
    TX,
)
oracle(
    "class_weight",
    """SELECT CAST(sum(is_fraud) AS BIGINT) AS fraud, CAST(sum(1 - is_fraud) AS BIGINT) AS legitimate,
    CAST(sum(1 - is_fraud) AS DOUBLE) / sum(is_fraud) AS scale_pos_weight FROM tx""",
    TX,
    settle=("scale_pos_weight",),
)
STEPS = """steps AS (SELECT score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY score)"""
oracle(
    "roc_auc",
    """SELECT CAST(sum(pos) AS BIGINT) AS positives, CAST(sum(neg) AS BIGINT) AS negatives,
    sum(pos * (below + neg / 2.0E0)) / (CAST(sum(pos) AS DOUBLE) * sum(neg)) AS auc
    FROM (SELECT *, coalesce(sum(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
      AND 1 PRECEDING), 0) AS below FROM steps) s""",
    SCORED, STEPS, settle=("auc",),
)
oracle(
    "confusion",
    """SELECT label AS actual, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predicted, count(*) AS n
    FROM scored GROUP BY 1, 2""",
    SCORED,
)
oracle(
    "class_report",
    """SELECT label, "precision", recall, CASE WHEN "precision" + recall > 0
      THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1, support FROM (
    SELECT c.label, coalesce(sum(CASE WHEN s.label = c.label AND y = c.label THEN 1 END) * 1.0E0
        / nullif(sum(CASE WHEN y = c.label THEN 1 END), 0), 0) AS "precision",
      coalesce(sum(CASE WHEN s.label = c.label AND y = c.label THEN 1 END) * 1.0E0
        / nullif(sum(CASE WHEN s.label = c.label THEN 1 END), 0), 0) AS recall,
      count(CASE WHEN s.label = c.label THEN 1 END) AS support
    FROM (SELECT label, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS y FROM scored) s,
      (VALUES (0), (1)) c(label) GROUP BY c.label) r""",
    SCORED,
    settle=("precision", "recall", "f1"),
)
CURVE = """curve AS (SELECT score AS threshold,
  sum(pos) OVER w * 1.0E0 / (sum(pos) OVER w + sum(neg) OVER w) AS "precision",
  sum(pos) OVER w * 1.0E0 / (SELECT sum(label) FROM scored) AS recall
  FROM steps WINDOW w AS (ORDER BY score DESC ROWS UNBOUNDED PRECEDING))"""
oracle(
    "pr_curve", "SELECT * FROM curve", SCORED, STEPS, CURVE,
    settle=("threshold", "precision", "recall"),
)
oracle(
    "pr_thresholds",
    f"""SELECT target_recall, threshold, "precision", recall, CASE WHEN "precision" + recall > 0
      THEN 2 * "precision" * recall / ("precision" + recall) ELSE 0 END AS f1 FROM (
    SELECT CAST(t AS DOUBLE) AS target_recall, curve.*, abs(recall - t) AS gap, row_number() OVER
      (PARTITION BY t ORDER BY abs(recall - t), threshold) AS rn
    FROM curve, (VALUES {', '.join(f'({t}E0)' for t in RECALL_TARGETS)}) targets(t)) b
    WHERE rn = 1 AND gap <= target_recall""",
    SCORED, STEPS, CURVE,
    settle=("target_recall", "threshold", "precision", "recall", "f1"),
)
oracle(
    "category_overrep",
    """SELECT merchant_category, "count", flag_count, global_share, flag_share,
    flag_share / global_share AS "index", hits * 1.0E0 / nullif(flag_count, 0) AS verified_fraud_rate
    FROM (SELECT merchant_category, n AS "count", f AS flag_count, hits,
      n * 1.0E0 / (SELECT count(*) FROM scored) AS global_share,
      coalesce(f * 1.0E0 / nullif((SELECT count(*) FROM scored WHERE score >= 0.957), 0), 0) AS flag_share
      FROM (SELECT merchant_category, count(*) AS n, count(CASE WHEN score >= 0.957 THEN 1 END) AS f,
        sum(CASE WHEN score >= 0.957 THEN label END) AS hits FROM scored GROUP BY 1) g) s""",
    SCORED,
    settle=("global_share", "flag_share", "index", "verified_fraud_rate"),
)
oracle(
    "amount_profile",
    """SELECT is_fraud, count(*) AS payments, avg(amount) AS mean, quantile_cont(amount, 0.5) AS median,
    quantile_cont(amount, 0.75) AS p75, quantile_cont(amount, 0.95) AS p95 FROM tx GROUP BY is_fraud""",
    TX,
    settle=("mean", "median", "p75", "p95"),
)
oracle(
    "amount_bins",
    "SELECT transaction_id, amount, CASE "
    + " ".join(f"WHEN amount <= {e} THEN '{n}'" for e, n in zip(BIN_EDGES, BIN_NAMES))
    + f" ELSE '{BIN_NAMES[-1]}' END AS amount_bin FROM tx",
    TX,
    settle=("amount",),
)
oracle(
    "operating_mode",
    "SELECT transaction_id, score, CASE "
    + " ".join(f"WHEN score >= {t}E0 THEN '{n}'" for n, t in reversed(OPERATING_MODES))
    + " ELSE 'None' END AS operating_mode FROM scored",
    SCORED,
    settle=("score",),
)
oracle(
    "balanced_sample",
    f"""SELECT transaction_id, is_fraud, amount FROM tx WHERE is_fraud = 1 UNION ALL
    SELECT transaction_id, is_fraud, amount FROM (SELECT *, row_number() OVER
      (ORDER BY {_hash('transaction_id', 'sample')}, transaction_id) AS rn FROM tx WHERE is_fraud = 0) n
    WHERE rn <= 500""",
    TX,
    settle=("amount",),
)
_SEGMENT = [
    "time_since_last_transaction", "spatial_velocity", "hour_deviation_from_norm",
    "amount_deviation_z_score",
]
oracle(
    "segment_top_features",
    'SELECT fraud_type, feature, mean_abs, CAST(r AS INT) AS "rank" FROM (SELECT *, row_number() OVER'
    " (PARTITION BY fraud_type ORDER BY mean_abs DESC, feature) AS r FROM ("
    + " UNION ALL ".join(
        f"SELECT fraud_type, '{f}' AS feature, avg(abs({f})) AS mean_abs FROM silver GROUP BY 1"
        for f in _SEGMENT
    )
    + ") u) t WHERE r <= 3",
    TX, META, SEQ, SILVER, settle=("mean_abs",),
)
oracle(
    "score_vs_truth",
    "SELECT transaction_id, score, fraud_target FROM scored JOIN meta USING (transaction_id)",
    SCORED, META, settle=("score",),
)
oracle(
    "operational_features",
    """SELECT time_since_last_transaction, transaction_sequence_number, spatial_velocity,
    hour_deviation_from_norm, amount_deviation_z_score, rapid_fire_transaction_flag,
    escalating_amounts_flag, merchant_category_switch_flag, transaction_channel, card_present,
    merchant_category, suspicious_cluster_member FROM gold""",
    *GOLD_CTES,
    settle=(
        "time_since_last_transaction", "spatial_velocity", "hour_deviation_from_norm",
        "amount_deviation_z_score",
    ),
)
oracle(
    "score_flag",
    """SELECT transaction_id, score AS fraud_probability, CASE WHEN score > 0.85 THEN 1 ELSE 0 END AS flagged
    FROM scored""",
    SCORED,
    settle=("fraud_probability",),
)

# --- sampling, cards ------------------------------------------------------------------------


def _draw(weights: dict[str, float], key: str, seed: str) -> str:
    total = float(sum(weights.values()))
    names, branches, upto = list(weights), [], total - weights[list(weights)[-1]]
    for name in reversed(names[:-1]):
        branches.insert(0, f"WHEN u < {upto!r}E0 THEN '{name}'")
        upto -= weights[name]
    return (
        f"SELECT {key}, CASE {' '.join(branches)} ELSE '{names[-1]}' END AS fraud_type"
        f" FROM (SELECT {key}, {_uniform(key, seed)} * {total!r}E0 AS u FROM tx) d"
    )


oracle("weighted_draw", _draw(FRAUD_MIX, "transaction_id", "draw"), TX)
oracle(
    "label_noise",
    f"""SELECT transaction_id, fraud_target, CASE label_noise WHEN 'fn' THEN 0 WHEN 'fp' THEN 1
      ELSE fraud_target END AS noisy_label, label_noise FROM (
    SELECT transaction_id, is_fraud AS fraud_target, CASE
      WHEN is_fraud = 1 AND {_uniform('transaction_id', 'noise-fn')} < 0.08 THEN 'fn'
      WHEN is_fraud = 0 AND {_uniform('transaction_id', 'noise-fp')} < 0.005 THEN 'fp'
      ELSE 'none' END AS label_noise FROM tx) n""",
    TX,
)
oracle(
    "card_status",
    f"""SELECT card_id, CAST(issue AS VARCHAR) AS issue_date, CAST(activation AS VARCHAR) AS activation_date,
    CAST(expiry AS VARCHAR) AS expiry_date, days_to_expiry, status, CASE status
      WHEN 'Active' THEN 'Normal usage' WHEN 'Blocked' THEN 'Suspected Fraud'
      ELSE 'Card Validity Ended' END AS status_reason FROM (
    SELECT account_id AS card_id, creation_date AS issue, creation_date + 1095 AS expiry,
      creation_date + CAST(2 + floor({_uniform('account_id', 'card-activation')} * 3) AS INT) AS activation,
      CAST(date_diff('day', DATE '2001-06-30', creation_date + 1095) AS INT) AS days_to_expiry,
      CASE WHEN date_diff('day', DATE '2001-06-30', creation_date + 1095) <= 0 THEN 'Expired'
        WHEN {_uniform('account_id', 'card-status')} < 0.90 THEN 'Active' ELSE 'Blocked' END AS status
    FROM acc) c""",
    ACC,
)
oracle(
    "registration_parts",
    """SELECT account_id, CAST(year(creation_date) AS INT) AS registration_year,
    CAST(month(creation_date) AS INT) AS registration_month,
    CAST(day(creation_date) AS INT) AS registration_day FROM acc""",
    ACC,
)
oracle("union_parts", "SELECT transaction_id, customer_id, amount FROM tx", TX, settle=("amount",))

# --- live features, replayed ------------------------------------------------------------------

oracle(
    "stream_zscore",
    """SELECT transaction_id, customer_id, n AS count_before, coalesce(m, 0) AS mean_before,
    CASE WHEN n > 1 THEN s ELSE 0 END AS std_before,
    CASE WHEN n > 1 AND s > 0 THEN (amount - m) / s ELSE 0 END AS amount_deviation_z_score
    FROM (SELECT *, count(*) OVER w AS n, avg(amount) OVER w AS m, stddev_pop(amount) OVER w AS s
      FROM tx WINDOW w AS (PARTITION BY customer_id ORDER BY tx_ts, transaction_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)) b""",
    TX,
    settle=("mean_before", "std_before", "amount_deviation_z_score"),
)
oracle(
    "stream_card_features",
    """SELECT transaction_id, card_id, coalesce(gap, 0) AS time_since_last_transaction,
    rn AS transaction_sequence_number,
    CASE WHEN p_cat <> merchant_category THEN 1 ELSE 0 END AS merchant_category_switch_flag,
    CASE WHEN amount > p THEN 1 ELSE 0 END AS escalating_amounts_flag,
    CASE WHEN gap > 0 THEN least(sqrt((location_lat - p_lat) * (location_lat - p_lat)
      + (location_long - p_lon) * (location_long - p_lon)) * 111 / (gap / 3600.0E0), 1000) ELSE 0 END
      AS spatial_velocity
    FROM (SELECT *, (epoch_us(tx_ts) - lag(epoch_us(tx_ts)) OVER w) / 1000000.0E0 AS gap,
      lag(amount) OVER w AS p, lag(merchant_category) OVER w AS p_cat, lag(location_lat) OVER w AS p_lat,
      lag(location_long) OVER w AS p_lon, row_number() OVER w AS rn
      FROM tx WINDOW w AS (PARTITION BY card_id ORDER BY tx_ts, transaction_id)) b""",
    TX,
    settle=("time_since_last_transaction", "spatial_velocity"),
)
for _name, _seconds in (("stream_burst", 60), ("stream_burst_wide", WIDE_SECONDS)):
    oracle(
        _name,
        f"""SELECT transaction_id, card_id, n AS burst_count,
        CASE WHEN n > 3 THEN 1 ELSE 0 END AS rapid_fire_transaction_flag FROM (SELECT *, count(*) OVER
          (PARTITION BY card_id ORDER BY epoch_us(tx_ts)
            RANGE BETWEEN {_seconds * 1_000_000 - 1} PRECEDING AND CURRENT ROW) AS n
        FROM tx) b""",
        TX,
    )
oracle(
    "card_history",
    """SELECT card_id, transaction_id, merchant_category, amount, (epoch_us(tx_ts) // 1000) AS "timestamp",
    location_lat, location_long, CAST(rn AS INT) AS rn FROM (SELECT *, row_number() OVER
      (PARTITION BY card_id ORDER BY tx_ts DESC, transaction_id DESC) AS rn FROM tx) h WHERE rn <= 10""",
    TX,
    settle=("amount", "location_lat", "location_long"),
)
oracle(
    "card_last_state",
    """SELECT card_id, (epoch_us(tx_ts) // 1000) AS last_ts, location_lat AS last_lat, location_long AS last_lon,
    merchant_category AS last_category, amount AS last_amount, seq FROM (SELECT *, row_number() OVER
      (PARTITION BY card_id ORDER BY tx_ts DESC, transaction_id DESC) AS rn,
      count(*) OVER (PARTITION BY card_id) AS seq FROM tx) h WHERE rn = 1""",
    TX,
    settle=("last_lat", "last_lon", "last_amount"),
)
oracle(
    "welford_seed",
    """SELECT customer_id, count(*) AS "count", avg(amount) AS mean, var_pop(amount) * count(*) AS m2
    FROM tx GROUP BY customer_id""",
    TX,
    settle=("mean", "m2"),
)
oracle(
    "customer_agg_seed",
    """SELECT customer_id, max(cf_fraud_rate) AS fraud_rate, max(cf_night_tx_ratio) AS night_ratio
    FROM gold GROUP BY customer_id""",
    *GOLD_CTES,
    settle=("fraud_rate", "night_ratio"),
)
oracle(
    "merchant_agg_seed",
    "SELECT merchant_id, avg(is_fraud) AS fraud_rate FROM tx GROUP BY merchant_id",
    TX,
    settle=("fraud_rate",),
)
oracle(
    "unlabeled_projection",
    """SELECT * EXCLUDE (is_fraud, chargeback, chargeback_days, tx_ts), (epoch_us(tx_ts) // 1000) AS "timestamp" FROM tx""",
    TX,
    settle=("amount", "location_lat", "location_long"),
)
oracle(
    "align_features",
    """SELECT transaction_id, CAST(CAST(amount AS FLOAT) AS DOUBLE) AS amount, card_present, merchant_category,
    CAST(0 AS FLOAT) AS spatial_velocity, 0 AS suspicious_cluster_member FROM tx""",
    TX,
    settle=("amount",),
)
oracle(
    "event_json_encode",
    """SELECT CAST(transaction_id AS VARCHAR) AS "key", customer_id, amount, merchant_category,
    (epoch_us(tx_ts) // 1000) AS ts_ms, CAST(NULL AS VARCHAR) AS is_fraud FROM tx""",
    TX,
    settle=("amount",),
)
oracle(
    "event_json_decode",
    """SELECT CAST(transaction_id AS VARCHAR) AS message_key,
    CASE WHEN transaction_id % 13 <> 0 THEN CAST(transaction_id AS VARCHAR) END AS transaction_id,
    CASE WHEN transaction_id % 13 <> 0 THEN CAST(card_id AS VARCHAR) END AS card_id,
    CASE WHEN transaction_id % 13 <> 0 THEN amount END AS amount,
    CASE WHEN transaction_id % 13 <> 0 THEN (epoch_us(tx_ts) // 1000) END AS ts_ms,
    CASE WHEN transaction_id % 13 <> 0 THEN 0 ELSE 1 END AS bad FROM tx""",
    TX,
    settle=("amount",),
)

_TRAIN = f"train AS (SELECT * FROM tx WHERE {_uniform('transaction_id', '42')} >= 0.2)"
oracle(
    "path_contributions",
    f"""SELECT count(*) AS payments, 1 AS exact FROM tx WHERE {_uniform('transaction_id', '42')} < 0.2""",
    TX,
)
oracle(
    "feature_spec",
    "SELECT feature, type, coalesce(levels, '') AS levels FROM (VALUES "
    + ", ".join(f"({_quote(n)}, {_quote(k)})" for n, k in FEATURE_SPEC.items())
    + ") s(feature, type) LEFT JOIN ("
    + " UNION ALL ".join(
        f"SELECT '{c}' AS name, string_agg({c}, ',' ORDER BY n DESC, {c}) AS levels"
        f" FROM (SELECT {c}, count(*) AS n FROM train GROUP BY 1)"
        for c in CATEGORICAL
    )
    + ") l ON name = feature",
    TX, _TRAIN,
)
oracle("model_checks", "SELECT * FROM (VALUES ('auc_above_0.9', 1), ('importances_sum_to_1', 1)) v(name, holds)")

# Splitting hot keys must not change an answer.
ORACLES |= {f"{name}_sliced": ORACLES[name] for name in SLICED}
