"""Table schemas: enforced on read and used to decode stream messages."""

from __future__ import annotations

from pyspark.sql import types as T

_S, _D, _B, _I, _L = T.StringType(), T.DoubleType(), T.BooleanType(), T.IntegerType(), T.LongType()


def _struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields.items()])


# Column names and types of the stored tables and the stream message.
TRANSACTIONS = _struct(
    transaction_id=_S, card_id=_S, account_id=_S, customer_id=_S, merchant_id=_S,
    merchant_name=_S, merchant_category=_S, mcc=_S, merchant_country=_S, amount=_D,
    currency=_S, timestamp=_S, transaction_channel=_S, card_present=_B, user_agent=_S,
    ip_address=_S, status=_S, auth_status=_S, failure_reason=_S, is_fraud=_B,
    chargeback=_B, chargeback_days=_I, location_lat=_D, location_long=_D, h3_r7=_S,
)

LABEL_COLUMNS = ["is_fraud", "chargeback", "chargeback_days"]

STREAM_MESSAGE = T.StructType([f for f in TRANSACTIONS if f.name not in LABEL_COLUMNS])

FRAUD_METADATA = _struct(
    transaction_id=_S, fraud_target=_B, fraud_type=_S, label_noise=_S, injector_version=_S,
    geo_anomaly=_B, device_anomaly=_B, ip_anomaly=_B, flags=_S, burst_session=_B,
    burst_seq=_I, campaign_id=_S, campaign_type=_S, campaign_phase=_S, campaign_day_number=_I,
)

CUSTOMERS = _struct(
    customer_id=_S, name=_S, age=_I, email=_S, state=_S, location=_S, location_type=_S,
    home_latitude=_D, home_longitude=_D, home_h3r5=_S, home_h3r7=_S, credit_score=_I,
    monthly_spend=_D, customer_risk_score=_D, is_fraud=_B, primary_ua=_S, secondary_ua=_S,
    isp=_S, ip_subnet=_S, registration_date=_S,
)

ACCOUNTS = _struct(
    account_id=_S, customer_id=_S, bank_id=_S, account_no=_S, account_type=_S, balance=_D,
    status=_S, creation_date=_S,
)

CARDS = _struct(
    card_id=_S, account_id=_S, customer_id=_S, card_number=_S, card_network=_S, card_type=_S,
    status=_S, status_reason=_S, issue_date=_S, activation_date=_S, expiry_date=_S,
    contactless_limit=_S, daily_atm_limit=_S, online_limit=_S, international_usage=_S,
    issuing_bank=_S, bank_code=_S,
)

MAP_MEMBER = _struct(type=_S, ref=_L)
MAP_NODES = _struct(id=_L, lat=_D, lon=_D, tags=T.MapType(_S, _S), h3_index=_S)
MAP_RELATIONS = _struct(id=_L, tags=T.MapType(_S, _S), members=T.ArrayType(MAP_MEMBER))

RING = T.ArrayType(_struct(lon=_D, lat=_D))
BOUNDARIES = _struct(st_nm=_S, district=_S, rings=T.ArrayType(RING))

FRAUD_SCORES = _struct(
    transaction_id=_S, card_id=_S, customer_id=_S, amount=_D, timestamp=T.TimestampType(),
    kafka_received_at=T.TimestampType(), fraud_probability=_D, flagged=_I,
    scored_at=T.TimestampType(),
)
