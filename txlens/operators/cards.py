"""Card life cycle from its dates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txlens.functions.hashing import hash_uniform

VALID_DAYS = 365 * 3
ACTIVE_SHARE = 0.90

# Reason text per status.
STATUS_REASONS = {
    "Active": "Normal usage",
    "Blocked": "Suspected Fraud",
    "Expired": "Card Validity Ended",
}


def card_status(
    cards: DataFrame, today: Column, key: str = "card_id", issued: str = "issue_date", seed: str = "card"
) -> DataFrame:
    """Activation, expiry, days left, status and reason; live cards draw Active or Blocked."""
    issue = F.col(issued).cast("date")
    expiry = F.date_add(issue, VALID_DAYS)
    wait = 2 + F.floor(hash_uniform(F.col(key), f"{seed}-activation") * 3).cast("int")
    left = F.datediff(expiry, today)
    live = F.when(hash_uniform(F.col(key), f"{seed}-status") < ACTIVE_SHARE, "Active").otherwise(
        "Blocked"
    )
    out = cards.withColumns(
        {
            "activation_date": F.date_add(issue, wait),
            "expiry_date": expiry,
            "days_to_expiry": left,
            "status": F.when(left <= 0, "Expired").otherwise(live),
        }
    )
    reason = F.lit("Unknown")
    for status, text in STATUS_REASONS.items():
        reason = F.when(F.col("status") == status, text).otherwise(reason)
    return out.withColumn("status_reason", reason)


def registration_parts(customers: DataFrame, column: str = "registration_date") -> DataFrame:
    date = F.col(column).cast("date")
    return customers.withColumns(
        {
            "registration_date": date,
            "registration_year": F.year(date),
            "registration_month": F.month(date),
            "registration_day": F.dayofmonth(date),
        }
    )
