"""Live features: one stateful operator keyed by customer.

A card belongs to one customer, so a single shuffle on the customer serves the customer's
running mean and every card's last payment. Payments of a customer are put in
(timestamp, id) order within a micro-batch and computed as arrays, one step per card; the size of a batch, and with it
the rows of a busy customer held at once, is set by the source's per-trigger limit.

Late payments: one that is older than the card's latest payment is scored, with ``late_flag`` 1, but does
not move the card back. It counts as a payment of the card (sequence number) and of the customer (running
amount statistics), and in the bursts it falls into; its gap, velocity, escalation and category switch, which
would compare it with a later payment, are 0, and it does not enter the history.

Expiry: with ``idle`` set, event time decides. A timer per card fires once the watermark has passed the card's
latest payment by ``idle``; the card's state goes, and with the last card the customer's. Payments
older than the watermark are then dropped by Spark, as their state may be gone.
"""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, GroupedData
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from txlens.functions.timeparts import epoch_micros
from txlens.operators.replay import (
    BURST_LIMIT,
    BURST_SECONDS,
    HISTORY_LENGTH,
    MAX_LIVE_VELOCITY,
    MICROS,
)

CUSTOMER_STATE = T.StructType(
    [
        T.StructField("count", T.LongType()),
        T.StructField("mean", T.DoubleType()),
        T.StructField("m2", T.DoubleType()),
    ]
)

CARD_KEY = T.StructType([T.StructField("card_id", T.StringType())])

CARD_STATE = T.StructType(
    [
        T.StructField("last_us", T.LongType()),
        T.StructField("lat", T.DoubleType()),
        T.StructField("lon", T.DoubleType()),
        T.StructField("category", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("seq", T.LongType()),
        T.StructField("recent_us", T.ArrayType(T.LongType())),
        T.StructField("history", T.ArrayType(T.StringType())),
    ]
)

PASSED = ["transaction_id", "card_id", "merchant_id", "amount", "timestamp", "received_at",
          "merchant_category", "transaction_channel", "card_present"]

FEATURES = T.StructType(
    [
        T.StructField("customer_id", T.StringType()),
        T.StructField("transaction_id", T.StringType()),
        T.StructField("card_id", T.StringType()),
        T.StructField("merchant_id", T.StringType()),
        T.StructField("amount", T.DoubleType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("received_at", T.TimestampType()),
        T.StructField("merchant_category", T.StringType()),
        T.StructField("transaction_channel", T.StringType()),
        T.StructField("card_present", T.IntegerType()),
        T.StructField("time_since_last_transaction", T.DoubleType()),
        T.StructField("transaction_sequence_number", T.LongType()),
        T.StructField("burst_count", T.LongType()),
        T.StructField("rapid_fire_transaction_flag", T.IntegerType()),
        T.StructField("escalating_amounts_flag", T.IntegerType()),
        T.StructField("merchant_category_switch_flag", T.IntegerType()),
        T.StructField("amount_deviation_z_score", T.DoubleType()),
        T.StructField("spatial_velocity", T.DoubleType()),
        T.StructField("hour_deviation_from_norm", T.DoubleType()),
        T.StructField("late_flag", T.IntegerType()),
        T.StructField("history", T.ArrayType(T.StringType())),
    ]
)


def amount_scores(
    stats: tuple[int, float, float], amount: np.ndarray
) -> tuple[np.ndarray, tuple[int, float, float]]:
    """z-score of every amount against all amounts before it; then count, mean and squared deviations after the last.

    Sums are taken of differences to the first amount, so that equal amounts deviate by exactly 0.
    """
    seen, mean_before, m2_before = stats
    diff = amount - amount[0]
    n = np.arange(len(amount) + 1)
    total = np.concatenate(([0.0], np.cumsum(diff)))
    squares = np.concatenate(([0.0], np.cumsum(diff * diff)))
    count = seen + n
    mean = amount[0] + total / np.maximum(n, 1)
    m2 = np.maximum(squares - total * total / np.maximum(n, 1), 0.0)
    # Joined with what was known before the batch.
    weight = n / np.maximum(count, 1)
    shift = mean - mean_before
    m2 = m2_before + m2 + shift * shift * seen * weight
    mean = mean_before + shift * weight
    std = np.where(count > 1, np.sqrt(m2 / np.maximum(count, 1)), 0.0)[:-1]
    scores = np.divide(amount - mean[:-1], std, out=np.zeros(len(amount)), where=std > 0)
    return scores, (int(count[-1]), float(mean[-1]), float(m2[-1]))


def card_features(card: dict | None, rows: pd.DataFrame) -> tuple[pd.DataFrame, dict]:
    """(features of one card's payments, its state after them); ``rows`` are in (event_us, transaction_id) order.

    Late payments are the first of these rows, so the others form one run that continues the state.
    """
    at = rows["event_us"].to_numpy("int64")
    n_late = int(np.searchsorted(at, card["last_us"])) if card else 0
    late = np.arange(len(at)) < n_late
    known = np.ones(len(at) - n_late, dtype=bool)
    if card is None:
        known[0] = False
    category = rows["merchant_category"].astype(object).where(rows["merchant_category"].notna(), None)

    def with_before(values: np.ndarray, field: str) -> np.ndarray:
        """Values of the run, led by the state's; a new card's first row stands before itself."""
        return np.concatenate((np.array([card[field] if card else values[0]], dtype=values.dtype), values[n_late:]))

    def not_late(values: np.ndarray) -> np.ndarray:
        return np.concatenate((np.zeros(n_late, dtype=values.dtype), values))

    amount = with_before(rows["amount"].to_numpy("float64"), "amount")
    kinds = with_before(category.to_numpy(object), "category")
    gap = np.diff(with_before(at, "last_us")) / MICROS
    km = 111.0 * np.hypot(
        np.diff(with_before(rows["location_lat"].to_numpy("float64"), "lat")),
        np.diff(with_before(rows["location_long"].to_numpy("float64"), "lon")),
    )
    velocity = np.divide(km, gap / 3600.0, out=np.zeros(len(gap)), where=known & (gap > 0))

    # Times of the last minute, in the state and in this batch up to the row itself.
    recent = np.sort(np.array(card["recent_us"] if card else [], dtype="int64"))
    newest = np.maximum(at, card["last_us"]) if card else at
    start = newest - BURST_SECONDS * MICROS
    stored = np.searchsorted(recent, at, "right") - np.searchsorted(recent, start, "right")
    fresh = np.arange(1, len(at) + 1) - np.searchsorted(at, start, "right")
    burst = np.maximum(1, np.maximum(stored, 0) + np.maximum(fresh, 0))

    seq = (card["seq"] if card else 0) + np.arange(1, len(at) + 1)
    past = list(card["history"]) if card else []
    ids = [*past[::-1], *rows["transaction_id"].iloc[n_late:]]  # oldest first
    upto = len(past) + np.maximum(np.arange(1, len(at) + 1) - n_late, 0)
    history = [ids[max(0, k - HISTORY_LENGTH) : k][::-1] for k in upto]

    features = pd.DataFrame(
        {
            "time_since_last_transaction": not_late(np.where(known, gap, 0.0)),
            "transaction_sequence_number": seq,
            "burst_count": burst,
            "rapid_fire_transaction_flag": (burst > BURST_LIMIT).astype("int32"),
            "escalating_amounts_flag": not_late((known & (amount[1:] > amount[:-1])).astype("int32")),
            "merchant_category_switch_flag": not_late((known & (kinds[1:] != kinds[:-1])).astype("int32")),
            "spatial_velocity": not_late(np.minimum(velocity, MAX_LIVE_VELOCITY)),
            "late_flag": late.astype("int32"),
            "history": history,
        },
        index=rows.index,
    )
    after = {
        "seq": int(seq[-1]),
        "recent_us": np.sort(np.concatenate((recent[recent > start[-1]], at[at > start[-1]]))).tolist(),
    }
    if late.all():
        return features, card | after
    last = rows.iloc[-1]
    after |= {
        "last_us": int(at[-1]),
        "lat": float(last["location_lat"]),
        "lon": float(last["location_long"]),
        "category": category.iloc[-1],
        "amount": float(last["amount"]),
        "history": history[-1],
    }
    return features, after


class PaymentState(StatefulProcessor):
    """Per customer: running amount statistics and the last payment of each card."""

    def __init__(self, idle_ms: int | None = None):
        self.idle_ms = idle_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stats = handle.getValueState("customer", CUSTOMER_STATE)
        self.cards = handle.getMapState("cards", CARD_KEY, CARD_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        batch = pd.concat(list(rows), ignore_index=True)
        batch = batch.sort_values(["event_us", "transaction_id"], kind="stable", ignore_index=True)
        stats = tuple(self.stats.get()) if self.stats.exists() else (0, 0.0, 0.0)
        scores, stats = amount_scores(stats, batch["amount"].to_numpy("float64"))
        self.stats.update(stats)
        parts = []
        for card_id, payments in batch.groupby("card_id", sort=False):
            features, card = card_features(self._load(card_id), payments)
            self._store(card_id, card)
            parts.append(features)
        out = batch[PASSED].join(pd.concat(parts))
        out = out.assign(customer_id=key[0], amount_deviation_z_score=scores, hour_deviation_from_norm=0.0)
        yield out[FEATURES.fieldNames()]

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        """Forget the cards that have been idle; a card used since then has a later timer."""
        now = expiredTimerInfo.getExpiryTimeInMs()
        names = CARD_STATE.fieldNames()
        last = {k[0]: dict(zip(names, v))["last_us"] for k, v in self.cards.iterator()}
        gone = [card_id for card_id, at in last.items() if self._expiry(at) <= now]
        for card_id in gone:
            self.cards.removeKey((card_id,))
        if len(gone) == len(last):
            self.cards.clear()
            self.stats.clear()
        yield pd.DataFrame(columns=FEATURES.fieldNames())

    def handleInitialState(self, key, initialState: pd.DataFrame, timerValues) -> None:
        for row in initialState.itertuples(index=False):
            self.stats.update((int(row.count_seen), float(row.mean), float(row.m2)))
            self._store(
                row.card_id,
                {
                    "last_us": int(row.last_us),
                    "lat": float(row.last_lat),
                    "lon": float(row.last_lon),
                    "category": row.last_category,
                    "amount": float(row.last_amount),
                    "seq": int(row.seq),
                    "recent_us": [int(t) for t in row.recent_us],
                    "history": [str(t) for t in row.history],
                },
            )

    def close(self) -> None:
        pass

    def _load(self, card_id: str) -> dict | None:
        key = (card_id,)
        if not self.cards.containsKey(key):
            return None
        state = dict(zip(CARD_STATE.fieldNames(), self.cards.getValue(key)))
        return state | {"recent_us": list(state["recent_us"]), "history": list(state["history"])}

    def _expiry(self, last_us: int) -> int:
        return last_us // 1000 + 1 + self.idle_ms

    def _store(self, card_id: str, state: dict) -> None:
        self.cards.updateValue((card_id,), tuple(state[f] for f in CARD_STATE.fieldNames()))
        if self.idle_ms is not None:
            self.handle.registerTimer(self._expiry(state["last_us"]))


def live_features(
    events: DataFrame, warm: GroupedData | None = None, idle: timedelta | None = None, delay: str = "1 hour"
) -> DataFrame:
    """Features of a decoded event stream; ``warm`` is the grouped warm-start table.

    ``idle`` is how long a card may be unused before it is forgotten, ``delay`` how late payments may then come.
    """
    idle_ms = None if idle is None else int(idle.total_seconds() * 1000)
    if idle is not None:
        events = events.withWatermark("timestamp", delay)

    rows = events.select(
        "customer_id", "transaction_id", "card_id", "merchant_id", "amount", "timestamp",
        "received_at", "merchant_category", "transaction_channel",
        F.col("card_present").cast("int").alias("card_present"), "location_lat", "location_long",
        epoch_micros(F.col("timestamp")).alias("event_us"),
    )
    return rows.groupBy("customer_id").transformWithStateInPandas(
        statefulProcessor=PaymentState(idle_ms),
        outputStructType=FEATURES,
        outputMode="append",
        timeMode="none" if idle is None else "eventTime",
        initialState=warm,
    )
