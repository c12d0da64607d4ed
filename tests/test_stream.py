"""The stateful stream equals its batch twins, also after a restart and a warm start."""

import math
import random
import tempfile
from datetime import timedelta

import pandas as pd
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from txlens.operators import model, projection, replay, sampling
from txlens.plans import catalog
from txlens.sources import fixtures as fx
from txlens.sources.tables import delete_folder, read_newest, write_version
from txlens.streaming import codec, score, seed, state

SMALL = "/root/testdata/sf0.001"
CUT = "2024-01-14"


@pytest.fixture(scope="module")
def tx(spark):
    return fx.payments(spark, SMALL)


def publish(tx, folder, run="all"):
    messages = codec.encode_events(projection.unlabeled_projection(tx))
    for _ in range(2):  # publishing a run again replaces it
        codec.publish_files(messages.coalesce(1), f"{folder}/in", run)


def consume(spark, folder, warm=None, fitted=None):
    decoded = codec.decode_events(codec.read_files(spark, f"{folder}/in"))
    good, _ = codec.split_quarantine(decoded)
    features = state.live_features(good, warm)
    if fitted is not None:
        side = replay.customer_agg_seed(catalog._gold(spark, SMALL))
        features = score.with_customer_aggregates(features, side)
    query = score.start_scoring(features, f"{folder}/out", f"{folder}/ckpt", fitted, True)
    query.awaitTermination()
    return spark.read.parquet(f"{folder}/out")


def as_text(df):
    return df.withColumn("transaction_id", F.col("transaction_id").cast("string"))


def assert_equal_columns(live, twin, columns):
    pair = live.alias("l").join(as_text(twin).alias("t"), "transaction_id")
    assert pair.count() == live.count()
    for c in columns:
        off = pair.filter(F.abs(F.col(f"l.{c}").cast("double") - F.col(f"t.{c}")) > 1e-6)
        assert off.count() == 0, c


def check_against_twins(live, tx):
    assert_equal_columns(live, replay.stream_zscore(tx), ["amount_deviation_z_score"])
    assert_equal_columns(
        live,
        replay.stream_card_features(tx),
        ["time_since_last_transaction", "transaction_sequence_number", "escalating_amounts_flag",
         "merchant_category_switch_flag", "spatial_velocity"],
    )
    assert_equal_columns(
        live, replay.stream_burst(tx), ["burst_count", "rapid_fire_transaction_flag"]
    )


def test_two_runs_equal_the_batch_twins(spark, tx):
    folder = tempfile.mkdtemp(prefix="run-")
    publish(tx.filter(F.col("timestamp") < CUT), folder, "first")
    first = consume(spark, folder).count()
    assert first == tx.filter(F.col("timestamp") < CUT).count()
    publish(tx.filter(F.col("timestamp") >= CUT), folder, "second")
    live = consume(spark, folder)  # restarted from the checkpoint
    assert live.count() == tx.count()
    check_against_twins(live, tx)
    last = live.filter("size(history) = 10").orderBy(F.desc("timestamp")).first()
    expected = replay.card_history(tx).filter(F.col("card_id") == int(last.card_id)).orderBy("rn")
    assert last.history == [str(r.transaction_id) for r in expected.collect()]


def test_warm_start_continues_history(spark, tx):
    folder = tempfile.mkdtemp(prefix="run-")
    old, new = tx.filter(F.col("timestamp") < CUT), tx.filter(F.col("timestamp") >= CUT)
    publish(new, folder)
    live = consume(spark, folder, seed.warm_start(old))
    assert live.count() == new.count()
    check_against_twins(live, tx)


def card_payments(spark, seconds):
    rows = [(i, "c", "k", "m", "x", 1.0 + i, s) for i, s in enumerate(seconds)]
    return spark.createDataFrame(
        rows, "transaction_id long, customer_id string, card_id string, merchant_id string,"
        " merchant_category string, amount double, s int"
    ).select(
        "*", F.timestamp_seconds(F.lit(1_700_000_000) + F.col("s")).alias("timestamp"),
        F.lit(0.0).alias("location_lat"), F.lit(0.0).alias("location_long"),
        F.lit(1).alias("card_present"), F.lit("upi").alias("transaction_channel"),
    ).drop("s")


def test_warm_start_refills_a_crowded_minute(spark):
    """Fifteen payments in the last minute before the start all count afterwards."""
    tx = card_payments(spark, list(range(15)) + [20, 55, 65])
    start = F.timestamp_seconds(F.lit(1_700_000_015))
    folder = tempfile.mkdtemp(prefix="run-")
    codec.publish_files(codec.encode_events(tx.filter(F.col("timestamp") >= start)).coalesce(1), f"{folder}/in")
    live = consume(spark, folder, seed.warm_start(tx.filter(F.col("timestamp") < start)))
    assert [r.burst_count for r in live.orderBy("timestamp").collect()] == [16, 17, 12]
    assert_equal_columns(live, replay.stream_burst(tx), ["burst_count", "rapid_fire_transaction_flag"])


def test_bursts_within_a_minute(spark):
    """Three, four and five payments within 60 s; one at exactly 60 s has left the window."""
    tx = card_payments(spark, [0, 10, 20, 30, 40, 70, 101])
    folder = tempfile.mkdtemp(prefix="run-")
    messages = codec.encode_events(tx.orderBy(F.desc("timestamp")))  # arrives out of order
    codec.publish_files(messages.coalesce(1), f"{folder}/in")
    live = consume(spark, folder).orderBy("timestamp").collect()
    assert [r.burst_count for r in live] == [1, 2, 3, 4, 5, 4, 2]
    assert [r.rapid_fire_transaction_flag for r in live] == [0, 0, 0, 1, 1, 1, 0]


def test_late_payments_do_not_move_a_card_back(spark):
    """Two runs: the second brings a payment older than the card's latest one, and one after it."""
    tx = card_payments(spark, [0, 100, 90, 110])
    folder = tempfile.mkdtemp(prefix="run-")
    for run, ids in (("a", [0, 1]), ("b", [2, 3])):
        messages = codec.encode_events(tx.filter(F.col("transaction_id").isin(ids)))
        codec.publish_files(messages.coalesce(1), f"{folder}/in", run)
        live = consume(spark, folder)
    rows = live.orderBy(F.col("transaction_id").cast("int")).collect()
    assert [r.late_flag for r in rows] == [0, 0, 1, 0]
    assert [r.time_since_last_transaction for r in rows] == [0, 100, 0, 10]
    assert [r.transaction_sequence_number for r in rows] == [1, 2, 3, 4]
    assert [r.burst_count for r in rows] == [1, 1, 1, 3]  # 90, 100 and 110 are in one minute
    assert [r.escalating_amounts_flag for r in rows] == [0, 1, 0, 1]
    assert rows[3].history == ["3", "1", "0"]


def one_payment_at_a_time(stats, cards, rows):
    """Plain version of the live step: payments in order, each against the state that those before it left."""
    out = []
    for row in rows:
        count, mean, m2 = stats
        std = math.sqrt(m2 / count) if count > 1 else 0.0
        score = (row["amount"] - mean) / std if std > 0 else 0.0
        delta = row["amount"] - mean
        stats = (count + 1, mean + delta / (count + 1), m2 + delta * delta * count / (count + 1))
        at, card = row["event_us"], cards.get(row["card_id"])
        late = card is not None and at < card["last_us"]
        before = None if late else card
        newest = card["last_us"] if late else at
        times = [t for t in (card["recent_us"] if card else []) + [at] if t > newest - 60_000_000]
        gap = (at - before["last_us"]) / 1e6 if before else 0.0
        km = 111.0 * math.hypot(row["location_lat"] - before["lat"], row["location_long"] - before["lon"]) if before else 0
        ids = card["history"] if card else []
        seen = {"seq": (card["seq"] if card else 0) + 1, "recent_us": sorted(times), "history": ids}
        if not late:
            seen |= {"history": [row["transaction_id"], *ids][:10], "last_us": at, "lat": row["location_lat"],
                     "lon": row["location_long"], "category": row["merchant_category"], "amount": row["amount"]}
        burst = max(1, sum(t <= at for t in times))
        out.append(
            {
                "transaction_id": row["transaction_id"],
                "time_since_last_transaction": gap,
                "transaction_sequence_number": seen["seq"],
                "burst_count": burst,
                "rapid_fire_transaction_flag": int(burst > 3),
                "escalating_amounts_flag": int(before is not None and row["amount"] > before["amount"]),
                "merchant_category_switch_flag": int(
                    before is not None and row["merchant_category"] != before["category"]
                ),
                "spatial_velocity": min(km / (gap / 3600.0), 1000.0) if gap > 0 else 0.0,
                "late_flag": int(late),
                "history": seen["history"],
                "amount_deviation_z_score": score,
            }
        )
        cards[row["card_id"]] = (card or {}) | seen
    return out, stats


@pytest.mark.parametrize("seed", range(6))
def test_arrays_equal_one_payment_at_a_time(seed):
    """Batches with late payments, equal times, equal amounts and missing categories."""
    draw = random.Random(seed)
    stats, cards, plain_stats, plain_cards, n = (0, 0.0, 0.0), {}, (0, 0.0, 0.0), {}, 0
    for step in range(12):
        rows = []
        for _ in range(draw.choice([1, 2, 40])):
            n += 1
            rows.append(
                {
                    "transaction_id": f"{n:05d}", "card_id": draw.choice("abc"),
                    "event_us": 1_000_000 * (step * draw.choice([20, 60]) + draw.randrange(90)),
                    "amount": 0.1 if step < 3 else draw.choice([0.1, 7.25, 1e4 * draw.random()]),
                    "merchant_category": draw.choice(["x", "y", None]),
                    "location_lat": draw.random(), "location_long": draw.random(),
                }
            )
        rows.sort(key=lambda r: (r["event_us"], r["transaction_id"]))
        expected, plain_stats = one_payment_at_a_time(plain_stats, plain_cards, rows)
        batch = pd.DataFrame(rows)
        scores, stats = state.amount_scores(stats, batch["amount"].to_numpy())
        parts = []
        for card_id, part in batch.groupby("card_id", sort=False):
            features, cards[card_id] = state.card_features(cards.get(card_id), part)
            parts.append(features)
        got = batch[["transaction_id"]].join(pd.concat(parts)).assign(amount_deviation_z_score=scores)
        for mine, plain in zip(got.to_dict("records"), expected):
            assert mine == {k: pytest.approx(v, abs=1e-9) if isinstance(v, float) else v for k, v in plain.items()}
        assert cards == plain_cards
        assert stats == pytest.approx(plain_stats, rel=1e-9, abs=1e-12)


def test_idle_cards_are_forgotten(spark):
    """Card c2 moves the watermark on by 40 days; by then c1, unused for longer than 30, has no state."""
    day = 86_400
    tx = card_payments(spark, [0, day, 40 * day, 41 * day, 41 * day + 60]).withColumns(
        {
            "card_id": F.when(F.col("transaction_id") == 2, "k2").otherwise("k"),
            "customer_id": F.when(F.col("transaction_id") == 2, "c2").otherwise("c"),
        }
    )
    seen = {}
    for name, idle in (("kept", None), ("forgotten", timedelta(days=30))):
        folder = tempfile.mkdtemp(prefix="run-")
        for n in range(5):
            one = codec.encode_events(tx.filter(F.col("transaction_id") == n))
            codec.publish_files(one.coalesce(1), f"{folder}/in", f"run{n}")
            good, _ = codec.split_quarantine(codec.decode_events(codec.read_files(spark, f"{folder}/in")))
            features = state.live_features(good, idle=idle)
            score.start_scoring(features, f"{folder}/out", f"{folder}/ckpt", None, True).awaitTermination()
        out = spark.read.parquet(f"{folder}/out").orderBy("timestamp").collect()
        seen[name] = [(r.transaction_sequence_number, len(r.history)) for r in out]
    assert seen["kept"] == [(1, 1), (2, 2), (1, 1), (3, 3), (4, 4)]
    assert seen["forgotten"] == [(1, 1), (2, 2), (1, 1), (1, 1), (2, 2)]


def test_lookup_follows_its_table(spark):
    """A batch sees the newest finished version of the customer table, not the one at the start."""
    folder = tempfile.mkdtemp(prefix="run-")
    batch = spark.createDataFrame([("c",)], "customer_id string")
    write = score.batch_writer(f"{folder}/out", None, lambda: read_newest(spark, f"{folder}/agg"))
    for n, ratio in enumerate((0.25, 0.5)):
        table = spark.createDataFrame([("c", ratio)], "customer_id string, night_ratio double")
        assert write_version(table, f"{folder}/agg") == n + 1
        write(batch, n)
    table.write.parquet(f"{folder}/agg/version=3")
    delete_folder(spark, f"{folder}/agg/version=3/_SUCCESS")  # a version that is not finished
    write(batch, 2)
    found = spark.read.parquet(f"{folder}/out").orderBy("batch_id").collect()
    assert [r.cf_night_tx_ratio for r in found] == [0.25, 0.5, 0.5]


def test_damaged_messages_are_kept_apart(spark, tx):
    messages = codec.encode_events(tx.limit(5)).select("value")
    partly = [
        F.to_json(F.struct(*[F.lit(None).alias(c) if c == gone else F.col(c) for c in tx.columns]))
        for gone in ("amount", "customer_id", "card_id", "location_lat")
    ]
    lacking = tx.limit(1).select(F.explode(F.array(*partly)).alias("value"))
    broken = spark.createDataFrame([("{oops",), ('{"amount": 3}',)], "value string")
    sent = messages.unionByName(broken).unionByName(lacking).withColumn("received_at", F.current_timestamp())
    good, bad = codec.split_quarantine(codec.decode_events(sent))
    assert good.count() == 5 and bad.columns == ["value", "received_at"]
    assert {"{oops", '{"amount": 3}'} < {r.value for r in bad.collect()} and bad.count() == 6


def test_scoring_sink(spark, tx):
    """A saved model scores the stream; replaying a batch overwrites its folder."""
    folder = tempfile.mkdtemp(prefix="run-")
    rows = sampling.strat_split(model.training_rows(catalog._gold(spark, SMALL)))
    fitted = model.train(rows, trees=5, depth=3)
    fitted.write().overwrite().save(f"{folder}/model")
    publish(tx, folder)
    loaded = PipelineModel.load(f"{folder}/model")
    out = consume(spark, folder, fitted=loaded)
    assert out.count() == tx.count()
    wrong = out.filter((F.col("fraud_probability") > 0.85).cast("int") != F.col("flagged"))
    assert wrong.count() == 0
    batch = spark.read.parquet(f"{folder}/out/batch_id=0")
    score.batch_writer(f"{folder}/again")(batch, 0)
    score.batch_writer(f"{folder}/again")(batch, 0)
    assert spark.read.parquet(f"{folder}/again").count() == batch.count()
    spec = model.feature_spec(spark, loaded)
    assert spec.count() == len(model.FEATURE_SPEC)
