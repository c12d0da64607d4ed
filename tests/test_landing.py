"""Landing tables: a period reads a part of the files, loads by key can be repeated."""

import tempfile

import pytest
from pyspark.sql import functions as F

from txlens.operators import nodes
from txlens.operators.ordered import ordered_columns
from txlens.operators.sampling import exact_split
from txlens.sources import landing


def leaf_metrics(df):
    """(files, rows) that the scan of a frame without shuffles reads."""
    df._jdf.queryExecution().executedPlan()
    execution = df._jdf.queryExecution()
    rows = execution.toRdd().count()
    leaf = execution.executedPlan().collectLeaves().head()
    return leaf.metrics().apply("numFiles").value(), leaf.metrics().apply("numOutputRows").value(), rows


@pytest.fixture(scope="module")
def payments(spark):
    rows = spark.range(0, 20_000, 1, 8).select(
        F.col("id").alias("transaction_id"),
        (F.col("id") % 97).cast("double").alias("amount"),
        F.when(F.col("id") % 1000 != 7, F.timestamp_seconds(F.lit(1_700_000_000) + (F.col("id") * 7919 % 20_000) * 40)).alias("timestamp"),
    )  # ten days, in no order
    return rows.checkpoint()


def test_a_period_reads_few_files(spark, payments):
    path = tempfile.mkdtemp(prefix="landing-")
    seen = landing.write_by_day(payments, path, rows_per_file=500, undated=F.count_if(F.col("timestamp").isNull()))
    assert (seen["n_rows"], seen["undated"]) == (20_000, 20)
    everything = landing.read_landing(spark, path)
    assert everything.columns == payments.columns and everything.exceptAll(payments).count() == 0
    all_files = leaf_metrics(everything)[0]
    part = landing.read_landing(spark, path, "2023-11-16 06:00:00", "2023-11-17 18:00:00")
    files, _, rows = leaf_metrics(part)
    assert 0 < files <= all_files // 3
    assert rows == payments.filter("timestamp >= '2023-11-16 06:00:00' AND timestamp < '2023-11-17 18:00:00'").count()
    # Inside a day every file covers a short span of it.
    spans = spark.read.parquet(path).filter("timestamp IS NOT NULL").groupBy(F.input_file_name(), landing.DAY).agg(
        (F.max("timestamp").cast("long") - F.min("timestamp").cast("long")).alias("s"), F.count(F.lit(1)).alias("n")
    )
    assert spans.filter("n >= 400").agg(F.max("s")).first()[0] < 86_400 / 3


def test_upsert_touches_the_days_of_its_rows(spark, payments):
    path = tempfile.mkdtemp(prefix="landing-")
    landing.write_by_day(payments, path)
    before = {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    # One payment moves to a day of its own, one only changes, one is new, one has no id, two share an id.
    new = spark.createDataFrame(
        [(1, 500.0, "2023-12-24 00:00:00"), (2, 501.0, None), (10**6, 502.0, "2023-11-20 00:00:00"),
         (None, 503.0, "2023-11-20 00:00:00"), (3, 504.0, "2023-11-20 00:00:00"), (3, 505.0, "2023-11-20 00:00:01")],
        "transaction_id long, amount double, timestamp string",
    ).withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    for _ in range(2):
        figures = landing.upsert(spark, path, new, "transaction_id")
        assert figures["without_key"] == 1
        table = landing.read_landing(spark, path)
        assert table.count() == 20_001 and table.select("transaction_id").distinct().count() == 20_001
        got = {r.transaction_id: r.amount for r in table.filter("amount >= 500").collect()}
        assert got == {1: 500.0, 2: 501.0, 10**6: 502.0, 3: 505.0}
    after = {r[0] for r in spark.read.parquet(path).select(F.input_file_name()).distinct().collect()}
    assert len(before & after) >= len(before) // 3  # days that the load does not touch keep their files
    # The only payment of a day moves back: its old folder goes.
    landing.upsert(spark, path, new.filter("transaction_id = 1").withColumn("timestamp", F.lit(None).cast("timestamp")), "transaction_id")
    table = spark.read.parquet(path)
    assert table.count() == 20_001 and table.filter(f"{landing.DAY} = '2023-12-24'").count() == 0


def test_upsert_into_nothing_and_of_nothing(spark, payments):
    path = f"{tempfile.mkdtemp(prefix='landing-')}/new"
    assert landing.upsert(spark, path, payments.limit(10), "transaction_id")["n_rows"] == 10
    landing.upsert(spark, path, payments.limit(0), "transaction_id")
    assert landing.read_landing(spark, path).count() == 10


def test_report_headings_are_carried_over_files(spark):
    counts = [(f"S{s}", f"city {s}: {c}", 100 - c) for s in range(4) for c in range(s * 20 + 1)]
    df = spark.createDataFrame(counts, "state string, city string, nodes long")
    path = tempfile.mkdtemp(prefix="report-")
    nodes.write_report(df.repartition(5), path)
    lines = spark.read.text(path)
    assert lines.filter("value LIKE 'State: %'").count() == 4
    for size in (10**6, 5):
        found = nodes.read_report(spark, path, max_key_rows=size)
        assert sorted(map(tuple, found.collect())) == sorted(counts)


@pytest.mark.parametrize("size", [10**6, 4])
def test_last_value_is_carried_over_slices(spark, size):
    values = [None, None, 3, None, None, None, None, None, None, 5, None, 7, None] + [None] * 20
    df = spark.createDataFrame(list(enumerate(values)), "at long, v int").repartition(4)
    out = ordered_columns(df, [], ["at"], running={"c": ("last", F.col("v"))}, max_key_rows=size)
    expected, last = [], None
    for v in values:
        last = v if v is not None else last
        expected.append(last)
    assert [r.c for r in out.orderBy("at").collect()] == expected


@pytest.mark.parametrize("size", [10**6, 3])
def test_strata_are_exact_to_one_row(spark, size):
    rows = spark.range(1013).selectExpr("id AS transaction_id", "CASE WHEN id % 50 = 0 THEN 1 WHEN id % 7 <> 0 THEN 0 END AS is_fraud")
    rows = rows.unionByName(spark.createDataFrame([(None, 1), (None, 2)], "transaction_id long, is_fraud int"))
    for share in (0.2, 0.0, 1.0):
        out = exact_split(rows, test_share=share, max_key_rows=size)
        assert out.count() == 1015 and out.columns == [*rows.columns, "split"]
        for r in out.groupBy("is_fraud").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
            assert r.t == int(r.n * share + 0.5)
