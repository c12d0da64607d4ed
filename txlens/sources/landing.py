"""Landing tables: one folder a day, narrow time ranges inside a day, loads that can be repeated.

A table is written by range over (day, time), so a file holds one short span of one day and a day with many
payments is cut into many files. A reader that asks for a period opens the folders of its days only, and
inside them the row groups of that span. Payments without a readable time are a folder of their own.

``upsert`` brings new files in by key. It touches only the days of the new rows and, where a
payment's time was corrected, the days of its older versions; all other folders stay as they are.
Loading the same file twice, or in several parts, gives the table of one load.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from txlens.sources.tables import delete_folder, folder_names, observed, stage

DAY = "landing_day"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def _by_day(df: DataFrame, time: str) -> DataFrame:
    return df.withColumn(DAY, F.to_date(time))


def _write(dated: DataFrame, path: str, time: str, mode: str, rows_per_file: int | None, **figures: Column) -> dict:
    ranged = dated.repartitionByRange(F.col(DAY), F.col(time)).sortWithinPartitions(DAY, time)
    ranged, seen = observed(ranged, **figures)
    writer = ranged.write.mode("overwrite").partitionBy(DAY).option("partitionOverwriteMode", mode)
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return {"n_rows": 0, **seen.get}


def write_by_day(
    df: DataFrame, path: str, time: str = "timestamp", rows_per_file: int | None = None, **figures: Column
) -> dict:
    """Replace the whole table; returns its row count and the ``figures`` asked for."""
    return _write(_by_day(df, time), path, time, "static", rows_per_file, **figures)


def read_landing(
    spark: SparkSession, path: str, since: str | None = None, until: str | None = None, time: str = "timestamp"
) -> DataFrame:
    """The table, or its rows from ``since`` on and before ``until``: the day folders of that period only."""
    df = spark.read.parquet(path)
    if since is not None:
        first = F.lit(since).cast("timestamp")
        df = df.filter((F.col(DAY) >= first.cast("date")) & (F.col(time) >= first))
    if until is not None:
        end = F.lit(until).cast("timestamp")
        df = df.filter((F.col(DAY) <= end.cast("date")) & (F.col(time) < end))
    return df.drop(DAY)


def newest_of_each(df: DataFrame, key: str, time: str) -> DataFrame:
    """One row a key, the one with the latest time; equal times are settled by the rows' hash.

    Repeated rows of a key meet in a partial aggregate, so a key with very many does no harm.
    """
    order = F.struct(F.col(time), F.xxhash64(*df.columns))
    row = F.max_by(F.struct(*df.columns), order)
    return df.filter(F.col(key).isNotNull()).groupBy(key).agg(row.alias("_row")).select("_row.*")


def upsert(spark: SparkSession, path: str, new: DataFrame, key: str, time: str = "timestamp") -> dict:
    """Bring rows into the landing table at ``path``: same key, the new row replaces the old one.

    Returns n_rows (rows of the folders written), without_key (new rows left out, as nothing
    identifies them) and days (folders written). A run that broke off can be repeated.
    """
    new, seen = observed(new, without_key=F.count_if(F.col(key).isNull()))
    landed, _ = stage(_by_day(newest_of_each(new, key, time), time), "landed")
    out = {"without_key": seen.get.get("without_key", 0)}
    if not folder_names(spark, path):
        figures = _write(landed, path, time, "static", None, days=F.collect_set(DAY))
        return out | {"n_rows": figures["n_rows"], "days": len(figures.get("days") or [])}
    old = spark.read.parquet(path)
    keys = landed.select(key)
    # Days, not rows, come to the driver: the folders to read and write are chosen there.
    before = old.select(key, DAY).join(keys, key, "left_semi").select(DAY)
    days = [r[0] for r in landed.select(DAY).unionByName(before).distinct().collect()]
    dated = [d for d in days if d is not None]
    touched = F.col(DAY).isin(dated) if dated else F.lit(False)
    touched = touched | F.col(DAY).isNull() if None in days else touched
    kept = old.filter(touched).join(keys, key, "left_anti")
    merged = kept.unionByName(landed).select(*old.columns)
    figures = _write(merged, path, time, "dynamic", None, days=F.collect_set(DAY), undated=F.count_if(F.col(DAY).isNull()))
    written = set(figures.get("days") or [])
    for day in days:  # a day that lost all its rows to others is not among the folders replaced
        if day not in written and not (day is None and figures.get("undated")):
            delete_folder(spark, f"{path}/{DAY}={_NO_DAY if day is None else day.isoformat()}")
    return out | {"n_rows": figures["n_rows"], "days": len(days)}
