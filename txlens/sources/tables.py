"""Reading and writing tables. Every write replaces its target, so a job can be repeated."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from txlens.session import ensure_checkpoint_dir

ROWS_PER_FILE = 500_000


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Parquet, with the declared columns and types when a schema is given."""
    df = spark.read.parquet(path)
    return enforce(df, schema) if schema else df


def enforce(df: DataFrame, schema: T.StructType) -> DataFrame:
    """The schema's columns in its order and types; a column the file lacks is null.

    The first column is the table's key: without it the file is some other table.
    """
    if schema.fields[0].name not in df.columns:
        raise ValueError(f"no column {schema.fields[0].name} among {df.columns}")

    def column(field: T.StructField) -> Column:
        found = F.col(field.name) if field.name in df.columns else F.lit(None)
        return found.cast(field.dataType).alias(field.name)

    return df.select(*[column(f) for f in schema.fields])


def read_jdbc(
    spark: SparkSession,
    url: str,
    table: str,
    properties: dict[str, str],
    split_on: str | None = None,
    bounds: tuple[int, int] | None = None,
    partitions: int = 64,
) -> DataFrame:
    """A database table, read in parallel ranges of a numeric column when one is given.

    Needs the database's driver jar on the cluster.
    """
    if split_on is None or bounds is None:
        return spark.read.jdbc(url, table, properties=properties)
    return spark.read.jdbc(
        url, table, column=split_on, lowerBound=bounds[0], upperBound=bounds[1],
        numPartitions=partitions, properties=properties,
    )


def observed(df: DataFrame, **figures: Column) -> tuple[DataFrame, Observation]:
    """The frame with its row count ``n_rows`` and other aggregates taken while it is written."""
    seen = Observation()
    named = [value.alias(name) for name, value in figures.items()]
    return df.observe(seen, F.count(F.lit(1)).alias("n_rows"), *named), seen


def write_table(df: DataFrame, path: str, rows_per_file: int | None = None, **figures: Column) -> dict:
    """Replace the table; returns its row count and the ``figures`` asked for, without a second scan."""
    df, seen = observed(df, **figures)
    writer = df.write.mode("overwrite")
    if rows_per_file:
        writer = writer.option("maxRecordsPerFile", rows_per_file)
    writer.parquet(path)
    return {"n_rows": 0, **seen.get}


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder below the shared checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{label}-{uuid.uuid4().hex}"


def stage(df: DataFrame, label: str, **figures: Column) -> tuple[DataFrame, dict]:
    """Write a step's rows to the shared checkpoint folder and read them back, with their figures.

    Unlike ``checkpoint`` it computes the rows once and keeps them in columns.
    """
    path = scratch(df.sparkSession, label)
    seen = write_table(df, path, **figures)
    return df.sparkSession.read.schema(df.schema).parquet(path), seen


def _folder(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = found.getFileSystem(spark._jsc.hadoopConfiguration())
    return files, files.makeQualified(found)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names below a folder; none if it does not exist."""
    files, found = _folder(spark, path)
    return [f.getPath().getName() for f in files.listStatus(found)] if files.exists(found) else []


def delete_folder(spark: SparkSession, path: str) -> None:
    files, found = _folder(spark, path)
    files.delete(found, True)


def _versions(spark: SparkSession, path: str) -> list[int]:
    """Finished versions of a table, in order."""
    named = [int(n.split("=")[1]) for n in folder_names(spark, path) if n.startswith("version=")]
    return sorted(v for v in named if "_SUCCESS" in folder_names(spark, f"{path}/version={v}"))


def write_version(df: DataFrame, path: str) -> int:
    """Add a version of a table beside the older ones, which readers may still be reading."""
    version = max(_versions(df.sparkSession, path), default=0) + 1
    write_table(df, f"{path}/version={version}")
    return version


def read_newest(spark: SparkSession, path: str) -> DataFrame:
    """The newest finished version."""
    return read_table(spark, f"{path}/version={_versions(spark, path)[-1]}")


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True)
