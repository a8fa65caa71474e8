"""Writers. Every write leaves from the executors; nothing is collected."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_dataset(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite",
                  partition_by: Sequence[str] = ()) -> str:
    writer = df.write.format(fmt).mode(mode)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    df.write.mode(mode).option("header", True).csv(path)
    return path


def write_named(df: DataFrame, name: str, path: str, mode: str = "overwrite") -> str:
    """A catalog table over files at `path`."""
    df.write.mode(mode).option("path", path).saveAsTable(name)
    return name


def append_by_date(df: DataFrame, path: str, date: str, fmt: str = "parquet") -> str:
    """Add one score date to a partitioned dataset.

    Dynamic overwrite replaces only that date, so a repeated run leaves one copy.
    """
    stamped = df.withColumn("score_date", F.lit(date))
    (stamped.write.format(fmt).mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("score_date").save(path))
    return path


def register_rows(spark: SparkSession, rows: Sequence[tuple], schema: str, name: str) -> DataFrame:
    """A small literal lookup as a named view."""
    df = spark.createDataFrame(list(rows), schema)
    df.createOrReplaceTempView(name)
    return df


def cache_named(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    df.sparkSession.catalog.cacheTable(name)
    return df.sparkSession.table(name)


def class_counts(df: DataFrame, column: str) -> DataFrame:
    """Rows per class of a written table, for a check after the write."""
    return df.groupBy(column).agg(F.count("*").alias("n"))
