"""Readers. Filters and column lists given by callers reach the file scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_SCHEMAS: dict[tuple[str, str], T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A base table. Its schema is read from the files once per application."""
    path = f"{sf_dir}/{name}.parquet"
    slot = (spark.sparkContext.applicationId, path)
    if slot not in _SCHEMAS:
        _SCHEMAS[slot] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[slot]).parquet(path)


def load_dataset(spark: SparkSession, path: str, fmt: str = "parquet",
                 schema: T.StructType | str | None = None) -> DataFrame:
    """Read a path dataset. `fmt` may name any installed source (`delta` where present)."""
    reader = spark.read.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """CSV with a header. Without a schema Spark reads the file twice to infer one."""
    reader = spark.read.option("header", True)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", True)
    return reader.csv(path)


def read_named(spark: SparkSession, name: str) -> DataFrame:
    return spark.read.table(name)
