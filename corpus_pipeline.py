"""The corpus pipeline: each stage works on all rows that the one before it kept.

1. toxicity: documents that the compression-distance score rejects go;
2. near-duplicates: of each class the document with the smallest id stays;
3. benchmark passages: documents that hold a window of a benchmark item go;
4. secrets: every span found is replaced by `[secret]`, and n_chars follows;
5. pieces: the ids of every text, with digests of the ids and of the decoded text.

All stages but the last return the columns of documents, whatever further columns there are.
Null texts stay null until they are encoded as empty ones; rows without id are never duplicates.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from propensity.llm import order_minhash, piece_encoding, positional_index, secret_index, toxicity
from propensity.llm.queries import PIECES, learning_labels
from propensity.session import new_path
from propensity.sources.tables import table

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.fit(docs, learning_labels(table(spark, sf_dir, "labels"))))


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    groups = order_minhash.find_groups(docs, shingles=order_minhash.SIMILARITY)
    return docs.join(groups.filter(~F.col("kept")).select("doc_id"), "doc_id", "left_anti").select(*docs.columns)


def benchmark_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return positional_index.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def secret_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    clean = secret_index.redact_secrets(docs, secret_index.RULES)
    if "n_chars" not in docs.columns:
        return clean
    size = F.coalesce(F.length("text").cast(dict(docs.dtypes)["n_chars"]), F.col("n_chars"))
    return clean.withColumn("n_chars", size).select(*docs.columns)


def piece_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return piece_encoding.encode_documents(docs, PIECES).drop("decoded")


STAGES: list[tuple[str, Stage]] = [
    ("toxicity", toxicity_stage), ("near_duplicates", near_duplicate_stage), ("benchmark_passages", benchmark_stage),
    ("secrets", secret_stage), ("pieces", piece_stage)]

# A fitted score and sketches decide which rows stay: SQL cannot express that.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        path = new_path(spark, "stage")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
