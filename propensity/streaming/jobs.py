"""Incremental jobs: score rows as they arrive, keep running activity totals.

Both read files, stop when the present files are done (availableNow) and can be started
again: the checkpoint remembers what was read, and each micro-batch replaces its own
partition, so a repeated batch leaves one copy.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _write_batch(df: DataFrame, batch_id: int, path: str, partitions: list[str]) -> None:
    (df.withColumn("batch", F.lit(batch_id)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(*partitions).parquet(path))


def run_to_end(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str,
               mode: str) -> None:
    query = (stream.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def read_stream(spark: SparkSession, path: str, schema: T.StructType,
                files_per_batch: int | None = None) -> DataFrame:
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def score_arrivals(spark: SparkSession, source: str, schema: T.StructType, out: str, checkpoint: str,
                   score: Callable[[DataFrame], DataFrame], key: str, time: str, date: str,
                   delay: str, files_per_batch: int | None = None) -> DataFrame:
    """Score new rows once per key and append them under their score date.

    A key that is sent again within the delay is dropped; state holds the keys of that
    time only. Spark starts the watermark at 1970, so event times must lie after it.
    """
    rows = read_stream(spark, source, schema, files_per_batch)
    fresh = rows.withWatermark(time, delay).dropDuplicatesWithinWatermark([key])

    def write(batch: DataFrame, batch_id: int) -> None:
        scored = score(batch).withColumn("score_date", F.lit(date))
        _write_batch(scored, batch_id, out, ["score_date", "batch"])

    run_to_end(fresh, write, checkpoint, "append")
    return spark.read.parquet(out)


EVENT_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()), T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()), T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType())])


def activity_totals(spark: SparkSession, source: str, out: str, checkpoint: str, delay: str,
                    files_per_batch: int | None = None) -> DataFrame:
    """Totals per user and day. Each batch writes the totals it changed; the newest count."""
    events = read_stream(spark, source, EVENT_SCHEMA, files_per_batch)
    timed = events.withColumn("ts", F.col("ts").cast("timestamp"))
    kind = F.col("event_type")
    totals = (timed.withWatermark("ts", delay)
              .groupBy(F.window("ts", "1 day").alias("w"), "user_id")
              .agg(F.count("*").alias("n_events"), F.sum("value").alias("total_value"),
                   F.count_if(kind == "view").alias("content_starts"),
                   F.count_if(kind == "error").alias("support_tickets"))
              .select(F.col("w.start").cast("date").alias("day"), "user_id", "n_events",
                      "total_value", "content_starts", "support_tickets"))
    run_to_end(totals, lambda b, i: _write_batch(b, i, out, ["batch"]), checkpoint, "update")
    return latest_totals(spark.read.parquet(out))


def latest_totals(changes: DataFrame) -> DataFrame:
    values = [c for c in changes.columns if c not in ("day", "user_id", "batch")]
    return (changes.groupBy("day", "user_id").agg(F.max_by(F.struct(*values), "batch").alias("v"))
            .select("day", "user_id", "v.*"))
