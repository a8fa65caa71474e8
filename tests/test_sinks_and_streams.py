from pyspark.sql import functions as F

from propensity.session import keep, new_path, shared_dir
from propensity.sources import sinks, tables, views
from propensity.streaming import jobs


def test_paths_are_new_and_shared(spark):
    assert new_path(spark, "a") != new_path(spark, "a")
    assert new_path(spark, "a").startswith(shared_dir(spark))


def test_keep_returns_the_same_rows(spark):
    df = spark.range(10).withColumn("x", F.array("id"))
    assert sorted(map(tuple, keep(df).collect())) == sorted(map(tuple, df.collect()))


def test_repeated_date_leaves_one_copy(spark):
    path = new_path(spark, "dates")
    df = spark.range(5)
    for day in ("2024-01-01", "2024-01-02", "2024-01-02"):
        sinks.append_by_date(df, path, day)
    got = {r.score_date: r["count"] for r in spark.read.schema("id long, score_date string").parquet(path)
           .groupBy("score_date").count().collect()}
    assert got == {"2024-01-01": 5, "2024-01-02": 5}


def test_csv_and_named_tables(spark):
    df = spark.createDataFrame([(1, "a,b"), (2, None)], "k int, s string")
    path = sinks.write_csv(df, new_path(spark, "csv"))
    assert sorted(map(tuple, tables.read_csv(spark, path, df.schema).collect())) == [(1, "a,b"), (2, None)]
    assert tables.read_csv(spark, path).dtypes == [("k", "int"), ("s", "string")]
    where = new_path(spark, "named")
    name = "t_" + where[-32:]
    sinks.write_named(df, name, where)
    assert tables.read_named(spark, name).count() == 2


def test_arrivals_are_scored_once_over_restarts(spark):
    source, out, state = (new_path(spark, n) for n in ("in", "out", "state"))
    df = spark.range(40).select("id", F.timestamp_seconds(1704067200 + F.col("id") * 3600).alias("at"))

    def run():
        return jobs.score_arrivals(spark, source, df.schema, out, state,
                                   lambda b: b.withColumn("prob", F.col("id") / 100.0), "id", "at",
                                   "2024-01-31", "30 days")

    df.filter("id < 20").write.parquet(source)
    assert run().count() == 20
    df.filter("id >= 10").write.mode("append").parquet(source)  # ten rows come again
    assert run().count() == 40
    assert run().count() == 40
    assert run().select("id").distinct().count() == 40


def test_activity_totals_over_many_batches(spark, small):
    events = tables.table(spark, small, "events")
    source = new_path(spark, "events")
    events.select("event_id", "ts", "user_id", "event_type", "value").repartition(6, "event_id").write.parquet(source)
    out = jobs.activity_totals(spark, source, new_path(spark, "tot"), new_path(spark, "st"), "60 days", 2)
    want = events.groupBy(F.to_date("ts").alias("day"), "user_id").agg(
        F.count("*").alias("n"), F.count_if(F.col("event_type") == "view").alias("v"))
    both = out.join(want, ["day", "user_id"], "full")
    assert both.filter("n IS NULL OR n_events IS NULL OR n <> n_events OR v <> content_starts").count() == 0


def test_label_needs_no_look_ahead(spark, small):
    f = views.order_features(spark, small)
    assert f.filter("n_orders > 0 AND recency_days < 0").count() == 0
    assert f.filter("churned = 1 AND n_orders = 0").count() == 0
