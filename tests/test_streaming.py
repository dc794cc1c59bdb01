"""Structured Streaming operators over multi-file landing folders: results
don't depend on how files fall into batches, and a stopped job goes on."""

import uuid

import pytest
from pyspark.sql import functions as F

from tessera.session import ensure_checkpoint_dir
from tessera.streaming import stream as ST

from conftest import SF_SMALL, rows

PAIR = ("event_type", "CAST(user_id AS STRING)")


def scratch(spark, name):
    return ensure_checkpoint_dir(spark).rstrip("/") + f"/tests/{name}-{uuid.uuid4().hex[:8]}"


def landing(spark, order, n_files=6):
    """Six files: by event time (first file first), or by a hash."""
    path = scratch(spark, "landing")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    if order == "time":
        cuts = ev.select(F.col("ts").cast("timestamp").alias("t")).agg(
            F.percentile_approx("t", [i / n_files for i in range(1, n_files)])).first()[0]
        low = None
        for high in [*cuts, None]:
            part = ev.filter((F.lit(low is None) | (F.col("ts").cast("timestamp") >= F.lit(low)))
                             & (F.lit(high is None) | (F.col("ts").cast("timestamp") < F.lit(high))))
            part.coalesce(1).write.mode("append").parquet(path)
            low = high
    else:
        ev.repartition(n_files, F.xxhash64("event_id")).write.parquet(path)
    return path, ev


def pairs(ev):
    return rows(ev.select(F.col("event_type").alias("code"), F.col("user_id").cast("string").alias("text")).distinct())


def batch_acceptance(ev):
    e = ev.withColumn("ts", F.col("ts").cast("timestamp"))
    last = e.agg(F.max("ts")).first()[0]
    g = e.groupBy(F.window("ts", "1 day").alias("w")).agg(
        F.count(F.lit(1)).alias("n_rows"), F.count_if(F.col("event_type").isin("click", "purchase")).alias("n_accepted"))
    g = g.filter(F.col("w.end") <= F.lit(last) - F.expr("INTERVAL 1 hour"))
    return rows(g.select(F.col("w.start").alias("window_start"), "n_rows", "n_accepted"))


@pytest.mark.parametrize("order", ["time", "hash"])
def test_exact_append_distinct_in_any_file_order(spark, order):
    path, ev = landing(spark, order)
    out = ST.run_append_distinct_exact(spark, path, ev.schema, *PAIR, max_files=1)
    assert rows(out) == pairs(ev)


@pytest.mark.parametrize("order", ["time", "hash"])
def test_windowed_acceptance_in_any_file_order(spark, order):
    path, ev = landing(spark, order)
    out = ST.run_acceptance(spark, path, ev.schema, "event_type IN ('click', 'purchase')", max_files=1)
    assert rows(out, "window_start", "n_rows", "n_accepted") == batch_acceptance(ev)


def test_jobs_go_on_where_they_stopped(spark):
    path, folder, folder2 = scratch(spark, "growing"), scratch(spark, "job"), scratch(spark, "job")
    ev = spark.read.parquet(f"{SF_SMALL}/events.parquet")
    early, late = ev.filter("event_id % 3 = 0"), ev.filter("event_id % 3 <> 0")
    early.coalesce(1).write.parquet(path)

    def both():
        return (ST.run_append_distinct_exact(spark, path, ev.schema, *PAIR, max_files=1, folder=folder),
                ST.run_acceptance(spark, path, ev.schema, "event_type IN ('click', 'purchase')", max_files=1,
                                  folder=folder2))
    first = both()
    assert rows(first[0]) == pairs(early)
    late.repartition(2).write.mode("append").parquet(path)
    again = both()
    assert rows(again[0]) == pairs(ev)
    assert rows(again[1], "window_start", "n_rows", "n_accepted") == batch_acceptance(ev)
    stored = spark.read.parquet(f"{folder}/out")
    assert stored.count() == len(pairs(ev))
    both()  # nothing new: nothing changes
    assert spark.read.parquet(f"{folder}/out").count() == len(pairs(ev))


def test_exact_store_treats_null_as_a_value(spark):
    path, folder = scratch(spark, "nulls"), scratch(spark, "job")
    schema = "code string, text string"
    data = [("a", None), ("a", "x"), (None, None), ("a", None)]
    for _ in range(2):
        spark.createDataFrame(data, schema).coalesce(1).write.mode("append").parquet(path)
    s = ST.event_stream(spark, path, spark.createDataFrame([], schema).schema, 1)
    out = ST.append_distinct_exact(s, folder=folder)
    assert sorted(map(tuple, out.collect()), key=str) == [("a", "x"), ("a", None), (None, None)] or out.count() == 3


def test_watermark_form_is_exact_within_its_delay(spark):
    path, ev = landing(spark, "hash", 3)
    out = ST.run_append_distinct(spark, path, ev.schema, *PAIR, delay="400 days", max_files=1)
    assert rows(out) == pairs(ev)
