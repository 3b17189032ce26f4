"""Physical plans are the ones meant."""

import pytest
from pyspark.sql import functions as F

from rollmark.operators import latest, reports
from rollmark.operators.arbitrate import arbitrate_marks
from rollmark.operators.dedupe import dedupe_events
from rollmark.operators.enrich import enrich_events
from rollmark.plans.session import scratch_path
from rollmark.plans.sizing import fits_broadcast
from rollmark.plans.skew import heavy_buckets, lookup_join
from rollmark.schemas import STUDENT, TEACHER
from rollmark.sources.messages import decode_events
from rows import enriched, event, frame


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def events(spark):
    path = scratch_path(spark, "events")
    frame(spark, [event(i, student=i % 7) for i in range(200)]).write.parquet(path)
    return spark.read.parquet(path)


def people(spark):
    return spark.createDataFrame([], STUDENT), spark.createDataFrame([], TEACHER)


def test_small_lookups_leave_events_where_they_are(spark, events):
    text = plan(enrich_events(events, *people(spark), broadcast=(True, True)))
    assert text.count("BroadcastHashJoin") == 2 and "Exchange hashpartitioning" not in text


def test_large_lookups_are_not_broadcast(spark, events):
    big = spark.range(50).select(F.col("id").cast("string").alias("k"))
    assert fits_broadcast(big, big.limit(3), max_rows=10) == [False, True]
    assert fits_broadcast(big.withColumn("t", F.repeat(F.lit("x"), 1000)), max_bytes=10_000) == [False]
    text = plan(enrich_events(events, *people(spark), broadcast=(False, False)).hint("none"))
    assert "_salt" in text


def test_hot_keys_are_found_and_spread(spark, events):
    keyed = events.withColumn("k", F.when(F.col("STUDENT_ID") < 5, 1).otherwise(F.col("STUDENT_ID")))
    heavy = heavy_buckets(keyed.unionByName(keyed.withColumn("k", F.lit(None).cast("int"))), ["k"], 60)
    assert len(heavy) == 1 and min(heavy.values()) > 100
    dim = spark.createDataFrame([(1, "a"), (5, "b")], "k int, v string")
    joined = lookup_join(keyed, dim, ["k"], broadcast=False, row_id=["ID"], rows_per_task=20)
    assert joined.count() == 200 and joined.filter("v IS NOT NULL").count() == keyed.filter("k IN (1, 5)").count()
    assert joined.columns == ["k", *[c for c in keyed.columns if c != "k"], "v"]


def test_arbitration_shuffles_and_sorts_once(spark, events):
    text = plan(arbitrate_marks(events))
    assert text.count("Exchange") == 1 and text.count("Sort [") == 1


def test_aggregates_reduce_before_the_shuffle(spark, events):
    for df in (latest.latest_rows(events), dedupe_events(events)):
        text = plan(df)
        assert "partial_" in text and text.count("Exchange") == 1
    assert "WindowGroupLimit" in plan(latest.latest_rows_window(events))


def test_reports_read_only_what_they_need(spark):
    path = scratch_path(spark, "mart")
    latest.latest_marks(enriched(spark, [event(i, student=i) for i in range(9)])).write.parquet(path)
    text = plan(reports.marks_by_group(spark.read.parquet(path), ["G"]))
    schema = text.split("ReadSchema:")[1]
    assert "struct<attendance_mark:int,group_short_title:string>" in schema
    assert "PushedFilters: [IsNotNull(group_short_title), EqualTo(group_short_title,G)]" in text


def test_messages_are_parsed_once(spark):
    path = scratch_path(spark, "messages")
    spark.createDataFrame([("k", "{}")], "key string, value string").write.parquet(path)
    good, _ = decode_events(spark.read.parquet(path))
    assert plan(good).count("from_json") == 1
