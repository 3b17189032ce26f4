"""Streams of the test tables: spread over tasks, and read once."""

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from rollmark.plans import catalog
from rollmark.plans.session import scratch_path
from rollmark.schemas import STORE_COLUMNS, STORE_TYPES
from rollmark.sources import canonical as c
from rollmark.streaming.figures import update_figures
from rollmark.streaming.run import start_batches
from rows import event, frame

ROWS = 3000


@pytest.fixture(scope="module")
def folder(spark):
    path = scratch_path(spark, "tables")
    Path(path).mkdir()

    def put(name, frame):
        pq.write_table(frame.toArrow(), f"{path}/{name}.parquet")

    put("events", spark.range(ROWS).selectExpr(
        "id AS event_id", "timestamp_ntz'2024-01-01 00:00:00' + make_interval(0, 0, 0, 0, 0, id, 0) AS ts",
        "id % 7 AS user_id", "'view' AS event_type", "1.5D AS value", "'{\"k\": 1}' AS props"))
    put("customer", spark.range(10).selectExpr(
        "id AS c_custkey", "concat('c', id) AS c_name", "0 AS c_nationkey", "1D AS c_acctbal", "'B' AS c_mktsegment"))
    put("supplier", spark.range(4).selectExpr(
        "id AS s_suppkey", "concat('s', id) AS s_name", "0 AS s_nationkey", "1D AS s_acctbal"))
    put("nation", spark.createDataFrame([(0, "N", 0)], "n_nationkey int, n_name string, n_regionkey int"))
    put("region", spark.createDataFrame([(0, "R")], "r_regionkey int, r_name string"))
    return path


def batches(spark, stream):
    """(files, partitions, rows) of each batch."""
    seen = []

    def on_batch(batch, number):
        files, rows = batch.agg(F.countDistinct("file"), F.count("*")).first()
        seen.append((files, batch.rdd.getNumPartitions(), rows))

    start_batches(stream, on_batch, scratch_path(spark, "cp")).awaitTermination()
    return seen


def written(spark, folder):
    return batches(spark, catalog._written_stream(spark, folder).withColumn("file", F.input_file_name()))


def test_a_part_of_the_messages_has_files_for_its_rows(spark, folder, monkeypatch):
    whole = sorted(map(str, catalog.stream_latest(spark, folder).collect()))
    assert [files for files, *_ in written(spark, folder)] == [1, 1, 1]
    monkeypatch.setattr(catalog, "_ROWS_A_FILE", 250)
    seen = written(spark, folder)
    assert [files for files, *_ in seen] == [4, 4, 4]
    assert sum(n for *_, n in seen) == ROWS
    assert sorted(map(str, catalog.stream_latest(spark, folder).collect())) == whole


def test_an_events_file_is_spread_over_tasks(spark, folder):
    ((_, partitions, n),) = batches(spark, c.event_stream(spark, folder).withColumn("file", F.lit("")))
    assert partitions == spark.sparkContext.defaultParallelism > 1 and n == ROWS
    assert c.directory_documents(spark, folder).rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism


def test_figures_read_a_batch_once(spark):
    read = spark.sparkContext.accumulator(0)

    @F.udf("int")
    def counted(mark):
        read.add(1)
        return mark

    marks = frame(spark, [event(k, at=k, student=k % 5) for k in range(40)])
    rows = marks.withColumn("ATTENDANCE_MARK", counted.asNondeterministic()("ATTENDANCE_MARK"))
    rows = rows.select(*[
        (F.col(k) if k in rows.columns else F.lit(None)).cast(STORE_TYPES[k]).alias(k) for k in STORE_COLUMNS])
    update_figures(rows, scratch_path(spark, "state"), scratch_path(spark, "figures"), "run", 0)
    assert read.value == 40
