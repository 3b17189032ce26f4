"""Starting streaming queries."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rollmark.plans.session import SETTINGS

_STATE_STORE = "spark.sql.streaming.stateStore.providerClass"


def use_rocksdb(spark: SparkSession) -> None:
    """Keep streaming state in RocksDB: off the JVM heap, and needed by ``arbitrate_stream``. Applies
    to queries started afterwards."""
    spark.conf.set(_STATE_STORE, SETTINGS[_STATE_STORE])


def query_id(spark: SparkSession, checkpoint: str) -> str:
    """Identifier of the query that owns a checkpoint: the same after a restart, another one for a
    fresh checkpoint. Batch numbers are unique only together with it. Known once the query runs."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()["value"])["id"]


def start_batches(
    stream: DataFrame,
    on_batch: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    every: str | None = None,
    name: str | None = None,
    mode: str = "append",
) -> StreamingQuery:
    """Call ``on_batch`` for every micro-batch: at the given interval, or for all available data
    and then stop. An error in a batch stops the query; a restart with the same checkpoint runs
    that batch again."""
    writer = stream.writeStream.foreachBatch(on_batch).outputMode(mode)
    writer = writer.option("checkpointLocation", checkpoint)
    if name:
        writer = writer.queryName(name)
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return writer.trigger(**trigger).start()


def supervise(queries: Sequence[StreamingQuery], poll_seconds: float = 0.5) -> None:
    """Wait until all queries of a job are done. When one fails, the others are stopped at once and its
    error is raised, so a job is never alive with a dead query."""
    waiting = list(queries)
    try:
        while waiting:
            waiting = [q for q in waiting if not q.awaitTermination(poll_seconds / len(waiting))]
    finally:
        for query in queries:
            if query.isActive:
                query.stop()
