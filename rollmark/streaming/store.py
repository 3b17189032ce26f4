"""Enriched messages into the history and into the latest-state table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.streaming import StreamingQuery

from rollmark.operators.conform import conform_enriched
from rollmark.operators.dedupe import dedupe_events
from rollmark.schemas import ENRICHED_EVENT
from rollmark.sinks.history import append_history, compact_history
from rollmark.sinks.latest import compact_latest, upsert_latest
from rollmark.streaming.run import query_id, start_batches

# Batches after which the partitions that several of them touched are merged.
MERGE_EVERY = 16


def _decoded(messages: DataFrame, value: str) -> DataFrame:
    record = F.from_json(F.col(value).cast("string"), ENRICHED_EVENT)
    return messages.select(F.col(value).cast("string").alias("_value"), F.inline(F.array(record)))


def decode_enriched(messages: DataFrame, value: str = "value") -> DataFrame:
    """Messages of enriched events to their 31 columns."""
    return _decoded(messages, value).filter(F.col("ID").isNotNull()).drop("_value")


def store_rows(messages: DataFrame, value: str = "value", **conform) -> tuple[DataFrame, DataFrame]:
    """(rows, rejects): what the store can hold, and everything else as (key, reason). Every message
    is in one of the two."""
    decoded = _decoded(messages, value)
    rows, refused = conform_enriched(decoded.filter(F.col("ID").isNotNull()).drop("_value"), **conform)
    unread = decoded.filter(F.col("ID").isNull()).select(
        F.col("_value").alias("key"), F.lit("no_id").alias("reason"))
    return rows, unread.unionByName(refused.select(F.col("ID").alias("key"), "reason"))


Sink = Callable[[DataFrame, int], None]


def _start(
    messages: DataFrame, path: str, add: Callable[..., None], merge: Callable[..., object], checkpoint: str,
    every: str | None, rejects: Sink | None, merge_every: int, conform: dict,
) -> StreamingQuery:
    def on_batch(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows, refused = store_rows(batch, **conform)
        add(rows, path, query_id(spark, checkpoint), batch_id)
        if rejects is not None:
            rejects(refused, batch_id)
        if batch_id % merge_every == merge_every - 1:
            merge(spark, path, 2)

    return start_batches(messages, on_batch, checkpoint, every=every)


def start_history(
    messages: DataFrame, path: str, checkpoint: str, *, every: str | None = None, rejects: Sink | None = None,
    merge_every: int = MERGE_EVERY, **conform,
) -> StreamingQuery:
    """Append enriched messages to the history, each ID once; ``rejects(rows, batch_id)`` gets the
    messages that the store cannot hold. A batch writes its own rows and reads nothing of the history."""

    def add(rows: DataFrame, *where) -> None:
        append_history(dedupe_events(rows), *where)

    return _start(messages, path, add, compact_history, checkpoint, every, rejects, merge_every, conform)


def start_mart(
    messages: DataFrame, path: str, checkpoint: str, *, every: str | None = None, rejects: Sink | None = None,
    merge_every: int = MERGE_EVERY, **conform,
) -> StreamingQuery:
    """Keep the latest-state table up to date from enriched messages; ``rejects`` and costs as above."""
    return _start(messages, path, upsert_latest, compact_latest, checkpoint, every, rejects, merge_every, conform)
