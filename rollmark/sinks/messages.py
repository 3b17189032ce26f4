"""Enriched events as keyed JSON messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from rollmark.functions.scalars import micros_text
from rollmark.schemas import OUTPUT_COLUMNS

# Producer settings of the enriched topic.
PRODUCER = {
    "kafka.batch.size": "16384",
    "kafka.linger.ms": "5",
    "kafka.compression.type": "snappy",
    "kafka.enable.idempotence": "true",
    "kafka.acks": "all",
    "kafka.retries": "2147483647",
}


def to_messages(enriched: DataFrame, columns: list[str] = OUTPUT_COLUMNS) -> DataFrame:
    """(key, value): the ID and the row as JSON. NULL fields are left out of the JSON.

    Times are written with microseconds, as events carry them; JSON on its own would cut them.
    """
    kinds = dict(enriched.dtypes)
    fields = [
        micros_text(F.col(c)).alias(c) if kinds[c].startswith("timestamp") else F.col(c) for c in columns
    ]
    return enriched.select(F.col("ID").alias("key"), F.to_json(F.struct(*fields)).alias("value"))


def write_messages(
    messages: DataFrame, fmt: str, *, batch_id: int | str | None = None, **options: str
) -> None:
    """Write messages to a topic (``fmt='kafka'``) or to files (``path=...``).

    Files of one batch have their own folder, which is replaced when the batch runs again. A
    topic may receive a batch twice; readers go by the key.
    """
    if fmt == "kafka":
        messages.write.format("kafka").options(**{**PRODUCER, **options}).save()
        return
    path = options.pop("path")
    if batch_id is None:
        messages.write.format(fmt).options(**options).mode("append").save(path)
    else:
        messages.write.format(fmt).options(**options).mode("overwrite").save(f"{path}/batch_id={batch_id}")
