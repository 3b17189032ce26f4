"""JSON messages to typed events, with everything that cannot be used kept aside."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from rollmark.schemas import RAW_COLUMNS, RAW_INTS

MESSAGE = "key string, value string"
_CORRUPT = "_malformed"

# Every field is read as text first: producers send some numbers quoted, and a cast that fails
# must cost one field, not the record.
_AS_TEXT = ", ".join(f"{c} string" for c in [*RAW_COLUMNS, _CORRUPT])


# The fields of a mark request as it is sent.
REQUEST = """
    request_id string, journalId string, userId string, lessonId string, attendance string,
    lessonDate string, requester_id bigint, requester_dean_id bigint, requester_kind string,
    requested_at timestamp_ntz
"""


def read_messages(
    spark: SparkSession, fmt: str, *, stream: bool = False, schema: str | None = None, **options: str
) -> DataFrame:
    """Messages from a topic (``fmt='kafka'``) or from files (``parquet``, ``json``, ...).

    A topic is read from its earliest offset and a gap in the data is an error, unless the
    options say otherwise. Files take ``path=...``.
    """
    reader = spark.readStream if stream else spark.read
    if fmt == "kafka":
        options = {"startingOffsets": "earliest", "failOnDataLoss": "true", **options}
    else:
        reader = reader.schema(schema or MESSAGE)
    path = options.pop("path", None)
    reader = reader.format(fmt).options(**options)
    return reader.load(path) if path else reader.load()


def decode_events(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(events, rejects): raw events with their 11 typed columns, and the messages without a
    usable ID with a ``reason``. Works on batch and streaming input."""
    text = F.col(value).cast("string")
    # inline() keeps the parse in one place: a filter on the parsed fields cannot be pushed
    # below it, which would parse every message twice.
    record = F.from_json(text, _AS_TEXT, {"columnNameOfCorruptRecord": _CORRUPT})
    others = [c for c in messages.columns if c not in (*RAW_COLUMNS, _CORRUPT)]
    parsed = messages.select(*others, F.inline(F.array(record)))

    events = parsed.filter(F.col("ID").isNotNull()).select(
        *[F.col(c).try_cast(RAW_INTS[c]).alias(c) if c in RAW_INTS else F.col(c) for c in RAW_COLUMNS]
    )
    rejects = parsed.filter(F.col("ID").isNull()).select(
        *others,
        F.when(F.col(value).isNull(), "no_value")
        .when(F.trim(text) == "", "empty_value")
        .when(F.col(_CORRUPT).isNotNull(), "malformed_json")
        .otherwise("no_id").alias("reason"),
    )
    return events, rejects


def decode_requests(messages: DataFrame, value: str = "value") -> tuple[DataFrame, DataFrame]:
    """(requests, rejects): mark requests with their typed fields, and the messages that are no request,
    with a ``reason``. A field that does not fit its type is NULL and costs only itself."""
    text = F.col(value).cast("string")
    fields = [f.split() for f in REQUEST.split(",")]
    record = F.from_json(text, ", ".join(f"{n} string" for n, _ in fields) + f", {_CORRUPT} string",
                         {"columnNameOfCorruptRecord": _CORRUPT})
    parsed = messages.select(F.col(value).alias("_value"), F.inline(F.array(record)))
    usable = F.col("request_id").isNotNull() & F.col(_CORRUPT).isNull()
    requests = parsed.filter(usable).select(*[F.col(n).try_cast(kind).alias(n) for n, kind in fields])
    rejects = parsed.filter(~usable).select(
        F.coalesce("request_id", F.col("_value").cast("string")).alias("key"),
        F.when(F.col("_value").isNull(), "no_value")
        .when(F.col(_CORRUPT).isNotNull(), "malformed_json").otherwise("no_id").alias("reason"),
    )
    return requests, rejects
