"""Lookup joins that hold when one key carries a large share of all rows."""

from __future__ import annotations

from collections.abc import Sequence
from math import ceil

from pyspark.sql import Column, DataFrame, functions as F

BUCKETS = 65_536
ROWS_PER_TASK = 5_000_000


def bucket_of(keys: Sequence[str]) -> Column:
    """Hash bucket of a key. A key never leaves its bucket, so a key with more than n rows
    always sits in a bucket with more than n rows."""
    return F.pmod(F.xxhash64(*keys), F.lit(BUCKETS)).cast("int")


def heavy_buckets(
    df: DataFrame, keys: Sequence[str], rows_per_task: int = ROWS_PER_TASK
) -> dict[int, int]:
    """Row counts of the buckets that hold at least ``rows_per_task`` rows more than the average,
    and more than ``rows_per_task``.

    On very large data every bucket holds many keys and many rows; what is beyond that is due to
    single keys. So no task gets a key with more than ``rows_per_task`` rows besides its share.
    Rows with a NULL in the key match nothing and are not counted. Counting is pre-aggregated on the map side and there are at most BUCKETS groups whatever the
    size of the data, so both the shuffle and the answer are small.
    """
    usable = F.lit(True)
    for k in keys:
        usable = usable & F.col(k).isNotNull()
    counts = df.filter(usable).groupBy(bucket_of(keys).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    seen = counts.agg(
        F.sum("n").alias("total"),
        F.collect_list(F.when(F.col("n") > rows_per_task, F.struct("bucket", "n"))).alias("large"),
    ).first()
    average = (seen["total"] or 0) / BUCKETS
    return {b["bucket"]: b["n"] for b in seen["large"] if b["n"] >= average + rows_per_task}


def lookup_join(
    facts: DataFrame,
    dim: DataFrame,
    keys: Sequence[str],
    *,
    broadcast: bool,
    row_id: Sequence[str],
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Left join of ``facts`` with a lookup table that has one row per key.

    With ``broadcast`` (say so only after measuring, see ``sizing``) the facts stay where they
    are. Otherwise both sides are shuffled on the key, and the rows of heavy buckets are spread
    over as many salts as they need, with the matching lookup rows repeated per salt. Rows
    with a NULL key match nothing and are spread over all tasks.

    ``row_id`` are fact columns that differ from row to row; ``count_from`` may name a cheaper
    table with the same keys to count in place of ``facts``.
    """
    keys = list(keys)
    if broadcast:
        return facts.join(F.broadcast(dim), keys, "left")

    spark = facts.sparkSession
    heavy = heavy_buckets(facts if count_from is None else count_from, keys, rows_per_task)
    spread = F.xxhash64(*row_id)
    no_key = F.lit(False)
    for k in keys:
        no_key = no_key | F.col(k).isNull()

    if not heavy:
        salted = facts.withColumn("_salt", F.when(no_key, spread).otherwise(F.lit(0).cast("bigint")))
        copies = dim.withColumn("_salt", F.lit(0).cast("bigint"))
        return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")

    salts = F.broadcast(
        spark.createDataFrame(
            [(b, ceil(n / rows_per_task)) for b, n in heavy.items()], "_bucket int, _salts int"
        )
    )
    salted = (
        facts.withColumn("_bucket", bucket_of(keys))
        .join(salts, "_bucket", "left")
        .withColumn(
            "_salt",
            F.when(no_key, spread).otherwise(F.pmod(spread, F.coalesce("_salts", F.lit(1)))),
        )
        .drop("_bucket", "_salts")
    )
    copies = (
        dim.withColumn("_bucket", bucket_of(keys))
        .join(salts, "_bucket", "left")
        .withColumn(
            "_salt",
            F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("_salts", F.lit(1)) - F.lit(1).cast("bigint"))),
        )
        .drop("_bucket", "_salts")
    )
    return salted.join(copies, [*keys, "_salt"], "left").drop("_salt")
