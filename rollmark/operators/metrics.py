"""Row counts taken while the rows pass, in place of extra counting jobs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, functions as F


def observe_stage(df: DataFrame, **more: Column) -> tuple[DataFrame, Observation]:
    """The same rows, and an observation that holds ``rows`` and the given aggregates once an
    action has run."""
    seen = Observation()
    metrics = [F.count(F.lit(1)).alias("rows"), *[c.alias(n) for n, c in more.items()]]
    return df.observe(seen, *metrics), seen


# Groups of ids that each keep their smallest; a sample is taken from these.
_BUCKETS = 16


def sampled_ids(ids: Column, asked: Column, most: int = 10) -> Column:
    """An aggregate: up to ``most`` distinct ids of the rows where ``asked`` holds, as an array.

    Ids are ordered by a hash and dealt into 16 groups by it; every group keeps its smallest, and of these
    the smallest are given. So what is held is bounded, parts merge to the same whatever the
    partitioning, and a frequent id is as likely as others. It can be observed while rows pass. With few ids,
    two in one group show as one.
    """
    text = ids.cast("string")
    digest = F.md5(text)
    mine = F.when(asked & text.isNotNull(), F.struct(digest.alias("h"), text.alias("id")))
    least = [
        F.min(F.when(F.substring(digest, 1, 1) == f"{bucket:x}", mine)) for bucket in range(_BUCKETS)
    ]
    found = F.filter(F.array(*least), lambda x: x.isNotNull())
    return F.transform(F.slice(F.array_sort(found), 1, most), lambda x: x["id"])


def sample_rows(df: DataFrame, rows: int = 2) -> DataFrame:
    """A few rows to look at."""
    return df.limit(rows)
