"""Values carried along ordered groups, without putting a large group into one task.

A window over the whole group is used where groups are of ordinary size. Groups in heavy
buckets are range-partitioned by (key, order), so a large group lies in consecutive chunks. Each
chunk runs the same windows on its own rows and is then given what the chunks before it end
with. At most one group reaches a chunk from an earlier one, so what is handed over has at most
one row per chunk.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from math import ceil

from pyspark.sql import Column, DataFrame, Window, functions as F

from rollmark.plans.session import cut
from rollmark.plans.skew import ROWS_PER_TASK, bucket_of, heavy_buckets

_NONE: Mapping[str, Column] = {}


@dataclass(frozen=True)
class Ordered:
    """Rows grouped by ``keys`` and ordered by ``order``; ``chunk`` names the chunk column when
    groups are split."""

    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunk: str | None = None

    def carry(
        self,
        df: DataFrame,
        *,
        last_before: Mapping[str, Column] = _NONE,
        last_upto: Mapping[str, Column] = _NONE,
        first_upto: Mapping[str, Column] = _NONE,
    ) -> DataFrame:
        """Add columns holding, per row, the last non-NULL value of an expression strictly
        before the row, the last one up to the row, or the first one up to the row."""
        split = (self.chunk,) if self.chunk else ()
        window = Window.partitionBy(*split, *self.keys).orderBy(*self.order)
        before = window.rowsBetween(Window.unboundedPreceding, -1)
        upto = window.rowsBetween(Window.unboundedPreceding, Window.currentRow)

        wanted = {**last_before, **last_upto, **first_upto}
        out = df.withColumns({f"_v_{n}": e for n, e in wanted.items()})
        local = {
            **{n: F.last(f"_v_{n}", ignorenulls=True).over(before) for n in last_before},
            **{n: F.last(f"_v_{n}", ignorenulls=True).over(upto) for n in last_upto},
            **{n: F.first(f"_v_{n}", ignorenulls=True).over(upto) for n in first_upto},
        }
        if self.chunk:
            out = self._with_handover(out, local, set(first_upto))
        else:
            out = out.withColumns(local)
        return out.drop(*[f"_v_{n}" for n in wanted])

    def _with_handover(self, df: DataFrame, local: dict[str, Column], firsts: set[str]) -> DataFrame:
        order = F.struct(*self.order)
        ends = df.groupBy(self.chunk, *self.keys).agg(
            *[
                (F.min_by if n in firsts else F.max_by)(
                    F.col(f"_v_{n}"), F.when(F.col(f"_v_{n}").isNotNull(), order)
                ).alias(f"_e_{n}")
                for n in local
            ]
        )
        earlier = (
            Window.partitionBy(*self.keys).orderBy(self.chunk)
            .rowsBetween(Window.unboundedPreceding, -1)
        )
        handover = ends.select(
            self.chunk,
            *self.keys,
            F.count(F.lit(1)).over(earlier).alias("_earlier"),
            *[
                (F.first if n in firsts else F.last)(f"_e_{n}", ignorenulls=True)
                .over(earlier).alias(f"_h_{n}")
                for n in local
            ],
        ).filter(F.col("_earlier") > 0).drop("_earlier")
        # One row per chunk at most, see the module text: safe to broadcast.
        joined = df.withColumns(local).alias("r").join(
            F.broadcast(handover.alias("h")),
            [F.col(f"r.{k}").eqNullSafe(F.col(f"h.{k}")) for k in (self.chunk, *self.keys)],
            "left",
        )
        kept = [F.col(f"r.{c}") for c in df.columns if c not in local]
        merged = [
            (F.coalesce(f"h._h_{n}", f"r.{n}") if n in firsts else F.coalesce(f"r.{n}", f"h._h_{n}")).alias(n)
            for n in local
        ]
        return joined.select(*kept, *merged)

    def settle(self, df: DataFrame) -> DataFrame:
        """End a pass: with split groups the rows are materialised, as the next pass reads them
        twice."""
        return cut(df) if self.chunk else df


def over_ordered_groups(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[str],
    step: Callable[[DataFrame, Ordered], DataFrame],
    *,
    rows_per_task: int = ROWS_PER_TASK,
    count_from: DataFrame | None = None,
) -> DataFrame:
    """Apply ``step`` to all groups, those in heavy buckets split into chunks.

    ``count_from`` may name a cheaper table to count group sizes on; it must hold at least the
    rows of ``df``.
    """
    keys, order = tuple(keys), tuple(order)
    heavy = heavy_buckets(df if count_from is None else count_from, keys, rows_per_task)
    if not heavy:
        return step(df, Ordered(keys, order))

    in_heavy = bucket_of(keys).isin(list(heavy))
    usual = step(df.filter(~in_heavy), Ordered(keys, order))
    # The tie column lets even rows that agree in every order column go to different chunks. It
    # is numbered over stored rows, so a task that runs again gives the same numbers.
    chunks = cut(
        cut(df.filter(in_heavy))
        .withColumn("_tie", F.monotonically_increasing_id())
        .repartitionByRange(max(2, ceil(sum(heavy.values()) / rows_per_task)), *keys, *order, "_tie")
        .withColumn("_chunk", F.spark_partition_id())
    )
    split = step(chunks, Ordered(keys, (*order, "_tie"), "_chunk")).drop("_tie", "_chunk")
    return usual.unionByName(split)
