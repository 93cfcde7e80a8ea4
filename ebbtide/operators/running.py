"""Exact running totals over one global order, without sorting in one task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.sources.writers import materialise


def running_totals(
    df: DataFrame, order: str, values: Sequence[str], ranges: int | None = None
) -> DataFrame:
    """For each row, in descending ``order``: totals above it and the next row's values.

    ``order`` must be unique in ``df``. Adds ``above_<v>`` (sum of v over all rows that
    come first), ``next_<v>`` (v of the following row, NULL on the last one) and ``total_<v>``.

    An unpartitioned window would sort everything in one task. Instead the rows are range
    partitioned by ``order`` (into ``ranges`` partitions, or as many as the session has for
    shuffles) and written once with the number of their range, which fixes the ranges for
    all that follows. Each range is ordered by itself; the totals of the ranges, one row
    each, link them, and that bounds what is broadcast and what one window sorts.
    """
    by_order = F.col(order).desc()
    spread = df.repartitionByRange(by_order) if ranges is None else df.repartitionByRange(ranges, by_order)
    rows = materialise(spread.withColumn("_range", F.spark_partition_id()), "ranges")
    all_ranges = Window.orderBy("_range")
    earlier = all_ranges.rowsBetween(Window.unboundedPreceding, -1)
    whole = all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per_range = rows.groupBy("_range").agg(
        *[F.sum(v).alias(f"sum_{v}") for v in values],
        *[F.max_by(v, order).alias(f"first_{v}") for v in values],
    )
    links = per_range.select(
        "_range",
        *[F.coalesce(F.sum(f"sum_{v}").over(earlier), F.lit(0)).alias(f"offset_{v}") for v in values],
        *[F.sum(f"sum_{v}").over(whole).alias(f"total_{v}") for v in values],
        *[F.lead(f"first_{v}").over(all_ranges).alias(f"following_{v}") for v in values],
    )
    inside = Window.partitionBy("_range").orderBy(by_order)
    before = inside.rowsBetween(Window.unboundedPreceding, -1)
    return rows.join(F.broadcast(links), "_range").select(
        *df.columns,
        *[f"total_{v}" for v in values],
        *[
            (F.col(f"offset_{v}") + F.coalesce(F.sum(v).over(before), F.lit(0))).alias(f"above_{v}")
            for v in values
        ],
        *[
            F.coalesce(F.lead(v).over(inside), F.col(f"following_{v}")).alias(f"next_{v}")
            for v in values
        ],
    )
