"""Operators on the snapshot history (many dated rows per customer)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import as_date
from ebbtide.names import CUSTOMER

SNAPSHOT_KEY = "snapshot_id"


def latest_snapshot(
    customer_info: DataFrame,
    columns: Sequence[str],
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """The chosen columns of each customer's latest snapshot.

    Two snapshots on the latest date need a tie-break, or reruns could differ. By
    default that is ``snapshot_id`` where the table has one, else the returned
    columns themselves (larger value first).

    ``row_number() = 1`` lets Spark plan a WindowGroupLimit before the shuffle, so
    every map task sends at most one row per customer, however many it read.
    """
    if tie_break is None:
        tie_break = [SNAPSHOT_KEY] if SNAPSHOT_KEY in customer_info.columns else list(columns)
    newest_first = Window.partitionBy(CUSTOMER).orderBy(
        as_date("datevalue").desc(), *[F.col(c).desc() for c in tie_break]
    )
    return (
        customer_info.withColumn("_position", F.row_number().over(newest_first))
        .where(F.col("_position") == 1)
        .select(CUSTOMER, *columns)
    )


def value_changes(
    customer_info: DataFrame,
    column: str,
    customers: DataFrame | None = None,
    direction: str = "as_reference",
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """Steps between two known, different values of ``column`` in a customer's history.

    Returns customer, from_value, to_value, prev_date, datevalue. With
    ``direction='as_reference'`` the history is read newest first, so from_value is
    the *later* value; ``'chronological'`` reads it oldest first. An unknown value in
    between breaks the chain. Rows of a day are ordered by ``tie_break``, by default
    as in ``latest_snapshot``.

    Every row counts, and still no customer is one window partition of all its rows:
    steps inside a day are found per customer and day, and days are linked by the first
    and the last value of each, which map-side combine finds. The busiest customer has
    as many rows there as the calendar has days.
    """
    if direction not in ("as_reference", "chronological"):
        raise ValueError(f"unknown direction {direction!r}")
    if customers is not None:
        customer_info = customer_info.join(customers.select(CUSTOMER), CUSTOMER, "left_semi")
    if tie_break is None:
        tie_break = [SNAPSHOT_KEY] if SNAPSHOT_KEY in customer_info.columns else []
    history = customer_info.select(
        CUSTOMER,
        as_date("datevalue").alias("datevalue"),
        F.col(column).alias("_value"),
        F.struct(*tie_break, column).alias("_place"),
    )
    day = [CUSTOMER, "datevalue"]
    days = history.groupBy(*day).agg(
        F.min_by("_value", "_place").alias("_first"), F.max_by("_value", "_place").alias("_last")
    )
    by_day = Window.partitionBy(CUSTOMER).orderBy("datevalue")
    between = days.select(
        CUSTOMER,
        F.lag("_last").over(by_day).alias("_from"),
        F.col("_first").alias("_to"),
        F.lag("datevalue").over(by_day).alias("_from_date"),
        F.col("datevalue").alias("_to_date"),
    )
    in_day = Window.partitionBy(*day).orderBy("_place")
    inside = history.select(
        CUSTOMER,
        F.lag("_value").over(in_day).alias("_from"),
        F.col("_value").alias("_to"),
        F.col("datevalue").alias("_from_date"),
        F.col("datevalue").alias("_to_date"),
    )
    earlier, later = ("_from", "_from_date"), ("_to", "_to_date")
    if direction == "as_reference":
        earlier, later = later, earlier
    return (
        between.unionByName(inside)
        .where(F.col("_from").isNotNull() & (F.col("_to") != F.col("_from")))
        .select(
            CUSTOMER,
            F.col(earlier[0]).alias("from_value"),
            F.col(later[0]).alias("to_value"),
            F.col(earlier[1]).alias("prev_date"),
            F.col(later[1]).alias("datevalue"),
        )
    )
