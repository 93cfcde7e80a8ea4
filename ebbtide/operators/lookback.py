"""Look-back windows: dated facts seen from each customer's anchor date."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import as_date, as_double, days_before, total_within
from ebbtide.names import CALL_DAYS, CUSTOMER, TALK_DAYS

DAY = "fact_day"
DISTANCE = "days_before"
#: Days of a cell; a window of 91 days touches four or five.
CELL_DAYS = 30


def daily_totals(
    facts: DataFrame, date: str, measures: Mapping[str, Column], keys: Sequence[str] = ()
) -> DataFrame:
    """One row per customer, key and day, holding the aggregated measures.

    This runs before the facts are brought together by customer. Its map-side
    combine is what keeps a customer with a third of all rows harmless: after it
    the largest customer has as many rows as the calendar has days (times keys).
    Rows without a date can fall in no window and are dropped at the scan.
    """
    return (
        facts.where(as_date(date).isNotNull())
        .groupBy(CUSTOMER, *keys, as_date(date).alias(DAY))
        .agg(*[measure.alias(name) for name, measure in measures.items()])
    )


def cell_of(day: str | Column) -> Column:
    """The CELL_DAYS-day cell of a date, counted from 1970."""
    return F.floor(F.unix_date(day) / CELL_DAYS).cast("int")


def look_back(
    anchors: DataFrame, facts: DataFrame, days: int, date: str = DAY, how: str = "left"
) -> DataFrame:
    """Facts of each anchor's customer, 0 to ``days`` days before ref_date; both ends count.

    An anchor is repeated for each cell its window touches, and facts meet it on customer
    and cell, with the band as a further condition. So the facts cross the network once,
    unsorted, spread over the cells of their customer, and cells that no window touches
    end there. The anchors' side, a few narrow rows per customer, is the one that is
    hashed. Adaptive execution splits a cell that is still too large, since the join reads
    its two sides straight from their exchanges. What is left is for the caller to aggregate, with
    map-side combine. ``how='left'`` adds one row without a fact for *every* anchor, so
    that one aggregation covers customers without facts too.
    """
    first, last = cell_of(F.date_sub("ref_date", days)), cell_of("ref_date")
    reach = anchors.withColumn("_cell", F.explode(F.sequence(first, last)))
    own = facts.withColumnRenamed(CUSTOMER, "_customer").withColumn("_fact_cell", cell_of(date))
    distance = days_before("ref_date", date)
    same_cell = (F.col(CUSTOMER) == F.col("_customer")) & (F.col("_cell") == F.col("_fact_cell"))
    found = (
        own.join(reach.hint("shuffle_hash"), same_cell & distance.between(0, days))
        .drop("_customer", "_cell", "_fact_cell")
        .withColumn(DISTANCE, distance)
    )
    if how == "inner":
        return found
    return found.unionByName(anchors, allowMissingColumns=True)


def in_reach(facts: DataFrame, date: str, anchors: DataFrame, days: int) -> DataFrame:
    """Facts between the earliest window's start and the latest anchor.

    The two bounds are one scalar subquery over the anchors. On a DATE column the filter
    reaches the scan, so row groups and date partitions outside are not read, and facts
    that no window can hold are not shuffled.
    """
    ends = anchors.agg(
        F.struct(F.min("ref_date").alias("first"), F.max("ref_date").alias("last"))
    ).scalar()
    return facts.where(
        (as_date(date) >= F.date_sub(ends["first"], days)) & (as_date(date) <= ends["last"])
    )


def daily_calls(calls: DataFrame, keys: Sequence[str] = ("call_type",)) -> DataFrame:
    return daily_totals(
        calls,
        "event_date",
        {
            "calls": F.count(F.lit(1)),
            "talk_seconds": F.sum(as_double("talk_time_seconds")),
            "hold_seconds": F.sum(as_double("hold_time_seconds")),
        },
        keys,
    )


def daily_usage(usage: DataFrame) -> DataFrame:
    """Download and upload per customer and day."""
    return daily_totals(
        usage,
        "calendar_date",
        {
            "download_mbs": F.sum(as_double("usage_download_mbs")),
            "upload_mbs": F.sum(as_double("usage_upload_mbs")),
        },
    )


def dated_calls(calls: DataFrame, keys: Sequence[str] = ("call_type",)) -> DataFrame:
    """Calls as facts: customer, ``keys``, day, 1 call, talk and hold seconds."""
    return calls.where(as_date("event_date").isNotNull()).select(
        CUSTOMER,
        *keys,
        as_date("event_date").alias(DAY),
        F.lit(1).alias("calls"),
        as_double("talk_time_seconds").alias("talk_seconds"),
        as_double("hold_time_seconds").alias("hold_seconds"),
    )


def dated_usage(usage: DataFrame) -> DataFrame:
    """Usage as facts: customer, day, download and upload."""
    return usage.where(as_date("calendar_date").isNotNull()).select(
        CUSTOMER,
        as_date("calendar_date").alias(DAY),
        as_double("usage_download_mbs").alias("download_mbs"),
        as_double("usage_upload_mbs").alias("upload_mbs"),
    )


def calls_by_type(anchors: DataFrame, calls: DataFrame, how: str = "left") -> DataFrame:
    """One row per anchor and call_type: calls, talk and hold per window, last call.

    Every column of ``anchors`` is carried along. With ``how='left'`` every customer has a
    row without a type, which counts the calls without one (0 if there are none).
    """
    windows = [total_within("calls", DISTANCE, d).alias(f"calls_{d}d") for d in CALL_DAYS]
    windows += [
        total_within(f"{kind}_seconds", DISTANCE, d).alias(f"{kind}_{d}d")
        for kind in ("talk", "hold")
        for d in TALK_DAYS
    ]
    return (
        look_back(
            anchors,
            dated_calls(in_reach(calls, "event_date", anchors, max(CALL_DAYS))),
            max(CALL_DAYS),
            how=how,
        )
        .groupBy(*anchors.columns, "call_type")
        .agg(*windows, F.min(DISTANCE).alias("last_call"))
    )
