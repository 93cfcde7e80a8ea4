"""Per-customer feature frames and the wide training and scoring frames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import (
    as_double,
    as_int,
    band,
    flag,
    percent_change,
    ratio_or_zero,
    total_within,
)
from ebbtide.names import (
    CALL_DAYS,
    CALL_FEATURES,
    CALL_TYPES,
    CONTRACT_FEATURES,
    CUSTOMER,
    FEATURES,
    LABEL,
    NEAR_END_OF_CONTRACT_DAYS,
    NO_CALL_RECENCY,
    NO_USAGE_RECENCY,
    PAYMENT_FEATURES,
    PRODUCT_FEATURES,
    REPEAT_CALLER_CALLS,
    TALK_DAYS,
    TALK_FEATURES,
    TENURE_FEATURE_BANDS,
    TYPED_CALL_DAYS,
    UNKNOWN,
    USAGE_DAYS,
)
from ebbtide.operators.anchors import churn_target, reference_dates, scoring_dates
from ebbtide.operators.lookback import DISTANCE, calls_by_type, dated_usage, in_reach, look_back
from ebbtide.operators.snapshots import latest_snapshot

SNAPSHOT_INPUTS = (
    "contract_dd_cancels",
    "dd_cancel_60_day",
    "tenure_days",
    "ooc_days",
    "contract_status",
    "sales_channel",
    "technology",
    "speed",
    "line_speed",
)


def call_and_talk_features(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Call counts and talk and hold minutes in one pass over the calls.

    Calls meet the anchors by customer and cell; what lies in a window is reduced to
    (customer, type), with map-side combine, and then to the customer. Every anchor
    customer is in the result.
    """
    per_type = calls_by_type(anchors.select(CUSTOMER, "ref_date"), calls)
    counts = [F.sum(f"calls_{d}d").alias(f"calls_total_{d}d") for d in CALL_DAYS]
    for kind, text in CALL_TYPES.items():
        for d in TYPED_CALL_DAYS:
            of_type = F.when(F.col("call_type") == text, F.col(f"calls_{d}d")).otherwise(0)
            counts.append(F.sum(of_type).alias(f"calls_{kind}_{d}d"))
    minutes = [
        (F.sum(f"{kind}_{d}d") / 60).cast("double").alias(f"{kind}_time_total_{d}d")
        for kind in ("talk", "hold")
        for d in TALK_DAYS
    ]
    per_customer = per_type.groupBy(CUSTOMER).agg(
        *counts,
        F.coalesce(F.min("last_call"), F.lit(NO_CALL_RECENCY)).alias("days_since_last_call"),
        F.count(F.when(F.col("calls_90d") > 0, F.col("call_type"))).alias(
            "call_type_diversity_90d"
        ),
        *minutes,
    )
    return per_customer.withColumns(
        {
            "repeat_caller_flag_30d": flag(F.col("calls_total_30d") >= REPEAT_CALLER_CALLS),
            "avg_talk_time_per_call_90d": ratio_or_zero("talk_time_total_90d", "calls_total_90d"),
            "hold_ratio_90d": ratio_or_zero("hold_time_total_90d", "talk_time_total_90d"),
        }
    ).select(CUSTOMER, *CALL_FEATURES, *TALK_FEATURES)


def call_features(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Calls by window and type, recency, variety and the repeat-caller flag."""
    return call_and_talk_features(calls, anchors).select(CUSTOMER, *CALL_FEATURES)


def talk_hold_features(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Talk and hold time in minutes, talk per call and hold per talk."""
    return call_and_talk_features(calls, anchors).select(CUSTOMER, *TALK_FEATURES)


def usage_features(
    usage: DataFrame,
    anchors: DataFrame,
    keep_totals: bool = False,
    how: str = "left",
) -> DataFrame:
    """Change in download volume, days 0-27 against days 28-55, in percent.

    ``keep_totals`` also returns the totals and the recency behind it; ``how="inner"``
    leaves out customers without usage in reach.
    """
    kinds = ("download", "upload")
    totals = {
        f"{kind}_total_{d}d": total_within(f"{kind}_mbs", DISTANCE, d)
        for kind in kinds
        for d in USAGE_DAYS
    }
    totals["days_since_last_usage"] = F.coalesce(F.min(DISTANCE), F.lit(NO_USAGE_RECENCY))
    totals["download_last_28d"] = total_within("download_mbs", DISTANCE, 27)
    totals["download_prev_28d"] = total_within("download_mbs", DISTANCE, 55, first=28)
    per_customer = (
        look_back(
            anchors.select(CUSTOMER, "ref_date"),
            dated_usage(in_reach(usage, "calendar_date", anchors, max(USAGE_DAYS))),
            max(USAGE_DAYS),
            how=how,
        )
        .groupBy(CUSTOMER)
        .agg(*[total.alias(name) for name, total in totals.items()])
        .withColumn("usage_drop_pct_28d", percent_change("download_last_28d", "download_prev_28d"))
    )
    extra = [name for name in totals if not name.endswith("_28d")] if keep_totals else []
    return per_customer.select(CUSTOMER, *extra, "usage_drop_pct_28d")


def snapshot_features(
    customer_info: DataFrame, tie_break: Sequence[str] | None = None
) -> DataFrame:
    """Payment, contract and product features from one pass over the latest snapshots."""
    latest = latest_snapshot(customer_info, SNAPSHOT_INPUTS, tie_break)

    def or_zero(name):
        return F.coalesce(as_int(name), F.lit(0))

    def or_unknown(name):
        return F.coalesce(F.col(name), F.lit(UNKNOWN))

    clean = latest.select(
        CUSTOMER,
        *[
            or_zero(c).alias(c)
            for c in ("contract_dd_cancels", "dd_cancel_60_day", "tenure_days", "ooc_days")
        ],
        *[or_unknown(c).alias(c) for c in ("contract_status", "sales_channel", "technology")],
        *[as_double(c).alias(c) for c in ("speed", "line_speed")],
    )
    gap = F.col("speed") - F.col("line_speed")
    return clean.withColumns(
        {
            "any_contract_dd_cancel": flag(F.col("contract_dd_cancels") > 0),
            "any_dd_cancel_60d": flag(F.col("dd_cancel_60_day") > 0),
            "is_out_of_contract": flag(F.col("ooc_days") > 0),
            "is_near_ooc": flag(F.col("ooc_days").between(-NEAR_END_OF_CONTRACT_DAYS, 0)),
            "tenure_bucket": band("tenure_days", TENURE_FEATURE_BANDS),
            "speed_gap": gap,
            "speed_gap_pct": F.when(F.col("speed") > 0, gap / F.col("speed")),
        }
    ).select(CUSTOMER, *PAYMENT_FEATURES, *CONTRACT_FEATURES, *PRODUCT_FEATURES)


def payment_friction_features(
    customer_info: DataFrame, tie_break: Sequence[str] | None = None
) -> DataFrame:
    return snapshot_features(customer_info, tie_break).select(CUSTOMER, *PAYMENT_FEATURES)


def contract_tenure_features(
    customer_info: DataFrame, tie_break: Sequence[str] | None = None
) -> DataFrame:
    return snapshot_features(customer_info, tie_break).select(CUSTOMER, *CONTRACT_FEATURES)


def product_tech_speed_features(
    customer_info: DataFrame, tie_break: Sequence[str] | None = None
) -> DataFrame:
    return snapshot_features(customer_info, tie_break).select(CUSTOMER, *PRODUCT_FEATURES)


def _wide(
    anchors: DataFrame,
    customer_info: DataFrame,
    calls: DataFrame,
    usage: DataFrame,
    tie_break: Sequence[str] | None,
) -> DataFrame:
    """One row per anchor customer; every side is already partitioned by customer.

    The call frame holds every anchor customer, so it is the base: the anchors
    themselves need no further scan.
    """
    return (
        call_and_talk_features(calls, anchors)
        .join(snapshot_features(customer_info, tie_break), CUSTOMER, "left")
        .join(usage_features(usage, anchors, how="inner"), CUSTOMER, "left")
        .select(CUSTOMER, *FEATURES)
    )


def training_features(
    cease: DataFrame,
    customer_info: DataFrame,
    calls: DataFrame,
    usage: DataFrame,
    anchors: DataFrame | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """38 columns: customer, 36 features and the label is_churned.

    The anchor follows the first *placed* cease, the label the *completed* ones, so a
    customer whose cease is still open has a churner's anchor and label 0. Snapshot
    features come from the latest snapshot even where it lies after the anchor.
    """
    if anchors is None:
        anchors = reference_dates(cease, customer_info)
    features = _wide(anchors, customer_info, calls, usage, tie_break)
    target = churn_target(cease).select(CUSTOMER, LABEL)
    return features.join(target, CUSTOMER, "left").fillna({LABEL: 0})


def inference_features(
    customer_info: DataFrame,
    calls: DataFrame,
    usage: DataFrame,
    anchors: DataFrame | None = None,
    tie_break: Sequence[str] | None = None,
) -> DataFrame:
    """37 columns: customer and 36 features, anchored on the last snapshot date."""
    if anchors is None:
        anchors = scoring_dates(customer_info)
    return _wide(anchors, customer_info, calls, usage, tie_break)
