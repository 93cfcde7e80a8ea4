"""The standing reports: who leaves, why, and how customers behave before."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import as_double, band, percent, total_within
from ebbtide.names import (
    CALL_DAYS,
    CHURNER,
    CUSTOMER,
    LABEL,
    NON_CHURNER,
    NUMERIC_FEATURES,
    SCORE,
    TENURE_REPORT_BANDS,
    UNKNOWN,
)
from ebbtide.operators.anchors import (
    churned,
    churned_customers,
    first_placed,
    size_of_own_group,
)
from ebbtide.operators.lookback import (
    DISTANCE,
    calls_by_type,
    dated_calls,
    dated_usage,
    in_reach,
    look_back,
)
from ebbtide.operators.shares import (
    column_total,
    customer_total,
    customers_per,
    percent_with_any,
    rate_per,
    rounded_mean,
    share_of_total,
    with_medians,
)
from ebbtide.operators.snapshots import latest_snapshot, value_changes
from ebbtide.sources.writers import materialise

# means of these flags are fractions of customers and are named so
FLAG_MEANS = {
    "repeat_caller_flag_30d": "pct_repeat_caller_30d",
    "any_contract_dd_cancel": "pct_any_contract_dd_cancel",
    "any_dd_cancel_60d": "pct_any_dd_cancel_60d",
    "is_out_of_contract": "pct_out_of_contract",
    "is_near_ooc": "pct_near_ooc",
}


# --- who leaves, and why ---


def overall_churn_rate(
    cease: DataFrame, customer_info: DataFrame, definition: str = "completed"
) -> DataFrame:
    """Customers, churned customers and the churn rate in percent (one row)."""
    left = customer_total(cease.where(churned(definition)))
    return (
        customer_info.agg(F.countDistinct(CUSTOMER).alias("total_customers"))
        .withColumn("churned_customers", left)
        .withColumn("churn_rate_pct", percent("churned_customers", "total_customers"))
    )


def churn_share_by(
    cease: DataFrame, column: str, top: int | None = 20, definition: str = "completed"
) -> DataFrame:
    """Share of churned customers per value of a cease column, largest first.

    A customer counts under each of its values, so shares may add up to over 100.
    """
    left = cease.where(churned(definition))
    report = share_of_total(
        customers_per(left, column, "churned_customers"),
        "churned_customers",
        customer_total(left),
        "churn_percentage",
        [F.col("churn_percentage").desc(), F.col(column)],
    )
    return report if top is None else report.limit(top)


def churn_share_by_reason(cease: DataFrame, top: int | None = 20) -> DataFrame:
    return churn_share_by(cease, "reason_description", top)


def churn_share_by_reason_insight(cease: DataFrame, top: int | None = 20) -> DataFrame:
    return churn_share_by(cease, "reason_description_insight", top)


def cease_customer_profiles(cease: DataFrame, customer_info: DataFrame) -> DataFrame:
    """Every snapshot of a customer with every cease of that customer.

    The pairs are the result. Both sides reach the join straight from an exchange,
    the shape in which adaptive execution splits a skewed customer's partition.
    """
    return customer_info.join(cease, CUSTOMER, "inner")


def churn_share_by_sales_channel(cease: DataFrame, customer_info: DataFrame) -> DataFrame:
    """Churned customers per channel of their latest snapshot; NULL is a group."""
    left = churned_customers(cease)
    counts = (
        left.join(latest_snapshot(customer_info, ["sales_channel"]), CUSTOMER, "left")
        .groupBy("sales_channel")
        .agg(F.count(F.lit(1)).alias("churned_customers"))
    )
    return share_of_total(
        counts,
        "churned_customers",
        customer_total(left),
        "churn_share_pct",
        [F.col("churn_share_pct").desc(), F.col("sales_channel")],
    )


def churners_ever_on_package(cease: DataFrame, customer_info: DataFrame) -> DataFrame:
    """Churned customers per package they ever had; no or unknown package is "Unknown"."""
    left = churned_customers(cease)
    package = F.coalesce(F.col("crm_package_name"), F.lit(UNKNOWN)).alias("crm_package_name")
    ever = customer_info.select(CUSTOMER, package).distinct()
    counts = (
        left.join(ever, CUSTOMER, "left")
        .groupBy(package)
        .agg(F.count(F.lit(1)).alias("churned_customers_who_ever_had_pkg"))
    )
    return share_of_total(
        counts,
        "churned_customers_who_ever_had_pkg",
        customer_total(left),
        "pct_of_churners_who_ever_had_pkg",
        [F.col("pct_of_churners_who_ever_had_pkg").desc(), F.col("crm_package_name")],
    )


def package_transitions(
    cease: DataFrame, customer_info: DataFrame, direction: str = "as_reference"
) -> DataFrame:
    """Package changes of churned customers, counted per pair of packages.

    By default the history is read newest first, so from_package is the later one;
    ``direction='chronological'`` swaps the two.
    """
    steps = value_changes(customer_info, "crm_package_name", churned_customers(cease), direction)
    counts = steps.groupBy(
        F.col("from_value").alias("from_package"), F.col("to_value").alias("to_package")
    ).agg(
        F.count(F.lit(1)).alias("transition_events"),
        F.countDistinct(CUSTOMER).alias("unique_customers"),
    )
    return share_of_total(
        counts,
        "transition_events",
        column_total(counts, "transition_events"),
        "event_share_pct",
        [F.col("transition_events").desc(), F.col("from_package"), F.col("to_package")],
    )


def _latest_with_churn(
    cease: DataFrame, customer_info: DataFrame, columns: list[str], definition: str
) -> DataFrame:
    """Latest snapshot of every customer with is_churned 1 or 0."""
    left = churned_customers(cease, definition).withColumn(LABEL, F.lit(1))
    return (
        latest_snapshot(customer_info, columns).join(left, CUSTOMER, "left").fillna({LABEL: 0})
    )


def churn_rate_by_tenure_band(
    cease: DataFrame, customer_info: DataFrame, definition: str = "completed_raw_notnull"
) -> DataFrame:
    """Churn rate per tenure band, in text order; unknown tenure falls in the last band."""
    customers = _latest_with_churn(cease, customer_info, ["tenure_days"], definition)
    banded = customers.withColumn("tenure_bucket", band("tenure_days", TENURE_REPORT_BANDS))
    return rate_per(banded, "tenure_bucket", LABEL).orderBy("tenure_bucket")


def churn_rate_by_speed(
    cease: DataFrame, customer_info: DataFrame, definition: str = "completed_raw_notnull"
) -> DataFrame:
    customers = _latest_with_churn(cease, customer_info, ["speed"], definition)
    return rate_per(customers, "speed", LABEL).orderBy(F.col("churn_rate_pct").desc(), "speed")


def churn_rate_by_technology(
    cease: DataFrame, customer_info: DataFrame, definition: str = "completed_raw_notnull"
) -> DataFrame:
    customers = _latest_with_churn(cease, customer_info, ["technology"], definition)
    named = customers.fillna({"technology": UNKNOWN})
    return rate_per(named, "technology", LABEL).orderBy(
        F.col("churn_rate_pct").desc(), "technology"
    )


# --- how customers behave before the anchor date ---


def call_volume_by_group(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Mean, median and any-call share per window and churn group, non-callers as 0."""
    names = [f"calls_{d}d" for d in CALL_DAYS]
    per_customer = (
        look_back(
            anchors,
            dated_calls(in_reach(calls, "event_date", anchors, max(CALL_DAYS)), keys=()),
            max(CALL_DAYS),
        )
        .groupBy(CUSTOMER, "churn_group")
        .agg(*[total_within("calls", DISTANCE, d).alias(f"calls_{d}d") for d in CALL_DAYS])
    )
    per_customer = materialise(per_customer, "calls_per_customer")
    means = [f"avg_{name}" for name in names]
    shares = [f"pct_any_{name}" for name in names]
    report = per_customer.groupBy("churn_group").agg(
        F.count(F.lit(1)).alias("customers"),
        *[rounded_mean(name, 2).alias(mean) for name, mean in zip(names, means, strict=True)],
        *[percent_with_any(name).alias(share) for name, share in zip(names, shares, strict=True)],
    )
    return with_medians(report, per_customer, "churn_group", names).select(
        "churn_group", "customers", *means, *[f"median_{name}" for name in names], *shares
    )


def payment_friction_by_group(
    cease: DataFrame, customer_info: DataFrame, definition: str = "completed"
) -> DataFrame:
    """Direct-debit cancellations in the latest snapshot, churned customers or not."""
    measures = ("contract_dd_cancels", "dd_cancel_60_day")
    customers = _latest_with_churn(cease, customer_info, list(measures), definition)
    group = F.when(F.col(LABEL) == 1, CHURNER).otherwise(NON_CHURNER)
    numbers = customers.select(
        group.alias("churn_group"),
        *[F.coalesce(as_double(m), F.lit(0.0)).alias(m) for m in measures],
    )
    return numbers.groupBy("churn_group").agg(
        F.count(F.lit(1)).alias("customers"),
        *[rounded_mean(m, 3).alias(f"avg_{m}") for m in measures],
        percent_with_any("contract_dd_cancels").alias("pct_with_any_contract_dd_cancel"),
        percent_with_any("dd_cancel_60_day").alias("pct_with_any_dd_cancel_60d"),
    )


def usage_trend_before_cease(cease: DataFrame, usage: DataFrame, weeks: int = 8) -> DataFrame:
    """Churners' weekly download, week 0 being the one that ends on the cease date."""
    days = 7 * weeks - 1
    anchors = first_placed(cease)
    usage = in_reach(usage, "calendar_date", anchors, days)
    weekly = (
        look_back(anchors, dated_usage(usage), days, how="inner")
        .groupBy(CUSTOMER, F.floor(F.col(DISTANCE) / 7).alias("week_before"))
        .agg(F.sum("download_mbs").alias("weekly_download_mbs"))
    )
    weekly = materialise(weekly, "weeks")
    report = weekly.groupBy("week_before").agg(
        F.count(F.lit(1)).alias("customers"),
        rounded_mean("weekly_download_mbs", 2).alias("avg_weekly_download_mbs"),
    )
    return with_medians(report, weekly, "week_before", ["weekly_download_mbs"]).orderBy("week_before")


def call_type_penetration(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Share of each churn group that made a call of a type, per window."""
    typed = calls_by_type(anchors, calls, how="inner")
    callers = typed.groupBy("churn_group", "call_type").agg(
        *[F.count_if(F.col(f"calls_{d}d") > 0).alias(f"cust_any_{d}d") for d in CALL_DAYS]
    )
    return callers.withColumn("customers", size_of_own_group(anchors)).withColumns(
        {f"pct_cust_any_{d}d": percent(f"cust_any_{d}d", "customers") for d in CALL_DAYS}
    )


def call_type_intensity(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Calls of a type per member of each churn group, per window."""
    typed = calls_by_type(anchors, calls, how="inner")
    totals = typed.groupBy("churn_group", "call_type").agg(
        *[F.sum(f"calls_{d}d").alias(f"total_calls_{d}d") for d in CALL_DAYS]
    )
    return totals.withColumn("customers", size_of_own_group(anchors)).withColumns(
        {
            f"avg_calls_per_customer_{d}d": F.round(
                F.try_divide(f"total_calls_{d}d", "customers"), 3
            )
            for d in CALL_DAYS
        }
    )


def one_group(report: DataFrame, group: str, measure: str) -> DataFrame:
    """The rows of one churn group, largest measure first."""
    return report.where(F.col("churn_group") == group).orderBy(
        F.col(measure).desc(), "call_type"
    )


def talk_hold_by_group(calls: DataFrame, anchors: DataFrame) -> DataFrame:
    """Mean calls, talk and hold seconds over 90 days, non-callers as 0."""
    days = max(CALL_DAYS)
    per_customer = (
        look_back(anchors, dated_calls(in_reach(calls, "event_date", anchors, days), keys=()), days)
        .groupBy(CUSTOMER, "churn_group")
        .agg(
            total_within("calls", DISTANCE, days).alias("calls"),
            total_within("talk_seconds", DISTANCE, days).alias("talk"),
            total_within("hold_seconds", DISTANCE, days).alias("hold"),
        )
    )
    return per_customer.groupBy("churn_group").agg(
        F.count(F.lit(1)).alias("customers"),
        rounded_mean("calls", 2).alias("avg_calls_90d"),
        rounded_mean("talk", 2).alias("avg_total_talk_90d_secs"),
        rounded_mean("hold", 2).alias("avg_total_hold_90d_secs"),
    )


# --- the labelled feature frame ---


def feature_means_by_label(features: DataFrame) -> DataFrame:
    """Customers and the mean of all 32 numeric features per label."""
    means = [
        rounded_mean(c, 3).alias(FLAG_MEANS.get(c, f"avg_{c}")) for c in NUMERIC_FEATURES
    ]
    return features.groupBy(LABEL).agg(F.count(F.lit(1)).alias("customers"), *means)


def label_balance(features: DataFrame) -> DataFrame:
    return features.groupBy(LABEL).agg(F.count(F.lit(1)).alias("count"))


def high_risk_customers(
    scores: DataFrame, threshold: float = 0.7, n: int = 100
) -> DataFrame:
    """The n customers with the highest probability at or above the threshold, ranked.

    ``orderBy().limit(n)`` is a distributed top-n; only its n rows are then ranked.
    """
    order = [F.col(SCORE).desc(), F.col(CUSTOMER)]
    top = scores.where(F.col(SCORE) >= threshold).orderBy(*order).limit(n)
    return top.select(CUSTOMER, SCORE, F.row_number().over(Window.orderBy(*order)).alias("risk_rank"))
