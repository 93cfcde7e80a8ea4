from datetime import date

import pytest
from core_rows import (
    ANCHOR,
    CALLS,
    CEASE,
    INFO,
    USAGE,
    anchors_of,
    before,
    by_customer,
    info_row,
)
from pyspark.sql import functions as F

from ebbtide.operators.shares import assert_grain, grain_check
from ebbtide.operators.snapshots import value_changes
from ebbtide.plans import reports


def rows_of(df, *columns):
    return [tuple(r[c] for c in columns) for r in df.collect()]


@pytest.fixture(scope="module")
def cease(spark):
    rows = [
        ("a", ANCHOR, "2024-07-10", "price", "money"),
        ("a", ANCHOR, "2024-07-10", "moved", "life"),
        ("b", ANCHOR, "2024-07-10", "price", "money"),
        ("c", ANCHOR, "2024-07-10", None, None),
        ("d", ANCHOR, "null", "price", "money"),
        ("e", ANCHOR, None, "price", "money"),
    ]
    return spark.createDataFrame(rows, CEASE)


@pytest.fixture(scope="module")
def info(spark):
    rows = [
        info_row("a", tenure_days=89, speed=20.0, technology="X", sales_channel="web"),
        info_row("b", tenure_days=90, speed=20.0, technology=None, sales_channel="web"),
        info_row("d", tenure_days=None, speed=None, technology="X", sales_channel="shop"),
        info_row("e", tenure_days=1095, speed=40.0, technology="X", sales_channel="shop"),
        info_row("f", tenure_days=1094, speed=40.0, technology="Y", sales_channel=None),
    ]
    return spark.createDataFrame(rows, INFO)


def test_overall_rate(cease, info):
    got = reports.overall_churn_rate(cease, info).first()
    assert tuple(got) == (5, 3, 60.0)


def test_rate_over_no_customers_is_null(cease, info):
    got = reports.overall_churn_rate(cease, info.limit(0)).first()
    assert tuple(got) == (0, 3, None)


def test_reason_shares_may_exceed_a_hundred(cease):
    got = rows_of(
        reports.churn_share_by_reason(cease),
        "reason_description",
        "churned_customers",
        "churn_percentage",
    )
    assert got == [("price", 2, 66.67), (None, 1, 33.33), ("moved", 1, 33.33)]
    assert reports.churn_share_by_reason_insight(cease, top=1).count() == 1
    assert reports.churn_share_by_reason(cease, top=None).count() == 3


def test_profiles_pair_all_snapshots_with_all_ceases(cease, info):
    got = reports.cease_customer_profiles(cease, info)
    assert got.groupBy("unique_customer_identifier").count().collect()
    assert got.where("unique_customer_identifier = 'a'").count() == 2
    assert len(got.columns) == len(info.columns) + len(cease.columns) - 1


def test_channel_share_keeps_unknown_channels(cease, info):
    got = rows_of(
        reports.churn_share_by_sales_channel(cease, info),
        "sales_channel",
        "churned_customers",
        "churn_share_pct",
    )
    assert got == [("web", 2, 66.67), (None, 1, 33.33)]


def test_packages_ever_held(spark, cease):
    info = spark.createDataFrame(
        [
            info_row("a", before(9), crm_package_name="P"),
            info_row("a", before(8), crm_package_name="P"),
            info_row("a", before(7), crm_package_name="Q"),
            info_row("b", before(7), crm_package_name=None),
            info_row("b", before(6), crm_package_name="P"),
            info_row("z", before(6), crm_package_name="P"),
        ],
        INFO,
    )
    got = rows_of(
        reports.churners_ever_on_package(cease, info),
        "crm_package_name",
        "churned_customers_who_ever_had_pkg",
        "pct_of_churners_who_ever_had_pkg",
    )
    # b counts as Unknown for its missing package, c because it has no snapshot
    assert got == [("P", 2, 66.67), ("Unknown", 2, 66.67), ("Q", 1, 33.33)]


@pytest.fixture(scope="module")
def package_history(spark):
    names = ["A", "A", "B", None, "B", "A"]
    rows = [
        info_row("a", date(2024, 1, 1 + i), crm_package_name=p) for i, p in enumerate(names)
    ]
    rows += [info_row("z", date(2024, 1, 1 + i), crm_package_name=p) for i, p in enumerate("AB")]
    return spark.createDataFrame(rows, INFO)


def test_transitions_in_both_directions(cease, package_history):
    columns = ("from_package", "to_package", "transition_events", "unique_customers")
    forward = rows_of(
        reports.package_transitions(cease, package_history, "chronological"), *columns
    )
    backward = rows_of(reports.package_transitions(cease, package_history), *columns)
    # A A B null B A: the missing package between the two Bs is no step
    assert forward == [("A", "B", 1, 1), ("B", "A", 1, 1)]
    assert sorted((t, f, n, u) for f, t, n, u in backward) == forward
    shares = reports.package_transitions(cease, package_history).agg(F.sum("event_share_pct"))
    assert shares.first()[0] == 100.0


def test_steps_carry_both_dates(package_history):
    steps = value_changes(package_history, "crm_package_name", direction="chronological")
    got = [tuple(r)[1:] for r in steps.where("unique_customer_identifier = 'z'").collect()]
    assert got == [("A", "B", date(2024, 1, 1), date(2024, 1, 2))]


def test_repeated_snapshots_change_nothing(cease, package_history):
    twice = package_history.unionByName(package_history.withColumn("snapshot_id", F.lit(2)))
    once = reports.package_transitions(cease, package_history).collect()
    assert reports.package_transitions(cease, twice).collect() == once


def test_unknown_direction_is_an_error(package_history):
    with pytest.raises(ValueError, match="unknown direction"):
        value_changes(package_history, "crm_package_name", direction="sideways")


def test_tenure_bands_of_the_report(spark, cease):
    edges = {
        89: "0–3 months",
        90: "3–6 months",
        179: "3–6 months",
        180: "6–12 months",
        364: "6–12 months",
        365: "1–2 years",
        729: "1–2 years",
        730: "2–3 years",
        1094: "2–3 years",
        1095: "3+ years",
        None: "3+ years",
    }
    info = spark.createDataFrame([info_row(f"t{t}", tenure_days=t) for t in edges], INFO)
    got = rows_of(
        reports.churn_rate_by_tenure_band(cease, info), "tenure_bucket", "customers"
    )
    expected = sorted({b: list(edges.values()).count(b) for b in edges.values()}.items())
    assert got == expected  # text order: "3+ years" comes before "3–6 months"


def test_rates_count_open_ceases_by_default(cease, info):
    columns = ("customers", "churned_customers", "churn_rate_pct")
    speed = {r[0]: r[1:] for r in rows_of(reports.churn_rate_by_speed(cease, info), "speed", *columns)}
    assert speed == {20.0: (2, 2, 100.0), None: (1, 1, 100.0), 40.0: (2, 0, 0.0)}
    technology = rows_of(reports.churn_rate_by_technology(cease, info), "technology", *columns)
    assert technology == [
        ("Unknown", 1, 1, 100.0),
        ("X", 3, 2, 66.67),
        ("Y", 1, 0, 0.0),
    ]
    strict = rows_of(
        reports.churn_rate_by_technology(cease, info, "completed"), "technology", *columns
    )
    assert ("X", 3, 1, 33.33) in strict


@pytest.fixture(scope="module")
def groups(spark):
    left = anchors_of(spark, ["a", "b", "quiet"])
    return left.unionByName(anchors_of(spark, ["x", "y"], "Non-churner"))


@pytest.fixture(scope="module")
def calls(spark):
    rows = [
        ("a", before(0), "Loyalty", 100.0, 10.0),
        ("a", before(45), "Loyalty", 100.0, None),
        ("a", before(90), "Tech", 100.0, 10.0),
        ("a", before(91), "Tech", 100.0, 10.0),
        ("b", before(2), None, None, None),
        ("x", before(70), "Tech", 50.0, 5.0),
    ]
    return spark.createDataFrame(rows, CALLS)


def test_call_volume_counts_customers_without_calls(calls, groups):
    got = {r.churn_group: r for r in reports.call_volume_by_group(calls, groups).collect()}
    left, stayed = got["Churner"], got["Non-churner"]
    assert (left.customers, stayed.customers) == (3, 2)
    assert (left.avg_calls_30d, left.avg_calls_60d, left.avg_calls_90d) == (0.67, 1.0, 1.33)
    assert (left.median_calls_30d, left.median_calls_90d) == (1, 1)
    assert (left.pct_any_calls_30d, stayed.pct_any_calls_90d) == (66.67, 50.0)
    assert stayed.median_calls_90d == 0


def test_penetration_is_over_the_whole_group(calls, groups):
    got = {
        (r.churn_group, r.call_type): r
        for r in reports.call_type_penetration(calls, groups).collect()
    }
    assert set(got) == {
        ("Churner", "Loyalty"),
        ("Churner", "Tech"),
        ("Churner", None),
        ("Non-churner", "Tech"),
    }
    tech = got["Churner", "Tech"]
    assert (tech.cust_any_30d, tech.cust_any_90d, tech.customers) == (0, 1, 3)
    assert (tech.pct_cust_any_30d, tech.pct_cust_any_90d) == (0.0, 33.33)
    assert got["Non-churner", "Tech"].pct_cust_any_90d == 50.0
    report = reports.call_type_penetration(calls, groups)
    one = reports.one_group(report, "Churner", "pct_cust_any_30d")
    assert rows_of(one, "call_type") == [(None,), ("Loyalty",), ("Tech",)]


def test_intensity_is_per_member_of_the_group(calls, groups):
    got = {
        (r.churn_group, r.call_type): r
        for r in reports.call_type_intensity(calls, groups).collect()
    }
    loyalty = got["Churner", "Loyalty"]
    assert (loyalty.total_calls_30d, loyalty.total_calls_60d) == (1, 2)
    assert loyalty.avg_calls_per_customer_60d == 0.667


def test_talk_and_hold_per_group_are_seconds(calls, groups):
    got = {r.churn_group: r for r in reports.talk_hold_by_group(calls, groups).collect()}
    left = got["Churner"]
    assert (left.avg_calls_90d, left.avg_total_talk_90d_secs) == (1.33, 100.0)
    assert left.avg_total_hold_90d_secs == 6.67


def test_payment_friction_groups_by_completed_ceases(spark, cease):
    rows = [
        info_row("a", contract_dd_cancels=2, dd_cancel_60_day=1),
        info_row("b"),
        info_row("d", contract_dd_cancels=1),
    ]
    info = spark.createDataFrame(rows, INFO)
    got = {r.churn_group: tuple(r)[1:] for r in reports.payment_friction_by_group(cease, info).collect()}
    assert got == {"Churner": (2, 1.0, 0.5, 50.0, 50.0), "Non-churner": (1, 1.0, 0.0, 100.0, 0.0)}


def test_usage_weeks_before_the_cease(spark, cease):
    rows = [
        ("a", before(d), float(d + 1), 0.0) for d in (-1, 0, 6, 7, 55, 56)
    ] + [("b", before(3), 10.0, 0.0), ("d", before(54), None, 0.0)]
    usage = spark.createDataFrame(rows, USAGE)
    got = rows_of(
        reports.usage_trend_before_cease(cease, usage),
        "week_before",
        "customers",
        "avg_weekly_download_mbs",
        "median_weekly_download_mbs",
    )
    assert got == [(0, 2, 9.0, 8.0), (1, 1, 8.0, 8.0), (7, 2, 56.0, 56.0)]


def test_grain_check(spark):
    df = spark.createDataFrame([("a", 1), ("a", 2), ("b", 1)], "unique_customer_identifier string, v int")
    assert rows_of(grain_check(df), "unique_customer_identifier", "count") == [("a", 2), ("b", 1)]
    with pytest.raises(ValueError, match="not one row per"):
        assert_grain(df)
    assert_grain(df, ["unique_customer_identifier", "v"])


def test_high_risk_list(spark):
    rows = [("a", 0.7), ("b", 0.9), ("c", 0.9), ("d", 0.69), ("e", None)]
    scores = spark.createDataFrame(rows, "unique_customer_identifier string, churn_probability double")
    columns = ("unique_customer_identifier", "risk_rank")
    assert rows_of(reports.high_risk_customers(scores), *columns) == [("b", 1), ("c", 2), ("a", 3)]
    assert rows_of(reports.high_risk_customers(scores, n=1), *columns) == [("b", 1)]


def test_label_reports(spark):
    from ebbtide.names import NUMERIC_FEATURES

    values = ", ".join(f"{i} + is_churned as {c}" for i, c in enumerate(NUMERIC_FEATURES))
    frame = spark.createDataFrame([(1,), (0,), (0,)], "is_churned int").selectExpr(
        "is_churned", *values.split(", ")
    )
    means = {r.is_churned: r for r in reports.feature_means_by_label(frame).collect()}
    assert len(means[0].asDict()) == 34
    assert (means[0].customers, means[1].customers) == (2, 1)
    assert means[1].avg_calls_total_30d == 1.0
    assert means[0].avg_speed_gap_pct == 31.0
    percentages = {c for c in means[0].asDict() if c.startswith("pct_")}
    assert percentages == {
        "pct_repeat_caller_30d",
        "pct_any_contract_dd_cancel",
        "pct_any_dd_cancel_60d",
        "pct_out_of_contract",
        "pct_near_ooc",
    }
    balance = {r.is_churned: r["count"] for r in reports.label_balance(frame).collect()}
    assert balance == {0: 2, 1: 1}


def test_customers_are_not_lost_between_frames(spark, sf001):
    from ebbtide.operators.anchors import reference_dates
    from ebbtide.plans.features import training_features
    from ebbtide.sources.order_views import order_views

    t = order_views(spark, sf001)
    anchors = reference_dates(t.cease, t.customer_info)
    features = training_features(*t).persist()
    assert features.count() == anchors.count()
    assert_grain(features)
    assert set(by_customer(features)) == set(by_customer(anchors))
    assert features.where("calls_total_30d > calls_total_60d or calls_total_60d > calls_total_90d").isEmpty()
    typed = "calls_loyalty_90d + calls_tech_90d + calls_csb_90d + calls_finance_90d"
    assert features.where(f"{typed} > calls_total_90d").isEmpty()
    volume = reports.call_volume_by_group(t.calls, anchors).agg(F.sum("customers")).first()[0]
    assert volume == anchors.count()
    features.unpersist()


def test_medians_are_exact_beyond_the_sketch(spark):
    """40,000 values a group against a sketch of accuracy 50; ties, NULLs and a NULL group."""
    from ebbtide.operators.shares import with_medians

    i = F.col("id")
    df = spark.range(0, 80_000, 1, 16).select(
        F.when(i % 2 == 0, "a").alias("g"),
        F.when(i % 5 != 0, F.pmod(F.xxhash64(i), F.lit(1_000_003)) / 7).alias("x"),
        F.pmod(F.xxhash64(i, F.lit(1)), F.lit(4)).cast("int").alias("y"),
        F.lit(None).cast("double").alias("z"),
    )
    report = df.groupBy("g").agg(F.count(F.lit(1)).alias("n"))
    medians = with_medians(report, df, "g", ["x", "y", "z"], accuracy=50)
    assert dict(medians.dtypes)["median_y"] == "int"
    got = {r.g: r for r in medians.collect()}
    rows = df.collect()
    for g in ("a", None):
        for name in ("x", "y"):
            values = sorted(r[name] for r in rows if r.g == g and r[name] is not None)
            assert got[g][f"median_{name}"] == values[(len(values) - 1) // 2]
        assert got[g].median_z is None
    nothing = with_medians(report.limit(0), df.limit(0), "g", ["x"])
    assert nothing.collect() == []
