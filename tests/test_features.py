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

from ebbtide.names import CALL_FEATURES, FEATURES, NUMERIC_FEATURES, TALK_FEATURES
from ebbtide.operators.snapshots import latest_snapshot
from ebbtide.plans.features import (
    call_features,
    contract_tenure_features,
    inference_features,
    payment_friction_features,
    product_tech_speed_features,
    talk_hold_features,
    training_features,
    usage_features,
)

TYPES = ["Loyalty", "Tech", "CS&B", "Customer Finance", "Other", None]


def calls_frame(spark, rows):
    return spark.createDataFrame(rows, CALLS)


def test_call_windows_are_closed_on_both_ends(spark):
    rows = [
        (f"d{d}", before(d), "Tech", 60.0, 6.0) for d in (-1, 0, 30, 31, 60, 61, 90, 91)
    ] + [("undated", None, "Tech", 60.0, 6.0)]
    customers = [r[0] for r in rows] + ["silent"]
    got = by_customer(call_features(calls_frame(spark, rows), anchors_of(spark, customers)))
    totals = {
        c: (r.calls_total_30d, r.calls_total_60d, r.calls_total_90d, r.days_since_last_call)
        for c, r in got.items()
    }
    none = (0, 0, 0, 91)
    assert totals == {
        "d-1": none,
        "d0": (1, 1, 1, 0),
        "d30": (1, 1, 1, 30),
        "d31": (0, 1, 1, 31),
        "d60": (0, 1, 1, 60),
        "d61": (0, 0, 1, 61),
        "d90": (0, 0, 1, 90),
        "d91": none,
        "undated": none,
        "silent": none,
    }
    assert got["silent"].call_type_diversity_90d == 0
    assert got["silent"].repeat_caller_flag_30d == 0


def test_call_types_and_variety(spark):
    rows = [("a", before(5), kind, 60.0, 6.0) for kind in TYPES]
    rows += [("a", before(70), kind, 60.0, 6.0) for kind in ("Loyalty", "Tech", "Tech")]
    rows += [("b", before(1), "Other", 60.0, 6.0)] * 2
    got = by_customer(call_features(calls_frame(spark, rows), anchors_of(spark, ["a", "b"])))
    a, b = got["a"], got["b"]
    assert (a.calls_total_30d, a.calls_total_90d) == (6, 9)
    assert (a.calls_loyalty_30d, a.calls_loyalty_90d) == (1, 2)
    assert (a.calls_tech_30d, a.calls_tech_90d) == (1, 3)
    assert (a.calls_csb_30d, a.calls_csb_90d) == (1, 1)
    assert (a.calls_finance_30d, a.calls_finance_90d) == (1, 1)
    assert a.call_type_diversity_90d == 5  # an unknown type is no type
    assert (a.repeat_caller_flag_30d, b.repeat_caller_flag_30d) == (1, 0)
    assert (b.calls_loyalty_90d, b.call_type_diversity_90d) == (0, 1)


def test_three_calls_in_thirty_days_make_a_repeat_caller(spark):
    rows = [("a", before(d), None, 1.0, 1.0) for d in (0, 15, 30)]
    rows += [("b", before(d), None, 1.0, 1.0) for d in (0, 15, 31)]
    got = by_customer(call_features(calls_frame(spark, rows), anchors_of(spark, ["a", "b"])))
    assert got["a"].repeat_caller_flag_30d == 1
    assert got["b"].repeat_caller_flag_30d == 0
    assert got["a"].call_type_diversity_90d == 0


def test_talk_and_hold_are_minutes(spark):
    rows = [
        ("a", before(10), "Tech", 120.0, 60.0),
        ("a", before(40), "Tech", 60.0, 30.0),
        ("no talk", before(3), "Tech", 0.0, 30.0),
        ("null talk", before(3), "Tech", None, 30.0),
        ("some null", before(3), "Tech", None, None),
        ("some null", before(3), "Tech", 300.0, 60.0),
    ]
    customers = ["a", "no talk", "null talk", "some null", "silent"]
    got = by_customer(talk_hold_features(calls_frame(spark, rows), anchors_of(spark, customers)))
    values = {c: tuple(r[f] for f in TALK_FEATURES) for c, r in got.items()}
    assert values == {
        "a": (2.0, 3.0, 1.0, 1.5, 1.5, 0.5),
        "no talk": (0.0, 0.0, 0.5, 0.5, 0.0, 0.0),
        "null talk": (0.0, 0.0, 0.5, 0.5, 0.0, 0.0),
        "some null": (5.0, 5.0, 1.0, 1.0, 2.5, 0.2),
        "silent": (0.0,) * 6,
    }


def test_usage_change_between_four_week_windows(spark):
    def use(customer, day, mbs):
        return (customer, before(day), mbs, 1.0)

    rows = [
        *[use("edges", d, 10.0) for d in (-1, 0, 27, 28, 55, 56, 60, 61)],
        use("falls", 3, 25.0),
        use("falls", 30, 100.0),
        use("new", 3, 25.0),
        use("zero", 3, 25.0),
        use("zero", 30, 0.0),
        use("null", 3, None),
        use("null", 30, 10.0),
        use("third", 1, 2.0),
        use("third", 29, 3.0),
        ("undated", None, 5.0, 5.0),
    ]
    customers = sorted({r[0] for r in rows}) + ["silent"]
    frame = usage_features(
        spark.createDataFrame(rows, USAGE), anchors_of(spark, customers), keep_totals=True
    )
    got = by_customer(frame)
    assert {c: r.usage_drop_pct_28d for c, r in got.items()} == {
        "edges": 0.0,
        "falls": -75.0,
        "new": None,
        "zero": None,
        "null": -100.0,
        "third": -33.33,
        "undated": None,
        "silent": None,
    }
    edges = got["edges"]
    assert (edges.download_total_30d, edges.download_total_60d) == (30.0, 60.0)
    assert edges.upload_total_60d == 6.0
    assert edges.days_since_last_usage == 0
    assert got["silent"].days_since_last_usage == 60
    assert got["silent"].download_total_60d == 0.0
    default = usage_features(spark.createDataFrame(rows, USAGE), anchors_of(spark, customers))
    assert default.columns == ["unique_customer_identifier", "usage_drop_pct_28d"]


def test_contract_and_tenure_bands(spark):
    tenures = {
        29: "0–1 month",
        30: "1–3 months",
        89: "1–3 months",
        90: "3–6 months",
        179: "3–6 months",
        180: "6–12 months",
        364: "6–12 months",
        365: "12–18 months",
        539: "12–18 months",
        540: "18–24 months",
        729: "18–24 months",
        730: "24+ months",
        None: "0–1 month",
    }
    contracts = {-61: (0, 0), -60: (0, 1), 0: (0, 1), 1: (1, 0), None: (0, 1)}
    rows = [info_row(f"t{t}", tenure_days=t) for t in tenures]
    rows += [info_row(f"o{o}", ooc_days=o, contract_status="In") for o in contracts]
    got = by_customer(contract_tenure_features(spark.createDataFrame(rows, INFO)))
    assert {t: got[f"t{t}"].tenure_bucket for t in tenures} == tenures
    flags = {o: (got[f"o{o}"].is_out_of_contract, got[f"o{o}"].is_near_ooc) for o in contracts}
    assert flags == contracts
    assert got["oNone"].ooc_days == 0
    assert (got["o1"].contract_status, got["t29"].contract_status) == ("In", "Unknown")


def test_payment_friction(spark):
    rows = [
        info_row("a", contract_dd_cancels=2, dd_cancel_60_day=0),
        info_row("b"),
        info_row("c", day=before(9), contract_dd_cancels=5),
        info_row("c", contract_dd_cancels=0, dd_cancel_60_day=1),
    ]
    got = by_customer(payment_friction_features(spark.createDataFrame(rows, INFO)))
    assert {c: tuple(r)[1:] for c, r in got.items()} == {
        "a": (2, 0, 1, 0),
        "b": (0, 0, 0, 0),
        "c": (0, 1, 0, 1),
    }


def test_speed_gap(spark):
    cases = {
        "slow": (50.0, 40.0, 10.0, 0.2),
        "fast": (50.0, 60.0, -10.0, -0.2),
        "zero": (0.0, 40.0, -40.0, None),
        "no speed": (None, 40.0, None, None),
        "no line": (50.0, None, None, None),
    }
    rows = [info_row(c, speed=v[0], line_speed=v[1]) for c, v in cases.items()]
    got = by_customer(product_tech_speed_features(spark.createDataFrame(rows, INFO)))
    assert {c: tuple(r)[3:] for c, r in got.items()} == cases
    assert got["slow"].sales_channel == got["slow"].technology == "Unknown"


def test_text_inputs_are_cast_and_dirt_becomes_null(spark):
    rows = [("a", "2024-06-30", "3.0", "x", "12", "55.5", "abc")]
    names = [
        "unique_customer_identifier",
        "datevalue",
        "contract_dd_cancels",
        "dd_cancel_60_day",
        "ooc_days",
        "speed",
        "line_speed",
    ]
    text = spark.createDataFrame(rows, names).selectExpr(
        "*", "'700' tenure_days", "'S' contract_status", "'C' sales_channel", "'T' technology"
    )
    payment = by_customer(payment_friction_features(text))["a"]
    assert (payment.contract_dd_cancels, payment.dd_cancel_60_day) == (3, 0)
    contract = by_customer(contract_tenure_features(text))["a"]
    assert (contract.ooc_days, contract.tenure_bucket) == (12, "18–24 months")
    product = by_customer(product_tech_speed_features(text))["a"]
    assert (product.speed, product.line_speed, product.speed_gap) == (55.5, None, None)


def test_latest_snapshot_breaks_ties(spark):
    rows = [
        info_row("a", snapshot=1, crm_package_name="old"),
        info_row("a", snapshot=9, crm_package_name="new"),
        info_row("a", day=before(1), snapshot=99, crm_package_name="earlier"),
    ]
    for order in (rows, rows[::-1]):
        info = spark.createDataFrame(order, INFO)
        latest = latest_snapshot(info, ["crm_package_name"]).collect()
        assert [r.crm_package_name for r in latest] == ["new"]
        other = latest_snapshot(info, ["crm_package_name"], tie_break=["crm_package_name"])
        assert [r.crm_package_name for r in other.collect()] == ["old"]
        unkeyed = latest_snapshot(info.drop("snapshot_id"), ["crm_package_name"])
        assert [r.crm_package_name for r in unkeyed.collect()] == ["old"]


@pytest.fixture(scope="module")
def small_tables(spark):
    cease = [
        ("left", ANCHOR, "2024-07-10", "r", "R"),
        ("open", ANCHOR, "null", "r", "R"),
        ("no snapshot", ANCHOR, "2024-07-11", "r", "R"),
        ("never placed", None, "2024-07-12", "r", "R"),
    ]
    info = [info_row(c, tenure_days=400) for c in ("left", "open", "stays")]
    calls = [("left", before(1), "Loyalty", 60.0, 60.0), ("stranger", before(1), "Tech", 1.0, 1.0)]
    usage = [("left", before(1), 5.0, 1.0), ("left", before(30), 10.0, 1.0)]
    return (
        spark.createDataFrame(cease, CEASE),
        spark.createDataFrame(info, INFO),
        spark.createDataFrame(calls, CALLS),
        spark.createDataFrame(usage, USAGE),
    )


def test_training_frame(small_tables):
    frame = training_features(*small_tables)
    assert frame.columns == ["unique_customer_identifier", *FEATURES, "is_churned"]
    assert (len(frame.columns), len(NUMERIC_FEATURES)) == (38, 32)
    got = by_customer(frame)
    # the anchor follows placed ceases, the label completed ones
    assert {c: r.is_churned for c, r in got.items()} == {
        "left": 1,
        "open": 0,
        "no snapshot": 1,
        "stays": 0,
    }
    assert got["left"].usage_drop_pct_28d == -50.0
    assert got["left"].calls_loyalty_30d == 1
    assert got["no snapshot"].contract_status is None
    assert got["no snapshot"].calls_total_90d == 0
    assert got["stays"].tenure_bucket == "12–18 months"


def test_scoring_frame_has_no_label(small_tables):
    _, info, calls, usage = small_tables
    frame = inference_features(info, calls, usage)
    assert frame.columns == ["unique_customer_identifier", *FEATURES]
    assert set(by_customer(frame)) == {"left", "open", "stays"}


def test_snapshot_features_ignore_the_anchor(spark, small_tables):
    cease, info, calls, usage = small_tables
    later = spark.createDataFrame(
        [info_row("left", day=date(2025, 1, 1), snapshot=2, tenure_days=800)], INFO
    )
    got = by_customer(training_features(cease, info.unionByName(later), calls, usage))
    assert got["left"].tenure_bucket == "24+ months"


def test_feature_names_are_generated_as_published():
    assert CALL_FEATURES[:5] == (
        "calls_total_30d",
        "calls_total_60d",
        "calls_total_90d",
        "calls_loyalty_30d",
        "calls_loyalty_90d",
    )
    assert TALK_FEATURES[:4] == (
        "talk_time_total_30d",
        "talk_time_total_90d",
        "hold_time_total_30d",
        "hold_time_total_90d",
    )
