"""Skew, plan shape and brute force: what has to hold at any size."""

import random
import re
from datetime import timedelta

import pytest
from core_rows import ANCHOR, CALLS, USAGE, anchors_of, before, by_customer, info_row, INFO, CEASE
from pyspark.sql import functions as F

from ebbtide import catalog
from ebbtide.names import CALL_FEATURES, TALK_FEATURES
from ebbtide.operators.lookback import daily_calls, daily_usage, dated_calls, look_back
from ebbtide.operators.snapshots import latest_snapshot, value_changes
from ebbtide.plans import reports
from ebbtide.plans.features import (
    call_and_talk_features,
    call_features,
    training_features,
    usage_features,
)
from ebbtide.sources.readers import Tables

ID = "unique_customer_identifier"


# --- brute force on random frames ---


def brute_calls(rows, customer):
    near = [
        ((ANCHOR - day).days, kind, talk, hold)
        for c, day, kind, talk, hold in rows
        if c == customer and day is not None and 0 <= (ANCHOR - day).days <= 90
    ]

    def count(days, kind=None):
        return sum(1 for d, k, _, _ in near if d <= days and (kind is None or k == kind))

    def minutes(days, place):
        return sum((r[place] or 0) / 60 for r in near if r[0] <= days)

    values = [count(d) for d in (30, 60, 90)]
    for kind in ("Loyalty", "Tech", "CS&B", "Customer Finance"):
        values += [count(d, kind) for d in (30, 90)]
    values += [
        min((r[0] for r in near), default=91),
        len({r[1] for r in near if r[1] is not None}),
        int(count(30) >= 3),
    ]
    talk, hold = minutes(90, 2), minutes(90, 3)
    values += [minutes(30, 2), talk, minutes(30, 3), hold]
    values += [talk / len(near) if near else 0.0, hold / talk if talk > 0 else 0.0]
    return values


@pytest.mark.parametrize("seed", [1, 2])
def test_call_features_against_brute_force(spark, seed):
    rng = random.Random(seed)
    kinds = ["Loyalty", "Tech", "CS&B", "Customer Finance", "Other", None]
    customers = [f"c{i}" for i in range(12)]
    rows = [
        (
            # one customer holds more than a third of all rows
            customers[0] if rng.random() < 0.4 else rng.choice(customers[:-1]),
            None if rng.random() < 0.05 else before(rng.randint(-5, 120)),
            rng.choice(kinds),
            None if rng.random() < 0.2 else float(rng.randint(0, 600)),
            None if rng.random() < 0.2 else float(rng.randint(0, 60)),
        )
        for _ in range(400)
    ]
    frame = call_and_talk_features(spark.createDataFrame(rows, CALLS), anchors_of(spark, customers))
    got = by_customer(frame)
    assert set(got) == set(customers)
    for c in customers:
        expected = brute_calls(rows, c)
        assert [got[c][n] for n in CALL_FEATURES + TALK_FEATURES] == pytest.approx(expected)


def test_usage_change_against_brute_force(spark):
    rng = random.Random(3)
    customers = [f"c{i}" for i in range(10)]
    rows = [
        (
            customers[0] if rng.random() < 0.4 else rng.choice(customers),
            before(rng.randint(-5, 80)),
            None if rng.random() < 0.1 else float(rng.randint(0, 50)),
            1.0,
        )
        for _ in range(300)
    ]
    usage, anchors = spark.createDataFrame(rows, USAGE), anchors_of(spark, customers)
    got = by_customer(usage_features(usage, anchors))
    for c in customers:
        def total(first, last):
            return sum(
                v or 0 for i, d, v, _ in rows if i == c and first <= (ANCHOR - d).days <= last
            )

        now, earlier = total(0, 27), total(28, 55)
        expected = round((now - earlier) / earlier * 100, 2) if earlier > 0 else None
        assert got[c].usage_drop_pct_28d == (None if expected is None else pytest.approx(expected))


def test_package_steps_against_brute_force(spark):
    rng = random.Random(4)
    rows, histories = [], {}
    for c in ("a", "b", "c"):
        for i in range(40):
            p = rng.choice(["P", "Q", "R", None])
            rows.append(info_row(c, ANCHOR + timedelta(days=i), snapshot=i, crm_package_name=p))
            histories.setdefault(c, []).append(p)
    rng.shuffle(rows)
    steps = value_changes(
        spark.createDataFrame(rows, INFO), "crm_package_name", direction="chronological"
    )
    got = sorted((r[ID], r.from_value, r.to_value, r.datevalue) for r in steps.collect())
    expected = sorted(
        (c, h[i - 1], h[i], ANCHOR + timedelta(days=i))
        for c, h in histories.items()
        for i in range(1, 40)
        if h[i - 1] and h[i] and h[i - 1] != h[i]
    )
    assert got == expected


def test_every_step_of_a_day_counts(spark):
    """A | B A B A, the last four on one day: four steps, whichever way they are read."""
    rows = [info_row("c", ANCHOR, snapshot=1, crm_package_name="A")]
    rows += [
        info_row("c", ANCHOR + timedelta(days=1), snapshot=2 + i, crm_package_name=p)
        for i, p in enumerate("BABA")
    ]
    info = spark.createDataFrame(rows, INFO)
    forward = value_changes(info, "crm_package_name", direction="chronological").collect()
    back = value_changes(info, "crm_package_name").collect()
    steps = sorted((r.from_value, r.to_value) for r in forward)
    assert steps == [("A", "B"), ("A", "B"), ("B", "A"), ("B", "A")]
    assert sorted((r.to_value, r.from_value) for r in back) == steps


# --- one customer with a third of all rows ---


@pytest.fixture(scope="module")
def hot_calls(spark):
    """30,000 calls, a third of them by one customer within 90 days."""
    i = F.col("id")
    hot = i % 3 == 0
    return spark.range(0, 30_000, 1, 8).select(
        F.when(hot, "hot").otherwise(F.concat(F.lit("c"), (i % 500).cast("string"))).alias(ID),
        F.date_sub(F.lit(ANCHOR), (i % 91).cast("int")).alias("event_date"),
        F.when(i % 2 == 0, "Tech").otherwise("Loyalty").alias("call_type"),
        F.lit(60.0).alias("talk_time_seconds"),
        F.lit(6.0).alias("hold_time_seconds"),
    )


def test_hot_customer_is_small_before_the_join(hot_calls):
    per_day = daily_calls(hot_calls, keys=()).where(F.col(ID) == "hot")
    assert per_day.count() == 91
    assert daily_calls(hot_calls).where(F.col(ID) == "hot").count() == 182
    assert per_day.agg(F.sum("calls")).first()[0] == 10_000


def test_hot_customer_is_split_by_cells_and_adaptively(spark, hot_calls):
    anchors = anchors_of(spark, ["hot", *(f"c{i}" for i in range(500))])
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "5KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "5KB",
    }
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        frame = call_features(hot_calls, anchors)
        got = by_customer(frame)
        plan = plan_of(frame)
    finally:
        for k in settings:
            spark.conf.unset(k)
    assert "ShuffledHashJoin(skew=true)" in plan
    assert got["hot"].calls_total_90d == 10_000
    assert len(got) == 501


def test_windows_touch_every_cell_at_any_anchor(spark):
    """Facts on each day of a year around anchors on each day of a month: bands decide, not cells."""
    days = [before(d) for d in range(-20, 160)]
    calls = spark.createDataFrame([("c", d, "Tech", 1.0, 1.0) for d in days], CALLS)
    for shift in range(0, 31, 3):
        anchors = anchors_of(spark, ["c"]).withColumn("ref_date", F.date_sub("ref_date", shift))
        found = look_back(anchors, dated_calls(calls), 90).where("fact_day is not null")
        assert sorted(r.days_before for r in found.collect()) == list(range(91))
        bare = look_back(anchors, dated_calls(calls), 90).where("fact_day is null").collect()
        assert len(bare) == 1 and bare[0].calls is None
    nowhere = anchors_of(spark, ["x"]).withColumn("ref_date", F.lit(None).cast("date"))
    assert look_back(nowhere, dated_calls(calls), 90).count() == 1
    assert look_back(nowhere, dated_calls(calls), 90, how="inner").count() == 0


def test_hot_customer_is_counted_whole(spark, hot_calls):
    anchors = anchors_of(spark, ["hot", "c1"])
    got = by_customer(call_features(hot_calls, anchors))["hot"]
    near = hot_calls.where(F.col(ID) == "hot")
    assert got.calls_total_90d == 10_000
    month = near.where(F.col("event_date") >= F.lit(before(30))).count()
    assert (got.calls_total_30d, got.calls_tech_90d) == (month, 5_000)


def test_hot_history_is_small_before_it_is_ordered(spark):
    i = F.col("id")
    info = spark.range(0, 9_000, 1, 8).select(
        F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), i.cast("string"))).alias(ID),
        F.date_sub(F.lit(ANCHOR), (i % 50).cast("int")).alias("datevalue"),
        i.alias("snapshot_id"),
        F.when(i % 50 < 25, "P").otherwise("Q").alias("crm_package_name"),
    )
    steps = value_changes(info, "crm_package_name").where(F.col(ID) == "hot").collect()
    assert [(r.from_value, r.to_value) for r in steps] == [("P", "Q")]
    plan = plan_of(value_changes(info, "crm_package_name"))
    # days are summed up before their shuffle, and only days are ordered by customer
    assert "partial_min_by" in plan and "partial_max_by" in plan
    latest = latest_snapshot(info, ["crm_package_name"]).where(F.col(ID) == "hot").collect()
    assert len(latest) == 1


def test_skewed_profile_join_is_split(spark, monkeypatch):
    """Adaptive execution splits the hot customer's partition and keeps all pairs."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
    }
    before_settings = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    try:
        i = F.col("id")
        info = spark.range(0, 60_000, 1, 16).select(
            F.when(i % 3 == 0, "hot").otherwise(F.concat(F.lit("c"), i.cast("string"))).alias(ID),
            F.lit(ANCHOR).alias("datevalue"),
            i.alias("snapshot_id"),
        )
        cease = spark.createDataFrame(
            [("hot", ANCHOR, "null", "r", "R"), ("c1", ANCHOR, "null", "r", "R")], CEASE
        )
        joined = reports.cease_customer_profiles(cease, info)
        assert len(joined.collect()) == 20_001
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "skew=true" in plan
    finally:
        for k, v in before_settings.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


# --- plans ---


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, sf001, tmp_path_factory):
    """The domain tables as parquet, so that plans show the engine and not the views."""
    from ebbtide.sources.order_views import order_views

    folder = tmp_path_factory.mktemp("stored")
    for name, df in order_views(spark, sf001)._asdict().items():
        df.write.parquet(str(folder / name))
    return Tables(**{n: spark.read.parquet(str(folder / n)) for n in Tables._fields})


@pytest.fixture()
def as_if_large(spark):
    """Plan as for tables too large to broadcast, without run-time re-planning."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.enabled": "false",
    }
    saved = {k: spark.conf.get(k) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in saved.items():
        spark.conf.set(k, v)


def exchanges(plan):
    return len(re.findall(r"Exchange hashpartitioning", plan)) - plan.count("ReusedExchange")


def test_training_frame_shuffles(stored, as_if_large):
    plan = plan_of(training_features(*stored))
    # each fact table crosses the network whole once, to (customer, cell)
    assert len(re.findall(r"Exchange hashpartitioning\(_customer", plan)) == 2
    assert plan.count("ShuffledHashJoin") == 2
    # small ones: anchors by customer and by cell (for calls and for usage), what lies in
    # the windows (calls by type and by customer, usage by customer), label; and the snapshots
    assert exchanges(plan) == 2 + 9
    assert plan.count("WindowGroupLimit") == 2


def test_scans_are_pruned_and_filtered(stored, as_if_large):
    plan = plan_of(call_features(stored.calls, anchors_for(stored)))
    scan = next(line for line in plan.splitlines() if "FileScan" in line and "call_type" in line)
    assert "talk_time_seconds" not in scan
    assert "IsNotNull(event_date)" in scan


def anchors_for(tables):
    from ebbtide.operators.anchors import reference_dates

    return reference_dates(tables.cease, tables.customer_info)


def test_anchors_take_one_shuffle(stored, as_if_large):
    plan = plan_of(anchors_for(stored))
    assert exchanges(plan) == 1
    assert "Join" not in plan
    assert daily_usage(stored.usage).columns == [ID, "fact_day", "download_mbs", "upload_mbs"]


def test_no_query_multiplies_rows_or_leaves_the_jvm(spark, sf001, as_if_large):
    fitted = catalog.fitted_queries()
    for name, query in catalog.all_queries().items():
        if name in fitted:
            continue
        plan = plan_of(query(spark, sf001))
        for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "PythonUDF"):
            assert bad not in plan, (name, bad)
