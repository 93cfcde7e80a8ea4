from datetime import date

import pytest
from core_rows import CEASE, INFO, by_customer, info_row

from ebbtide.operators.anchors import (
    churn_target,
    churned,
    churned_customers,
    reference_dates,
    scoring_dates,
)

OPEN, DONE = "null", "2024-03-20"


@pytest.fixture(scope="module")
def cease(spark):
    rows = [
        ("two", date(2024, 3, 1), DONE, "a", "A"),
        ("two", date(2024, 2, 1), "2024-02-20", "b", "B"),
        ("open", date(2024, 4, 1), OPEN, "a", "A"),
        ("empty", date(2024, 4, 2), None, "a", "A"),
        ("unplaced", None, DONE, "a", "A"),
        ("gone", date(2024, 1, 5), DONE, None, None),
    ]
    return spark.createDataFrame(rows, CEASE)


@pytest.fixture(scope="module")
def info(spark):
    rows = [
        info_row(c, day)
        for c in ("two", "open", "empty", "unplaced", "stays")
        for day in (date(2024, 1, 1), date(2024, 5, 1))
    ]
    return spark.createDataFrame(rows, INFO)


def test_reference_dates(cease, info):
    got = by_customer(reference_dates(cease, info))
    assert {c: (r.ref_date, r.churn_group) for c, r in got.items()} == {
        "two": (date(2024, 2, 1), "Churner"),
        "open": (date(2024, 4, 1), "Churner"),
        "empty": (date(2024, 4, 2), "Churner"),
        "gone": (date(2024, 1, 5), "Churner"),  # has no snapshot at all
        "unplaced": (date(2024, 5, 1), "Non-churner"),
        "stays": (date(2024, 5, 1), "Non-churner"),
    }


def test_scoring_dates_know_no_ceases(info):
    got = by_customer(scoring_dates(info))
    assert set(got) == {"two", "open", "empty", "unplaced", "stays"}
    assert {r.ref_date for r in got.values()} == {date(2024, 5, 1)}


@pytest.mark.parametrize(
    "definition, customers",
    [
        ("completed", {"two", "unplaced", "gone"}),
        ("placed", {"two", "open", "empty", "gone"}),
        ("completed_raw_notnull", {"two", "open", "unplaced", "gone"}),
    ],
)
def test_three_definitions_of_churned(cease, definition, customers):
    assert set(by_customer(churned_customers(cease, definition))) == customers


def test_unknown_definition_is_an_error():
    with pytest.raises(ValueError, match="unknown churn definition"):
        churned("left")


def test_target_is_the_first_completion(cease):
    got = by_customer(churn_target(cease))
    assert set(got) == {"two", "unplaced", "gone"}
    assert got["two"].ref_date == date(2024, 2, 20)
    assert all(r.is_churned == 1 for r in got.values())


def test_completion_column_may_be_a_date(spark):
    rows = [("a", date(2024, 1, 1), date(2024, 1, 9)), ("b", date(2024, 1, 1), None)]
    typed = spark.createDataFrame(
        rows,
        "unique_customer_identifier string, cease_placed_date date, cease_completed_date date",
    )
    assert set(by_customer(churn_target(typed))) == {"a"}
