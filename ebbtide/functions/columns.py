"""Column expressions. All are built-in JVM expressions, so they stay in codegen."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(column: str | Column) -> Column:
    return F.col(column) if isinstance(column, str) else column


def as_date(column: str | Column) -> Column:
    """DATE from a date, timestamp or ISO text; unreadable text gives NULL.

    ``try_cast`` keeps ANSI mode from failing the job on one dirty row, and is
    removed by Catalyst when the column already is a DATE.
    """
    return _col(column).try_cast("date")


def as_double(column: str | Column) -> Column:
    return _col(column).try_cast("double")


def as_int(column: str | Column) -> Column:
    """INT, truncating; goes through DOUBLE so that the text '3.0' gives 3."""
    return _col(column).try_cast("double").try_cast("int")


def flag(condition: Column) -> Column:
    """1 where the condition is true, 0 where it is false or unknown."""
    return F.when(condition, 1).otherwise(0)


def days_before(anchor: str | Column, day: str | Column) -> Column:
    """Whole days from ``day`` up to ``anchor``; negative after the anchor."""
    return F.datediff(_col(anchor), _col(day))


def total_within(value: str | Column, days: str | Column, last: int, first: int = 0) -> Column:
    """Sum of ``value`` over the rows whose day distance is in [first, last].

    Both ends count. Missing values add nothing, and a group without any row in
    the window has total 0, so no back-fill join is needed afterwards.
    """
    inside = _col(days).between(first, last)
    return F.coalesce(F.sum(F.when(inside, _col(value))), F.lit(0))


def ratio_or_zero(part: str | Column, whole: str | Column) -> Column:
    """part / whole where whole is positive, otherwise 0.0."""
    return F.coalesce(F.when(_col(whole) > 0, _col(part) / _col(whole)), F.lit(0.0))


def percent(part: str | Column, whole: str | Column, digits: int = 2) -> Column:
    """Share of ``part`` in ``whole`` as a rounded percentage; NULL when whole is 0."""
    return F.round(F.try_divide(_col(part), _col(whole)) * 100, digits)


def percent_change(now: str | Column, earlier: str | Column, digits: int = 2) -> Column:
    """Change from ``earlier`` to ``now`` in percent; NULL unless earlier is positive."""
    change = (_col(now) - _col(earlier)) / _col(earlier) * 100
    return F.when(_col(earlier) > 0, F.round(change, digits))


def band(value: str | Column, bands: Iterable[tuple[float | None, str]]) -> Column:
    """Label of the first band whose upper limit lies above ``value``.

    NULL passes no comparison and therefore gets the label without a limit.
    """
    value = _col(value)
    *limited, (_, last) = bands
    labels = F
    for limit, label in limited:
        labels = labels.when(value < limit, label)
    return labels.otherwise(last)
