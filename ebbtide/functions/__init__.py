from ebbtide.functions.columns import (
    as_date,
    as_double,
    as_int,
    band,
    days_before,
    flag,
    percent,
    percent_change,
    ratio_or_zero,
    total_within,
)

__all__ = [
    "as_date",
    "as_double",
    "as_int",
    "band",
    "days_before",
    "flag",
    "percent",
    "percent_change",
    "ratio_or_zero",
    "total_within",
]
