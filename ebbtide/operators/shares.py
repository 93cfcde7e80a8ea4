"""Report building blocks: counts, shares and rates over a grouping column.

Totals enter as scalar subqueries, so a report is one plan: nothing is collected to
the driver and nothing is cross joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.functions import percent
from ebbtide.names import CUSTOMER


def customer_total(df: DataFrame) -> Column:
    """The number of different customers in ``df``, as a scalar subquery."""
    return df.agg(F.countDistinct(CUSTOMER)).scalar()


def share_of_total(
    counts: DataFrame, count: str, total: Column, share: str, order: Sequence[Column]
) -> DataFrame:
    """Add ``count`` as a percentage of ``total`` (a scalar), and order the report."""
    return counts.withColumn(share, percent(count, total)).orderBy(*order)


def column_total(counts: DataFrame, count: str) -> Column:
    """The sum of a report column, for use in the same report.

    The scalar sums every number of the report and picks one. Summing one alone would
    prune the other columns from the subquery's plan, and Spark could then not reuse
    the report's exchange but would compute everything below it again.
    """
    numbers = [name for name, kind in counts.dtypes if kind in ("bigint", "int", "double")]
    return counts.agg(F.struct(*[F.sum(n).alias(n) for n in numbers])).scalar()[count]


def customers_per(df: DataFrame, column: str, count: str) -> DataFrame:
    """Different customers per value of ``column``; NULL is a value of its own.

    Spark runs one distinct count as (value, customer) groups first, so a value or
    a customer with a third of all rows is spread before it is counted.
    """
    return df.groupBy(column).agg(F.countDistinct(CUSTOMER).alias(count))


def rate_per(df: DataFrame, column: str, flag_column: str) -> DataFrame:
    """Rows per value of ``column``, how many are flagged, and the percentage."""
    return (
        df.groupBy(column)
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.sum(flag_column).alias("churned_customers"),
        )
        .withColumn("churn_rate_pct", percent("churned_customers", "customers"))
    )


def rounded_mean(column: str | Column, digits: int) -> Column:
    return F.round(F.avg(column), digits)


def percent_with_any(column: str, digits: int = 2) -> Column:
    """Percentage of rows in which ``column`` is positive."""
    return F.round(F.avg(F.when(F.col(column) > 0, 1).otherwise(0)) * 100, digits)


def with_medians(
    report: DataFrame, df: DataFrame, group: str, columns: Sequence[str], accuracy: int = 10_000
) -> DataFrame:
    """Add ``median_<c>`` of each column of ``df`` to a report of one row per ``group``.

    The lower median of the values present (NULL where there are none), exact and the same
    on every run. A sketch only proposes a bracket of ranks around the middle, four of its
    own errors wide to either side; values in the bracket are counted exactly, the smaller
    ones as one number, and only the bracket's values are ordered. A bracket that missed the
    middle would stop the job. ``df`` is read twice: pass one that is already written.

    The broadcast frame has one row per group and column, so ``group`` must have few values.
    """
    numbers = F.array(*[F.col(c).cast("double") for c in columns])
    values = df.select(F.col(group).alias("_group"), F.posexplode(numbers).alias("_column", "_value"))
    values = values.where(F.col("_value").isNotNull())
    margin = 4 / accuracy
    ends = F.percentile_approx("_value", [0.5 - margin, 0.5 + margin], accuracy)
    brackets = values.groupBy("_group", "_column").agg(
        F.ceil(F.count(F.lit(1)) / 2).alias("_target"), ends.alias("_ends")
    )
    same = F.col("_group").eqNullSafe(F.col("_its_group")) & (F.col("_column") == F.col("_its_column"))
    near = brackets.withColumnsRenamed({"_group": "_its_group", "_column": "_its_column"})
    # the smaller values are one row, whose value is NULL
    inside = F.when(F.col("_value") >= F.col("_ends")[0], F.col("_value"))
    counted = (
        values.join(F.broadcast(near), same)
        .where(F.col("_value") <= F.col("_ends")[1])
        .groupBy("_group", "_column", "_target", inside.alias("_value"))
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    upto = Window.partitionBy("_group", "_column", "_target").orderBy(F.col("_value").asc_nulls_first())
    reached = counted.withColumn("_upto", F.sum("_rows").over(upto)).where("_upto >= _target")
    missed = F.raise_error(F.lit("the sketch's bracket missed the median")).cast("double")
    middle = F.struct(F.col("_upto"), F.coalesce("_value", missed).alias("value"))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    found = (
        reached.groupBy("_group", "_column")
        .agg(F.min_by(middle, "_upto").alias("_middle"))
        .groupBy("_group")
        .agg(
            *[
                F.max(F.when(F.col("_column") == i, F.col("_middle.value")))
                .cast(kinds[c])
                .alias(f"median_{c}")
                for i, c in enumerate(columns)
            ]
        )
    )
    joined = report.join(F.broadcast(found), F.col(group).eqNullSafe(F.col("_group")), "left")
    return joined.drop("_group")


def grain_check(df: DataFrame, keys: str | Sequence[str] = CUSTOMER) -> DataFrame:
    """Rows per key, most frequent first."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count"))
    return counts.orderBy(F.col("count").desc(), *keys)


def assert_grain(df: DataFrame, keys: str | Sequence[str] = CUSTOMER) -> None:
    """Raise if any key occurs more than once; brings one row to the driver."""
    worst = grain_check(df, keys).first()
    if worst is not None and worst["count"] > 1:
        raise ValueError(f"not one row per {keys}: {worst.asDict()}")
