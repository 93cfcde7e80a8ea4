"""Who churned, and the date each customer's look-back windows end on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.functions import as_date
from ebbtide.names import CHURNER, CUSTOMER, LABEL, NON_CHURNER, NULL_TEXT

CHURN_DEFINITIONS = ("completed", "placed", "completed_raw_notnull")


def churned(definition: str = "completed") -> Column:
    """Predicate on cease rows for one of the three definitions of "churned".

    * ``completed``: a completion date is present and is not the text ``null``
    * ``placed``: a cease was placed, whatever became of it
    * ``completed_raw_notnull``: the completion column is not NULL, which also
      keeps rows holding the text ``null`` (open ceases)
    """
    completed = F.col("cease_completed_date").cast("string")
    if definition == "completed":
        return completed.isNotNull() & (completed != NULL_TEXT)
    if definition == "placed":
        return F.col("cease_placed_date").isNotNull()
    if definition == "completed_raw_notnull":
        return completed.isNotNull()
    raise ValueError(f"unknown churn definition {definition!r}; use one of {CHURN_DEFINITIONS}")


def churned_customers(cease: DataFrame, definition: str = "completed") -> DataFrame:
    """One row per customer with a matching cease."""
    return cease.where(churned(definition)).select(CUSTOMER).distinct()


def first_placed(cease: DataFrame) -> DataFrame:
    """Churners only: customer and the date of the first placed cease."""
    return (
        cease.where(churned("placed"))
        .groupBy(CUSTOMER)
        .agg(F.min(as_date("cease_placed_date")).alias("ref_date"))
    )


def reference_dates(cease: DataFrame, customer_info: DataFrame) -> DataFrame:
    """One row per customer: ref_date and churn_group.

    Churners are anchored on their first placed cease, everybody else on the last
    snapshot. Both tables are stacked and reduced by one aggregation: a single
    shuffle with map-side combine, instead of two aggregations, an anti join and
    a union. A customer holding a third of all rows arrives as one row per map task.

    Rows without an identifier are kept, as one group of their own.
    """
    no_date = F.lit(None).cast("date")
    placed = cease.where(churned("placed")).select(
        CUSTOMER,
        as_date("cease_placed_date").alias("placed"),
        no_date.alias("seen"),
        F.lit(1).alias("is_churner"),
    )
    seen = customer_info.select(
        CUSTOMER,
        no_date.alias("placed"),
        as_date("datevalue").alias("seen"),
        F.lit(0).alias("is_churner"),
    )
    per_customer = (
        placed.unionByName(seen)
        .groupBy(CUSTOMER)
        .agg(
            F.min("placed").alias("placed"),
            F.max("seen").alias("seen"),
            F.max("is_churner").alias("is_churner"),
        )
    )
    churner = F.col("is_churner") == 1
    return per_customer.select(
        CUSTOMER,
        F.when(churner, F.col("placed")).otherwise(F.col("seen")).alias("ref_date"),
        F.when(churner, F.lit(CHURNER)).otherwise(F.lit(NON_CHURNER)).alias("churn_group"),
    )


def scoring_dates(customer_info: DataFrame) -> DataFrame:
    """Anchors for scoring: every customer's last snapshot date."""
    return (
        customer_info.groupBy(CUSTOMER)
        .agg(F.max(as_date("datevalue")).alias("ref_date"))
    )


def churn_target(cease: DataFrame) -> DataFrame:
    """Customers with a completed cease: first completion date and label 1."""
    return (
        cease.where(churned("completed"))
        .groupBy(CUSTOMER)
        .agg(F.min(as_date("cease_completed_date")).alias("ref_date"))
        .withColumn(LABEL, F.lit(1))
    )


def size_of_own_group(anchors: DataFrame) -> Column:
    """For a report with a churn_group column: the customers of that row's group.

    Both sizes come from one scalar subquery. It also reads ref_date, so that its plan
    needs the same columns as a look-back join and shares the anchors' exchange.
    """
    group = F.col("churn_group")
    sizes = anchors.agg(
        F.struct(
            F.count_if(group == CHURNER).alias("churners"),
            F.count_if(group == NON_CHURNER).alias("others"),
            F.max("ref_date").alias("last_date"),
        )
    ).scalar()
    return F.when(group == CHURNER, sizes["churners"]).otherwise(sizes["others"])
