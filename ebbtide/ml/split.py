"""Repeatable stratified splits, folds, class weights and random rows by hashing.

A row's place depends on its customer identifier and the seed alone, never on its
partition or position, so recomputing a lost partition cannot move it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.names import CUSTOMER, LABEL, SEED, TEST_FRACTION


def hash_position(seed: int = SEED) -> Column:
    """A 32-bit number from the MD5 of identifier and seed.

    Rows without an identifier share one position, so they are kept, as one group.
    """
    known = F.coalesce(F.col(CUSTOMER).cast("string"), F.lit("\0no identifier"))
    digest = F.md5(F.concat(known, F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def class_quantiles(placed: DataFrame, fractions: Sequence[float]) -> DataFrame:
    """Per class, the exact quantiles of ``_position``: (_class, _cuts).

    Training and test part are read by different jobs, so the cuts must come out the
    same every time; a merged sketch may not. Positions have 32 bits. They are counted
    by their upper half first, which finds the half that holds each quantile, and only
    there by their full value. Every counted frame and every window partition has at
    most 65,536 rows per class, whatever the size of the data.
    """
    upper = F.shiftright("_position", 16).alias("_upper")
    halves = placed.groupBy(F.col(LABEL).alias("_class"), upper).agg(
        F.count(F.lit(1)).alias("_rows")
    )
    in_class = Window.partitionBy("_class")
    ranks = F.array(*[F.struct(F.lit(i).alias("i"), F.lit(f).alias("f")) for i, f in enumerate(fractions)])
    wanted = (
        halves.withColumn("_upto", F.sum("_rows").over(in_class.orderBy("_upper")))
        .withColumn("_total", F.sum("_rows").over(in_class))
        .select("*", F.explode(ranks).alias("_rank"))
        .withColumn("_target", F.greatest(F.lit(1), F.ceil(F.col("_rank.f") * F.col("_total"))))
        .where(
            (F.col("_target") <= F.col("_upto"))
            & (F.col("_target") > F.col("_upto") - F.col("_rows"))
        )
        .select(
            "_class",
            "_upper",
            F.col("_rank.i").alias("_i"),
            (F.col("_target") - F.col("_upto") + F.col("_rows")).alias("_within"),
        )
    )
    values = (
        placed.select(F.col(LABEL).alias("_class"), upper, "_position")
        .join(F.broadcast(wanted), ["_class", "_upper"])
        .groupBy("_class", "_i", "_within", "_position")
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    by_value = Window.partitionBy("_class", "_i").orderBy("_position")
    return (
        values.withColumn("_upto", F.sum("_rows").over(by_value))
        .where(F.col("_upto") >= F.col("_within"))
        .groupBy("_class", "_i")
        .agg(F.min("_position").alias("_cut"))
        .groupBy("_class")
        .agg(F.array_sort(F.collect_list("_cut")).alias("_cuts"))
    )


def _with_cuts(features: DataFrame, fractions: Sequence[float], seed: int) -> DataFrame:
    """Add each row's hash and its class's hash quantiles at ``fractions``.

    A row without a label would fall into no part, so it stops the job.

    The joined frame has one row per class (a 0/1 label), so broadcasting it is
    bounded whatever the size of the data.
    """
    unlabelled = F.raise_error(F.lit(f"a row without {LABEL} cannot be split by class"))
    position = F.when(F.col(LABEL).isNull(), unlabelled.cast("bigint")).otherwise(hash_position(seed))
    placed = features.withColumn("_position", position)
    cuts = class_quantiles(placed.select(LABEL, "_position"), fractions)
    same_class = F.col(LABEL) == F.col("_class")
    return placed.join(F.broadcast(cuts), same_class, "left").drop("_class")


def add_split(
    features: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED
) -> DataFrame:
    """Add ``is_test``: true for the given share of each class."""
    marked = _with_cuts(features, [test_fraction], seed)
    return marked.select(
        *features.columns, (F.col("_position") <= F.col("_cuts")[0]).alias("is_test")
    )


def train_test_split(
    features: DataFrame, test_fraction: float = TEST_FRACTION, seed: int = SEED
) -> tuple[DataFrame, DataFrame]:
    marked = add_split(features, test_fraction, seed)
    train = marked.where(~F.col("is_test")).drop("is_test")
    return train, marked.where("is_test").drop("is_test")


def add_folds(features: DataFrame, folds: int = 5, seed: int = SEED + 1) -> DataFrame:
    """Add ``fold``, 0 to folds - 1, holding an equal share of each class.

    The seed differs from the split's, so folds do not follow the split's order.
    """
    marked = _with_cuts(features, [i / folds for i in range(1, folds)], seed)
    fold = sum(
        (F.when(F.col("_position") > F.col("_cuts")[i], 1).otherwise(0) for i in range(folds - 1)),
        F.lit(0),
    )
    return marked.select(*features.columns, fold.cast("int").alias("fold"))


def class_counts(features: DataFrame) -> DataFrame:
    """One row: negatives, positives and the weight negatives / positives."""
    return features.agg(
        F.count_if(F.col(LABEL) == 0).alias("negatives"),
        F.count_if(F.col(LABEL) == 1).alias("positives"),
    ).withColumn("positive_weight", F.try_divide("negatives", "positives"))


def add_positive_weight(features: DataFrame) -> DataFrame:
    """Add ``weight``: negatives / positives for class 1, and 1 for class 0."""
    ratio = class_counts(features).select("positive_weight").scalar()
    return features.withColumn("weight", F.when(F.col(LABEL) == 1, ratio).otherwise(F.lit(1.0)))


def add_balanced_weight(features: DataFrame) -> DataFrame:
    """Add ``weight``: rows / (2 * rows of the class), which sums to the same per class."""
    total = F.col("negatives") + F.col("positives")
    counts = class_counts(features)
    of_positive = counts.select(F.try_divide(total, 2 * F.col("positives"))).scalar()
    of_negative = counts.select(F.try_divide(total, 2 * F.col("negatives"))).scalar()
    return features.withColumn(
        "weight", F.when(F.col(LABEL) == 1, of_positive).otherwise(of_negative)
    )


def random_rows(df: DataFrame, n: int = 10, seed: int = SEED) -> DataFrame:
    """n pseudo-random rows, the same ones on every run: those with the lowest hash."""
    return df.orderBy(hash_position(seed), CUSTOMER).limit(n)
