"""What each filter of a chain removes, in every order of the filters.

Each document gets a mask of the filters it fails; documents are counted by mask, and all
orders and steps are sums of those counts. The duplicate filter's flags come from the
radix tries of ``text_tries``.
"""

from __future__ import annotations

import itertools
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import text_of
from ebbtide.llm.text_tries import first_rows

FILTERS = "ABCDE"
SPACES = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[#$%&*|]"


def text_filters() -> dict[str, Column]:
    """Failure conditions that a text alone decides, over ``text`` and its array ``words``."""
    words, text = F.size("words"), F.col("text")
    capitals = F.length(text) - F.length(F.regexp_replace(text, "[A-Z]+", ""))
    return {
        "A": words < 100,
        "B": 100 * F.size(F.array_distinct("words")) < 80 * words,
        "C": 100 * capitals > 10 * F.length(text),
        "D": text.rlike(SYMBOLS),
    }


def failure_masks(docs: DataFrame) -> DataFrame:
    """(doc_id, part, mask) of each row; bit k of the mask is set if filter k of FILTERS fails.

    A missing text is empty. E fails if a smaller doc_id has the identical text; a row
    without doc_id neither fails it nor makes others fail. ``part`` is the row's lang, a
    missing one the empty string.
    """
    flags = text_filters()
    rows = (
        docs.select(
            F.col("doc_id").cast("long").alias("doc_id"),
            F.coalesce("lang", F.lit("")).alias("part"),
            text_of().alias("text"),
        )
        .withColumn("words", F.array_remove(F.split("text", SPACES, -1), ""))
        .select(
            "doc_id",
            "part",
            F.xxhash64("text").alias("print"),
            sum(F.when(flags[f], 1 << FILTERS.index(f)).otherwise(0) for f in "ABCD").alias("mask"),
        )
    )
    first = first_rows(docs).withColumn("first", F.lit(True))
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    bit = F.when(copy, 1 << FILTERS.index("E")).otherwise(0)
    # rows without doc_id join nothing; a random key would deal them evenly, but they stay out
    known = rows.where(F.col("doc_id").isNotNull()).join(first, ["doc_id", "print"], "left")
    unknown = rows.where(F.col("doc_id").isNull()).withColumn("first", F.lit(True))
    return known.unionByName(unknown).select("doc_id", "part", (F.col("mask") + bit).alias("mask"))


def label_flags(labels: DataFrame) -> DataFrame:
    """One row per labelled doc_id: whether any of its rows says quality = 1, or toxic = 1."""
    return (
        labels.where(F.col("doc_id").isNotNull())
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(
            F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"),
            F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"),
        )
    )


def mask_counts(masks: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents, and those labelled so, by part and mask."""
    flags = label_flags(labels)
    known = masks.where(F.col("doc_id").isNotNull()).join(flags, "doc_id", "left")
    unknown = masks.where(F.col("doc_id").isNull()).withColumns(
        {"good": F.lit(False), "toxic": F.lit(False)}
    )
    return (
        known.unionByName(unknown)
        .groupBy("part", "mask")
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if("good").alias("good"),
            F.count_if("toxic").alias("toxic"),
        )
    )


def every_step(filters: str = FILTERS) -> list[tuple[str, int, int, int]]:
    """(order, step, bit of its filter, bits of the filters before it) for all orders."""
    out = []
    for order in itertools.permutations(filters):
        before = 0
        for step, letter in enumerate(order, 1):
            bit = 1 << filters.index(letter)
            out.append(("".join(order), step, bit, before))
            before |= bit
    return out


def steps_of_masks(counts: DataFrame, steps: Sequence[tuple[str, int, int, int]]) -> DataFrame:
    """The report of all orders and steps from the counts by mask.

    The counts have a row for each part and mask at most (32 masks), so what is exploded,
    and every window partition, is bounded by the number of parts.
    """
    listed = F.array(
        *[
            F.struct(F.lit(o).alias("o"), F.lit(s).alias("s"), F.lit(b).alias("b"), F.lit(p).alias("p"))
            for o, s, b, p in steps
        ]
    )
    rows = counts.select("*", F.explode(listed).alias("at"))
    mask, bit, before = F.col("mask"), F.col("at.b"), F.col("at.p")
    fails, gone = mask.bitwiseAND(bit) != 0, mask.bitwiseAND(before) != 0

    def total(which: Column, value: str = "n") -> Column:
        return F.sum(F.when(which, F.col(value)).otherwise(0)).cast("long")

    report = rows.groupBy("part", F.col("at.o").alias("filter_order"), F.col("at.s").alias("step"), bit.alias("bit")).agg(
        total(~fails & ~gone).alias("kept"),
        total(fails & ~gone).alias("removed"),
        total(fails & gone).alias("redundant"),
        total(mask == bit).alias("unique_fails"),
        total(fails & ~gone, "good").alias("good_lost"),
        total(fails & ~gone, "toxic").alias("toxic_lost"),
    )
    own = Window.partitionBy("part", "bit")
    return report.withColumn("shapley", F.sum("removed").over(own)).drop("bit")


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: kept, removed, redundant, and so on.

    Missing and empty texts have no words; labels missing, repeated or without doc_id count
    as in ``label_flags``. Ties and repeated rows are counted as often as they are there;
    an empty table gives an empty result; other columns are ignored.

    Texts cross the network once, reduced per map task; masks and labels meet by doc_id.
    """
    return steps_of_masks(mask_counts(failure_masks(docs), labels), every_step())
