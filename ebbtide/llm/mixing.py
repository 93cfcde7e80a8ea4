"""Mixing sources to target weights by a curriculum that changes over the training run.

Each source has a schedule of weights over training time 0 to 1. Its integral up to time t
is the share of the source's target that training has asked for by then. The inverse of
that cumulative demand turns a document's place in its source into a training position,
and sorting by position gives the order of training.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import WORD, stored, text_of

WEIGHTS = (5.0, 2.0, 1.0)
MOST_REPEATS = 3.0
HASH_BITS = 60
BUCKET_BITS = 10

#: (time, weight) corners of each schedule, joined by straight lines; relative to the
#: source's own weight, so only the shape counts. Taken in turn, like the weights.
SCHEDULES: tuple[tuple[tuple[float, float], ...], ...] = (
    ((0.0, 1.5), (0.5, 1.0), (1.0, 0.5)),
    ((0.0, 1.0), (1.0, 1.0)),
    ((0.0, 0.4), (0.6, 1.0), (1.0, 2.0)),
)


def pieces(schedule: Sequence[tuple[float, float]]) -> list[tuple[float, float, float, float, float]]:
    """(time, weight, slope, demand so far, length) of each straight piece; whole demand is 1."""
    whole = sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:], strict=False))
    out, so_far = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:], strict=False):
        out.append((t0, w0 / whole, (w1 - w0) / (t1 - t0) / whole, so_far, t1 - t0))
        so_far += (t1 - t0) * (w0 + w1) / 2 / whole
    return out


def position(share: Column, schedule: Sequence[tuple[float, float]]) -> Column:
    """The time by which ``share`` (0 to 1) of a source's demand has been asked for."""
    result = None
    for t0, w0, slope, so_far, length in pieces(schedule):
        rest = F.greatest(share - F.lit(so_far), F.lit(0.0))
        if abs(slope) < 1e-12:
            time = rest / w0
        else:  # the root of slope / 2 * x**2 + w0 * x = rest that starts at 0
            inner = F.greatest(F.lit(w0 * w0) + rest * (2.0 * slope), F.lit(0.0))
            time = rest * 2.0 / (F.sqrt(inner) + w0)
        here = F.lit(t0) + F.least(time, F.lit(length))
        result = here if result is None else F.when(share >= so_far, here).otherwise(result)
    return result


def source_targets(
    sizes: DataFrame, weights: Sequence[float] = WEIGHTS, most_repeats: float = MOST_REPEATS
) -> DataFrame:
    """One row per source: _source, source_size, target, _turn (its place among the weights).

    Sources are in code-point order, a missing source last. Targets share the size of all
    sources by weight, none above ``most_repeats`` times its source's size; what is over
    is shared again. Ordered by cap / weight, the capped sources come first. The share per
    weight of what is left, after capping all before a source, rises along the capped ones
    and falls after them, so its maximum is the final share, found in one pass.
    """
    per_source = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    everything = Window.partitionBy(F.lit(0))
    by_name = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    turn = F.row_number().over(by_name) - 1
    per_source = per_source.withColumn("_turn", F.pmod(turn, F.lit(len(weights))))
    weight = F.element_at(F.lit([float(w) for w in weights]), F.col("_turn") + 1)
    cap = F.col("source_size") * float(most_repeats)
    per_source = per_source.withColumn("_weight", weight).withColumn("_cap", cap)
    by_ratio = Window.partitionBy(F.lit(0)).orderBy(
        F.col("_cap") / F.col("_weight"), F.col("source").asc_nulls_last()
    )
    earlier = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    later = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(
        F.sum("_cap").over(earlier), F.lit(0.0)
    )
    per_source = per_source.withColumn("_level", left / F.sum("_weight").over(later))
    level = F.max("_level").over(everything)
    return per_source.select(
        F.col("source").alias("_source"),
        F.col("source_size"),
        F.least(level * F.col("_weight"), F.col("_cap")).cast("double").alias("target"),
        "_turn",
    )


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    most_repeats: float = MOST_REPEATS,
    schedules: Sequence[Sequence[tuple[float, float]]] = SCHEDULES,
    label: str = "sizes",
    carry: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, size, source_size, target, passes, taken, positions.

    Documents of a source stand in the order of a hash, and training goes round them until
    the target is met: pass k takes a document if the middle of its place, k source sizes
    later, is below the target. So a source misses its target by half a document at most,
    and no document is taken more than ``most_repeats`` times (rounded up; at 3 exactly 3).
    ``passes`` is that number, ``taken`` = passes * size, and ``positions`` holds the
    training position (0 to 1) of each pass.

    Size is the number of words; a missing or empty text has size 0 and is never taken. A
    missing source is a source. Repeated rows count separately; rows equal in doc_id, text
    and source are alike, whichever comes first. An empty table gives an empty result.

    The table is read once, for sizes; hashes, not texts, are shuffled. A source with a
    third of all rows is spread over 1,024 ranges of the hash, linked by their sums.
    ``carry`` adds the whole input row as ``_row``; then the rows are shuffled with it.
    """
    identity = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("none")), text_of())
    measured = docs.select(
        "doc_id",
        "source",
        F.regexp_count(text_of(), F.lit(WORD)).cast("long").alias("size"),
        F.conv(F.substring(F.md5(identity), 1, 15), 16, 10).cast("long").alias("_hash"),
        F.struct(*docs.columns).alias("_row"),
    )
    bucket = F.shiftright("_hash", HASH_BITS - BUCKET_BITS).cast("int")
    # never missing, so that joins and windows on it share one partitioning
    key = F.coalesce(F.concat(F.lit("="), "source"), F.lit(""))
    measured = measured.withColumns({"_bucket": bucket, "_key": key})
    sizes = stored(measured.drop("_row"), label)
    up_to = Window.unboundedPreceding
    sums = sizes.groupBy("source", "_key", "_bucket").agg(F.sum("size").alias("_sum"))
    in_source = Window.partitionBy("_key").orderBy("_bucket").rowsBetween(up_to, Window.currentRow)
    starts = sums.select(
        F.col("source").alias("_s"),
        "_key",
        "_bucket",
        (F.sum("_sum").over(in_source) - F.col("_sum")).alias("_start"),
    )
    targets = source_targets(sizes, weights, most_repeats)
    starts = starts.join(targets, F.col("_s").eqNullSafe(F.col("_source"))).drop("_source", "_s")
    in_bucket = (
        Window.partitionBy("_key", "_bucket")
        .orderBy("_hash", "doc_id")
        .rowsBetween(up_to, Window.currentRow)
    )
    rows = measured if carry else sizes
    placed = rows.withColumn("_before", F.sum("size").over(in_bucket) - F.col("size"))
    placed = placed.join(starts, ["_key", "_bucket"])
    middle = F.col("_start") + F.col("_before") + F.col("size") / 2.0
    whole = F.greatest(F.col("source_size").cast("double"), F.lit(1.0))
    passes = F.when(F.col("size") == 0, F.lit(0)).otherwise(
        F.greatest(F.ceil((F.col("target") - middle) / whole), F.lit(0)).cast("int")
    )
    passes = F.least(passes, F.lit(int(-(-most_repeats // 1))))
    placed = placed.withColumn("_middle", middle).withColumn("passes", passes.cast("int"))

    def at(k: Column) -> Column:
        share = (F.col("_middle") + k * whole) / F.greatest(F.col("target"), F.lit(1e-9))
        time = F.lit(None).cast("double")
        for turn in range(len(weights)):
            time = F.when(
                F.col("_turn") == turn, position(share, schedules[turn % len(schedules)])
            ).otherwise(time)
        return time

    rounds = F.array(
        *[F.when(F.col("passes") > k, at(F.lit(float(k)))) for k in range(int(-(-most_repeats // 1)))]
    )
    return placed.select(
        "doc_id",
        "source",
        "size",
        "source_size",
        "target",
        "passes",
        (F.col("passes") * F.col("size")).cast("long").alias("taken"),
        F.array_compact(rounds).alias("positions"),
        "_hash",
        *(["_row"] if carry else []),
    )


def _in_order(mixed: DataFrame) -> DataFrame:
    """A row per pass, ``_pass`` from 0, range-sorted by position."""
    return (
        mixed.select("*", F.posexplode("positions").alias("_pass", "_position"))
        .repartitionByRange("_position", "_hash")
        .sortWithinPartitions("_position", "_hash")
    )


def in_training_order(docs: DataFrame, label: str = "sizes", **options) -> DataFrame:
    """The rows of ``mix`` with ``first_position``, range-sorted by it.

    Rows that the mix does not take have none and stand last.
    """
    mixed = mix(docs, label=label, **options).withColumn("first_position", F.get("positions", F.lit(0)))
    by_position = F.col("first_position").asc_nulls_last()
    spread = F.when(F.col("first_position").isNull(), F.col("_hash"))  # those rows are no hot key
    return mixed.repartitionByRange(by_position, spread).sortWithinPartitions(by_position, "_hash")


def training_positions(docs: DataFrame, label: str = "sizes", **options) -> DataFrame:
    """The passes in the order of training: doc_id, source, pass (from 1) and position (0 to 1).

    Rows as in ``training_order``, without the documents' other columns.
    """
    rows = _in_order(mix(docs, label=label, **options))
    return rows.select(
        "doc_id", "source", (F.col("_pass") + 1).alias("pass"), F.col("_position").alias("position")
    )


def training_order(docs: DataFrame, label: str = "sizes", **options) -> DataFrame:
    """The documents as training reads them: a row per pass, range-sorted by position.

    Returns the columns of ``docs``. Documents whose share of the mix is nothing are left
    out, repeated ones come once per pass.
    """
    mixed = mix(docs, label=label, carry=True, **options)
    return _in_order(mixed.select("_row", "positions", "_hash")).select("_row.*")
