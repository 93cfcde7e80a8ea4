"""N-gram Jaccard self-join by grouped prefixes, and the classes its links form.

Documents with equal shingle sets are one set. Sets with the same size and the same prefix
in a global order of shingles are one group. Groups that share a prefix shingle and have
fitting sizes are candidates; they are expanded to their sets, and pairs are verified on
the whole shingle sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import Temporary, eager_jobs, in_arrow, stored, text_of, unused
from ebbtide.llm.words import U64, chunks_of, mixed, shingle_hashes, word_hashes

#: A shingle in more sets' windows than this goes to the end of the global order.
COMMON = 48
#: From more sets than this, three comparisons with centres a set are fewer than all pairs.
CROWD = 7
BITS = ("b0", "b1", "b2", "b3")
SLOT_BITS = 24
#: So many open shingles before its own does an entry carry, to tell pairs met before.
BEFORE = 4


@dataclass(frozen=True)
class Similarity:
    """Jaccard similarity of at least ``top / bottom``, in whole numbers."""

    top: int = 90
    bottom: int = 100
    words: int = 3

    def prefix(self, n: int) -> int:
        """Sets that are similar share a shingle among so many first ones."""
        return n - -(-self.top * n // self.bottom) + 1

    def prefix_of(self, n: Column) -> Column:
        need = F.ceil((n * self.top).cast("double") / self.bottom)
        return (n - need + 1).cast("int")

    def sizes_fit(self, a: Column, b: Column) -> Column:
        return (F.least(a, b) * self.bottom) >= (F.greatest(a, b) * self.top)

    def bits_fit(self, n_a: Column, n_b: Column, bits_a: list, bits_b: list) -> Column:
        """No fewer shingles differ than bits of the two parity maps do."""
        differing = sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(bits_a, bits_b, strict=True))
        return differing * (self.top + self.bottom) <= (n_a + n_b) * (self.bottom - self.top)

    def maps_fit(self, n_a: Column, n_b: Column, a: Column, b: Column) -> Column:
        """The same for maps that grow with the sets; the longer one is folded to the shorter.

        Sets whose sizes fit differ by one doubling at most; others are not told apart.
        """

        def folded(x: Column) -> Column:
            half = (F.size(x) / 2).cast("int")
            return F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda p, q: p.bitwiseXOR(q))

        a, b = (
            F.when(F.size(x) == 2 * F.size(y), folded(x)).otherwise(x) for x, y in ((a, b), (b, a))
        )
        differing = F.aggregate(
            F.zip_with(a, b, lambda p, q: F.bit_count(p.bitwiseXOR(q))),
            F.lit(0),
            lambda total, x: total + F.coalesce(x, F.lit(0)),
        )
        return differing * (self.top + self.bottom) <= (n_a + n_b) * (self.bottom - self.top)

    def rest_fits(self, n_a: Column, n_b: Column, at_a: Column, at_b: Column) -> Column:
        """Enough shingles are left from the places of the first one that both sets hold."""
        return F.least(n_a - at_a, n_b - at_b) * (self.top + self.bottom) >= (n_a + n_b) * self.top

    def similar(self, n_a: Column, n_b: Column, shared: Column) -> Column:
        return shared * self.bottom >= (n_a + n_b - shared) * self.top


def _set_id(hashes: np.ndarray) -> int:
    """64-bit fingerprint of a set; two of a billion differing sets share one by 3 in 100."""
    total = mixed(hashes ^ U64(0xA0761D6478BD642F)).sum(dtype=U64, keepdims=True)
    return int(mixed(total + U64(len(hashes))).view(np.int64)[0])


def _parity(hashes: np.ndarray) -> list[int]:
    """256 bits: is the number of shingles that fall on a bit odd?"""
    counts = np.bincount((mixed(hashes) >> U64(56)).astype(np.int64), minlength=256) & 1
    return np.packbits(counts.astype(np.uint8)).view(">i8").tolist()


def _map(hashes: np.ndarray) -> np.ndarray:
    """A parity map that grows with the set: a bit for each two shingles, 256 at least."""
    bits = 256
    while bits * 2 < len(hashes):
        bits *= 2
    counts = np.bincount((mixed(hashes) & U64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(counts.astype(np.uint8)).view(">i8").astype(np.int64)


SKETCH = "doc_id long, text_hash long, n long, gid long, window array<long>, map array<long>, " + ", ".join(f"{b} long" for b in BITS)


def sketches(docs: DataFrame, how: Similarity) -> DataFrame:
    """Per row: set size and fingerprint, the first shingles by hash, and a parity map."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for texts in chunks_of(batch.column(2)):
                sets = shingle_hashes(*word_hashes(texts), how.words)
                windows = [s[: 2 * how.prefix(len(s)) + 8].view(np.int64) for s in sets]
                bits = list(zip(*map(_parity, sets), strict=True))
                columns = [
                    batch.column(0).slice(texts.first, len(texts)),
                    batch.column(1).slice(texts.first, len(texts)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_set_id(s) for s in sets], pa.int64()),
                    pa.array(windows, pa.list_(pa.int64())),
                    pa.array([_map(s) for s in sets], pa.list_(pa.int64())),
                    *[pa.array(b, pa.int64()) for b in bits],
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["doc_id", "text_hash", "n", "gid", "window", "map", *BITS])

    rows = docs.select(
        F.col("doc_id").cast("long"), F.xxhash64(text_of()).alias("text_hash"), text_of().alias("text")
    )
    return in_arrow(rows, run, SKETCH)


def _bitmap(keys: DataFrame) -> np.ndarray:
    """Which hash slots the keys fall on: at most 2**24 bits, the bound of what is broadcast."""
    slot = F.pmod("_slot", F.lit(1 << SLOT_BITS))
    words = (
        keys.select((slot / 32).cast("int").alias("word"), (slot % 32).cast("int").alias("bit"))
        .groupBy("word")
        .agg(F.bit_or(F.expr("shiftleft(1L, bit)")).alias("bits"))
        .toArrow()
    )
    out = np.zeros(1 << (SLOT_BITS - 5), np.int64)
    out[words["word"].to_numpy()] = words["bits"].to_numpy()
    return out


def whole_sets(docs: DataFrame, wanted: DataFrame, how: Similarity) -> DataFrame:
    """gid and the whole shingle set, in hash order, of the sets in ``wanted`` (gid, doc_id).

    The texts are read again, so that no table of all shingles has to be kept. Texts are
    not shuffled: a bitmap of fixed size lets the scan pass over most others, and the join
    on gid and doc_id removes the rest, whatever share that is. Rows repeated in both are
    one before anything is written, so that a join on gid meets each set once.
    """
    # a missing doc_id falls on a slot too, so that its texts are found again
    slot = F.xxhash64(F.col("doc_id").cast("long"))
    bitmap = docs.sparkSession.sparkContext.broadcast(_bitmap(wanted.select(slot.alias("_slot"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.column(0).to_numpy() & ((1 << SLOT_BITS) - 1)
            wanted_rows = pa.array((bitmap.value[at >> 5] >> (at & 31)) & 1 == 1)
            slots = batch.column(0).filter(wanted_rows)
            for texts in chunks_of(batch.column(1).filter(wanted_rows)):
                sets = shingle_hashes(*word_hashes(texts), how.words)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([_set_id(s) for s in sets], pa.int64()),
                        slots.slice(texts.first, len(texts)),
                        pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())),
                    ],
                    names=["gid", "_slot", "shingles"],
                )

    rows = docs.select(slot.alias("_slot"), text_of().alias("text"))
    found = in_arrow(rows, run, "gid long, _slot long, shingles array<long>")
    found = found.join(wanted.select("gid", slot.alias("_slot")), ["gid", "_slot"], "left_semi")
    return found.groupBy("gid").agg(F.any_value("shingles").alias("shingles"))


def with_prefixes(
    docs: DataFrame, sets: DataFrame, how: Similarity, common: int, own_tables: Temporary
) -> DataFrame:
    """``sets`` with ``prefix``: the first shingles in the global order.

    The order is: shingles that few sets hold by hash, then common ones by hash. A shingle
    is common if more than ``common`` sets have it in their window (their smallest hashes,
    twice a prefix and 8 more), counted over all sets. Any fixed order gives right results;
    this one keeps passages that many documents share out of the prefixes. A set whose
    window holds too few uncommon shingles is looked at as a whole.
    """
    spread = sets.select("gid", F.explode("window").alias("key"))
    heavy = spread.groupBy("key").count().where(F.col("count") > common).select("key")
    heavy = own_tables.stored(heavy, "common")
    own = spread.join(heavy, "key", "left_semi").groupBy("gid").agg(F.collect_list("key").alias("_own"))
    length = how.prefix_of(F.col("n"))
    parts = sets.drop("map").join(own, "gid", "left").withColumn("_own", F.coalesce("_own", F.array().cast("array<long>")))
    light = F.array_except("window", "_own")
    enough = (F.size(light) >= length) | (F.size("window") >= F.col("n"))
    ordered = F.concat(light, F.array_intersect("window", "_own"))
    parts = own_tables.stored(
        parts.withColumn("prefix", F.when(enough, F.slice(ordered, 1, length))).drop("_own", "window"),
        "prefixes",
    )
    short = parts.where(F.col("prefix").isNull())
    elements = whole_sets(docs, short.select("gid", "doc_id"), how).select(
        "gid", F.posexplode("shingles").alias("at", "key")
    )
    marked = elements.join(heavy.withColumn("late", F.lit(1)), "key", "left").withColumn(
        "late", F.coalesce("late", F.lit(0))
    )
    ranked = marked.groupBy("gid").agg(
        F.array_sort(F.collect_set(F.struct("late", "at", "key"))).alias("_all")
    )
    whole = short.drop("prefix").join(ranked, "gid").withColumn(
        "prefix", F.slice(F.transform("_all", lambda x: x["key"]), 1, length)
    )
    return parts.where(F.col("prefix").isNotNull()).unionByName(whole.drop("_all"))


def verified(
    docs: DataFrame, pairs: DataFrame, sets: DataFrame, how: Similarity, label: str, into: Temporary
) -> DataFrame:
    """The pairs (a, b) of set ids that are similar, found on the whole sets.

    Maps of a bit for each two shingles first rule out nearly all other pairs, so that few
    whole sets have to be brought together.
    """
    of_a = sets.select(F.col("gid").alias("a"), F.col("n").alias("_n"), F.col("map").alias("_map"))
    of_b = sets.select(F.col("gid").alias("b"), F.col("n").alias("_k"), F.col("map").alias("_pam"))
    close = how.maps_fit(F.col("_n"), F.col("_k"), F.col("_map"), F.col("_pam"))
    with Temporary(docs.sparkSession) as own:
        pairs = own.stored(pairs.join(of_a, "a").join(of_b, "b").where(close).select("a", "b"), f"{label}_pairs")
        ends = pairs.select(F.explode(F.array("a", "b")).alias("gid")).distinct()
        wanted = sets.select("gid", "doc_id").join(ends, "gid", "left_semi")
        elements = own.stored(whole_sets(docs, wanted, how), f"{label}_sets")
        left = elements.select(F.col("gid").alias("a"), F.col("shingles").alias("_x"))
        right = elements.select(F.col("gid").alias("b"), F.col("shingles").alias("_y"))
        n_a, n_b = F.size("_x").cast("long"), F.size("_y").cast("long")
        shared = F.size(F.array_intersect("_x", "_y")).cast("long")
        links = pairs.join(left, "a").join(right, "b").where(how.similar(n_a, n_b, shared))
        return into.stored(links.select("a", "b"), f"{label}_links")


def components(links: DataFrame, into: Temporary) -> DataFrame:
    """gid and comp (the smallest gid it is connected with) of all ends of ``links``.

    Labels spread to neighbours and jump to their label's label; a round is written, so
    that lineage stays short, and rounds end when nothing changes. A round's tables go
    once the next round is written.
    """
    spark = links.sparkSession
    with Temporary(spark) as own:
        both = own.stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "edges")
        labels = both.groupBy("a").agg(F.min("b").alias("_m")).select(
            F.col("a").alias("gid"), F.least("a", "_m").alias("comp")
        )
        last = Temporary(spark)
        labels = last.stored(labels, "labels")
        while True:
            with last, Temporary(spark) as turn:
                near = (
                    both.join(labels.select(F.col("gid").alias("b"), "comp"), "b")
                    .groupBy("a")
                    .agg(F.min("comp").alias("_near"))
                )
                closer = labels.join(near.withColumnRenamed("a", "gid"), "gid").select(
                    "gid", F.col("comp").alias("_old"), F.least("comp", "_near").alias("comp")
                )
                closer = turn.stored(closer, "closer")
                jump = closer.select(F.col("gid").alias("comp"), F.col("comp").alias("_next"))
                jumped = closer.join(jump, "comp", "left").select(
                    "gid", "_old", F.least("comp", F.coalesce("_next", "comp")).alias("comp")
                )
                following = Temporary(spark)
                labels = following.stored(jumped, "labels")
            last = following
            if labels.where("comp <> _old").isEmpty():
                with last:
                    return into.stored(labels.select("gid", "comp"), "components")
            labels = labels.drop("_old")


def _columns(prefix: str, names: tuple[str, ...]) -> list[Column]:
    return [F.col(n).alias(f"{prefix}{n}") for n in names]


def _labelled(grouped: DataFrame, links: DataFrame, label: str, into: Temporary) -> DataFrame:
    """The sets with ``comp``, the smallest set they are connected with so far."""
    with Temporary(links.sparkSession) as own:
        return into.stored(
            grouped.drop("prefix")
            .join(components(links, own), "gid", "left")
            .withColumn("comp", F.coalesce("comp", "gid")),
            label,
        )


def _spans(labelled: DataFrame) -> DataFrame:
    """Per group: its number of sets and the smallest and largest class they are in."""
    return labelled.groupBy("grp").agg(
        F.min("comp").alias("low"), F.max("comp").alias("high"), F.count(F.lit(1)).alias("members")
    )


def _key_spans(entries: DataFrame, span: DataFrame) -> DataFrame:
    return (
        entries.join(span, "grp")
        .groupBy("key")
        .agg(F.min("low").alias("_low"), F.max("high").alias("_high"), F.sum("members").alias("_sets"))
        .where("_low <> _high")
    )


def _open_entries(entries: DataFrame, span: DataFrame) -> DataFrame:
    """grp, key, at and before of the shingles whose groups are not all in one class yet.

    ``before`` holds the last open shingles that precede the entry's own in its group.
    """
    found = entries.select("grp", "key", "at").join(_key_spans(entries, span).select("key"), "key", "left_semi")
    last = Window.partitionBy("grp").orderBy("at").rowsBetween(-BEFORE, -1)
    return found.withColumn("before", F.collect_list("key").over(last))


def _rest_pairs(sides: DataFrame, how: Similarity, fit) -> DataFrame:
    """Pairs of groups of different classes that share an open shingle, with repetitions.

    Long sets that are alike share hundreds of shingles. Their pair is looked for at the
    first of them only, as far as an entry knows: one that both carry before their own is
    an earlier one. There, too few shingles may be left for the sets to be similar. Both
    conditions hold at the first shared shingle of every similar pair.
    """
    # a key's largest class is a single class already: its groups need not meet each other
    closed = F.col("low") == F.col("high")
    largest = (
        sides.where(closed)
        .groupBy("key", "low")
        .agg(F.count(F.lit(1)).alias("_many"))
        .groupBy("key")
        .agg(F.max(F.struct("_many", "low"))["low"].alias("_largest"))
    )
    sides = sides.join(largest, "key", "left").withColumn(
        "inner", closed & F.col("low").eqNullSafe(F.col("_largest"))
    )
    names = ("grp", "n", "members", "low", "high", "inner", "at", "before", *BITS)
    left = sides.where(~F.col("inner")).select("key", *_columns("x_", names))
    right = sides.select("key", *_columns("y_", names))
    open_pair = ~(
        (F.col("x_low") == F.col("x_high"))
        & (F.col("y_low") == F.col("y_high"))
        & (F.col("x_low") == F.col("y_low"))
    )
    # the bits of a group of one are those of its set
    alone = (F.col("x_members") == 1) & (F.col("y_members") == 1)
    return (
        left.join(right, "key")
        .where(
            (F.col("y_inner") | (F.col("x_grp") < F.col("y_grp")))
            & open_pair
            & how.sizes_fit(F.col("x_n"), F.col("y_n"))
            & how.rest_fits(F.col("x_n"), F.col("y_n"), F.col("x_at"), F.col("y_at"))
            & (~alone | fit("x_", "y_"))
            & ~F.arrays_overlap("x_before", "y_before")
        )
        .select(F.least("x_grp", "y_grp").alias("x_grp"), F.greatest("x_grp", "y_grp").alias("y_grp"))
    )


def _crowds(entries: DataFrame, span: DataFrame) -> DataFrame:
    """grp, key and held of open shingles of more than CROWD sets, and of such groups.

    A group stands for itself by its own number, since its sets need not share a shingle
    with another group. ``held`` is the number of the group's crowded shingles.
    """
    inside = span.where("low <> high").select("grp", F.col("grp").alias("key"))
    all_entries = entries.select("grp", "key").unionByName(inside)
    keys = _key_spans(all_entries, span).where(F.col("_sets") > CROWD).select("key")
    found = all_entries.join(keys, "key", "left_semi")
    return found.withColumn("held", F.count(F.lit(1)).over(Window.partitionBy("grp")))


def to_centres(crowd: DataFrame, how: Similarity, fit) -> DataFrame:
    """Pairs (a, b) of each set of a crowded shingle and the most typical ones of its size.

    Copies that were each changed in their own place are often similar to what they were
    copied from and not to each other. A change brings rare shingles, which stand first in
    the global order and push the crowd's own out of the prefix. So the set with most
    crowded shingles in its prefix is the centre, for each shingle and band of sizes; a
    set meets the centres of its band and of the two beside it. That costs three pairs an
    entry and joins such classes before any pairs of a crowd are compared. What is
    similar to no centre is compared later.
    """
    band = F.floor(F.log("n") / F.log(F.lit(how.bottom / how.top))).cast("int")
    rows = crowd.withColumn("band", band)
    carried = ("gid", "n", "comp", *BITS)
    centres = (
        rows.groupBy("key", "band")
        .agg(F.max(F.struct("held", F.negative("n"), *carried)).alias("_c"))
        .select("key", "band", *[F.col(f"_c.{x}").alias(f"c_{x}") for x in carried])
    )
    near = rows.withColumn("band", F.explode(F.array(*[F.col("band") + k for k in (-1, 0, 1)])))
    return (
        near.join(centres, ["key", "band"])
        .where((F.col("comp") != F.col("c_comp")) & fit("", "c_"))
        .select(F.least("gid", "c_gid").alias("a"), F.greatest("gid", "c_gid").alias("b"))
        .distinct()
    )


def join_sets(
    docs: DataFrame, sets: DataFrame, how: Similarity, common: int, own: Temporary
) -> DataFrame:
    """gid and comp for every set that is linked with another.

    First every set of a group is compared with the group's first set, and every group's
    first set with the first group of each of its prefix shingles: as many pairs as there
    are entries. Sets of shingles whose many sets are not one class then meet the most
    typical sets among them. Last come all remaining pairs of groups and of sets in a group,
    except pairs already connected, which could not change a class: shingles of one class
    are left out, and so are pairs inside a shingle's largest class. So copies that
    are similar to a centre cost about as many comparisons as there are copies. A crowd of
    sets that are similar to no centre is still compared in pairs, by size, place and bits,
    within a shingle, and a pair is made about once, not once a shared shingle. No link
    between classes is lost.
    """
    carried = ("gid", "n", *BITS)
    grouped = with_prefixes(docs, sets, how, common, own).withColumn(
        "grp", F.xxhash64("n", F.to_json(F.struct("prefix")))
    )
    grouped = own.stored(grouped, "grouped")
    first = grouped.groupBy("grp").agg(
        F.min(F.struct("gid", "n", *BITS, "prefix")).alias("_f"), F.count(F.lit(1)).alias("members")
    )
    groups = own.stored(first.select("grp", "members", "_f.*"), "groups")
    spread = groups.select("grp", "gid", F.posexplode("prefix").alias("at", "key"))
    shared = (
        spread.groupBy("key")
        .agg(F.min("gid").alias("c_gid"), F.count(F.lit(1)).alias("_many"))
        .where("_many > 1")
        .drop("_many")
    )
    # most shingles are in one group only and end here; sizes and bits join what is left
    entries = own.stored(spread.drop("gid").join(shared, "key"), "entries")
    facts = groups.select(*carried)

    def fit(x: str, y: str) -> Column:
        n_x, n_y = F.col(f"{x}n"), F.col(f"{y}n")
        bits = [[F.col(f"{s}{b}") for b in BITS] for s in (x, y)]
        return how.sizes_fit(n_x, n_y) & how.bits_fit(n_x, n_y, *bits)

    to_centre = (
        entries.select("grp", "c_gid")
        .distinct()
        .join(groups.select("grp", *carried), "grp")
        .where(F.col("gid") != F.col("c_gid"))
        .join(facts.select(*_columns("c_", carried)), "c_gid")
        .where(fit("", "c_"))
        .select(F.col("gid").alias("b"), F.col("c_gid").alias("a"))
    )
    heads = groups.where("members > 1").select("grp", *_columns("c_", carried))
    inside = (
        grouped.join(heads, "grp")
        .where((F.col("gid") != F.col("c_gid")) & fit("", "c_"))
        .select(F.col("gid").alias("b"), F.col("c_gid").alias("a"))
    )
    pairs = to_centre.unionByName(inside).distinct()
    links = verified(docs, pairs, sets, how, "first", own)
    labelled = _labelled(grouped, links, "labelled", own)
    span = _spans(labelled)
    crowd = _crowds(entries, span).join(labelled, "grp").select("key", "held", "comp", *carried)
    pairs = to_centres(own.stored(crowd, "crowd"), how, fit)
    links = links.unionByName(verified(docs, pairs, sets, how, "second", own))
    labelled = _labelled(grouped, links, "labelled_again", own)
    span = _spans(labelled)

    facts = groups.select("grp", "n", "members", *BITS).join(span.drop("members"), "grp")
    sides = own.stored(_open_entries(entries, span).join(facts, "grp"), "sides")
    group_pairs = _rest_pairs(sides, how, fit).distinct()
    itself = span.where("low <> high").select(F.col("grp").alias("x_grp"), F.col("grp").alias("y_grp"))
    members = labelled.select("grp", "comp", *carried)
    x = members.select(*_columns("x_", ("grp", "comp", *carried)))
    y = members.select(*_columns("y_", ("grp", "comp", *carried)))
    more = (
        group_pairs.unionByName(itself)
        .join(x, "x_grp")
        .join(y, "y_grp")
        .where((F.col("x_comp") != F.col("y_comp")) & fit("x_", "y_"))
        .select(
            F.least("x_gid", "y_gid").alias("a"), F.greatest("x_gid", "y_gid").alias("b")
        )
        .distinct()
    )
    found = verified(docs, more, sets, how, "rest", own)
    return components(links.unionByName(found), own)


def _classed(docs: DataFrame, how: Similarity, common: int) -> DataFrame:
    """Per row: doc_id, text_hash, n, gid, component_id and the class's first row.

    ``first_gid`` is the smallest set among those of the class with its smallest doc_id.
    """
    facts = ("doc_id", "text_hash", "n", "gid")
    with eager_jobs(docs.sparkSession), Temporary(docs.sparkSession) as own:
        with Temporary(docs.sparkSession) as wide:
            rows = wide.stored(sketches(docs, how), "sketches")
            one = [F.first(c).alias(c) for c in ("n", "window", "map", *BITS)]
            sets = rows.where("n > 0").groupBy("gid").agg(F.min("doc_id").alias("doc_id"), *one)
            sets = own.stored(sets, "sets")
            rows = own.stored(rows.select(*facts), "rows")
        filled = rows.where("n > 0")
        labels = join_sets(docs, sets, how, common, own)
        placed = sets.select("gid", "doc_id").join(labels, "gid", "left").select(
            "gid", F.coalesce("comp", "gid").alias("comp"), "doc_id"
        )
        first = F.min(F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "gid")))
        least = placed.groupBy("comp").agg(first.alias("_first"))
        of_set = placed.join(least, "comp").select(
            "gid", F.col("_first.doc_id").alias("component_id"), F.col("_first.gid").alias("first_gid")
        )
        linked = filled.select(*facts).join(of_set, "gid")
        alone = rows.where("n = 0").select(
            *facts, F.col("doc_id").alias("component_id"), F.col("gid").alias("first_gid")
        )
        columns = (*facts, "component_id", "first_gid")
        return stored(linked.select(*columns).unionByName(alone.select(*columns)), "classes")


def near_duplicates(
    docs: DataFrame, how: Similarity | None = None, common: int = COMMON
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_shingles, component_id, set_id.

    Two rows are linked if their shingle sets have at least the given Jaccard similarity;
    component_id is the smallest doc_id reachable by links. A missing or empty text, or
    one without words, has no shingles and is linked with nothing. Repeated rows have
    equal sets and so are linked; a missing doc_id takes part, and a class of only such
    rows has a missing component_id. An empty table gives an empty result; other columns
    are ignored. Shingles are compared as 64-bit hashes.
    """
    return _classed(docs, how or Similarity(), common).select(
        "doc_id",
        F.col("n").alias("n_shingles"),
        "component_id",
        F.when(F.col("n") > 0, F.col("gid")).alias("set_id"),
    )


def keep_first(docs: DataFrame, how: Similarity | None = None) -> DataFrame:
    """The rows of ``docs`` that are the first of their class, with all columns.

    First is the smallest doc_id, and of its sets the smallest; of rows equal in doc_id and
    in shingle set one stays, the first as JSON text. A doc_id with several texts is looked
    at text by text: each stays or goes with its own class. Rows without shingles and rows
    with a missing doc_id all stay.
    """
    found = _classed(docs, how or Similarity(80, 100, 5), COMMON)
    found = found.where((F.col("n") > 0) & F.col("doc_id").isNotNull())
    first = (F.col("doc_id") == F.col("component_id")) & (F.col("gid") == F.col("first_gid"))
    id_, hash_, gid_, rows_, first_ = (
        unused(docs, name) for name in ("_id", "_text_hash", "_gid", "_rows", "_first")
    )
    keys = {"doc_id": id_, "text_hash": hash_, "gid": gid_}
    texts = found.groupBy("doc_id", "text_hash", "gid").agg(
        F.max(first).alias(first_), F.count(F.lit(1)).alias(rows_)
    )
    texts = stored(texts.withColumnsRenamed(keys), "first_rows")
    gone = texts.where(~F.col(first_)).select(id_, hash_)
    again = texts.where(F.col(first_)).groupBy(id_, gid_).agg(
        F.sum(rows_).alias(rows_), F.collect_set(hash_).alias("_texts")
    )
    again = again.where(F.col(rows_) > 1).select(id_, gid_, F.explode("_texts").alias(hash_))
    marks = {id_: F.col("doc_id").cast("long"), hash_: F.xxhash64(text_of())}
    kept = docs.withColumns(marks).join(gone, [id_, hash_], "left_anti")
    plain = kept.join(again, [id_, hash_], "left_anti").select(*docs.columns)
    row = F.struct(*docs.columns)
    one = F.min_by(row, F.to_json(row)).alias(rows_)
    repeated = kept.join(again, [id_, hash_]).groupBy(id_, gid_).agg(one)
    return plain.unionByName(repeated.select(f"{rows_}.*"))
