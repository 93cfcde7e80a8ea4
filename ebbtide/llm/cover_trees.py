"""Product codes of vectors by Lloyd rounds over partition-local cover trees.

Vectors become integers and are cut into equal parts; each part position has a codebook.
Blocks of rows, made where the rows lie, hold a cover tree per part position: a node
covers its points within a radius, its children cover them within half of it, and the
centres of a node's children are further apart than that. Cumulative sums give the sum and the count
of any subtree. In a round a subtree goes whole to the nearest entry of its centre if
the triangle inequality rules out every other entry for all its points; only ambiguous
nodes descend, down to exact comparisons of single points. All sums are of integers, so
results do not depend on blocks, partitions or order.
"""

from __future__ import annotations

import hashlib
import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import in_arrow, stored

PARTS = 8
ENTRIES = 16
ROUNDS = 6
SCALE = 4096
#: Bounds of a block: rows, and numbers in all its vectors.
BLOCK_ROWS = 4096
BLOCK_NUMBERS = 1 << 21
LEAF = 64
#: Integers of this size or more are refused, so that squares and sums stay exact.
LARGEST = 1 << 27
#: What rounding of distances could cost, relative to them; nearer decisions descend.
SLACK = 1e-9
PAIRS = 1 << 18  # centres or points times entries compared at a time


def squares(points: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Exact squared distances of integer points (n, w) to others (k, w)."""
    out = np.zeros((len(points), len(others)), np.int64)
    for j in range(points.shape[1]):
        step = points[:, j, None] - others[None, :, j]
        out += step * step
    return out


class CoverTree:
    """A cover tree over the distinct points of a block; equal points share a place."""

    def __init__(self, values: np.ndarray):
        points, owner, counts = np.unique(values, axis=0, return_inverse=True, return_counts=True)
        order = np.arange(len(points))
        low, high, centre = [0], [len(points)], [0]
        self.radius: list[float] | np.ndarray = []
        children = []
        node = 0
        while node < len(low):
            a, b = low[node], high[node]
            members = order[a:b]
            near = np.sqrt(squares(points[members], points[centre[node]][None]).ravel())
            radius = float(near.max())
            self.radius.append(radius)
            if b - a <= LEAF or radius == 0.0:
                children.append((0, 0))
            else:
                group, centres = self._net(points[members], near, radius / 2)
                centres = [centre[node], *members[centres]]
                by_group = np.argsort(group, kind="stable")
                order[a:b] = members[by_group]
                cuts = a + np.searchsorted(group[by_group], np.arange(len(centres) + 1))
                children.append((len(low), len(low) + len(centres)))
                low += cuts[:-1].tolist()
                high += cuts[1:].tolist()
                centre += [int(c) for c in centres]
            node += 1
        place = np.empty_like(order)
        place[order] = np.arange(len(order))
        self.points, self.place = points[order], place[owner.ravel()].astype(np.int32)
        self.counts = counts[order]
        self.low, self.high = np.array(low), np.array(high)
        self.centre = place[np.array(centre)]
        self.radius = np.array(self.radius)
        self.children = np.array(children)

    @staticmethod
    def _net(points: np.ndarray, near: np.ndarray, limit: float) -> tuple[np.ndarray, list[int]]:
        """Centres further apart than ``limit`` that cover all points within it, and each one's group.

        Group 0 is that of the node's own centre, to which ``near`` are the distances.
        """
        near, group, centres = near.copy(), np.zeros(len(points), np.int64), []
        while near[far := int(near.argmax())] > limit:
            centres.append(far)
            to = np.sqrt(squares(points, points[far][None]).ravel())
            closer = to < near
            group[closer], near[closer] = len(centres), to[closer]
        return group, centres

    def assign(self, entries: np.ndarray) -> tuple[np.ndarray, int]:
        """The nearest entry of each place (ties: the first), and how many comparisons it took."""
        out = np.empty(len(self.points), np.int64)
        frontier, compared = np.zeros(1, np.int64), 0
        while len(frontier):
            following = []
            for at in range(0, len(frontier), max(1, PAIRS // len(entries))):
                nodes = frontier[at : at + max(1, PAIRS // len(entries))]
                square = squares(self.points[self.centre[nodes]], entries)
                compared += square.size
                best = square.argmin(axis=1)
                radius = self.radius[nodes]
                decided = radius == 0.0
                if len(entries) == 1:
                    decided[:] = True
                else:
                    nearest = np.sqrt(np.partition(square, 1, axis=1)[:, :2].astype(float))
                    margin = SLACK * (nearest[:, 1] + radius)
                    decided |= nearest[:, 1] - nearest[:, 0] > 2 * radius + margin
                for node, entry in zip(nodes[decided], best[decided], strict=True):
                    out[self.low[node] : self.high[node]] = entry
                open_nodes = nodes[~decided]
                inner = self.children[open_nodes, 1] > 0
                following += [np.arange(a, b) for a, b in self.children[open_nodes[inner]]]
                for node in open_nodes[~inner]:
                    single = squares(self.points[self.low[node] : self.high[node]], entries)
                    compared += single.size
                    out[self.low[node] : self.high[node]] = single.argmin(axis=1)
            frontier = np.concatenate(following) if following else np.zeros(0, np.int64)
        return out, compared

    def sums(self, entry_of: np.ndarray, entries: int) -> tuple[np.ndarray, np.ndarray]:
        """Per entry the count and the sum of its points, by cumulative sums over runs of places."""
        runs = np.flatnonzero(np.diff(entry_of, prepend=-1))
        ends = np.append(runs[1:], len(entry_of))
        weighted = np.zeros((len(self.points) + 1, self.points.shape[1]), np.int64)
        np.cumsum(self.points * self.counts[:, None], axis=0, out=weighted[1:])
        counted = np.append(0, np.cumsum(self.counts))
        count, total = np.zeros(entries, np.int64), np.zeros((entries, self.points.shape[1]), np.int64)
        np.add.at(count, entry_of[runs], counted[ends] - counted[runs])
        np.add.at(total, entry_of[runs], weighted[ends] - weighted[runs])
        return count, total


def usable(column: str = "embedding") -> Column:
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & (F.size(column) > 0) & ~bad


def integers(vectors: list[list[float]], width: int) -> np.ndarray:
    """floor(SCALE * x), as an array (rows, width)."""
    scaled = np.floor(np.array(vectors, np.float64).reshape(-1, width) * SCALE)
    if np.abs(scaled).max(initial=0) >= LARGEST:
        raise ValueError(f"a component times {SCALE} is {LARGEST} or more; sums of squares would not stay exact")
    return scaled.astype(np.int64)


def _block_maker(width: int, parts: int):
    """Rows (vec_id, label, embedding) to blocks: identifiers, labels, and pickled trees, one a part."""
    most = max(1, min(BLOCK_ROWS, BLOCK_NUMBERS // width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            while batch.num_rows:
                room = most - sum(b.num_rows for b in held)
                held.append(batch.slice(0, room))
                batch = batch.slice(room)
                if sum(b.num_rows for b in held) == most:
                    yield block(held)
                    held = []
        if held:
            yield block(held)

    def block(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held).combine_chunks()
        flat = np.concatenate([c.flatten().to_numpy(zero_copy_only=False) for c in rows["embedding"].chunks])
        values = integers(flat, width)
        trees = [pickle.dumps(CoverTree(v), protocol=5) for v in np.split(values, parts, axis=1)]

        def listed(name: str) -> pa.Array:
            column = rows[name].combine_chunks()
            return pa.ListArray.from_arrays([0, len(column)], column)

        return pa.RecordBatch.from_arrays(
            [listed("vec_id"), listed("label"), pa.array([trees], pa.list_(pa.binary()))],
            names=["vec_ids", "labels", "trees"],
        )

    return run


def _round(books, parts: int, entries: int):
    """Counts and sums of each part's entries over all blocks of a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, sums = [None] * parts, [None] * parts
        for batch in batches:
            for trees in batch.column(0).to_pylist():
                for p, tree in enumerate(map(pickle.loads, trees)):
                    count, total = tree.sums(tree.assign(books.value[p])[0], entries)
                    counts[p] = count if counts[p] is None else counts[p] + count
                    sums[p] = total if sums[p] is None else sums[p] + total
        if counts[0] is not None:
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(np.repeat(np.arange(parts), entries).astype(np.int32)),
                    pa.array(np.tile(np.arange(entries), parts).astype(np.int32)),
                    pa.array(np.concatenate(counts)),
                    pa.array([row.tolist() for total in sums for row in total], pa.list_(pa.int64())),
                ],
                names=["part", "entry", "n", "sums"],
            )

    return run


def _coder(books):
    """vec_id, label, code and error of every row of a block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                one = batch.slice(k, 1)
                digits, error = [], 0
                for p, tree in enumerate(map(pickle.loads, one.column(2).to_pylist()[0])):
                    entry_of, _ = tree.assign(books.value[p])
                    off = tree.points - books.value[p][entry_of]
                    digits.append(entry_of[tree.place])
                    error = error + (off * off).sum(axis=1)[tree.place]
                codes = np.stack(digits, axis=1).astype(np.uint8)
                yield pa.RecordBatch.from_arrays(
                    [
                        one.column(0).flatten(),
                        one.column(1).flatten(),
                        pa.array([row.tobytes().hex() for row in codes], pa.string()),
                        pa.array(error),
                    ],
                    names=["vec_id", "label", "code", "error"],
                )

    return run


def learnt_codebooks(blocks: DataFrame, books: list[np.ndarray], rounds: int) -> list[np.ndarray]:
    """The codebooks after ``rounds``; an entry without points stays, others become floored means.

    Each round is one job that moves a row per task, part and entry; what comes back is one
    number per component of the codebooks.
    """
    spark = blocks.sparkSession
    parts, entries = len(books), len(books[0])
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(books)
        found = in_arrow(
            blocks.select("trees"), _round(shared, parts, entries), "part int, entry int, n long, sums array<long>"
        )
        totals = (
            found.select("part", "entry", "n", F.posexplode("sums").alias("at", "value"))
            .groupBy("part", "entry", "at")
            .agg(F.sum("n").alias("n"), F.sum("value").alias("value"))
        )
        books = [book.copy() for book in books]
        for r in totals.where("n > 0").collect():
            books[r["part"]][r["entry"], r["at"]] = r["value"] // r["n"]
        shared.unpersist()
    return books


def books_digest(books: list[np.ndarray]) -> str:
    numbers = ",".join(str(x) for book in books for row in book.tolist() for x in row)
    return hashlib.sha256(numbers.encode()).hexdigest()


def compress(
    vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS
) -> DataFrame:
    """One row per usable vector: vec_id, code, error, label_error, codebooks_sha256.

    ``vectors`` has vec_id, embedding and label. Vectors that are missing, empty or hold
    missing or non-finite components take no part. All others must have one length that
    ``parts`` divides: the most frequent such length counts (of equally frequent ones the
    largest), and vectors of other lengths take no part. A row without vec_id is kept, but
    starts a codebook entry only after all rows that have one; rows of one vec_id start
    entries in the order of their vectors. With fewer rows than ``entries`` the codebooks
    have as many entries as there are rows. Repeated rows count as often as they are
    there. A component of 32,768 or more in size stops the job, because sums of squares
    would leave 64 bits. An empty table gives an empty result; other columns are ignored.

    Rows stay where they are read: blocks of at most BLOCK_ROWS rows are built there and
    written once. Codebooks have a number per vector component and entry, whatever the
    size of the data. Errors are summed per label with map-side combine.
    """
    spark = vectors.sparkSession
    label_type = vectors.schema["label"].dataType.simpleString()
    rows = vectors.where(usable()).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        "label",
        F.col("embedding").cast("array<double>").alias("embedding"),
    )
    lengths = rows.groupBy(F.size("embedding").alias("length")).count()
    lengths = lengths.where(F.col("length") % parts == 0).orderBy(F.desc("count"), F.desc("length"))
    width = (lengths.first() or {"length": parts})["length"]
    rows = rows.where(F.size("embedding") == width)
    start = rows.orderBy(F.asc_nulls_last("vec_id"), "embedding").limit(entries).collect()
    schema = f"vec_id long, code string, error long, label {label_type}"
    if not start:
        return spark.createDataFrame([], schema + ", label_error long, codebooks_sha256 string").drop("label")
    first = integers([x for r in start for x in r["embedding"]], width)
    blocks = stored(
        in_arrow(
            rows, _block_maker(width, parts), f"vec_ids array<long>, labels array<{label_type}>, trees array<binary>"
        ),
        "blocks",
    )
    books = learnt_codebooks(blocks, np.split(first, parts, axis=1), rounds)
    coded = in_arrow(
        blocks.select("vec_ids", "labels", "trees"),
        _coder(spark.sparkContext.broadcast(books)),
        f"vec_id long, label {label_type}, code string, error long",
    )
    coded = stored(coded, "codes")
    errors = coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error"))
    return coded.join(errors, F.col("label").eqNullSafe(F.col("of_label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(books_digest(books)).alias("codebooks_sha256")
    )
