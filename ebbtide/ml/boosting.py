"""Second-order boosted trees that take missing values, grown by DataFrame aggregates.

Numbers are replaced by the number of their bin, once. A level of a tree is one aggregation
of gradients and Hessians per (model, node, feature, bin): each task adds its rows up in arrays
and sends its cells, however many rows it has read, those of a node and feature as one value.
After the only shuffle the tasks add the cells of their features up and choose the best split of
each node; a row per node and task comes back. Several models (the folds of a search) grow in
the same jobs. Nothing is imputed: each split learns the side to which missing values go.

Gradients are summed as whole numbers, so the sums do not depend on the order of rows or
tasks, and a recomputed task cannot change a tree (where NumPy's exp is the same on all machines).
"""

from __future__ import annotations

import json
import random
import uuid
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml import PipelineModel
from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ebbtide.ml.model import fit_encoders
from ebbtide.ml.split import add_positive_weight
from ebbtide.names import CATEGORICAL_FEATURES, CUSTOMER, FEATURES, LABEL, SCORE, SEED
from ebbtide.sources.writers import remove_folder, shared_folder

BINS = 256  # at most so many bins of present values per feature
SCALE = 2**24  # gradients are summed as whole multiples of 1 / SCALE
REFRESH = 5  # the rows are written anew with their margins after so many trees
ROUNDING = 1e-6  # a smaller gain is none
NODES = 256  # nodes of all models that one job adds up, which bounds the arrays of a task
CELLS = "model int, node int, feature int, bin int, g bigint, h bigint, c bigint"
PACKED = "model int, node int, feature int, cells binary"
BEST = (
    "model int, node int, feature int, bin int, missing_left boolean, gain double, "
    "g_left bigint, h_left bigint, g_all bigint, h_all bigint"
)

ALL_ROWS = -1  # the fold left out by a model that learns from every row


class Settings(NamedTuple):
    """How one model is grown; the penalties are those of second-order boosting.

    A child needs ``min_child_weight`` of summed Hessian, a split must lower the loss by more
    than ``min_gain``, and ``penalty`` is the squared penalty on leaf weights.
    """

    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    row_fraction: float = 1.0
    column_fraction: float = 1.0
    min_child_weight: float = 1.0
    min_gain: float = 0.0
    penalty: float = 1.0
    seed: int = SEED


class Split(NamedTuple):
    """Present values in bins below ``bin`` go left, and missing ones if ``missing_left``."""

    feature: int
    bin: int
    missing_left: bool
    gain: float


# nodes by number: 1 is the root, the children of n are 2n and 2n + 1; a leaf is its weight
Tree = dict[int, Split | float]


class BoostedTrees(NamedTuple):
    """A fitted model: plain numbers only, as many as trees and cuts."""

    features: tuple[str, ...]
    cuts: tuple[tuple[float, ...], ...]
    trees: tuple[Tree, ...]
    encoders: PipelineModel | None = None


# --- bins ---


def _number(name: str) -> Column:
    """A feature as a double; NULL and NaN are both missing."""
    return F.nanvl(F.col(name).cast("double"), F.lit(None).cast("double"))


def bin_cuts(df: DataFrame, features: Sequence[str], bins: int = BINS) -> tuple[tuple[float, ...], ...]:
    """Per feature, increasing cuts at the quantiles of its present values, in one pass.

    At most ``bins`` - 1 numbers per feature reach the driver. A feature that is constant or
    wholly missing has no cut; infinite values share the outermost bins.
    """
    infinite = float("inf")
    fractions = F.array(*[F.lit(i / bins) for i in range(bins)])
    found = df.agg(
        *[F.percentile_approx(_number(c), fractions, 10_000).alias(f"q{i}") for i, c in enumerate(features)],
        *[F.min(_number(c)).alias(f"least{i}") for i, c in enumerate(features)],
    ).first()
    return tuple(
        tuple(sorted({v for v in found[f"q{i}"] or () if found[f"least{i}"] < v < infinite}))
        for i in range(len(features))
    )


def add_bins(df: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]) -> DataFrame:
    """Add ``bins``: per feature 0 for a missing value, else 1 plus the cuts not above it."""
    cut = [i for i, of_feature in enumerate(cuts) if of_feature]
    infinite = float("inf")
    # Bucketizer drops or refuses NULL, so a missing number passes through it as NaN
    numbers = {f"_v{i}": F.coalesce(_number(c), F.lit(float("nan"))) for i, c in enumerate(features)}
    placed = df.withColumns(numbers)
    if cut:
        placed = Bucketizer(
            splitsArray=[[-infinite, *cuts[i], infinite] for i in cut],
            inputCols=[f"_v{i}" for i in cut],
            outputCols=[f"_b{i}" for i in cut],
            handleInvalid="keep",
        ).transform(placed)

    def bin_of(i: int) -> Column:
        place = F.col(f"_b{i}").cast("int") + 1 if cuts[i] else F.lit(1)
        return F.when(F.isnan(f"_v{i}"), 0).otherwise(place)

    bins = F.array(*[bin_of(i) for i in range(len(features))])
    return placed.select(*df.columns, bins.alias("bins"))


# --- trees as expressions ---


def _listed(tree: Tree) -> dict[str, int | list]:
    """A tree's nodes in a row, the root first and siblings side by side; a leaf has left 0.

    Places of at least ``least`` and below ``bin`` go left; 0 is the place of a missing value.
    """
    nodes = sorted(tree)
    place = {node: i for i, node in enumerate(nodes)}
    entries = [tree[node] for node in nodes]
    splits = [e if isinstance(e, Split) else None for e in entries]
    return {
        "depth": max(nodes).bit_length() - 1,
        "feature": [s.feature if s else 0 for s in splits],
        "least": [0 if s is None or s.missing_left else 1 for s in splits],
        "bin": [s.bin if s else 0 for s in splits],
        "left": [place[2 * node] if s else 0 for node, s in zip(nodes, splits, strict=True)],
        "weight": [0.0 if s else float(e) for e, s in zip(entries, splits, strict=True)],
    }


LISTED = (
    "array<struct<depth:int,feature:array<int>,least:array<int>,bin:array<int>,left:array<int>,"
    "weight:array<double>>>"
)


def probability(trees: Sequence[Tree]) -> Column:
    """The probability of class 1, from ``bins``.

    The trees are one constant that is walked as an array: as nested conditions, a hundred of
    them make a plan that takes longer to prepare than the rows take to score.
    """
    every = F.from_json(F.lit(json.dumps([_listed(t) for t in trees])), LISTED)

    def margin(bins: Column) -> Column:
        def weight(tree: Column) -> Column:
            def step(node: Column, _: Column) -> Column:
                place = bins[tree["feature"][node]]
                right = (place < tree["least"][node]) | (place >= tree["bin"][node])
                left = tree["left"][node]
                return F.when(left == 0, node).otherwise(left + right.cast("int"))

            levels = F.array_repeat(F.lit(0), tree["depth"])
            return tree["weight"][F.aggregate(levels, F.lit(0), step)]

        return F.aggregate(every, F.lit(0.0), lambda total, tree: total + weight(tree))

    # bound once a row, so that no step of a walk derives the bins again
    return 1 / (1 + F.exp(-F.transform(F.array("bins"), margin)[0]))


# --- growing ---


# a model that grows: its settings, fold left out, tree so far, growing nodes, features in use
Growing = dict[int, tuple[Settings, int, Tree, set[int], list[int]]]


def _table(tree: Tree) -> dict[str, np.ndarray]:
    """A tree as arrays by node: feature (-1 where it stops), bin, side of missing values, weight."""
    size = max(tree, default=0) + 2
    table = {
        "feature": np.full(size, -1, np.int64),
        "bin": np.zeros(size, np.int64),
        "missing_left": np.zeros(size, bool),
        "weight": np.zeros(size),
    }
    for node, entry in tree.items():
        if isinstance(entry, Split):
            for name in ("feature", "bin", "missing_left"):
                table[name][node] = getattr(entry, name)
        else:
            table["weight"][node] = entry
    return table


def _walker() -> Callable[[dict[str, np.ndarray], np.ndarray], np.ndarray]:
    """The walk down a tree as an array operation; it lies inside, so that tasks need no library."""

    def ends(table: dict[str, np.ndarray], binned: np.ndarray) -> np.ndarray:
        """The node at which each row stops."""
        node = np.ones(len(binned), np.int64)
        moving = np.arange(len(binned))
        while len(moving := moving[table["feature"][node[moving]] >= 0]):
            at = node[moving]
            place = binned[moving, table["feature"][at]]
            left = (place < table["bin"][at]) & ((place > 0) | table["missing_left"][at])
            node[moving] = 2 * at + ~left
        return node

    return ends


def _reader() -> Callable[[pa.RecordBatch, str], np.ndarray]:
    """Numbers that ``_stored`` has written as bytes, a line per row, without a copy."""

    def numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
        column = batch.column(name)
        wide = np.int64 if pa.types.is_large_binary(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], wide)[column.offset : column.offset + len(column) + 1]
        data = np.frombuffer(column.buffers()[2], np.uint8)[offsets[0] : offsets[-1]]
        return data.view(np.float64 if name == "margins" else np.int32).reshape(len(column), -1)

    return numbers


def _writer() -> Callable[[np.ndarray], pa.Array]:
    """Each line of an array as one value of bytes."""

    def as_bytes(lines: np.ndarray) -> pa.Array:
        lines = np.ascontiguousarray(lines)
        offsets = np.arange(len(lines) + 1, dtype=np.int32) * np.int32(lines.itemsize * lines.shape[1])
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(lines)]
        return pa.Array.from_buffers(pa.binary(), len(lines), buffers)

    return as_bytes


def _stored(models: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does to lay its rows out for growing: bins, and a margin of 0 per model, as bytes.

    An array column costs Spark some work per number each time a level reads it.
    """
    as_bytes = _writer()

    def lay_out(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            binned = batch.column("bins").flatten().to_numpy(zero_copy_only=False)
            binned = binned.astype(np.int32).reshape(batch.num_rows, -1)
            names = batch.schema.names
            columns = [as_bytes(binned) if n == "bins" else batch.column(n) for n in names]
            margins = as_bytes(np.zeros((batch.num_rows, models)))
            yield pa.RecordBatch.from_arrays([*columns, margins], [*names, "margins"])

    return lay_out


def _largest() -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does to find the largest bin of each feature: one row, or none without rows."""
    numbers = _reader()

    def largest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        most = [numbers(batch, "bins").max(0) for batch in batches if batch.num_rows]
        if most:
            found = pa.array([np.max(most, 0).tolist()], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays([found], ["most"])

    return largest


def _moved(
    before: Sequence[Sequence[Tree]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does to add the trees to its rows' margins; other columns stay as they are."""
    ends, numbers, as_bytes = _walker(), _reader(), _writer()
    models = [[_table(t) for t in own] for own in before]

    def move(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            margins, binned = numbers(batch, "margins").copy(), numbers(batch, "bins")
            for m, earlier in enumerate(models):
                for table in earlier:
                    margins[:, m] += table["weight"][ends(table, binned)]
            names = batch.schema.names
            columns = [as_bytes(margins) if n == "margins" else batch.column(n) for n in names]
            yield pa.RecordBatch.from_arrays(columns, names)

    return move


def _cells(
    growing: Growing, before: Sequence[Sequence[Tree]], bins: Sequence[int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does: add its rows up per (model, node, feature, bin), as whole numbers.

    ``before`` has each model's trees that the margins do not hold yet, ``bins`` the number of
    bins of each feature. A batch has ``taken``, an entry per growing model, beside the rows' own
    columns. Trees are walked here, as arrays: as SQL they make methods too long to be compiled.
    The functions lie inside, so that tasks need no copy of the library.
    """
    first = np.concatenate([[0], np.cumsum(bins)]).astype(np.int64)
    size = int(first[-1])
    slots = [(m, node) for m, (*_, nodes, _) in growing.items() for node in sorted(nodes)]
    models = []
    for m, (_, _, tree, nodes, used) in growing.items():
        slot_of = np.full(max(*nodes, *tree, 1) + 1, -1, np.int64)
        for slot, (model, node) in enumerate(slots):
            if model == m:
                slot_of[node] = slot
        models.append((m, slot_of, _table(tree), [_table(t) for t in before[m]], np.asarray(used, np.int64)))

    ends = _walker()

    def whole(x: np.ndarray) -> np.ndarray:
        """Multiples of 1 / SCALE, halves away from zero."""
        x = x * SCALE
        down = np.trunc(x)
        return (down + np.sign(x) * (np.abs(x - down) >= 0.5)).astype(np.int64)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = {n: np.zeros(len(slots) * size, np.int64) for n in ("g", "h", "c")}
        for batch in batches:
            if not batch.num_rows:
                continue
            label, weight = (batch.column(n).to_numpy(zero_copy_only=False) for n in (LABEL, "weight"))
            taken, margins, binned = (
                batch.column(n).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1)
                for n in ("taken", "margins", "bins")
            )
            for place, (m, slot_of, tree, earlier, used) in enumerate(models):
                met = np.flatnonzero(taken[:, place])
                slot = slot_of[ends(tree, binned[met])]
                met, slot = met[slot >= 0], slot[slot >= 0]
                own, margin = binned[met], margins[met, m]
                for table in earlier:
                    margin = margin + table["weight"][ends(table, own)]
                with np.errstate(over="ignore"):
                    p = 1 / (1 + np.exp(-margin))
                g = whole(weight[met] * (p - label[met]))
                h = whole(weight[met] * p * (1 - p))
                cell = (slot[:, None] * size + first[used] + own[:, used]).ravel()
                np.add.at(sums["g"], cell, np.repeat(g, len(used)))
                np.add.at(sums["h"], cell, np.repeat(h, len(used)))
                sums["c"] += np.bincount(cell, minlength=len(sums["c"]))
        full = np.flatnonzero(sums["c"])
        slot, within = np.divmod(full, size)
        feature = np.searchsorted(first, within, "right") - 1
        model, node = np.asarray(slots, np.int64)[slot].T
        places = [v.astype(np.int32) for v in (model, node, feature, within - first[feature])]
        columns = [*places, *[sums[n][full] for n in ("g", "h", "c")]]
        names = [field.split()[0] for field in CELLS.split(", ")]
        for start in range(0, len(full), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(v[start : start + 100_000]) for v in columns], names)

    return add_up


def _packed(
    add_up: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``add_up`` between bytes: rows come as ``_stored`` lays them out, and the cells of a node
    and feature go as one value, (bin, g, h, c) in turn."""
    numbers = _reader()

    def opened(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            names = batch.schema.names
            columns = {n: batch.column(n) for n in names}
            for name in ("margins", "bins"):
                lines = numbers(batch, name)
                flat = pa.array(lines.ravel())
                columns[name] = pa.FixedSizeListArray.from_arrays(flat, lines.shape[1])
            yield pa.RecordBatch.from_arrays(list(columns.values()), names)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in add_up(opened(batches)):
            if not batch.num_rows:
                continue
            model, node, feature = (batch.column(n).to_numpy() for n in ("model", "node", "feature"))
            changes = (np.diff(model) != 0) | (np.diff(node) != 0) | (np.diff(feature) != 0)
            starts = np.concatenate([[0], np.flatnonzero(changes) + 1])
            cells = np.stack([batch.column(n).to_numpy().astype(np.int64) for n in ("bin", "g", "h", "c")], 1)
            offsets = np.append(starts, len(cells)).astype(np.int32) * cells.itemsize * 4
            buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(cells))]
            values = pa.Array.from_buffers(pa.binary(), len(starts), buffers)
            keys = [pa.array(v[starts]) for v in (model, node, feature)]
            yield pa.RecordBatch.from_arrays([*keys, values], ["model", "node", "feature", "cells"])

    return pack


def _best(
    growing: Growing, bins: Sequence[int]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """What a task does with the cells of its features: the best split of each node among them.

    A row has the node's totals, and no gain where no split is allowed. Of equal gains the
    earlier feature's, the lower bin's and the one with missing values to the right is best.
    """
    scale = float(SCALE)
    fields = [field.split()[0] for field in BEST.split(", ")]
    types = [pa.int32()] * 4 + [pa.bool_(), pa.float64()] + [pa.int64()] * 4
    schema = pa.schema(list(zip(fields, types, strict=True)))
    rules = {m: (float(s.penalty), float(s.min_child_weight)) for m, (s, *_) in growing.items()}

    def loss(g: np.ndarray, h: np.ndarray, penalty: float) -> np.ndarray:
        below = h / scale + penalty
        if (below == 0).any():
            raise ZeroDivisionError("a node without Hessian and penalty has no loss")
        return np.square(g / scale) / below

    def split_of(cells: np.ndarray, penalty: float, least: float) -> tuple:
        """(bin, missing_left, gain, g_left, h_left, g_all, h_all) from (g, h, c) by bin."""
        met = np.flatnonzero(cells[:, 2])
        upto, whole = np.cumsum(cells, 0)[met], cells.sum(0)
        # the side of missing values is the last axis, right before left
        left = np.stack([upto - cells[0], upto], 1)
        right = whole - left
        allowed = (met > 0)[:, None] & (left[..., 2] > 0) & (right[..., 2] > 0)
        allowed &= (left[..., 1] / scale >= least) & (right[..., 1] / scale >= least)
        if not allowed.any():
            return int(met[0]), False, None, 0, 0, int(whole[0]), int(whole[1])
        taken = np.argwhere(allowed)
        left, right = left[allowed], right[allowed]
        gain = (
            loss(left[:, 0], left[:, 1], penalty)
            + loss(right[:, 0], right[:, 1], penalty)
            - loss(whole[:1], whole[1:2], penalty)
        )
        first = int(np.argmax(gain))
        place, side = taken[first]
        ours = (int(left[first, 0]), int(left[first, 1]), int(whole[0]), int(whole[1]))
        return int(met[place]), bool(side), float(gain[first]), *ours

    def choose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[tuple[int, int, int], np.ndarray] = {}
        for batch in batches:
            keys = zip(*(batch.column(n).to_pylist() for n in ("model", "node", "feature")), strict=True)
            for key, value in zip(keys, batch.column("cells"), strict=True):
                cells = np.frombuffer(value.as_buffer(), np.int64).reshape(-1, 4)
                if key not in sums:
                    sums[key] = np.zeros((bins[key[2]], 3), np.int64)
                sums[key][cells[:, 0]] += cells[:, 1:]
        found: dict[tuple[int, int], tuple] = {}
        for (m, node, feature), cells in sorted(sums.items(), key=lambda item: item[0]):
            split = (feature, *split_of(cells, *rules[m]))
            kept = found.get((m, node))
            if kept is None or (split[3] is not None and (kept[3] is None or split[3] > kept[3])):
                found[m, node] = split
        rows = [(*node, *split) for node, split in found.items()]
        if rows:
            columns = zip(*rows, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, t in zip(columns, types, strict=True)], schema=schema
            )

    return choose


def _level(
    rows: DataFrame, before: Sequence[Sequence[Tree]], growing: Growing, number: int, bins: Sequence[int]
):
    """Best splits of the growing nodes by BEST: a row per (model, node) and task, with its totals.

    Each row meets a model once, at one node. ``before`` are the models' trees that the rows'
    margins do not hold yet.
    """
    taken = []
    for settings, without, *_ in growing.values():
        drawn = "true"
        if settings.row_fraction < 1:
            place = f"pmod(xxhash64({CUSTOMER}, {settings.seed}, {number}), 1000000)"
            drawn = f"{place} < {round(settings.row_fraction * 1_000_000)}"
        taken.append(f"IF(fold <> {without} AND {drawn}, 1, 0)")
    met = rows.selectExpr(LABEL, "weight", "margins", "bins", f"array({', '.join(taken)}) AS taken")
    sums = met.mapInArrow(_packed(_cells(growing, before, bins)), PACKED)
    return sums.repartition("model", "node", "feature").mapInArrow(_best(growing, bins), BEST)


def _by_job(growing: Growing) -> Iterator[Growing]:
    """The growing nodes in parts of at most NODES, in order."""
    every = [(m, node) for m, (*_, nodes, _) in growing.items() for node in sorted(nodes)]
    for start in range(0, len(every), NODES):
        part: dict[int, set[int]] = {}
        for m, node in every[start : start + NODES]:
            part.setdefault(m, set()).add(node)
        yield {m: (*growing[m][:3], nodes, growing[m][4]) for m, nodes in part.items()}


def _rank(best: Row) -> tuple[float, int]:
    """What the better of two features' splits of a node has more of: gain, then place."""
    return (-float("inf") if best.gain is None else best.gain, -best.feature)


def _grow(
    rows: DataFrame,
    before: Sequence[Sequence[Tree]],
    models: dict[int, tuple[Settings, int]],
    number: int,
    bins: Sequence[int],
) -> dict[int, Tree]:
    """The next tree of each model, all grown level by level in the same jobs."""
    width = len(bins)
    trees: dict[int, Tree] = {m: {} for m in models}
    open_nodes = {m: {1} for m in models}
    used = {}
    for m, (settings, _) in models.items():
        count = max(1, round(settings.column_fraction * width))
        used[m] = sorted(random.Random(f"{settings.seed}/{number}").sample(range(width), count))
    for level in range(max(s.depth for s, _ in models.values())):
        growing = {
            m: (settings, without, trees[m], open_nodes[m], used[m])
            for m, (settings, without) in models.items()
            if open_nodes[m] and level < settings.depth
        }
        if not growing:
            break
        found: dict[tuple[int, int], Row] = {}
        for part in _by_job(growing):
            for r in _level(rows, before, part, number, bins).collect():
                kept = found.get((r.model, r.node))
                if kept is None or _rank(r) > _rank(kept):
                    found[r.model, r.node] = r
        for m, (settings, _, tree, nodes, _) in growing.items():

            def leaf(g: int, h: int, s: Settings = settings) -> float:
                below = h / SCALE + s.penalty
                return -s.rate * (g / SCALE) / below if below > 0 else 0.0

            following = set()
            for node in nodes:
                best = found.get((m, node))
                if best is None:  # no row reached it: an empty table or sample
                    tree[node] = 0.0
                    continue
                gain = best["gain"]
                if gain is None or gain <= max(settings.min_gain, ROUNDING):
                    tree[node] = leaf(best["g_all"], best["h_all"])
                    continue
                tree[node] = Split(best["feature"], best["bin"] + 1, best["missing_left"], gain)
                tree[2 * node] = leaf(best["g_left"], best["h_left"])
                tree[2 * node + 1] = leaf(
                    best["g_all"] - best["g_left"], best["h_all"] - best["h_left"]
                )
                following |= {2 * node, 2 * node + 1}
            open_nodes[m] = following
    return trees


def grow_models(binned: DataFrame, models: Sequence[tuple[Settings, int]]) -> list[tuple[Tree, ...]]:
    """Trees of several models at once, each given as (settings, fold it does not see).

    ``binned`` holds the customer, the 0/1 label, ``weight``, ``fold`` and ``bins``. Every
    five trees the rows are written with their margins, which cuts lineage, and the table
    before is removed.
    """
    spark = binned.sparkSession
    folder = f"{shared_folder(spark)}/ebbtide-{uuid.uuid4().hex}"
    trees: list[list[Tree]] = [[] for _ in models]
    kept = [CUSTOMER, LABEL, "weight", "fold", "bins"]

    def written(df: DataFrame, step: int) -> DataFrame:
        df.write.parquet(f"{folder}/{step}")
        return spark.read.schema(df.schema).parquet(f"{folder}/{step}")

    plain = binned.select(*kept)
    types = [plain.schema[n] for n in kept if n != "bins"]
    schema = T.StructType([*types, *[T.StructField(n, T.BinaryType()) for n in ("bins", "margins")]])
    stored = written(plain.mapInArrow(_stored(len(models)), schema), 0)
    tops = [r.most for r in stored.mapInArrow(_largest(), "most array<int>").collect()]
    bins = [max(top) + 1 for top in zip(*tops, strict=True)] or [1]
    done = 0  # trees already in the stored margins
    for number in range(max(s.trees for s, _ in models)):
        if number - done == REFRESH:
            moved = stored.mapInArrow(_moved([own[done:] for own in trees]), stored.schema)
            stored = written(moved, number)
            remove_folder(spark, f"{folder}/{done}")
            done = number
        before = [own[done:] for own in trees]
        active = {m: model for m, model in enumerate(models) if number < model[0].trees}
        for m, tree in _grow(stored, before, active, number, bins).items():
            trees[m].append(tree)
    remove_folder(spark, folder)
    return [tuple(own) for own in trees]


# --- fitting and scoring a frame ---


def encoded(features: DataFrame, encoders: PipelineModel) -> DataFrame:
    """Categories replaced by their codes; numbers, missing ones too, as they are."""
    codes = {c: F.col(f"{c}_code") for c in CATEGORICAL_FEATURES}
    return encoders.transform(features).withColumns(codes).select(features.columns)


def train_boosted_trees(
    train: DataFrame, encoders: PipelineModel | None = None, settings: Settings = Settings()
) -> BoostedTrees:
    """Fit on the wide frame, class 1 weighted by negatives / positives.

    A training part of one class has no such ratio: its rows then weigh 1. An empty one
    gives trees of a single leaf without weight, so that every score is 0.5.
    """
    encoders = fit_encoders(train) if encoders is None else encoders
    frame = encoded(train, encoders)
    cuts = bin_cuts(frame, FEATURES)
    (trees,) = grow_models(training_rows(frame, FEATURES, cuts), [(settings, ALL_ROWS)])
    return BoostedTrees(tuple(FEATURES), cuts, trees, encoders)


def training_rows(
    frame: DataFrame, features: Sequence[str], cuts: Sequence[Sequence[float]]
) -> DataFrame:
    """What growing reads of an encoded frame; ``fold`` is 0 where the frame has none.

    A row without a label teaches nothing and stops the job.
    """
    unlabelled = F.raise_error(F.lit(f"a row without {LABEL} cannot be learnt from"))
    labelled = frame.withColumn(LABEL, F.coalesce(F.col(LABEL), unlabelled.cast("int")))
    weighted = add_positive_weight(labelled).withColumn("weight", F.coalesce("weight", F.lit(1.0)))
    if "fold" not in frame.columns:
        weighted = weighted.withColumn("fold", F.lit(0))
    return add_bins(weighted, features, cuts).select(CUSTOMER, LABEL, "weight", "fold", "bins")


def score(model: BoostedTrees, features: DataFrame) -> DataFrame:
    """Customer, label (where present), predicted class and probability of class 1."""
    keep = [CUSTOMER] + ([LABEL] if LABEL in features.columns else [])
    frame = features if model.encoders is None else encoded(features, model.encoders)
    placed = add_bins(frame, model.features, model.cuts)
    scored = placed.select(*keep, probability(model.trees).alias(SCORE))
    return scored.select(*keep, (F.col(SCORE) > 0.5).cast("int").alias("prediction"), SCORE)


def feature_gains(spark: SparkSession, model: BoostedTrees) -> DataFrame:
    """(feature, gain): the mean gain of a feature's splits as a share of all, largest first."""
    gains: dict[int, list[float]] = {i: [] for i in range(len(model.features))}
    for tree in model.trees:
        for node in tree.values():
            if isinstance(node, Split):
                gains[node.feature].append(node.gain)
    means = {i: sum(g) / len(g) if g else 0.0 for i, g in gains.items()}
    total = sum(means.values()) or 1.0
    rows = [(model.features[i], mean / total) for i, mean in means.items()]
    frame = spark.createDataFrame(rows, "feature string, gain double")
    return frame.orderBy(F.col("gain").desc(), "feature")
