"""Nearest neighbours by vantage-point trees, one tree per shard.

The largest inner product becomes the smallest distance by one more coordinate:
sqrt(M**2 - |x|**2) for rows, with M the largest length of the shard, and 0 for queries.
Distances are a metric, so the triangle inequality tells which side of a tree's node can
hold nothing nearer. ``factor`` above 1 prunes more than it allows, 1 is exact.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import ship_package, stored

SHARD_ROWS = 8192
LEAF = 256
QUERY_BLOCK = 8192
CLOSE = 1e-9  # relative; nearer ones are compared by their exact products
SLACK = 1e-7  # of the lengths; what squared distances near zero lose to rounding
TIED_BLOCK = 256  # queries whose ties are collected at a time


def usable(column: str = "embedding") -> Column:
    """Vectors without missing or non-finite components that are not zero."""
    v = F.transform(F.col(column), lambda x: x.cast("double"))
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.col(column).isNotNull() & ~bad & F.exists(v, lambda x: x != 0)


@dataclass
class Node:
    """Rows ``low`` to ``high``; an inner node splits them by distance from a vantage point."""

    low: int
    high: int
    point: np.ndarray | None = None
    radius: float = 0.0
    inside: Node | None = None
    outside: Node | None = None


class Tree:
    """A vantage-point tree over distinct vectors; equal vectors share a place."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        order = np.argsort(ids, kind="stable")
        ids, vectors = ids[order], vectors[order]
        _, first, owner = np.unique(
            np.ascontiguousarray(vectors).view(f"V{vectors.shape[1] * 8}").ravel(),
            return_index=True,
            return_inverse=True,
        )
        self.vectors = vectors[first]
        lengths = (self.vectors**2).sum(axis=1)
        self.most = float(lengths.max())
        lifted = np.sqrt(np.maximum(self.most - lengths, 0.0))
        self.points = np.hstack([self.vectors, lifted[:, None]])
        self.order = np.arange(len(first))
        self.root = self._split(0, len(first), np.random.default_rng(7))
        self.vectors, self.points = self.vectors[self.order], self.points[self.order]
        place = np.empty_like(self.order)
        place[self.order] = np.arange(len(self.order))
        members = place[owner.ravel()]
        by_place = np.argsort(members, kind="stable")
        self.member_ids = ids[by_place]
        self.member_at = np.searchsorted(members[by_place], np.arange(len(self.order) + 1))
        # places that hold one id only are no candidates of a query with this id
        low, high = self.member_at[:-1], self.member_at[1:] - 1
        alone = self.member_ids[low][self.member_ids[low] == self.member_ids[high]]
        self.lone_ids, self.lone_counts = np.unique(alone, return_counts=True)

    def _split(self, low: int, high: int, rng: np.random.Generator) -> Node:
        node = Node(low, high)
        if high - low > LEAF:
            rows = self.order[low:high]
            node.point = self.points[rng.choice(rows)]
            far = np.sqrt(((self.points[rows] - node.point) ** 2).sum(axis=1))
            middle = (high - low) // 2
            parts = np.argpartition(far, middle)
            self.order[low:high] = rows[parts]
            node.radius = float(far[parts[middle]])
            node.inside = self._split(low, low + middle, rng)
            node.outside = self._split(low + middle, high, rng)
        return node

    def search(self, queries: np.ndarray, k: int, factor: float) -> tuple[np.ndarray, np.ndarray]:
        """Places and inner products of the ``k`` + 1 best for each query, worst first not sorted."""
        self.k = k + 1
        self.bound = self.found = None
        self.q = queries
        self.q_length = (queries**2).sum(axis=1)
        self.best = np.full((len(queries), self.k), -np.inf)
        self.place = np.full((len(queries), self.k), -1)
        self._visit(self.root, np.arange(len(queries)), factor)
        return self.place, self.best

    def members(self, place: int, query_id: int) -> np.ndarray:
        """The ids at a place in order, without the query's own."""
        ids = self.member_ids[self.member_at[place] : self.member_at[place + 1]]
        return ids[ids != query_id]

    def at_least(self, queries: np.ndarray, bound: np.ndarray, factor: float) -> list[np.ndarray]:
        """For each query all places with an inner product of its bound or more."""
        self.q = queries
        self.q_length = (queries**2).sum(axis=1)
        self.bound, self.found = bound, [[] for _ in queries]
        self._visit(self.root, np.arange(len(queries)), factor)
        return [np.concatenate(f or [np.zeros(0, np.int64)]) for f in self.found]

    def _reach(self, active: np.ndarray) -> np.ndarray:
        """Distance of each query's worst kept place, or of its bound."""
        worst = self.best[active].min(axis=1) if self.bound is None else self.bound[active]
        square = self.q_length[active] + self.most - 2 * worst
        slack = SLACK * np.sqrt(self.q_length[active] + self.most)
        reach = np.sqrt(np.maximum(square, 0.0)) * (1 + CLOSE) + slack
        return np.where(np.isfinite(worst), reach, np.inf)

    def _visit(self, node: Node, active: np.ndarray, factor: float) -> None:
        if not len(active):
            return
        if node.inside is None or node.outside is None:
            products = self.q[active] @ self.vectors[node.low : node.high].T
            if self.bound is not None:
                for query, row in zip(active, products >= self.bound[active, None], strict=True):
                    if row.any():
                        self.found[query].append(node.low + np.flatnonzero(row))
                return
            merged = np.hstack([self.best[active], products])
            places = np.broadcast_to(np.arange(node.low, node.high), products.shape)
            places = np.hstack([self.place[active], places])
            top = np.argpartition(-merged, self.k - 1, axis=1)[:, : self.k]
            self.best[active] = np.take_along_axis(merged, top, axis=1)
            self.place[active] = np.take_along_axis(places, top, axis=1)
            return
        gap = self.q_length[active] + (node.point**2).sum() - 2 * self.q[active] @ node.point[:-1]
        far = np.sqrt(np.maximum(gap, 0.0))
        near = far < node.radius
        for side, other, mine in (
            (node.inside, node.outside, active[near]),
            (node.outside, node.inside, active[~near]),
        ):
            self._visit(side, mine, factor)
            margin = np.abs(far[near] if side is node.inside else far[~near]) - node.radius
            open_ = np.abs(margin) * factor <= self._reach(mine)
            self._visit(other, mine[open_], factor)


def exact_products(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products in double precision, each row summed in the same way."""
    return (rows * query).sum(axis=1)


def best_of_tree(
    tree: Tree, query_ids: np.ndarray, queries: np.ndarray, k: int, factor: float
) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(query, row ids, products) of each query's best ``k``, ties to the smaller id."""
    at = np.minimum(np.searchsorted(tree.lone_ids, query_ids), len(tree.lone_ids) - 1)
    own_places = np.zeros(len(query_ids), np.int64)
    if len(tree.lone_ids):
        own_places = np.where(tree.lone_ids[at] == query_ids, tree.lone_counts[at], 0)
    for extra in np.unique(own_places):
        mine = np.flatnonzero(own_places == extra)
        for j, places in _candidates(tree, queries[mine], k + int(extra), factor):
            query_id = int(query_ids[mine[j]])
            yield query_id, *_ranked(tree, query_id, queries[mine[j]], places, k)


def _candidates(
    tree: Tree, queries: np.ndarray, k: int, factor: float
) -> Iterator[tuple[int, np.ndarray]]:
    """(query, places) that can be among its best ``k``, with all ties of the k-th.

    A shortlist does if its last product is below the k-th by more than rounding. Else all
    places down to the k-th product are collected.
    """
    places, best = tree.search(queries, min(k + 8, len(tree.order)), factor)
    bound = np.full(len(queries), -np.inf)
    if best.shape[1] >= k:
        close = CLOSE * np.sqrt(tree.q_length * tree.most)
        bound = -np.partition(-best, k - 1, axis=1)[:, k - 1] - close
    tied = np.isfinite(bound) & (best.min(axis=1) >= bound)
    for j in np.flatnonzero(~tied):
        yield int(j), places[j][places[j] >= 0]
    again = np.flatnonzero(tied)
    for low in range(0, len(again), TIED_BLOCK):
        part = again[low : low + TIED_BLOCK]
        for j, found in zip(part, tree.at_least(queries[part], bound[part], factor), strict=True):
            yield int(j), found


def _ranked(
    tree: Tree, query_id: int, query: np.ndarray, places: np.ndarray, k: int
) -> tuple[np.ndarray, np.ndarray]:
    """Row ids and products of the best ``k`` at ``places``, without the query's own id.

    By product and smallest id, the first ``k`` places hold the first ``k`` rows.
    """
    products = exact_products(query, tree.vectors[places])
    least = tree.member_ids[tree.member_at[places]]
    taken = np.ones(len(places), bool)
    for j in np.flatnonzero(least == query_id):
        others = tree.members(places[j], query_id)
        taken[j] = len(others) > 0
        least[j] = others[0] if len(others) else query_id
    places, products, least = places[taken], products[taken], least[taken]
    order = np.lexsort((least, -products))[:k]
    members = [tree.members(p, query_id)[:k] for p in places[order]]
    ids = np.concatenate([*members, np.zeros(0, np.int64)])
    scores = np.repeat(products[order], [len(m) for m in members])
    order = np.lexsort((ids, -scores))[:k]
    return ids[order], scores[order]


def _searcher(shared, k: int, factor: float):
    """The function that builds a shard's tree and searches it with the broadcast queries."""

    def search(frame: pd.DataFrame) -> pd.DataFrame:
        query_ids, values = shared.value
        out = []
        if len(query_ids):
            tree = Tree(frame["vec_id"].to_numpy(), np.stack(frame["embedding"].to_numpy()).astype(float))
            out = list(best_of_tree(tree, query_ids, values, k, factor))
        return pd.DataFrame(
            {
                "query_id": np.repeat([q for q, _, _ in out], [len(i) for _, i, _ in out]).astype("int64"),
                "vec_id": np.concatenate([i for _, i, _ in out] or [[]]).astype("int64"),
                "score": np.concatenate([s for _, _, s in out] or [[]]).astype("float64"),
            }
        )

    return search


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    k: int = 20,
    factor: float = 1.0,
    shard_rows: int = SHARD_ROWS,
    query_block: int = QUERY_BLOCK,
) -> DataFrame:
    """Each query's ``k`` rows of the largest inner product: query_id, rank, vec_id, score.

    ``vectors`` and ``queries`` have vec_id and embedding. A row with the query's own vec_id
    is no candidate. Vectors that are missing, zero or hold missing or non-finite
    components take no part, nor do rows without vec_id; all must be of one length. Ties go
    to the smaller vec_id; rows repeated in vec_id and vector come as often as they are
    there. Fewer candidates than ``k``: all. An empty table gives an empty result; other
    columns are ignored.

    Rows are dealt to shards of about ``shard_rows`` by a hash of vec_id, so none is hot.
    Queries, a stated set, pass over the shards in blocks of ``query_block``: a block is
    what is broadcast. Each shard returns its best ``k`` of a query, and those are merged.
    """
    spark = vectors.sparkSession
    ship_package(spark)
    rows = vectors.where(usable() & F.col("vec_id").isNotNull()).select(
        F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
    )
    count = rows.count()
    shards = max(1, -(-count // shard_rows))
    shard = F.pmod(F.xxhash64("vec_id", "embedding"), F.lit(shards)).cast("int")
    placed = rows.withColumn("shard", shard)
    asked = stored(
        queries.where(usable() & F.col("vec_id").isNotNull()).select(
            F.col("vec_id").cast("long"), F.col("embedding").cast("array<double>").alias("embedding")
        ).distinct(),
        "queries",
    )
    blocks = max(1, -(-asked.count() // query_block))
    result = None
    for b in range(blocks):
        part = asked.where(F.pmod(F.xxhash64("vec_id"), F.lit(blocks)) == b).orderBy("vec_id").collect()
        ids = np.array([r["vec_id"] for r in part], np.int64)
        values = np.array([r["embedding"] for r in part], np.float64)
        shared = spark.sparkContext.broadcast((ids, values))

        found = placed.groupBy("shard").applyInPandas(_searcher(shared, k, factor), "query_id long, vec_id long, score double")
        result = found if result is None else result.unionByName(found)
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    return (
        result.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
