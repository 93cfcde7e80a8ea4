"""Operator 13: trees and rounds against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from ebbtide.llm import cover_trees

SCHEMA = "vec_id long, embedding array<double>, label int"


def brute_codes(rows, parts=8, entries=16, rounds=6):
    """rows: (vec_id, vector, label), usable ones of one length only."""
    ints = [(i, [math.floor(4096 * x) for x in v], label) for i, v, label in rows]
    width = len(ints[0][1]) // parts
    cut = [[v[p * width : (p + 1) * width] for p in range(parts)] for _, v, _ in ints]
    start = sorted(range(len(ints)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, rows[k][1]))[:entries]
    books = [[list(cut[k][p]) for k in start] for p in range(parts)]

    def square(a, b):
        return sum((x - y) ** 2 for x, y in zip(a, b, strict=True))

    def nearest(v, book):
        return min(range(len(book)), key=lambda e: (square(v, book[e]), e))

    for _ in range(rounds):
        for p in range(parts):
            groups = {}
            for row in cut:
                groups.setdefault(nearest(row[p], books[p]), []).append(row[p])
            for e, members in groups.items():
                books[p][e] = [sum(x) // len(members) for x in zip(*members, strict=True)]
    out, by_label = [], {}
    for (i, _, label), row in zip(ints, cut, strict=True):
        digits = [nearest(row[p], books[p]) for p in range(parts)]
        error = sum(square(row[p], books[p][d]) for p, d in enumerate(digits))
        by_label[label] = by_label.get(label, 0) + error
        out.append([i, "".join(f"{d:02x}" for d in digits), error, label])
    digest = hashlib.sha256(",".join(str(x) for book in books for e in book for x in e).encode()).hexdigest()
    return sorted(((i, c, e, by_label[label], digest) for i, c, e, label in out), key=str)


def found(df):
    return sorted(map(tuple, df.collect()), key=str)


def points_of(kind, n, width, seed=0):
    rng = np.random.default_rng(seed)
    if kind == "grid":  # ties everywhere
        return rng.integers(-2, 3, (n, width))
    if kind == "clusters":
        return rng.integers(-9, 9, (5, width))[rng.integers(0, 5, n)] * 1000 + rng.integers(-3, 4, (n, width))
    if kind == "same":
        return np.full((n, width), 7)
    return rng.integers(-4096, 4096, (n, width))


@pytest.mark.parametrize("kind", ["grid", "clusters", "same", "wide"])
@pytest.mark.parametrize("leaf", [1, 8, 64])
def test_tree_invariants_and_assignment(kind, leaf, monkeypatch):
    monkeypatch.setattr(cover_trees, "LEAF", leaf)
    values = points_of(kind, 700, 4)
    tree = cover_trees.CoverTree(values)
    assert np.array_equal(tree.points[tree.place], values) and tree.counts.sum() == len(values)
    for node in range(len(tree.low)):
        low, high = tree.low[node], tree.high[node]
        centre = tree.points[tree.centre[node]]
        away = np.sqrt(((tree.points[low:high] - centre) ** 2).sum(axis=1))
        assert away.max() == pytest.approx(tree.radius[node])
        a, b = tree.children[node]
        if b:
            assert tree.low[a] == low and tree.high[b - 1] == high
            assert np.array_equal(tree.high[a : b - 1], tree.low[a + 1 : b])
            assert tree.radius[a:b].max() <= tree.radius[node] / 2  # covering
            centres = tree.points[tree.centre[a:b]]
            assert (centres == centre).all(axis=1).any()  # nesting
            between = np.sqrt(cover_trees.squares(centres, centres).astype(float))
            assert (between + np.eye(b - a) * 1e9).min() > tree.radius[node] / 2  # separation
    for entries in (values[:1], values[:16], points_of(kind, 16, 4, 3)):
        entry_of, _ = tree.assign(entries)
        assert np.array_equal(entry_of, cover_trees.squares(tree.points, entries).argmin(axis=1))
        count, total = tree.sums(entry_of, len(entries))
        for e in range(len(entries)):
            mine = entry_of[tree.place] == e
            assert count[e] == mine.sum() and np.array_equal(total[e], values[mine].sum(axis=0))


def test_whole_subtrees_save_comparisons():
    values = points_of("clusters", 5000, 8)
    tree = cover_trees.CoverTree(values)
    centres = np.unique(np.round(values / 1000).astype(np.int64) * 1000, axis=0)
    assert len(centres) == 5
    _, compared = tree.assign(centres)  # every cluster lies well inside its own centre's cell
    assert compared < 0.05 * len(tree.points) * len(centres)


@pytest.mark.parametrize("block", [5, 4096])
@pytest.mark.parametrize("kind", ["grid", "clusters", "wide"])
def test_codes_equal_brute_force(spark, kind, block, monkeypatch):
    monkeypatch.setattr(cover_trees, "BLOCK_ROWS", block)
    points = points_of(kind, 300, 16, 1) / 512
    rows = [(int(i), [float(x) for x in v], random.Random(i).choice([0, 1, None])) for i, v in enumerate(points)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert found(cover_trees.compress(df)) == brute_codes(rows)


def test_odd_vectors(spark):
    rng = random.Random(2)
    good = [(i % 40, [rng.uniform(-1, 1) for _ in range(8)], rng.choice([1, None])) for i in range(60)]
    good += [(None, [0.5] * 8, 1), (None, [0.25] * 8, None)]
    bad = [
        (1, None, 1), (2, [], 1), (3, [float("nan")] * 8, 1), (4, [float("inf")] + [0.0] * 7, 1),
        (5, [None] + [0.0] * 7, 1), (6, [1.0] * 16, 1), (7, [1.0] * 7, 1),
    ]
    df = spark.createDataFrame([(*r, "x", 9) for r in good + bad], SCHEMA + ", code string, error int").repartition(3)
    assert found(cover_trees.compress(df)) == brute_codes(good)
    few = good[:5]
    assert found(cover_trees.compress(spark.createDataFrame(few, SCHEMA))) == brute_codes(few)
    for rows in ([], bad[:5]):
        assert cover_trees.compress(spark.createDataFrame(rows, SCHEMA)).count() == 0


def test_too_large_components_stop_the_job(spark):
    df = spark.createDataFrame([(1, [1e30] * 8, 1)], SCHEMA)
    with pytest.raises(Exception, match="exact"):
        cover_trees.compress(df).collect()
