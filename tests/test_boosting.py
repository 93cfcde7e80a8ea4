"""Second-order boosting against a learner that tries every split by itself."""

import math
import random

import pytest
from pyspark.sql import functions as F

from ebbtide.ml import boosting, metrics, search, split
from ebbtide.ml.boosting import ALL_ROWS, SCALE, Settings, Split
from test_learning import ID, planted

NAMES = ("a", "b", "c", "d")
SCHEMA = f"{ID} string, is_churned int, fold int, " + ", ".join(f"{n} double" for n in NAMES)


def made_up(n, seed):
    """Rows with ties, missing values that matter, an infinite value and a constant column."""
    draw = random.Random(seed)
    rows = []
    for i in range(n):
        a = None if draw.random() < 0.3 else float(draw.randint(0, 9))
        b = float("nan") if draw.random() < 0.2 else draw.choice([1.5, 2.5, 2.5, 9.0, float("inf")])
        c = draw.random()
        signal = (2 if a is None else a / 5) + (0 if b is None or math.isnan(b) else min(b, 5) / 5)
        rows.append((f"r{i}", int(signal + draw.random() > 2.2), i % 3, a, b, c, 4.0))
    return rows


def bin_of(value, cuts):
    if value is None or math.isnan(value):
        return 0
    return 1 + sum(cut <= value for cut in cuts)


def brute_force(bins, labels, weights, settings):
    """Trees and margins by trying every bin, side and feature of every node."""

    def whole(x):
        return round(x * SCALE)

    margins = [0.0] * len(labels)
    trees = []
    for _ in range(settings.trees):
        p = [1 / (1 + math.exp(-m)) for m in margins]
        g = [whole(w * (q - y)) / SCALE for w, q, y in zip(weights, p, labels)]
        h = [whole(w * (q * (1 - q))) / SCALE for w, q in zip(weights, p)]
        tree, nodes = {}, {1: list(range(len(labels)))}
        for depth in range(settings.depth + 1):
            following = {}
            for node, members in nodes.items():
                total_g, total_h = sum(g[i] for i in members), sum(h[i] for i in members)
                tree[node] = -settings.rate * total_g / (total_h + settings.penalty)
                found = []
                for f in range(len(bins[0])):
                    for cut in sorted({bins[i][f] for i in members} - {0}):
                        for side in (True, False):
                            left = [
                                i for i in members
                                if (side if bins[i][f] == 0 else bins[i][f] <= cut)
                            ]
                            if not 0 < len(left) < len(members):
                                continue
                            lg, lh = sum(g[i] for i in left), sum(h[i] for i in left)
                            rg, rh = total_g - lg, total_h - lh
                            if min(lh, rh) < settings.min_child_weight:
                                continue
                            gain = (
                                lg**2 / (lh + settings.penalty)
                                + rg**2 / (rh + settings.penalty)
                                - total_g**2 / (total_h + settings.penalty)
                            )
                            found.append((round(gain, 7), -f, -cut, not side, left))
                best = max(found, default=None, key=lambda x: x[:4])
                if depth == settings.depth or best is None or best[0] <= max(settings.min_gain, 1e-6):
                    for i in members:
                        margins[i] += tree[node]
                    continue
                gain, f, cut, right, left = best
                tree[node] = Split(-f, 1 - cut, not right, gain)
                inside = set(left)
                following[2 * node] = left
                following[2 * node + 1] = [i for i in members if i not in inside]
            nodes = following
        trees.append(tree)
    return trees, margins


@pytest.mark.parametrize(
    "settings",
    [
        Settings(trees=3, depth=3, rate=0.3),
        Settings(trees=2, depth=4, rate=0.5, penalty=0.0, min_child_weight=3.0, min_gain=0.4),
        Settings(trees=12, depth=2, rate=0.2, penalty=4.0),  # beyond one refresh of the margins
    ],
)
def test_trees_equal_brute_force(spark, settings):
    rows = made_up(240, settings.trees)
    frame = spark.createDataFrame(rows, SCHEMA).repartition(5)
    cuts = boosting.bin_cuts(frame, NAMES, 16)
    assert cuts[3] == () and len(cuts[0]) == 9
    bins = [[bin_of(v, c) for v, c in zip(r[3:], cuts)] for r in rows]
    labels = [r[1] for r in rows]
    ratio = labels.count(0) / labels.count(1)
    weights = [ratio if y else 1.0 for y in labels]
    binned = boosting.training_rows(frame, NAMES, cuts).persist()
    assert {r[ID]: r.bins for r in binned.collect()} == {r[0]: b for r, b in zip(rows, bins)}

    (got,) = boosting.grow_models(binned, [(settings, ALL_ROWS)])
    expected, margins = brute_force(bins, labels, weights, settings)
    assert len(got) == settings.trees
    for ours, theirs in zip(got, expected):
        assert ours.keys() == theirs.keys()
        for node, entry in theirs.items():
            if isinstance(entry, Split):
                assert ours[node][:3] == entry[:3]
                assert ours[node].gain == pytest.approx(entry.gain, abs=1e-5)
            else:
                assert ours[node] == pytest.approx(entry, abs=1e-6)
    fitted = boosting.BoostedTrees(NAMES, cuts, got)
    scored = {r[ID]: r.churn_probability for r in boosting.score(fitted, frame).collect()}
    for row, margin in zip(rows, margins):
        assert scored[row[0]] == pytest.approx(1 / (1 + math.exp(-margin)), abs=1e-5)


def test_models_grown_together_equal_models_grown_alone(spark):
    rows = made_up(300, 9)
    frame = spark.createDataFrame(rows, SCHEMA)
    cuts = boosting.bin_cuts(frame, NAMES, 16)
    binned = boosting.training_rows(frame, NAMES, cuts).persist()
    models = [
        (Settings(trees=2, depth=3), 0),
        (Settings(trees=3, depth=2, column_fraction=0.5, row_fraction=0.7), 1),
        (Settings(trees=1, depth=4), ALL_ROWS),
    ]
    together = boosting.grow_models(binned, models)
    alone = [boosting.grow_models(binned, [m])[0] for m in models]
    assert together == alone
    # partitions and their order are of no account, to the last bit
    assert boosting.grow_models(binned.repartition(7), models) == together
    # a model does not see the fold it leaves out
    without = binned.where("fold <> 0")
    assert boosting.grow_models(without, [(models[0][0], ALL_ROWS)])[0] == together[0]


def test_odd_tables(spark):
    few = Settings(trees=2, depth=2)
    none = spark.createDataFrame([], SCHEMA)
    cuts = boosting.bin_cuts(none, NAMES)
    assert cuts == ((), (), (), ())
    (trees,) = boosting.grow_models(boosting.training_rows(none, NAMES, cuts), [(few, ALL_ROWS)])
    assert trees == ({1: 0.0}, {1: 0.0})
    one_class = spark.createDataFrame([(None, 0, 0, 1.0, None, 2.0, None)] * 3, SCHEMA)
    cuts = boosting.bin_cuts(one_class, NAMES)
    (trees,) = boosting.grow_models(boosting.training_rows(one_class, NAMES, cuts), [(few, ALL_ROWS)])
    assert all(set(t) == {1} and t[1] < 0 for t in trees)
    scored = boosting.score(boosting.BoostedTrees(NAMES, cuts, trees), one_class).collect()
    assert [r.prediction for r in scored] == [0, 0, 0]
    unlabelled = one_class.withColumn("is_churned", F.lit(None).cast("int"))
    with pytest.raises(Exception, match="cannot be learnt from"):
        boosting.training_rows(unlabelled, NAMES, cuts).collect()


def test_missing_values_need_no_imputation(spark):
    """The label follows whether a value is missing; one split finds it, whatever its cuts."""
    rows = [(f"c{i}", i % 2, 0, None if i % 2 else float(i % 7), 1.0, 1.0, 1.0) for i in range(200)]
    frame = spark.createDataFrame(rows, SCHEMA)
    cuts = boosting.bin_cuts(frame, NAMES)
    (trees,) = boosting.grow_models(
        boosting.training_rows(frame, NAMES, cuts), [(Settings(trees=1, depth=1), ALL_ROWS)]
    )
    root = trees[0][1]
    assert (root.feature, root.missing_left) == (0, False)
    assert trees[0][2] < 0 < trees[0][3]


def test_wide_frame(spark):
    train, test = split.train_test_split(planted(spark, 1500))
    fitted = boosting.train_boosted_trees(train, settings=Settings(trees=12, depth=4))
    scored = boosting.score(fitted, test)
    assert scored.columns == [ID, "is_churned", "prediction", "churn_probability"]
    assert metrics.roc_auc(scored).first()[0] > 0.9
    gains = boosting.feature_gains(spark, fitted).collect()
    assert {r.feature for r in gains[:2]} == {"calls_total_90d", "ooc_days"}
    assert sum(r.gain for r in gains) == pytest.approx(1.0)
    plan = scored._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan


def test_staged_search_equals_fits_of_their_own(spark):
    train = planted(spark, 400).persist()
    grid = {"trees": (1, 2), "depth": (2,), "min_child_rows": (2,)}
    found = search.staged_search(train, grid, n=2, folds=2, together=4)
    table = {r.candidate: r for r in found.candidates.collect()}
    assert len(table) == 2
    from ebbtide.ml.model import fit_encoders

    frame = split.add_folds(boosting.encoded(train, fit_encoders(train)), 2)
    cuts = boosting.bin_cuts(frame, boosting.FEATURES)
    binned = boosting.training_rows(frame, boosting.FEATURES, cuts).persist()
    for number, candidate in enumerate(search.sample_candidates(grid, 2)):
        settings = search.settings_of(candidate)
        assert settings.min_child_weight == 2
        grown = boosting.grow_models(binned, [(settings, fold) for fold in range(2)])
        own = []
        for fold, trees in enumerate(grown):
            fitted = boosting.BoostedTrees(tuple(boosting.FEATURES), cuts, trees)
            held_out = frame.where(F.col("fold") == fold)
            own.append(metrics.roc_auc(boosting.score(fitted, held_out)).first()[0])
        assert table[number].mean_auc == pytest.approx(sum(own) / 2, abs=1e-9)
    best = max(table.values(), key=lambda r: (r.mean_auc, -r.candidate))
    assert len(found.best.trees) == best.trees
    assert found.candidates.first().candidate == best.candidate
