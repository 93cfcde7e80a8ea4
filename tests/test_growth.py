"""What a fit reads and sends as its table grows."""

import math
import os
import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide import catalog
from ebbtide.ml import boosting
from ebbtide.ml.boosting import ALL_ROWS, Settings, Split
from ebbtide.plans import features
from ebbtide.sources.order_views import order_views
from ebbtide.sources.writers import hashed_joins
from test_boosting import NAMES, SCHEMA, made_up
from test_learning import ID, planted


def binned_rows(spark, n):
    frame = spark.createDataFrame(made_up(n, 5), SCHEMA)
    return boosting.training_rows(frame, NAMES, boosting.bin_cuts(frame, NAMES, 16))


def test_a_task_sends_a_row_per_cell_however_many_rows_it_reads(spark, monkeypatch):
    """The sums before their shuffle: before, every row was unfolded and grouped by hashing."""
    sent = []
    cells = boosting._cells

    def counting(growing, before, bins):
        sent.append((bins, cells(growing, before, bins)))
        return sent[-1][1]

    monkeypatch.setattr(boosting, "_cells", counting)
    boosting.grow_models(binned_rows(spark, 200), [(Settings(trees=1, depth=1), ALL_ROWS)])
    bins, add_up = sent[0]
    batch = pa.RecordBatch.from_pydict(
        {
            "is_churned": [1, 0, 0],
            "weight": [float(2**33), 1.0, 7.0],
            "margins": [[0.0]] * 3,
            "taken": [[1], [1], [0]],
            "bins": [[0, 1, 2, 1], [0, 2, 2, 1], [1, 1, 1, 1]],
        }
    )
    got = pa.Table.from_batches(add_up(iter([batch] * 3))).to_pylist()
    assert len(got) == 5 <= sum(bins)
    assert sum(r["c"] for r in got) == 3 * 2 * 4  # the third row is in no sample
    both = [r for r in got if r["feature"] == 0]
    half, quarter = boosting.SCALE // 2, boosting.SCALE // 4
    expected = (0, 3 * half * (1 - 2**33), 3 * quarter * (1 + 2**33), 6)
    assert [(r["bin"], r["g"], r["h"], r["c"]) for r in both] == [expected]


def test_nodes_beyond_one_job(spark, monkeypatch):
    binned = binned_rows(spark, 300).persist()
    models = [
        (Settings(trees=2, depth=3, rate=0.3), ALL_ROWS),
        (Settings(trees=1, depth=3, column_fraction=0.5, row_fraction=0.7), 1),
    ]
    whole = boosting.grow_models(binned, models)
    jobs = []
    level = boosting._level
    monkeypatch.setattr(boosting, "NODES", 2)
    monkeypatch.setattr(boosting, "_level", lambda *a: (jobs.append(sum(len(n) for *_, n, _ in a[2].values())), level(*a))[1])
    assert boosting.grow_models(binned, models) == whole
    assert max(jobs) == 2 and len(jobs) > 6


def test_features_are_derived_once_for_the_split(spark, sf001, monkeypatch):
    made = {}
    materialise = catalog.materialise

    def noted(df, label):
        made[label] = df._jdf.queryExecution().optimizedPlan().toString()
        return materialise(df, label)

    monkeypatch.setattr(catalog, "materialise", noted)
    monkeypatch.setattr(catalog, "_kept", lambda spark, key, make: make())
    marked = catalog._split_features(spark, sf001)
    assert "l_shipdate" in made["features"] and "l_shipdate" not in made["split"]
    assert marked.select(F.count_if("is_test")).first()[0] > 0  # nothing it needs was removed
    assert not any("/features" in os.path.dirname(f) for f in marked.inputFiles())


def joined_plan(spark):
    """The plan a shuffled join ends with."""
    rows = spark.range(20_000)
    joined = rows.join(rows.select((F.col("id") * 2).alias("id"), F.lit(1).alias("b")), "id")
    joined.collect()
    return joined._jdf.queryExecution().executedPlan().toString()


def test_features_hash_the_smaller_side_of_a_shuffled_join(spark):
    """Before, both sides of every join of the features were sorted."""
    key = "spark.sql.autoBroadcastJoinThreshold"
    other = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    setting = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    usual, set_before = spark.conf.get(key), spark.conf.get(setting)
    try:
        spark.conf.set(key, "-1")
        spark.conf.set(other, "-1")
        assert "SortMergeJoin" in joined_plan(spark).split("Initial Plan")[0]
        with hashed_joins(spark):
            found = joined_plan(spark).split("Initial Plan")[0]
        assert "ShuffledHashJoin" in found and "SortMergeJoin" not in found
    finally:
        spark.conf.set(key, usual)
        spark.conf.unset(other)
    assert spark.conf.get(setting) == set_before


def test_scoring_features_are_derived_once(spark, sf001):
    """Ranking samples the scores before it sorts them, so it read the features' joins twice."""
    marked = catalog._scoring_features(spark, sf001)
    assert marked is catalog._scoring_features(spark, sf001)
    assert "Join" not in marked._jdf.queryExecution().executedPlan().toString()
    want = features.inference_features(*order_views(spark, sf001)[1:])
    assert sorted(map(str, marked.collect())) == sorted(map(str, want.collect()))


def fitted_by(spark, monkeypatch, name):
    """What the query hands the learner: rows of the training part, settings; few trees grow here."""
    rows = planted(spark, 60)
    marked = rows.withColumn("is_test", F.expr(f"int(substr({ID}, 2)) % 3 = 0")).persist()
    asked = []
    train = boosting.train_boosted_trees

    def noted(part, encoders=None, settings=Settings()):
        asked.append((part.count(), settings))
        return train(part, encoders, settings._replace(trees=2, depth=1))

    monkeypatch.setattr(catalog, "_split_features", lambda spark, folder: marked)
    monkeypatch.setattr(catalog, "_kept", lambda spark, key, make: make())
    monkeypatch.setattr(boosting, "train_boosted_trees", noted)
    found = catalog.all_queries()[name](spark, "none").collect()
    return found, asked, marked.where("not is_test").count(), marked.where("is_test").count()


PUBLISHED = dict(trees=100, depth=6, rate=0.1, row_fraction=1.0, column_fraction=1.0, min_gain=0.0)


def test_second_order_metrics_are_of_the_published_fit(spark, monkeypatch):
    """Before, ten trees of depth four were fitted."""
    found, asked, train, _ = fitted_by(spark, monkeypatch, "m05_second_order_metrics")
    assert len(found) == 1
    ((rows, settings),) = asked
    assert rows == train and PUBLISHED.items() <= settings._asdict().items()


def test_second_order_scores_are_of_the_published_fit(spark, monkeypatch):
    """Before, ten trees of depth four scored the test part."""
    found, asked, train, test = fitted_by(spark, monkeypatch, "m05_second_order_scores_checked")
    assert len(found) == test and all(r.valid and r.consistent for r in found)
    ((rows, settings),) = asked
    assert rows == train and PUBLISHED.items() <= settings._asdict().items()


def test_a_level_has_one_shuffle(spark):
    rows = spark.createDataFrame([(None, 1, 1.0, 0, b"", b"")], f"{ID} string, is_churned int, weight double, fold int, bins binary, margins binary")
    growing = {0: (Settings(), ALL_ROWS, {}, {1}, [0])}
    plan = boosting._level(rows, [[]], growing, 0, [2])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Sort" not in plan


def test_many_deep_trees_score_as_walked(spark):
    """As nested conditions, a hundred deep trees were a plan of some 20 s and too long to compile."""
    draw = random.Random(4)

    def grown(tree, node, depth):
        if depth == 6 or (depth and draw.random() < 0.2):
            tree[node] = draw.uniform(-0.3, 0.3)
            return tree
        tree[node] = Split(draw.randrange(5), draw.randint(1, 9), draw.random() < 0.5, 1.0)
        return grown(grown(tree, 2 * node, depth + 1), 2 * node + 1, depth + 1)

    trees = [grown({}, 1, 0) for _ in range(100)] + [{1: 0.125}]
    rows = [(i, [draw.randint(0, 9) for _ in range(5)]) for i in range(50)]
    expected = {}
    for i, bins in rows:
        margin = 0.0
        for tree in trees:
            node = 1
            while isinstance(split := tree[node], Split):
                place = bins[split.feature]
                left = place < split.bin and (place > 0 or split.missing_left)
                node = 2 * node + (not left)
            margin += tree[node]
        expected[i] = 1 / (1 + math.exp(-margin))
    scored = spark.createDataFrame(rows, "id int, bins array<int>").select("id", boosting.probability(trees).alias("p"))
    assert {r[0]: r[1] for r in scored.collect()} == pytest.approx(expected, abs=1e-15)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in plan  # the trees are a constant, not read anew for each row
    assert spark.createDataFrame(rows, "id int, bins array<int>").select(boosting.probability([])).first()[0] == 0.5
