import pytest
from pyspark.sql import functions as F

from ebbtide.ml import metrics, model, search, split
from ebbtide.names import CATEGORICAL_FEATURES, FEATURES, NUMERIC_FEATURES
from ebbtide.operators.running import running_totals

ID = "unique_customer_identifier"


def scored_frame(spark, rows):
    """(label, prediction, probability) rows with generated identifiers."""
    return spark.createDataFrame(
        [(f"c{i}", *r) for i, r in enumerate(rows)],
        f"{ID} string, is_churned int, prediction int, churn_probability double",
    )


def planted(spark, n=2000, missing=True):
    """A wide frame whose label follows two features, with missing values in others."""
    base = spark.range(0, n, 1, 4).select(
        F.concat(F.lit("c"), F.col("id").cast("string")).alias(ID), "id"
    )
    h = lambda salt: F.pmod(F.xxhash64("id", F.lit(salt)), F.lit(1000)) / 1000
    columns = {c: (h(i) * 10).cast("double") for i, c in enumerate(NUMERIC_FEATURES)}
    if missing:
        columns["usage_drop_pct_28d"] = F.when(h("m") > 0.5, h("u") * 100)
        columns["speed_gap"] = F.when(h("g") > 0.2, h("s") * 100)
    for c in CATEGORICAL_FEATURES:
        columns[c] = F.element_at(F.array(F.lit("a"), F.lit("b"), F.lit(None)), (h(c) * 2.99 + 1).cast("int"))
    signal = columns["calls_total_90d"] + columns["ooc_days"] + 2 * h("noise")
    columns["is_churned"] = (signal > 14).cast("int")
    return base.withColumns(columns).select(ID, *FEATURES, "is_churned")


@pytest.fixture(scope="module")
def frame(spark):
    df = planted(spark).persist()
    df.count()
    return df


# --- encoding ---


def test_labels_are_encoded_in_text_order(spark):
    rows = [("1", "b"), ("2", None), ("3", "B"), ("4", "a"), ("5", "b")]
    df = spark.createDataFrame(rows, f"{ID} string, technology string")
    got = {r[ID]: r.technology for r in model.label_encode(df, ["technology"]).collect()}
    assert got == {"3": 0, "2": 1, "4": 2, "1": 3, "5": 3}  # B, None, a, b


@pytest.mark.parametrize("handling", ["error", "keep"])
def test_unseen_labels(spark, handling):
    from pyspark.ml import Pipeline

    seen = spark.createDataFrame([("x",), ("y",)], "technology string")
    new = spark.createDataFrame([("z",)], "technology string")
    fitted = Pipeline(stages=model.encoder_stages(["technology"], handling)).fit(seen)
    if handling == "keep":
        assert fitted.transform(new).first().technology_code == 2
    else:
        with pytest.raises(Exception, match="(?i)unseen label"):
            fitted.transform(new).collect()


# --- split, folds, weights ---


def test_split_is_stratified_and_repeatable(frame):
    marked = split.add_split(frame.select(ID, "is_churned"))
    shares = marked.groupBy("is_churned").agg(F.avg(F.col("is_test").cast("int")).alias("s"))
    assert all(abs(r.s - 0.2) < 0.01 for r in shares.collect())
    chosen = {r[ID] for r in marked.where("is_test").collect()}
    again = split.add_split(frame.select(ID, "is_churned").repartition(13))
    assert {r[ID] for r in again.where("is_test").collect()} == chosen
    other = split.add_split(frame.select(ID, "is_churned"), seed=7)
    assert {r[ID] for r in other.where("is_test").collect()} != chosen


@pytest.mark.parametrize("spread", [1, 1 << 10, 1 << 32])
def test_class_quantiles_are_exact(spark, spread):
    """Also where many rows share a position or all lie in one upper half."""
    import random

    rng = random.Random(spread)
    rows = [(int(rng.random() < 0.2), rng.randrange(spread)) for _ in range(500)]
    df = spark.createDataFrame(rows, "is_churned int, _position bigint")
    fractions = [0.0, 0.2, 0.5, 0.8, 1.0]
    got = {r._class: r._cuts for r in split.class_quantiles(df, fractions).collect()}
    for label in (0, 1):
        values = sorted(v for c, v in rows if c == label)
        n = len(values)
        ranks = [max(1, -int(-f * n // 1)) for f in fractions]
        assert got[label] == [values[k - 1] for k in ranks]


def test_parts_of_a_split_never_overlap(frame):
    train, test = split.train_test_split(frame.select(ID, "is_churned"))
    ids = [r[ID] for r in train.collect()] + [r[ID] for r in test.collect()]
    assert len(ids) == len(set(ids)) == frame.count()


def test_folds_hold_equal_shares_of_each_class(frame):
    folds = split.add_folds(frame.select(ID, "is_churned"), 4)
    counts = folds.groupBy("is_churned", "fold").count().collect()
    sizes = frame.groupBy("is_churned").count().collect()
    sizes = {r.is_churned: r["count"] for r in sizes}
    assert {r.fold for r in counts} == {0, 1, 2, 3}
    assert all(abs(r["count"] - sizes[r.is_churned] / 4) <= 2 for r in counts)


def test_rows_without_identifier_are_kept_as_one_group(spark):
    rows = [(f"c{i}" if i else None, i % 2) for i in range(101)] + [(None, 0)]
    df = spark.createDataFrame(rows, f"{ID} string, is_churned int")
    train, test = split.train_test_split(df)
    assert train.count() + test.count() == 102
    assert {train.where(f"{ID} is null").count(), test.where(f"{ID} is null").count()} == {0, 2}
    folds = split.add_folds(df).where(f"{ID} is null").select("fold").collect()
    assert len(folds) == 2 and len({r.fold for r in folds}) == 1


def test_weights(spark):
    df = spark.createDataFrame([(f"c{i}", int(i < 2)) for i in range(8)], f"{ID} string, is_churned int")
    counts = split.class_counts(df).first()
    assert tuple(counts) == (6, 2, 3.0)
    weights = {r.is_churned: r.weight for r in split.add_positive_weight(df).collect()}
    assert weights == {1: 3.0, 0: 1.0}
    balanced = {r.is_churned: r.weight for r in split.add_balanced_weight(df).collect()}
    assert balanced == {1: 2.0, 0: pytest.approx(8 / 12)}


# --- metrics ---


def test_metrics_by_hand(spark):
    rows = [(1, 1, 0.9)] * 3 + [(1, 0, 0.4)] + [(0, 1, 0.6)] * 2 + [(0, 0, 0.1)] * 4
    scored = scored_frame(spark, rows)
    got = metrics.classification_metrics(scored).first()
    assert got.accuracy == pytest.approx(0.7)
    assert got.precision == pytest.approx(0.6)
    assert got.recall == pytest.approx(0.75)
    assert got.f1_score == pytest.approx(2 * 0.6 * 0.75 / 1.35)
    matrix = {(r.actual, r.predicted): r["count"] for r in metrics.confusion_matrix(scored).collect()}
    assert matrix == {(1, 1): 3, (1, 0): 1, (0, 1): 2, (0, 0): 4}
    report = {r["class"]: r for r in metrics.classification_report(scored).collect()}
    assert list(report) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert (report["0"].support, report["1"].support) == (6, 4)
    assert report["0"].precision == pytest.approx(0.8)
    assert report["macro avg"].recall == pytest.approx((0.75 + 4 / 6) / 2)
    assert report["weighted avg"].recall == pytest.approx(0.7)
    assert (report["accuracy"].f1_score, report["accuracy"].precision) == (pytest.approx(0.7), None)


def test_metrics_without_positive_predictions(spark):
    scored = scored_frame(spark, [(1, 0, 0.1), (0, 0, 0.2)])
    assert tuple(metrics.classification_metrics(scored).first()) == (0.5, 0.0, 0.0, 0.0)


def brute_auc(rows):
    won = [
        (a > b) + 0.5 * (a == b)
        for y, _, a in rows
        if y == 1
        for z, _, b in rows
        if z == 0
    ]
    return sum(won) / len(won)


def brute_roc(rows, drop):
    positives = sum(y for y, _, _ in rows)
    points, tp, fp = [], 0, 0
    for t in sorted({s for _, _, s in rows}, reverse=True):
        tp += sum(1 for y, _, s in rows if s == t and y == 1)
        fp += sum(1 for y, _, s in rows if s == t and y == 0)
        points.append((t, fp, tp))
    if drop and len(points) > 2:
        keep = [points[0]]
        for a, b, c in zip(points, points[1:], points[2:], strict=False):
            if (c[1] - b[1], c[2] - b[2]) != (b[1] - a[1], b[2] - a[2]):
                keep.append(b)
        points = [*keep, points[-1]]
    n = len(rows) - positives
    return [(float("inf"), 0.0, 0.0)] + [(t, f / n, p / positives) for t, f, p in points]


@pytest.mark.parametrize("distinct", [3, 40, 5000])
def test_roc_against_brute_force(spark, distinct):
    import random

    rng = random.Random(distinct)
    rows = []
    for _ in range(400):
        y = int(rng.random() < 0.3)
        s = rng.randrange(distinct) / distinct
        rows.append((y, int(s > 0.5), min(1.0, s + 0.1 * y)))
    scored = scored_frame(spark, rows)
    assert metrics.roc_auc(scored).first()[0] == pytest.approx(brute_auc(rows))
    evaluated = search.auc_evaluator().setRawPredictionCol("churn_probability").evaluate(scored)
    assert evaluated == pytest.approx(brute_auc(rows))
    for drop in (True, False):
        curve = metrics.roc_curve(scored, drop_intermediate=drop).collect()
        got = sorted(((r.threshold, r.fpr, r.tpr) for r in curve), reverse=True)
        expected = brute_roc(rows, drop)
        assert len(got) == len(expected)
        for g, e in zip(got, expected, strict=True):
            assert g == pytest.approx(e)


@pytest.mark.parametrize("ranges", [1, 2, 7, 256, None])
def test_running_totals_do_not_depend_on_the_ranges(spark, ranges):
    values = [(float(i * i % 101) + i / 1000, i % 5, i % 3) for i in range(300)]
    df = spark.createDataFrame(values, "s double, p int, n int").repartition(5)
    got = {r.s: r for r in running_totals(df, "s", ["p", "n"], ranges).collect()}
    ordered = sorted(values, reverse=True)
    for place, (s, _, _) in enumerate(ordered):
        above, following = ordered[:place], ordered[place + 1 : place + 2]
        assert got[s].above_p == sum(p for _, p, _ in above)
        assert got[s].above_n == sum(n for _, _, n in above)
        assert got[s].next_p == (following[0][1] if following else None)
        assert got[s].total_n == sum(n for _, _, n in values)
    assert running_totals(df.limit(0), "s", ["p", "n"], ranges).count() == 0


def test_spot_check_is_repeatable(spark):
    scored = scored_frame(spark, [(i % 2, i % 3 % 2, i / 50) for i in range(50)])
    first = metrics.spot_check(scored).collect()
    assert len(first) == 10
    assert metrics.spot_check(scored.repartition(7)).collect() == first
    for r in first:
        assert r.prediction_status == (
            "Correct" if r.actual_churn == r.predicted_churn else "Incorrect"
        )


# --- learners ---


@pytest.fixture(scope="module")
def parts(frame):
    train, test = split.train_test_split(frame)
    return train.persist(), test.persist()


@pytest.fixture(scope="module")
def trees(parts):
    return model.train_trees(parts[0], trees=10, depth=4)


def auc_of(fitted, test):
    return metrics.roc_auc(model.score(fitted, test)).first()[0]


def test_trees_find_the_planted_signal(trees, parts):
    assert auc_of(trees, parts[1]) > 0.9


def test_importances_rank_the_planted_features_first(spark, trees):
    got = model.feature_importances(spark, trees).collect()
    assert {r.feature for r in got[:2]} == {"calls_total_90d", "ooc_days"}
    assert [r.importance for r in got] == sorted((r.importance for r in got), reverse=True)
    assert sum(r.importance for r in got) == pytest.approx(1.0)
    assert {r.feature for r in got} >= set(FEATURES)
    assert model.feature_importances(spark, trees, top=10).collect() == got[:10]


def test_saved_model_gives_the_same_scores(spark, trees, parts, tmp_path):
    path = str(tmp_path / "model")
    model.save_model(trees, path)
    again = model.predict_churn(model.load_model(path), parts[1]).collect()
    assert again == model.predict_churn(trees, parts[1]).collect()


def test_missing_model_is_an_error(tmp_path, spark):
    with pytest.raises(FileNotFoundError, match="train one first"):
        model.load_model(str(tmp_path / "nothing"))


def test_predictions_are_sorted_and_need_no_label(trees, parts):
    with_label = model.predict_churn(trees, parts[1]).collect()
    without = model.predict_churn(trees, parts[1].drop("is_churned")).collect()
    assert with_label == without
    assert [r.churn_probability for r in without] == sorted(
        (r.churn_probability for r in without), reverse=True
    )
    assert without[0].asDict().keys() == {ID, "churn_probability"}


def test_encoders_know_categories_of_the_test_part(spark, parts):
    train, test = parts
    rare = test.withColumn("technology", F.lit("z"))
    encoders = model.fit_encoders(train.unionByName(rare))
    fitted = model.train_trees(train, encoders=encoders, trees=1, depth=2)
    assert model.score(fitted, rare).count() == test.count()
    with pytest.raises(Exception, match="(?i)unseen label"):
        model.score(fitted, test.withColumn("technology", F.lit("y"))).collect()


def test_missing_values_as_zero(parts):
    fitted = model.train_trees(parts[0], missing="zero", trees=3, depth=3)
    assert auc_of(fitted, parts[1]) > 0.8
    with pytest.raises(ValueError, match="unknown way"):
        model.preparation_stages(parts[0], "mean")


def test_a_wholly_missing_number_and_a_missing_label(frame):
    empty = frame.withColumn("speed", F.lit(None).cast("double"))
    assert model.medians(empty)["speed"] == 0.0
    assert model.score(model.train_trees(empty, trees=1, depth=2), empty).count() == frame.count()
    unlabelled = frame.select(ID, F.when(F.col(ID) != "c7", F.col("is_churned")).alias("is_churned"))
    with pytest.raises(Exception, match="without is_churned"):
        split.add_split(unlabelled).collect()


def test_logistic_regression(parts):
    fitted = model.train_logistic(parts[0])
    assert auc_of(fitted, parts[1]) > 0.9


def test_candidates_are_different_points_of_the_grid():
    candidates = search.sample_candidates()
    assert len(candidates) == len({tuple(c.items()) for c in candidates}) == 50
    assert candidates == search.sample_candidates()
    everything = search.sample_candidates({"a": (1, 2), "b": (3, 4, 5)}, n=100)
    assert sorted((c["a"], c["b"]) for c in everything) == [
        (a, b) for a in (1, 2) for b in (3, 4, 5)
    ]
    sizes = [len(v) for v in search.SEARCH_GRID.values()]
    product = 1
    for s in sizes:
        product *= s
    assert product == 5184


def test_search_returns_a_usable_best_model(parts):
    grid = {
        "trees": (2, 4),
        "depth": (2, 3),
        "column_fraction": (0.7, 1.0),
        "row_fraction": (0.8,),
        "min_child_rows": (3,),
        "min_gain": (0.2,),
    }
    found = search.randomised_search(parts[0], grid, n=2, folds=2, parallelism=2)
    table = found.candidates.collect()
    assert len(table) == 2
    assert table[0].mean_auc >= table[1].mean_auc > 0.6
    assert auc_of(found.best, parts[1]) > 0.7
