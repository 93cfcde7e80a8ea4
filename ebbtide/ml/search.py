"""Randomised hyper-parameter search with stratified cross-validation."""

from __future__ import annotations

import random
from collections.abc import Mapping, Sequence
from math import prod
from typing import NamedTuple

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.tuning import CrossValidator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.ml import boosting
from ebbtide.ml.boosting import ALL_ROWS, BoostedTrees, Settings
from ebbtide.ml.model import VECTOR, fit_encoders, gradient_boosted_trees, preparation_stages
from ebbtide.ml.split import add_folds, add_positive_weight
from ebbtide.names import CUSTOMER, FEATURES, LABEL, SCORE, SEARCH_GRID, SEED
from ebbtide.sources.writers import materialise


class SearchResult(NamedTuple):
    best: PipelineModel
    candidates: DataFrame


def sample_candidates(
    grid: Mapping[str, Sequence] = SEARCH_GRID, n: int = 50, seed: int = SEED
) -> list[dict]:
    """n different combinations of the grid; combinations are numbered, not built."""
    size = prod(len(values) for values in grid.values())
    chosen = random.Random(seed).sample(range(size), min(n, size))
    candidates = []
    for number in chosen:
        candidate = {}
        for name, values in grid.items():
            number, place = divmod(number, len(values))
            candidate[name] = values[place]
        candidates.append(candidate)
    return candidates


def candidate_table(
    spark: SparkSession, grid: Mapping[str, Sequence] = SEARCH_GRID, n: int = 50, seed: int = SEED
) -> DataFrame:
    """The sampled candidates as rows, in the order in which the search numbers them."""
    chosen = sample_candidates(grid, n, seed)
    schema = ", ".join(["candidate int", *[f"{k} double" for k in grid]])
    return spark.createDataFrame(
        [(i, *[float(c[k]) for k in grid]) for i, c in enumerate(chosen)], schema
    )


def auc_evaluator() -> BinaryClassificationEvaluator:
    """Exact area under the ROC curve (no binning of the scores)."""
    return BinaryClassificationEvaluator(
        labelCol=LABEL, rawPredictionCol="probability", metricName="areaUnderROC", numBins=0
    )


def randomised_search(
    train: DataFrame,
    grid: Mapping[str, Sequence] = SEARCH_GRID,
    n: int = 50,
    folds: int = 5,
    seed: int = SEED,
    parallelism: int = 4,
    missing: str = "median",
    encoders: PipelineModel | None = None,
) -> SearchResult:
    """Boosted trees over sampled candidates, each scored by its mean AUC over the folds.

    Vectors, weights and folds are written once, outside the folds' loop; every candidate
    then trains on that table. The frame of candidates is small: one row per candidate.

    ``min_gain`` in the grid is a loss reduction summed over rows; Spark's threshold is
    one per row, so it is divided by the rows of ``train``.
    """
    spark = train.sparkSession
    preparation = Pipeline(stages=preparation_stages(train, missing, encoders)).fit(train)
    prepared = add_folds(add_positive_weight(preparation.transform(train)), folds)
    vectors = materialise(prepared.select(CUSTOMER, LABEL, "weight", "fold", VECTOR), "vectors")
    rows = max(vectors.count(), 1)
    learner = gradient_boosted_trees(spark, seed=seed)
    by_name = {
        "trees": learner.maxIter,
        "depth": learner.maxDepth,
        "rate": learner.stepSize,
        "row_fraction": learner.subsamplingRate,
        "column_fraction": learner.featureSubsetStrategy,
        "min_child_rows": learner.minInstancesPerNode,
        "min_gain": learner.minInfoGain,
    }

    def setting(name, value):
        if name == "column_fraction":
            return "all" if value >= 1.0 else str(value)
        return value / rows if name == "min_gain" else value

    candidates = sample_candidates(grid, n, seed)
    maps = [{by_name[k]: setting(k, v) for k, v in c.items()} for c in candidates]
    search = CrossValidator(
        estimator=learner,
        estimatorParamMaps=maps,
        evaluator=auc_evaluator(),
        numFolds=folds,
        foldCol="fold",
        parallelism=parallelism,
        seed=seed,
    )
    fitted = search.fit(vectors)
    results = [
        (i, *[float(c[k]) for k in by_name if k in c], float(auc))
        for i, (c, auc) in enumerate(zip(candidates, fitted.avgMetrics, strict=True))
    ]
    names = [k for k in by_name if k in candidates[0]]
    schema = ", ".join(["candidate int", *[f"{k} double" for k in names], "mean_auc double"])
    table = spark.createDataFrame(results, schema).orderBy(F.col("mean_auc").desc(), "candidate")
    best = PipelineModel(stages=[*preparation.stages, fitted.bestModel])
    return SearchResult(best, table)


class BoostedSearch(NamedTuple):
    best: BoostedTrees
    candidates: DataFrame


def settings_of(candidate: Mapping, seed: int = SEED) -> Settings:
    """A point of the grid as the second-order learner takes it, penalties unchanged."""
    given = {("min_child_weight" if k == "min_child_rows" else k): v for k, v in candidate.items()}
    return Settings(**given, seed=seed)


def staged_search(
    train: DataFrame,
    grid: Mapping[str, Sequence] = SEARCH_GRID,
    n: int = 50,
    folds: int = 5,
    seed: int = SEED,
    together: int = 20,
    encoders: PipelineModel | None = None,
) -> BoostedSearch:
    """Second-order trees over sampled candidates, each scored by its mean AUC over the folds.

    Bins, weights and folds are written once. Candidates that differ only in the number of
    trees are one fit, scored after each of their numbers: a tree depends on those before it
    alone. All folds of a fit grow in the same jobs, and up to ``together`` models do (at
    least the folds of one fit), which bounds the margins a row carries. Cuts and category
    codes are learnt from all of ``train``, without its labels. The best candidate (of equal
    ones the first) is fitted on all rows.
    """
    spark = train.sparkSession
    encoders = fit_encoders(train) if encoders is None else encoders
    frame = boosting.encoded(train, encoders)
    cuts = boosting.bin_cuts(frame, FEATURES)
    rows = boosting.training_rows(add_folds(frame, folds), FEATURES, cuts)
    binned = materialise(rows, "bins")

    candidates = sample_candidates(grid, n, seed)
    asked = [settings_of(c, seed) for c in candidates]
    longest: dict[Settings, int] = {}
    for settings in asked:
        fit = settings._replace(trees=0)
        longest[fit] = max(longest.get(fit, 0), settings.trees)
    fits = [fit._replace(trees=trees) for fit, trees in longest.items()]

    grown: dict[Settings, list] = {}
    at_once = max(1, together // folds)
    for start in range(0, len(fits), at_once):
        batch = fits[start : start + at_once]
        models = [(fit, fold) for fit in batch for fold in range(folds)]
        for (fit, _), trees in zip(models, boosting.grow_models(binned, models), strict=True):
            grown.setdefault(fit._replace(trees=0), []).append(trees)

    def held_out(settings: Settings) -> list[float]:
        """The candidate's AUC on each fold, by the trees that have not seen it."""
        by_fold = [t[: settings.trees] for t in grown[settings._replace(trees=0)]]
        return [
            auc_evaluator().setRawPredictionCol(SCORE).evaluate(
                binned.where(F.col("fold") == fold).select(
                    LABEL, boosting.probability(trees).alias(SCORE)
                )
            )
            for fold, trees in enumerate(by_fold)
        ]

    means = [sum(scores) / folds for scores in map(held_out, asked)]
    names = list(grid)
    schema = ", ".join(["candidate int", *[f"{k} double" for k in names], "mean_auc double"])
    results = [
        (i, *[float(c[k]) for k in names], float(mean))
        for i, (c, mean) in enumerate(zip(candidates, means, strict=True))
    ]
    table = spark.createDataFrame(results, schema).orderBy(F.col("mean_auc").desc(), "candidate")
    best = asked[max(range(len(asked)), key=lambda i: (means[i], -i))]
    (trees,) = boosting.grow_models(binned, [(best, ALL_ROWS)])
    return BoostedSearch(BoostedTrees(tuple(FEATURES), cuts, trees, encoders), table)
