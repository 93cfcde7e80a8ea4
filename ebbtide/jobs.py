"""The two end-to-end jobs: train a churn model, and score customers with it.

Each stage writes a table the next one reads. That cuts lineage at a place every
executor can reach, so a lost executor costs the tasks it ran and not the features.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from typing import NamedTuple

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.ml.metrics import classification_metrics, roc_auc
from ebbtide.ml.model import (
    feature_importances,
    fit_encoders,
    has_checkpoint_dir,
    load_model,
    save_model,
    score,
    train_trees,
)
from ebbtide.ml.split import add_split
from ebbtide.names import (
    CUSTOMER,
    EXPERIMENT,
    HIGH_RISK_THRESHOLD,
    HIGH_RISK_TOP_N,
    LABEL,
    SCORE,
    SEED,
    TEST_FRACTION,
)
from ebbtide.operators.anchors import reference_dates
from ebbtide.plans.features import inference_features, training_features
from ebbtide.plans.reports import high_risk_customers
from ebbtide.sources.readers import Tables, load_scoring_tables, load_tables
from ebbtide.sources.writers import log_run, write_csv, write_features


class TrainingResult(NamedTuple):
    model: PipelineModel
    metrics: dict[str, float]
    rows: int
    features: DataFrame
    scored_test: DataFrame


def outputs_under(folder: str) -> dict[str, str]:
    """Default output locations below a shared folder."""
    names = (
        "anchors",
        "features",
        "split",
        "checkpoints",
        "scored_test",
        "model",
        "feature_importance",
        "runs",
        "scores",
        "predictions",
        "high_risk",
    )
    return {name: f"{folder.rstrip('/')}/{name}" for name in names}


def beside(outputs: Mapping[str, str], name: str) -> str:
    """The place of an intermediate table, next to the feature table or predictions if not given."""
    main = outputs.get("features") or outputs["predictions"]
    return outputs.get(name, f"{main.rstrip('/')}_{name}")


def train_job(
    spark: SparkSession,
    inputs: Mapping[str, str] | Tables,
    outputs: Mapping[str, str],
    test_fraction: float = TEST_FRACTION,
    seed: int = SEED,
    missing: str = "median",
    experiment: str = EXPERIMENT,
    unseen: str = "error",
    checkpoint_dir: str | None = None,
    **settings,
) -> TrainingResult:
    """Features, split, boosted trees, test metrics, model, importances and run log.

    ``inputs`` are paths keyed cease, customer_info, calls and usage, or loaded tables;
    ``settings`` go to the learner (trees, depth, rate, ...). A category unseen in
    training stops a scoring job; ``unseen='keep'`` gives all such one further code.

    Boosting cuts its lineage in the cluster's checkpoint folder. Where the session names
    none, it is ``checkpoint_dir`` (shared storage), by default beside the outputs.
    """
    if not has_checkpoint_dir(spark):
        spark.sparkContext.setCheckpointDir(checkpoint_dir or beside(outputs, "checkpoints"))
    tables = inputs if isinstance(inputs, Tables) else load_tables(spark, inputs)

    reference_dates(tables.cease, tables.customer_info).write.mode("overwrite").parquet(
        outputs["anchors"]
    )
    anchors = spark.read.parquet(outputs["anchors"])
    rows = write_features(training_features(*tables, anchors=anchors), outputs["features"])
    features = spark.read.parquet(outputs["features"])

    # the cuts of the split take passes of their own, so its result is a table as well
    split_path = beside(outputs, "split")
    add_split(features, test_fraction, seed).write.mode("overwrite").parquet(split_path)
    marked = spark.read.parquet(split_path)
    train = marked.where(~F.col("is_test")).drop("is_test")
    test = marked.where("is_test").drop("is_test")
    encoders = fit_encoders(features, handle_invalid=unseen)
    model = train_trees(train, missing, encoders, seed=seed, **settings)
    save_model(model, outputs["model"])

    score(model, test).write.mode("overwrite").parquet(outputs["scored_test"])
    scored = spark.read.parquet(outputs["scored_test"])
    metrics = classification_metrics(scored).first().asDict() | roc_auc(scored).first().asDict()

    write_csv(feature_importances(spark, model), outputs["feature_importance"])
    log_run(
        spark,
        outputs["runs"],
        run_id=uuid.uuid4().hex,
        experiment=experiment,
        params={
            "seed": seed,
            "test_fraction": test_fraction,
            "missing": missing,
            "unseen": unseen,
            "rows": rows,
            **settings,
        },
        metrics=metrics,
        artifacts={k: outputs[k] for k in ("model", "feature_importance", "features")},
    )
    return TrainingResult(model, metrics, rows, features, scored)


def scoring_job(
    spark: SparkSession,
    inputs: Mapping[str, str] | Tables,
    outputs: Mapping[str, str],
    model: PipelineModel | None = None,
    threshold: float = HIGH_RISK_THRESHOLD,
    top: int = HIGH_RISK_TOP_N,
) -> DataFrame:
    """Score every customer and write predictions and the high-risk list as CSV."""
    tables = inputs if isinstance(inputs, Tables) else load_scoring_tables(spark, inputs)
    if model is None:
        model = load_model(outputs["model"])
    features = inference_features(tables.customer_info, tables.calls, tables.usage)
    # a sorted write samples its input first, so scores are written before they are sorted
    scores_path = beside(outputs, "scores")
    score(model, features.drop(LABEL)).select(CUSTOMER, SCORE).write.mode("overwrite").parquet(
        scores_path
    )
    scores = spark.read.parquet(scores_path)
    write_csv(scores.orderBy(F.col(SCORE).desc(), CUSTOMER), outputs["predictions"])
    write_csv(high_risk_customers(scores, threshold, top), outputs["high_risk"])
    return spark.read.schema(scores.schema).option("header", True).csv(outputs["predictions"])
