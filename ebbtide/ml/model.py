"""Feature preparation, learners, scoring and persistence on Spark ML.

A fitted model is one ``PipelineModel``: category codes, imputation and classifier
travel together, so scoring needs no separate encoder files.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import SQLTransformer, StringIndexer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.ml.split import add_balanced_weight, add_positive_weight
from ebbtide.names import (
    CATEGORICAL_FEATURES,
    CUSTOMER,
    FEATURES,
    LABEL,
    MISSING_LABEL,
    NUMERIC_FEATURES,
    SCORE,
    SEED,
)

VECTOR = "features"
# numeric features that can be missing; any_dd_cancel_60d is so only without a snapshot
NULLABLE_FEATURES = (
    "contract_dd_cancels",
    "dd_cancel_60_day",
    "ooc_days",
    "any_dd_cancel_60d",
    "usage_drop_pct_28d",
    "speed",
    "line_speed",
    "speed_gap",
    "speed_gap_pct",
)


def encoder_stages(
    columns: Sequence[str] = CATEGORICAL_FEATURES, handle_invalid: str = "error"
) -> list:
    """Stages giving each category its rank among the sorted labels, as <column>_code.

    A missing category is encoded as the label "None". A label unseen in fitting is an
    error; ``handle_invalid='keep'`` gives it one further code.
    """
    texts = ", ".join(f"coalesce({c}, '{MISSING_LABEL}') AS {c}_text" for c in columns)
    codes = ", ".join(f"CAST({c}_index AS INT) AS {c}_code" for c in columns)
    return [
        SQLTransformer(statement=f"SELECT *, {texts} FROM __THIS__"),
        StringIndexer(
            inputCols=[f"{c}_text" for c in columns],
            outputCols=[f"{c}_index" for c in columns],
            stringOrderType="alphabetAsc",
            handleInvalid=handle_invalid,
        ),
        # the cast also drops the nominal-attribute metadata: codes are plain numbers
        SQLTransformer(statement=f"SELECT *, {codes} FROM __THIS__"),
    ]


def fit_encoders(
    features: DataFrame,
    columns: Sequence[str] = CATEGORICAL_FEATURES,
    handle_invalid: str = "error",
) -> PipelineModel:
    """Learn the category codes, from all labelled customers before they are split."""
    return Pipeline(stages=encoder_stages(columns, handle_invalid)).fit(features)


def label_encode(
    df: DataFrame, columns: Sequence[str] = CATEGORICAL_FEATURES
) -> DataFrame:
    """Replace each category by its integer code."""
    encoded = fit_encoders(df, columns).transform(df)
    codes = {c: F.col(f"{c}_code") for c in columns}
    return encoded.withColumns(codes).select(df.columns)


def medians(train: DataFrame) -> dict[str, float]:
    """The median of each numeric feature in one pass; 0 for one that is wholly missing."""
    found = train.agg(
        *[
            F.percentile_approx(F.col(c).cast("double"), 0.5, 10_000).alias(c)
            for c in NUMERIC_FEATURES
        ]
    ).first()
    return {c: 0.0 if found[c] is None else found[c] for c in NUMERIC_FEATURES}


def preparation_stages(
    train: DataFrame, missing: str = "median", encoders: PipelineModel | None = None
) -> list:
    """Stages from the wide frame to one feature vector.

    Without fitted ``encoders`` the category codes are learned with the rest. Spark's
    learners refuse missing numbers. ``missing='median'`` fills them with the column's
    median in ``train`` and adds a 0/1 column per nullable feature; ``'zero'`` fills with 0.
    """
    codes = [f"{c}_code" for c in CATEGORICAL_FEATURES]
    stages = encoder_stages() if encoders is None else [encoders]
    if missing == "zero":
        filled = ", ".join(
            f"CAST(coalesce({c}, 0) AS DOUBLE) AS {c}_number" for c in NUMERIC_FEATURES
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {filled} FROM __THIS__"))
        inputs = {c: f"{c}_number" for c in NUMERIC_FEATURES}
        indicators = []
    elif missing == "median":
        indicators = [f"{c}_missing" for c in NULLABLE_FEATURES]
        flags = ", ".join(
            f"CAST({c} IS NULL AS INT) AS {c}_missing" for c in NULLABLE_FEATURES
        )
        filled = ", ".join(
            f"coalesce(CAST({c} AS DOUBLE), CAST('{value!r}' AS DOUBLE)) AS {c}_number"
            for c, value in medians(train).items()
        )
        stages.append(SQLTransformer(statement=f"SELECT *, {flags}, {filled} FROM __THIS__"))
        inputs = {c: f"{c}_number" for c in NUMERIC_FEATURES}
    else:
        raise ValueError(f"unknown way to treat missing values: {missing!r}")
    inputs |= dict(zip(CATEGORICAL_FEATURES, codes, strict=True))
    stages.append(
        VectorAssembler(inputCols=[inputs[c] for c in FEATURES] + indicators, outputCol=VECTOR)
    )
    return stages


def has_checkpoint_dir(spark: SparkSession) -> bool:
    """Whether the cluster names a shared checkpoint folder in spark.checkpoint.dir."""
    return bool(spark.conf.get("spark.checkpoint.dir", "")) or (
        spark.sparkContext.getCheckpointDir() is not None
    )


def gradient_boosted_trees(
    spark: SparkSession,
    trees: int = 100,
    depth: int = 6,
    rate: float = 0.1,
    row_fraction: float = 1.0,
    column_fraction: float = 1.0,
    min_child_rows: int = 1,
    min_gain: float = 0.0,
    seed: int = SEED,
) -> GBTClassifier:
    """Boosted trees with row weights.

    Boosting chains one job after another; where the cluster names a checkpoint
    folder, the chain's lineage is cut every ten trees.
    """
    return GBTClassifier(
        featuresCol=VECTOR,
        labelCol=LABEL,
        weightCol="weight",
        maxIter=trees,
        maxDepth=depth,
        stepSize=rate,
        subsamplingRate=row_fraction,
        featureSubsetStrategy="all" if column_fraction >= 1.0 else str(column_fraction),
        minInstancesPerNode=min_child_rows,
        minInfoGain=min_gain,
        seed=seed,
        checkpointInterval=10 if has_checkpoint_dir(spark) else -1,
    )


def train_trees(
    train: DataFrame,
    missing: str = "median",
    encoders: PipelineModel | None = None,
    **settings,
) -> PipelineModel:
    """Fit boosted trees, class 1 weighted by negatives / positives."""
    learner = gradient_boosted_trees(train.sparkSession, **settings)
    stages = preparation_stages(train, missing, encoders) + [learner]
    return Pipeline(stages=stages).fit(add_positive_weight(train))


def train_logistic(
    train: DataFrame,
    missing: str = "median",
    encoders: PipelineModel | None = None,
    max_iter: int = 1000,
    rows: int | None = None,
) -> PipelineModel:
    """Fit a logistic regression with balanced class weights.

    The penalty is the one of a unit inverse strength: 1 / rows on Spark's mean loss.
    """
    rows = train.count() if rows is None else rows
    learner = LogisticRegression(
        featuresCol=VECTOR,
        labelCol=LABEL,
        weightCol="weight",
        maxIter=max_iter,
        regParam=1.0 / max(rows, 1),
        standardization=False,
    )
    stages = preparation_stages(train, missing, encoders) + [learner]
    return Pipeline(stages=stages).fit(add_balanced_weight(train))


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Customer, label (where present), predicted class and probability of class 1."""
    keep = [CUSTOMER] + ([LABEL] if LABEL in features.columns else [])
    scored = model.transform(features)
    return scored.select(
        *keep,
        F.col("prediction").cast("int").alias("prediction"),
        vector_to_array("probability")[1].alias(SCORE),
    )


def predict_churn(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Customer and churn probability, highest first; a label column is ignored."""
    return (
        score(model, features.drop(LABEL))
        .select(CUSTOMER, SCORE)
        .orderBy(F.col(SCORE).desc(), CUSTOMER)
    )


def feature_importances(
    spark: SparkSession, model: PipelineModel, top: int | None = None
) -> DataFrame:
    """(feature, importance), largest first; one row per input of the vector."""
    names = model.stages[-2].getInputCols()
    values = model.stages[-1].featureImportances.toArray()
    suffixes = ("_number", "_code")
    rows = []
    for name, value in zip(names, values, strict=True):
        for suffix in suffixes:
            name = name.removesuffix(suffix)
        rows.append((name, float(value)))
    frame = spark.createDataFrame(rows, "feature string, importance double")
    ranked = frame.orderBy(F.col("importance").desc(), "feature")
    return ranked if top is None else ranked.limit(top)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    """Load a saved model; a missing one is a FileNotFoundError."""
    try:
        return PipelineModel.load(path)
    except Exception as error:
        if "not exist" in str(error).lower() or "empty collection" in str(error).lower():
            raise FileNotFoundError(f"no model at {path}; train one first") from error
        raise
