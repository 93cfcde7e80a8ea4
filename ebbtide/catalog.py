"""Every query by name: operators bound to the tables of one data folder.

Queries whose results hold sums of doubles are rounded to six places, because the
order of addition differs from run to run.
"""

from __future__ import annotations

import os
import weakref
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.ml import boosting, metrics, model, search, split
from ebbtide.names import CUSTOMER, LABEL, SCORE
from ebbtide.operators.anchors import churn_target, reference_dates, scoring_dates
from ebbtide.operators.lookback import daily_calls, daily_usage
from ebbtide.operators.shares import grain_check
from ebbtide.operators.snapshots import value_changes
from ebbtide.plans import features, reports
from ebbtide.sources.order_views import order_views
from ebbtide.sources.readers import Tables, profile
from ebbtide.sources.writers import hashed_joins, materialise, remove_folder

Query = Callable[[SparkSession, str], DataFrame]


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    doubles = [name for name, kind in df.dtypes if kind == "double"]
    return df.withColumns({c: F.round(c, digits) for c in doubles})


def on_tables(build: Callable[[Tables], DataFrame]) -> Query:
    return lambda spark, folder: build(order_views(spark, folder))


def on_anchors(build: Callable[[Tables, DataFrame], DataFrame]) -> Query:
    return on_tables(lambda t: build(t, reference_dates(t.cease, t.customer_info)))


def on_features(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_tables(lambda t: build(features.training_features(*t)))


def rule_scores(frame: DataFrame) -> DataFrame:
    """Scores by a fixed rule on the features, so that metrics can be checked exactly.

    Prediction is 1 from a score of 0.5.
    """
    score = F.least(
        F.lit(1.0), F.col("calls_total_90d") / 5 + F.col("any_dd_cancel_60d") / 4
    )
    score = F.coalesce(score, F.lit(0.0))
    return frame.select(
        CUSTOMER, F.col(LABEL), (score >= 0.5).cast("int").alias("prediction"), score.alias(SCORE)
    )


def on_scores(build: Callable[[DataFrame], DataFrame]) -> Query:
    return on_features(lambda frame: build(rule_scores(frame)))


def feature_queries() -> dict[str, Query]:
    return {
        "q01_ref_dates": on_anchors(lambda t, a: a),
        "q01_scoring_dates": on_tables(lambda t: scoring_dates(t.customer_info)),
        "q02_call_features": on_anchors(lambda t, a: features.call_features(t.calls, a)),
        "q03_talk_hold_features": on_anchors(
            lambda t, a: rounded(features.talk_hold_features(t.calls, a))
        ),
        "q04_payment_friction_features": on_tables(
            lambda t: features.payment_friction_features(t.customer_info)
        ),
        "q05_contract_tenure_features": on_tables(
            lambda t: features.contract_tenure_features(t.customer_info)
        ),
        "q06_usage_features": on_anchors(lambda t, a: features.usage_features(t.usage, a)),
        "q06_usage_features_with_totals": on_anchors(
            lambda t, a: rounded(features.usage_features(t.usage, a, keep_totals=True), 4)
        ),
        "q07_product_tech_speed_features": on_tables(
            lambda t: rounded(features.product_tech_speed_features(t.customer_info))
        ),
        "q08_churn_target_completed": on_tables(lambda t: churn_target(t.cease)),
        "q09_training_features": on_features(rounded),
        "q10_inference_features": on_tables(
            lambda t: rounded(features.inference_features(t.customer_info, t.calls, t.usage))
        ),
    }


def report_queries() -> dict[str, Query]:
    def by_cease(report) -> Query:
        return on_tables(lambda t: report(t.cease, t.customer_info))

    def by_calls(report) -> Query:
        return on_anchors(lambda t, a: report(t.calls, a))

    return {
        "q11_overall_churn_rate": by_cease(reports.overall_churn_rate),
        "q12_churn_share_by_reason": on_tables(lambda t: reports.churn_share_by_reason(t.cease)),
        "q13_churn_share_by_reason_insight": on_tables(
            lambda t: reports.churn_share_by_reason_insight(t.cease)
        ),
        "q14_cease_customer_profiles": by_cease(reports.cease_customer_profiles),
        "q15_churn_share_by_sales_channel": by_cease(reports.churn_share_by_sales_channel),
        "q16_churners_ever_on_package": by_cease(reports.churners_ever_on_package),
        "q17_package_transitions": by_cease(reports.package_transitions),
        "q17_package_transitions_chronological": on_tables(
            lambda t: reports.package_transitions(t.cease, t.customer_info, "chronological")
        ),
        "q17_package_steps": on_tables(
            lambda t: value_changes(t.customer_info, "crm_package_name")
        ),
        "q18_churn_rate_by_tenure_band": by_cease(reports.churn_rate_by_tenure_band),
        "q19_churn_rate_by_speed": by_cease(reports.churn_rate_by_speed),
        "q20_churn_rate_by_technology": by_cease(reports.churn_rate_by_technology),
        "q21_call_volume_by_group": by_calls(reports.call_volume_by_group),
        "q22_payment_friction_by_group": by_cease(reports.payment_friction_by_group),
        "q23_usage_trend_before_cease": on_tables(
            lambda t: rounded(reports.usage_trend_before_cease(t.cease, t.usage), 2)
        ),
        "q24_call_type_penetration": by_calls(reports.call_type_penetration),
        "q24_churner_penetration": on_anchors(
            lambda t, a: reports.one_group(
                reports.call_type_penetration(t.calls, a), "Churner", "pct_cust_any_30d"
            )
        ),
        "q24_non_churner_penetration": on_anchors(
            lambda t, a: reports.one_group(
                reports.call_type_penetration(t.calls, a), "Non-churner", "pct_cust_any_30d"
            )
        ),
        "q25_call_type_intensity": by_calls(reports.call_type_intensity),
        "q25_churner_intensity": on_anchors(
            lambda t, a: reports.one_group(
                reports.call_type_intensity(t.calls, a), "Churner", "avg_calls_per_customer_30d"
            )
        ),
        "q25_non_churner_intensity": on_anchors(
            lambda t, a: reports.one_group(
                reports.call_type_intensity(t.calls, a), "Non-churner", "avg_calls_per_customer_30d"
            )
        ),
        "q26_talk_hold_by_group": by_calls(reports.talk_hold_by_group),
        "q27_feature_means_by_label": on_features(reports.feature_means_by_label),
        "q28_label_balance": on_features(reports.label_balance),
        "q29_grain_check": on_features(grain_check),
        "q29_snapshot_grain": on_tables(
            lambda t: grain_check(t.customer_info, [CUSTOMER, "datevalue"])
        ),
        "q30_high_risk_customers": on_scores(reports.high_risk_customers),
    }


def table_queries() -> dict[str, Query]:
    return {
        "s03_cease": on_tables(lambda t: t.cease),
        "s03_customer_info": on_tables(lambda t: t.customer_info),
        "s05_table_profile": on_tables(lambda t: profile(t._asdict())),
        "s07_features_missing_as_zero": on_features(lambda f: rounded(f.fillna(0))),
        "j01_daily_calls": on_tables(lambda t: rounded(daily_calls(t.calls))),
        "j01_daily_usage": on_tables(lambda t: rounded(daily_usage(t.usage), 4)),
    }


def learning_queries() -> dict[str, Query]:
    keys = [CUSTOMER, LABEL]
    return {
        "m01_label_encode": on_features(
            lambda f: model.label_encode(f).select(CUSTOMER, *model.CATEGORICAL_FEATURES)
        ),
        "m03_stratified_split": on_features(
            lambda f: split.add_split(f.select(keys)).withColumn(
                "is_test", F.col("is_test").cast("int")
            )
        ),
        "m04_class_weight": on_features(
            lambda f: split.class_counts(split.train_test_split(f.select(keys))[0])
        ),
        "m07_classification_metrics": on_scores(
            lambda s: rounded(metrics.classification_metrics(s))
        ),
        "m08_roc_auc": on_scores(lambda s: rounded(metrics.roc_auc(s))),
        "m09_classification_report": on_scores(
            lambda s: rounded(metrics.classification_report(s))
        ),
        "m10_confusion_matrix": on_scores(metrics.confusion_matrix),
        "m11_roc_curve": on_scores(lambda s: rounded(metrics.roc_curve(s))),
        "m11_roc_curve_all_points": on_scores(
            lambda s: rounded(metrics.roc_curve(s, drop_intermediate=False))
        ),
        "m13_stratified_folds": on_features(lambda f: split.add_folds(f.select(keys))),
        "m15_balanced_weight": on_features(
            lambda f: rounded(split.add_balanced_weight(f.select(keys)))
        ),
        "m17_spot_check": on_scores(metrics.spot_check),
    }


# models and split features by session and folder; both go when the session goes
_fitted: weakref.WeakKeyDictionary[SparkSession, dict[tuple, object]] = weakref.WeakKeyDictionary()


def _kept(spark: SparkSession, key: tuple, make: Callable[[], object]):
    own = _fitted.setdefault(spark, {})
    if key not in own:
        own[key] = make()
    return own[key]


def _split_features(spark: SparkSession, folder: str) -> DataFrame:
    """The folder's features with ``is_test``, written once for all fits and scores.

    The cuts of the split read the rows twice before the split does, so the features are
    written first and not derived three times.
    """

    def make() -> DataFrame:
        with hashed_joins(spark):
            wide = materialise(features.training_features(*order_views(spark, folder)), "features")
        marked = materialise(split.add_split(wide), "split")
        for path in {os.path.dirname(f) for f in wide.inputFiles()}:
            remove_folder(spark, path)
        return marked

    return _kept(spark, (folder, "split"), make)


def _scoring_features(spark: SparkSession, folder: str) -> DataFrame:
    """The folder's features at the last snapshots, written once: ranking their scores reads them twice."""

    def make() -> DataFrame:
        tables = order_views(spark, folder)
        frame = features.inference_features(tables.customer_info, tables.calls, tables.usage)
        with hashed_joins(spark):
            return materialise(frame, "scoring")

    return _kept(spark, (folder, "scoring"), make)


def _trained(spark: SparkSession, folder: str, kind: str):
    """A model fitted with the learner's defaults on the training part, once per session."""

    def fit():
        marked = _split_features(spark, folder)
        encoders = model.fit_encoders(marked)
        train = marked.where("not is_test").drop("is_test")
        learner = {
            "trees": model.train_trees,
            "logistic": model.train_logistic,
            "second_order": second_order,
        }[kind]
        return learner(train, encoders=encoders)

    return _kept(spark, (folder, kind), fit)


def second_order(train: DataFrame, encoders) -> boosting.BoostedTrees:
    """The published fit: a hundred trees of depth six."""
    return boosting.train_boosted_trees(train, encoders)


# the catalogued search: the published one has 50 candidates, 5 folds and up to 300 trees
SHORT_GRID = {"trees": (3, 6), "depth": (2, 3), "rate": (0.1, 0.3), "min_gain": (0.0, 0.2)}


def fitted_queries() -> dict[str, Query]:
    """Queries behind a fitted model. The learner has no SQL equivalent; the ``_checked``
    forms say of each row what must hold of it, so that SQL can confirm the rows."""

    def scored_by(kind: str, then: Callable[[DataFrame], DataFrame]) -> Query:
        def run(spark: SparkSession, folder: str) -> DataFrame:
            test = _split_features(spark, folder).where("is_test").drop("is_test")
            score = boosting.score if kind == "second_order" else model.score
            return then(score(_trained(spark, folder, kind), test))

        return run

    def batch_scores(spark: SparkSession, folder: str) -> DataFrame:
        return model.predict_churn(_trained(spark, folder, "trees"), _scoring_features(spark, folder))

    def importances(spark: SparkSession, folder: str, top: int | None = None) -> DataFrame:
        return model.feature_importances(spark, _trained(spark, folder, "trees"), top)

    def importances_checked(spark: SparkSession, folder: str) -> DataFrame:
        found = importances(spark, folder)
        total = found.agg(F.round(F.sum("importance"), 6)).scalar()
        return found.select("feature", (F.col("importance") >= 0).alias("valid"), total.alias("total"))

    def search_results(spark: SparkSession, folder: str) -> DataFrame:
        train = _split_features(spark, folder).where("not is_test").drop("is_test")
        return search.staged_search(train, SHORT_GRID, n=4, folds=3).candidates

    def valid():
        return F.col(SCORE).between(0, 1).alias("valid")

    def checked(scores: DataFrame) -> DataFrame:
        return scores.select(
            CUSTOMER,
            F.col(LABEL).cast("int").alias(LABEL),
            valid(),
            (F.col("prediction") == (F.col(SCORE) > 0.5).cast("int")).alias("consistent"),
        )

    return {
        "m05_boosted_trees_metrics": scored_by("trees", metrics.classification_metrics),
        "m06_test_scores": scored_by("trees", lambda s: s),
        "m06_test_scores_checked": scored_by("trees", checked),
        "m05_second_order_metrics": scored_by("second_order", metrics.classification_metrics),
        "m05_second_order_scores_checked": scored_by("second_order", checked),
        "m13_staged_search": search_results,
        "m12_feature_importances": importances,
        "m12_top_importances": lambda spark, folder: importances(spark, folder, 10),
        "m12_feature_importances_checked": importances_checked,
        "m15_logistic_report": scored_by("logistic", metrics.classification_report),
        "m15_logistic_roc_curve": scored_by("logistic", lambda s: rounded(metrics.roc_curve(s))),
        "m16_churn_predictions": batch_scores,
        "m16_churn_predictions_checked": lambda spark, folder: batch_scores(spark, folder).select(
            CUSTOMER, valid()
        ),
    }


def all_queries() -> dict[str, Query]:
    return (
        feature_queries()
        | report_queries()
        | table_queries()
        | learning_queries()
        | fitted_queries()
    )
