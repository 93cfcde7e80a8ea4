"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR names the folder of parquet tables and BENCH_CPUS the local threads. Each
query runs from the base tables to its last row (the noop sink), once to warm up and
then BENCH_REPEATS times; the best time counts.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

from ebbtide import catalog  # noqa: E402

HEADLINES = [
    "q01_ref_dates",
    "q02_call_features",
    "q03_talk_hold_features",
    "q04_payment_friction_features",
    "q05_contract_tenure_features",
    "q06_usage_features",
    "q07_product_tech_speed_features",
    "q09_training_features",
    "q10_inference_features",
    "q11_overall_churn_rate",
    "q12_churn_share_by_reason",
    "q14_cease_customer_profiles",
    "q15_churn_share_by_sales_channel",
    "q16_churners_ever_on_package",
    "q17_package_transitions",
    "q18_churn_rate_by_tenure_band",
    "q20_churn_rate_by_technology",
    "q21_call_volume_by_group",
    "q22_payment_friction_by_group",
    "q23_usage_trend_before_cease",
    "q24_call_type_penetration",
    "q25_call_type_intensity",
    "q26_talk_hold_by_group",
    "q27_feature_means_by_label",
    "q30_high_risk_customers",
    "m03_stratified_split",
    "m05_boosted_trees_metrics",
    "m08_roc_auc",
    "m11_roc_curve",
    "m15_logistic_report",
    "m16_churn_predictions",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("ebbtide-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.all_queries()
    times: dict[str, float] = {}
    for name in HEADLINES:
        best = float("inf")
        for attempt in range(repeats + 1):
            started = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            if attempt > 0:
                best = min(best, time.perf_counter() - started)
        times[name] = round(best, 3)
    line = {
        "metric": "headline_queries_total",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(line))
    spark.stop()


if __name__ == "__main__":
    main()
