"""Command line of the two jobs, for spark-submit or ``python -m ebbtide``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from ebbtide.jobs import outputs_under, scoring_job, train_job


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="ebbtide", description=__doc__)
    parser.add_argument("mode", choices=["train", "inference"])
    for table in ("cease", "customer-info", "calls", "usage"):
        parser.add_argument(f"--{table}", help=f"path of the {table} table")
    parser.add_argument("--output", required=True, help="shared folder for all results")
    parser.add_argument("--trees", type=int, default=100)
    options = parser.parse_args(arguments)
    names = ["customer_info", "calls", "usage"] + (["cease"] if options.mode == "train" else [])
    inputs = {name: getattr(options, name) for name in names}
    missing = [name for name, path in inputs.items() if path is None]
    if missing:
        parser.error(f"{options.mode} needs the paths of: {', '.join(missing)}")

    spark = SparkSession.builder.getOrCreate()
    outputs = outputs_under(options.output)
    if options.mode == "train":
        result = train_job(spark, inputs, outputs, trees=options.trees)
        print(f"trained on {result.rows} customers: {result.metrics}")
        print(f"model saved to {outputs['model']}")
    else:
        scoring_job(spark, inputs, outputs)
        print(f"predictions saved to {outputs['predictions']}")


if __name__ == "__main__":
    main()
