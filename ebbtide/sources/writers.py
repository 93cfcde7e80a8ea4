"""Sinks. Executors write their own partitions; nothing is collected first."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def write_features(features: DataFrame, path: str, fill_missing: bool = False) -> int:
    """Feature table as parquet; ``fill_missing`` sets missing numbers to 0.

    Returns the rows written. They are counted in the written table, where a count
    reads no column, so the features are computed once. (An ``Observation`` on the write
    would put an unserialisable member into the session, and in Spark 4.1 logistic models
    held in memory could then score nothing.) The table keeps as many files as it has partitions, since a single output file
    would send every row through one task.
    """
    frame = features.fillna(0) if fill_missing else features
    frame.write.mode("overwrite").parquet(path)
    return frame.sparkSession.read.parquet(path).count()


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; one of its own only in local mode, where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        folder = tempfile.mkdtemp(prefix="ebbtide-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once below the shared folder and read it back, so that later jobs do not recompute it."""
    path = f"{shared_folder(df.sparkSession)}/ebbtide-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def hashed_joins(spark: SparkSession) -> Iterator[None]:
    """Let the jobs run inside the block hash the smaller side of a shuffled join, not sort both.

    Adaptive execution does so where it has measured every partition of that side at no more than
    an advisory partition, so that what is hashed stays bounded; others are sorted as ever. The
    caller's setting comes back at the end.
    """
    key = "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes"))
        yield
    finally:
        spark.conf.set(key, before)


def remove_folder(spark: SparkSession, path: str) -> None:
    """Remove a folder that the library itself has made, on whichever file system it lies."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with a header, overwriting; files follow the order of a sorted frame."""
    df.write.mode("overwrite").option("header", True).csv(path)


RUN_SCHEMA = T.StructType(
    [
        T.StructField("run_id", T.StringType(), False),
        T.StructField("experiment", T.StringType(), False),
        T.StructField("params", T.MapType(T.StringType(), T.StringType()), False),
        T.StructField("metrics", T.MapType(T.StringType(), T.DoubleType()), False),
        T.StructField("artifacts", T.MapType(T.StringType(), T.StringType()), False),
    ]
)


def log_run(
    spark: SparkSession,
    path: str,
    run_id: str,
    experiment: str,
    params: Mapping[str, object],
    metrics: Mapping[str, float],
    artifacts: Mapping[str, str],
) -> None:
    """Append one training run to the parquet run log."""
    row = (
        run_id,
        experiment,
        {k: str(v) for k, v in params.items()},
        {k: float(v) for k, v in metrics.items()},
        dict(artifacts),
    )
    runs = spark.createDataFrame([row], RUN_SCHEMA)
    runs.withColumn("logged_at", F.current_timestamp()).coalesce(1).write.mode("append").parquet(
        path
    )
