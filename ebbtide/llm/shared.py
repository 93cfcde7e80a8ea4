"""Small helpers the operators share: tables in the shared folder, columns, vocabulary paths."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; in local mode a folder of its own where none is set."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not folder:
        if spark.sparkContext.master.partition("[")[0] != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors see")
        folder = tempfile.mkdtemp(prefix="ebbtide-")
        spark.sparkContext.setCheckpointDir(folder)
    return folder.rstrip("/")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` below the shared folder and read it back.

    This cuts the lineage where every executor can read it: a lost executor costs its
    running tasks, never the steps before. Spark's committer keeps retries apart.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/ebbtide-{uuid.uuid4().hex}/{label}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def eager_jobs(spark: SparkSession, rows: int = 1000) -> Iterator[None]:
    """Session settings for a chain of jobs that each write a table and run inside the block.

    Arrow batches get at most ``rows`` rows: texts are long, and a batch lies in memory on
    both sides of a Python worker's pipe. Shuffle files go when their job is done, since
    what follows reads the written table. The caller's settings come back at the end.
    """
    usual = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    settings = {
        "spark.sql.execution.arrow.maxRecordsPerBatch": str(min(rows, int(usual)) if int(usual) > 0 else rows),
        "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    }
    before = {key: spark.conf.get(key) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class Temporary:
    """Tables that are removed on leaving the ``with`` block, for results stored inside it.

    Only folders made here, with names of their own, are removed, through Spark's own file
    system of the shared folder.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.folders: list[str] = []

    def __enter__(self) -> Temporary:
        return self

    def stored(self, df: DataFrame, label: str) -> DataFrame:
        path = f"{shared_folder(self.spark)}/ebbtide-{uuid.uuid4().hex}"
        self.folders.append(path)
        df.write.parquet(f"{path}/{label}")
        return self.spark.read.schema(df.schema).parquet(f"{path}/{label}")

    def __exit__(self, *error) -> None:
        for path in self.folders:
            folder = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(folder, True)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def unused(df: DataFrame, name: str) -> str:
    """``name`` with as many underscores appended as it takes to clash with no column of ``df``."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(column: str = "text") -> Column:
    """The text, a missing one as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


def crc_of_id(column: str = "doc_id") -> Column:
    """crc32 of the identifier written as text; a missing one counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary"))


def lower_ascii(column: Column) -> Column:
    return F.translate(column, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def vocabulary(name: str) -> str:
    """Path of a public tokenizer's vocabulary file, which every node has installed."""
    import public_tokenizers

    return public_tokenizers.path(name)


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on executors that do not have it installed, once a session."""
    context = spark.sparkContext
    if getattr(context, "_ebbtide_shipped", False):
        return
    package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    archive = os.path.join(tempfile.mkdtemp(prefix="ebbtide-package-"), "ebbtide_package.zip")
    with zipfile.ZipFile(archive, "w") as out:
        for folder, _, names in os.walk(package):
            for name in sorted(names):
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.relpath(path, os.path.dirname(package)))
    context.addPyFile(archive)
    context._ebbtide_shipped = True


def in_arrow(df: DataFrame, function, schema: str) -> DataFrame:
    """mapInArrow with the package at hand on every executor."""
    ship_package(df.sparkSession)
    return df.mapInArrow(function, schema)
