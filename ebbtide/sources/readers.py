"""Readers for the four input tables, their types, and a row-count profile.

CSV is read as text under its header's names and then typed by ``normalise_*``:
no inference pass over the data, no dependence on the column order of the file,
and the text ``null`` survives, which the churn definitions need.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ebbtide.functions import as_date, as_double, as_int
from ebbtide.names import CATEGORICAL_FEATURES, CUSTOMER

CASTS = {"date": as_date, "int": as_int, "double": as_double}

# declared types; everything else, and columns not named here, keeps its own type
COLUMN_TYPES = {
    "cease": {"cease_placed_date": "date"},
    "customer_info": {
        "datevalue": "date",
        "contract_dd_cancels": "int",
        "dd_cancel_60_day": "int",
        "tenure_days": "int",
        "ooc_days": "int",
        "speed": "double",
        "line_speed": "double",
    },
    "calls": {
        "event_date": "date",
        "talk_time_seconds": "double",
        "hold_time_seconds": "double",
    },
    "usage": {
        "calendar_date": "date",
        "usage_download_mbs": "double",
        "usage_upload_mbs": "double",
    },
}


class Tables(NamedTuple):
    cease: DataFrame | None
    customer_info: DataFrame
    calls: DataFrame
    usage: DataFrame


def normalise(df: DataFrame, table: str) -> DataFrame:
    """Cast the known columns of ``table``; unreadable values become NULL."""
    types = COLUMN_TYPES[table]
    columns = {c: CASTS[types[c]](c) for c in df.columns if c in types}
    columns[CUSTOMER] = F.col(CUSTOMER).cast("string")
    if table == "cease":
        columns["cease_completed_date"] = F.col("cease_completed_date").cast("string")
    return df.withColumns(columns)


def first_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """(file, header): the first line with any character in it of each file that has one.

    The block that starts at 0 lies in one task, which reads its lines in their order.
    """
    lines = spark.read.text(list(paths)).select(
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("start"),
        "value",
        F.monotonically_increasing_id().alias("at"),
    )
    return (
        lines.where((F.col("start") == 0) & (F.trim("value") != ""))
        .groupBy("file")
        .agg(F.min_by("value", "at").alias("header"))
    )


def read_csv_text(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """All columns as text, named by each file's header; ``path`` may be a folder of files.

    Spark gives all files of one read the first one's header. So files are read in groups
    of equal headers, and the groups are stacked by name; a column that a group lacks is
    NULL there. One scan of the files as plain lines finds the first line of each, by the
    file's block that starts at 0; it takes the same few jobs for any number of files.
    Different header lines reach the driver, and names of files only if headers differ.
    """
    paths = [path] if isinstance(path, str) else list(path)

    def read(files: list[str]) -> DataFrame:
        return spark.read.option("header", True).csv(files)

    headers = first_lines(spark, paths)
    different = sorted(r["header"] for r in headers.select("header").distinct().collect())
    if len(different) < 2:
        return read(paths)
    files: dict[str, list[str]] = {header: [] for header in different}
    for row in headers.orderBy("file").collect():
        files[row["header"]].append(row["file"])
    parts = [read(files[header]) for header in different]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_cease(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return normalise(read_csv_text(spark, path), "cease")


def read_calls(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    return normalise(read_csv_text(spark, path), "calls")


def read_customer_info(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path), "customer_info")


def read_usage(spark: SparkSession, path: str) -> DataFrame:
    return normalise(spark.read.parquet(path), "usage")


def load_tables(spark: SparkSession, paths: Mapping[str, str]) -> Tables:
    """The four tables for training, from paths keyed cease, customer_info, calls, usage."""
    return load_scoring_tables(spark, paths)._replace(cease=read_cease(spark, paths["cease"]))


def load_scoring_tables(spark: SparkSession, paths: Mapping[str, str]) -> Tables:
    """The three tables scoring needs; ``cease`` is None."""
    return Tables(
        cease=None,
        customer_info=read_customer_info(spark, paths["customer_info"]),
        calls=read_calls(spark, paths["calls"]),
        usage=read_usage(spark, paths["usage"]),
    )


def read_feature_csv(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """A labelled feature table kept as many CSV files, read as one table and typed."""
    text = read_csv_text(spark, path)
    keep = {CUSTOMER, *CATEGORICAL_FEATURES}
    return text.withColumns({c: as_double(c) for c in text.columns if c not in keep})


def profile(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Rows and columns of each table, as one job: (table_name, row_count, column_count)."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"),
            "row_count",
            F.lit(len(df.columns)).alias("column_count"),
        )
        for name, df in tables.items()
    ]
    return reduce(DataFrame.unionByName, counts)
