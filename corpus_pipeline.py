"""The corpus pipeline: toxic documents go, one of each near-duplicate class stays, benchmark
leaks go, sources are mixed to their target weights, and rows get shards.

Each stage takes (spark, docs, sf_dir), works on all rows of ``docs`` and returns a frame;
``run`` writes each stage's rows and reads them again for the next. All but the last return
the columns of documents. Missing and empty texts pass every filter (they are neither
toxic, nor copies, nor leaks) and are not taken by the mix, which takes words.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import decontamination, jaccard_join, mixing, sharding, toxicity
from ebbtide.llm.shared import stored, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 9: fit on the labelled rows, drop the documents the field finds toxic."""
    field = toxicity.fit_on(docs, table(spark, sf_dir, "labels"))
    return toxicity.without_toxic(docs, field)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 1 on shingles of five words and a similarity of 0.8: the first of a class stays."""
    return jaccard_join.keep_first(docs, jaccard_join.Similarity(80, 100, 5))


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 7: drop the documents that hold an item of the benchmark."""
    return decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 10: a row for each time the mix takes a document, in the order of training."""
    return mixing.training_order(docs)


def assign_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Operator 6: all rows with the shard they go to."""
    return sharding.shard_documents(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", assign_shards),
]

#: SQL cannot express the fitted field; tests hold every stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over the documents of ``sf_dir``."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
