"""The corpus pipeline: every stage on its own input, against brute force."""

import collections

import pytest

import corpus_pipeline
from ebbtide.llm import jaccard_join, mixing, sharding, toxicity
from test_text_operators import brute_components


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """A folder of small tables with every planted case and odd rows."""
    item = "several plain words that make up one item of the benchmark used here"
    clean = [f"clean text number {i} about topic{i} and place{i} with detail{i} more{i} words{i} end{i}" for i in range(40)]
    rows = [(i, clean[i], "en", f"s{i % 3}") for i in range(40)]
    rows += [(100 + i, clean[i], "en", "s0") for i in range(5)]  # exact copies
    rows += [(200 + i, clean[i] + " awfulword " * 2, "en", "s1") for i in range(20)]
    rows += [(300, f"start of it. {item} and so on", "en", "s2"), (301, None, "en", None), (302, "", "en", "s0")]
    rows += [(None, "row without an identifier and some other words", None, "s1")]
    docs = [(*r, len(r[1] or "")) for r in rows]
    path = tmp_path_factory.mktemp("tables")
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(
        str(path / "documents.parquet"))
    labels = [(i, 1, 0) for i in range(40)] + [(200 + i, 0, 1) for i in range(20)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(str(path / "labels.parquet"))
    spark.createDataFrame([(7, item)], "item_id long, text string").write.parquet(str(path / "benchmark.parquet"))
    return str(path)


def test_stages_in_turn(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before = docs
        docs = corpus_pipeline.stored(stage(spark, docs, folder), name)
        seen[name] = (before.collect(), docs.collect())
        if name != "sharding":
            assert docs.columns == columns
    ids = {name: [r.doc_id for r in rows] for name, (_, rows) in seen.items()}

    assert set(ids["toxicity"]) == {*range(40), *range(100, 105), 300, 301, 302, None}

    before, after = seen["ngram_jaccard_join"]
    found = brute_components([(r.doc_id, r.text) for r in before if r.doc_id is not None], jaccard_join.Similarity(80, 100, 5))
    assert {r.doc_id for r in after} == {d for d, (_, c) in found.items() if c == d} | {None}

    assert set(ids["ngram_jaccard_join"]) - set(ids["decontamination"]) == {300}

    before, after = seen["mixing"]
    passes = {r.doc_id: r.passes for r in mixing.mix(spark.createDataFrame(before, docs_schema(spark, folder))).collect()}
    assert collections.Counter(ids["mixing"]) == collections.Counter({d: n for d, n in passes.items() if n})

    before, after = seen["sharding"]
    assert sorted(map(str, (r[:5] for r in after))) == sorted(map(str, (r[:5] for r in before)))
    assert all(0 <= r.shard < 40 for r in after)


def docs_schema(spark, folder):
    return spark.read.parquet(f"{folder}/documents.parquet").schema


def test_run_is_the_stages(spark, folder):
    first = corpus_pipeline.run(spark, folder)
    assert "shard" in first.columns
    again = corpus_pipeline.run(spark, folder)
    assert sorted(map(str, first.collect())) == sorted(map(str, again.collect()))


def test_stages_are_the_agreed_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "toxicity", "ngram_jaccard_join", "decontamination", "mixing", "sharding"]
    assert corpus_pipeline.ORACLE_SQL is None
    assert toxicity.SAMPLE_TOXIC and sharding.SUB_BUCKETS
