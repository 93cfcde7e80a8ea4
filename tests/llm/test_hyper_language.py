"""Operator 11: n-grams and bundles against plain loops, and held-out accuracy."""

import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ebbtide.llm import hyper_language as hyper
from ebbtide.llm.words import chunks_of

SAMPLES = ["Ab, c!", None, "", "12 34", "é", "ÉÀ  x-y", "漢字 and ΣΑΣ", "a" * 50, " lead and trail  ", "x́y 😀 z"]


def plain_grams(text):
    symbols = []
    for c in f" {text or ''} ":
        low = c.lower() if len(c.lower()) == 1 else c
        symbol = ord(low) if c.isalpha() else 0
        if symbol or not symbols or symbols[-1]:
            symbols.append(symbol)
    windows = [tuple(symbols[k : k + 3]) for k in range(len(symbols) - 2)]
    return [w for w in windows if any(w)]


def decoded(code):
    return tuple(int(code) >> (21 * k) & ((1 << 21) - 1) for k in (2, 1, 0))


@pytest.mark.parametrize("limit", [3, 1 << 20])
def test_grams_follow_the_plain_loop(limit):
    found = []
    for texts in chunks_of(pa.array(SAMPLES, pa.string()), limit):
        codes, first = hyper.grams(texts)
        found += [[decoded(c) for c in codes[a:b]] for a, b in zip(first[:-1], first[1:], strict=True)]
    assert found == [plain_grams(t) for t in SAMPLES]


@pytest.mark.parametrize("slice_", [3, 1 << 13])
def test_bundle_is_the_sum_of_bound_permuted_vectors(slice_, monkeypatch):
    monkeypatch.setattr(hyper, "SLICE", slice_)
    texts = next(chunks_of(pa.array(["Banana, banana und Bär"])))
    codes, _ = hyper.grams(texts)
    want = np.zeros(hyper.DIMENSIONS)
    for window in plain_grams("Banana, banana und Bär"):
        a, b, c = hyper.letter_vectors(np.array(window)).astype(int)
        want += np.roll(a, 2) * np.roll(b, 1) * c
    assert np.array_equal(hyper.Bundler(codes).bundle(codes), want)


def test_letters_have_nearly_orthogonal_vectors():
    vectors = hyper.letter_vectors(np.arange(97, 123)).astype(int)
    dots = vectors @ vectors.T / hyper.DIMENSIONS
    assert set(np.unique(vectors)) == {-1, 1} and np.abs(dots - np.eye(26)).max() < 0.2


def test_held_out_documents(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    got = hyper.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out]
    assert sum(r.lang_pred == r.lang for r in held) >= 0.97 * len(held)


def test_predictions_ignore_lang_and_order(spark, sf01):
    docs = spark.read.parquet(f"{sf01}/documents.parquet")
    prototypes = hyper.learn(docs)
    again = hyper.learn(docs.repartition(7))
    assert all(np.array_equal(prototypes[k], again[k]) for k in prototypes) and list(prototypes) == list(again)
    plain = hyper.predict(docs, prototypes).select("doc_id", "lang_pred")
    turned = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")}).repartition(5)
    assert sorted(plain.collect()) == sorted(hyper.predict(turned, prototypes).select("doc_id", "lang_pred").collect())
    held = F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(4)) == 2
    spoilt = hyper.learn(docs.withColumn("lang", F.when(held, "zz").otherwise(F.col("lang"))))
    assert all(np.array_equal(prototypes[k], spoilt[k]) for k in prototypes) and "zz" not in spoilt


def test_odd_rows_and_empty_tables(spark, odd, empty):
    rows = hyper.identify(odd).collect()
    assert len(rows) == 11 and all(0 <= r.score <= 1 for r in rows)
    no_letter = {r.doc_id: (r.lang_pred, r.score) for r in rows if r.doc_id in (3, 4, 5)}
    assert no_letter == {3: ("und", 0.0), 4: ("und", 0.0), 5: ("und", 0.0)}
    assert {r.lang_pred for r in rows if r.doc_id in (1, 2, 8)} <= {"en", "xx"}
    assert hyper.identify(empty).count() == 0
    nothing = hyper.identify(odd.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert {(r.lang_pred, r.score) for r in nothing} == {("und", 0.0)}


def test_too_many_languages_stop_the_job(spark, monkeypatch):
    monkeypatch.setattr(hyper, "MOST_LANGUAGES", 2)
    docs = spark.createDataFrame([(i, "abc def", f"l{i}") for i in range(12)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError, match="languages"):
        hyper.learn(docs)
