"""Operator 12: tries and masks against brute force."""

import collections
import itertools
import random
import re

import pytest

from ebbtide.llm import filter_audit, text_tries

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_masks(rows):
    """(part, mask) of each (doc_id, text, lang)."""
    least = {}
    for i, text, _ in rows:
        if i is not None:
            least[text or ""] = min(least.get(text or "", i), i)
    out = []
    for i, text, lang in rows:
        text = text or ""
        words = WORD.findall(text)
        fails = [
            len(words) < 100,
            100 * len(set(words)) < 80 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
            bool(re.search(r"[#$%&*|]", text)),
            i is not None and least[text] < i,
        ]
        out.append((i, lang or "", sum(f << k for k, f in enumerate(fails))))
    return out


def brute_audit(rows, labels):
    good = {i for i, q, _ in labels if q == 1 and i is not None}
    toxic = {i for i, _, t in labels if t == 1 and i is not None}
    masks = brute_masks(rows)
    out = {}
    for part in {p for _, p, _ in masks}:
        own = [(i, {f for k, f in enumerate("ABCDE") if m >> k & 1}) for i, p, m in masks if p == part]
        shapley = collections.Counter()
        for order in itertools.permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                removed = [(i, x) for i, x in left if f in x]
                left = [(i, x) for i, x in left if f not in x]
                shapley[f] += len(removed)
                out[part, "".join(order), step] = [
                    len(left),
                    len(removed),
                    sum(1 for _, x in own if f in x) - len(removed),
                    sum(1 for _, x in own if x == {f}),
                    sum(1 for i, _ in removed if i in good),
                    sum(1 for i, _ in removed if i in toxic),
                ]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return out


def as_rows(df):
    names = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
    return {(r.part, r.filter_order, r.step): [r[n] for n in names] for r in df.collect()}


def test_trie_holds_the_least_of_each_text():
    rng = random.Random(1)
    texts = ["", "a", "ab", "abc", "b"] + ["".join(rng.choices("ab", k=rng.randrange(30))) for _ in range(2000)]
    texts += ["x" * 5000 + s for s in ("", "y", "yz", "é")] * 2
    trie, want = text_tries.Trie(), {}
    for i, text in enumerate(texts):
        number = rng.randrange(10_000)
        trie.insert(text, (number, i))
        want[text] = min(want.get(text, (number, i)), (number, i))
    assert {"".join(path): held for path, held in trie.terminals()} == want


def test_shared_length():
    for edge, text, at in [("abc", "xabd", 1), ("abc", "abc", 0), ("a", "b", 0), ("abc", "zzab", 2)]:
        want = 0
        while want < len(edge) and at + want < len(text) and edge[want] == text[at + want]:
            want += 1
        assert text_tries.shared_length(edge, text, at) == want


@pytest.fixture(scope="module")
def crowded(spark):
    """Copies in hundreds, texts that differ only late, a long common start, missing values."""
    rng = random.Random(7)
    start = "the same preamble stands before every text of this group and goes on " * 3
    rows = [(i, "one hot copy | " + "w " * 120, "en") for i in range(0, 900, 3)]
    rows += [(i, start + " ".join(rng.choices("abcdefgh", k=90)) + str(i % 150), "en") for i in range(1, 900, 3)]
    rows += [(i, " ".join(f"w{rng.randrange(400)}" for _ in range(rng.choice([20, 150]))), "de") for i in range(2, 900, 3)]
    rows += [(5000, None, None), (5001, "", "fr"), (None, "", "fr"), (None, "one hot copy | " + "w " * 120, None)]
    rows += [(5002, "ALL CAPS # ", "fr"), (5003, " ", "fr"), (5002, "ALL CAPS # ", "fr"), (1, "again", "en")]
    rows += [(5004, "x" * 200_000, "fr"), (5005, "x" * 199_999 + "y", "fr"), (5006, "x" * 200_000, "fr")]
    return rows


@pytest.mark.parametrize("heavy", [0.25, 0.002])
def test_first_rows_of_crowds(spark, crowded, heavy, monkeypatch):
    monkeypatch.setattr(text_tries, "HEAVY_SHARE", heavy)
    docs = spark.createDataFrame(crowded, "doc_id long, text string, lang string").repartition(6)
    want = {}
    for i, text, _ in crowded:
        if i is not None:
            want[text or ""] = min(want.get(text or "", i), i)
    got = text_tries.first_rows(docs)
    assert sorted(r.doc_id for r in got.collect()) == sorted(want.values())


def test_prefixes_grow_until_none_is_heavy(spark, crowded):
    docs = spark.createDataFrame(crowded, "doc_id long, text string, lang string")
    texts = docs.selectExpr(
        "coalesce(text, '') as text", "xxhash64(coalesce(text, '')) as print", "octet_length(coalesce(text, '')) as bytes"
    )
    heavy = text_tries.heavy_prefixes(texts, 64, 100_000)
    assert sorted(heavy)[:3] == [8, 32, 128]  # the preamble has some 210 characters
    lengths = {r[0] for r in texts.select(text_tries.prefix_length(heavy)).distinct().collect()}
    assert 8 in lengths and max(lengths) > 210


def test_audit_equals_brute_force(spark, crowded):
    labels = [(i, i % 2, int(i % 5 == 0)) for i in range(0, 900, 2)] + [(2, None, 1), (2, 0, None), (None, 1, 1)]
    docs = spark.createDataFrame(
        [(*r, 1, "m", 2) for r in crowded], "doc_id long, text string, lang string, mask int, part string, print long"
    ).repartition(5)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    assert as_rows(filter_audit.audit(docs, table)) == brute_audit(crowded, labels)


def test_odd_rows_and_empty_tables(spark, odd, empty):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.lang) for r in odd.collect()]
    assert as_rows(filter_audit.audit(odd, labels)) == brute_audit(rows, [])
    assert filter_audit.audit(empty, labels).count() == 0
