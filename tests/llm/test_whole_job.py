"""Cases in which an operator once did less than the whole job."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from ebbtide import catalog
from ebbtide.llm import decontamination, jaccard_join, mixing, vantage_trees
from ebbtide.llm.queries import all_queries, all_sql
from test_text_operators import ITEM, brute_nearest, leaks_of


# --- 1: near duplicates, row by row ---


def test_a_repeated_id_loses_only_the_rows_that_are_copies(spark):
    copy = "one two three four five six seven eight nine ten"
    rows = [
        (1, copy), (2, copy), (2, "quite another text of its own that nobody else has written so far"),
        (3, ""), (3, "a lonely text about rivers and hills and the sea beyond them all"), (3, None),
        (4, "Said once  and once again in the same seven words"), (4, "said once and once again in the same seven words"),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = sorted(map(str, [rows[0], *rows[2:7]]))
    assert sorted(str(tuple(r)) for r in jaccard_join.keep_first(docs).collect()) == want
    again = jaccard_join.keep_first(docs.repartition(5)).collect()
    assert sorted(str(tuple(r)) for r in again) == want


def test_a_wanted_set_is_read_once(spark):
    rows = [(None, "a b c d e")] * 3 + [(7, "f g h i j")] * 4 + [(8, "f g h i j"), (7, "k l m n")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    how = jaccard_join.Similarity()
    marks = jaccard_join.sketches(docs, how).groupBy("gid").agg(F.min("doc_id").alias("doc_id")).localCheckpoint()
    wanted = marks.where("doc_id is null").unionByName(marks.where("doc_id = 7").orderBy("gid"))
    got = jaccard_join.whole_sets(docs, wanted, how).collect()
    assert sorted(r.gid for r in got) == sorted(r.gid for r in wanted.collect())
    assert len(got) == 3


# --- 5: nearest vectors ---


@pytest.mark.parametrize("shard_rows", [97, 10_000])
def test_ties_beyond_the_shortlist_go_to_the_smaller_ids(spark, shard_rows):
    rng = np.random.default_rng(5)
    points = (rng.random(size=(900, 12)) < 0.4).astype(float)  # few products, many distinct vectors
    points[points.sum(axis=1) == 0, 0] = 1.0
    rows = [(int(i), [float(x) for x in p]) for i, p in zip(rng.permutation(900), points, strict=True)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vantage_trees.nearest(df, df.where("vec_id % 60 = 0"), 5, 1.0, shard_rows).collect()
    assert sorted(map(tuple, got)) == sorted(brute_nearest(rows, [r for r in rows if r[0] % 60 == 0], 5))


def test_a_repeated_query_id_hides_no_other_row(spark):
    same = [1.0, 2.0]
    rows = [(1, same)] * 8 + [(1, [3.0 + i, 9.0]) for i in range(20)] + [(i, same) for i in (5, 6, 7)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = vantage_trees.nearest(df, spark.createDataFrame(rows[:1], df.schema), 3).collect()
    assert [tuple(r) for r in sorted(got)] == [(1, 1, 5, 5.0), (1, 2, 6, 5.0), (1, 3, 7, 5.0)]


# --- 7: benchmark leaks ---


def test_plain_copies_are_found_whatever_templates_say(spark):
    title = " ".join(w.capitalize() for w in ITEM.split())
    edited = ITEM.replace("30 minutes", "31 minutes")  # 30 stands for 30 and for 31
    sums = "3 4 7 12 5 9 81 6 2 54 11 8 90 13"
    assert {r[:2] for r in leaks_of(spark, [ITEM.lower(), ITEM.upper(), title, edited], [ITEM])} == {
        (0, 0), (1, 0), (2, 0), (3, 0),
    }
    assert {r[:2] for r in leaks_of(spark, [f"what is {sums} then"], [sums])} == {(0, 0)}


def test_capitalised_items_in_loud_and_in_lower_case_texts(spark):
    item = "so Anna bought ripe plums. Then old Carl painted three. While Bergen slept Dora baked fresh bread for Oslo"
    loud = "THE NEWS OF TODAY AND MORE NEWS STILL " + item.upper()
    copies = [loud, item.lower(), item.title()]
    assert {r[:2] for r in leaks_of(spark, copies, [item])} == {(0, 0), (1, 0), (2, 0)}


def test_words_put_in_or_left_out_do_not_part_a_copy(spark):
    words = [f"w{chr(97 + i // 26)}{chr(97 + i % 26)}" for i in range(39)]
    item = " ".join(words)
    dropped = " ".join(words[:19] + words[20:])
    inserted = " ".join([*words[:13], "extra", *words[13:26], "more", *words[26:]])
    backwards = " ".join(words[26:] + words[13:26] + words[:13])
    got = {d: c for d, _, c, _ in leaks_of(spark, [dropped, inserted, backwards], [item])}
    assert got == {0: round(38 / 39, 6), 1: 1.0}


def test_slots_are_checked_over_the_whole_chain(spark):
    one = "farmer brown sold 12 sheep to the old miller who lived near the river"
    two = "and the miller paid for all those 12 sheep with silver coins from the mill"
    def put(a, b):
        return f"{one.replace('12', a)} really {two.replace('12', b)}"
    got = leaks_of(spark, [put("77", "77"), put("77", "78")], [f"{one} {two}"], coverage=0.9)
    assert [r[0] for r in got] == [0]


def test_items_without_an_id_are_found(spark):
    docs = spark.createDataFrame([(1, f"So {ITEM}."), (2, "nothing of it")], "doc_id long, text string")
    items = spark.createDataFrame([(None, ITEM), (3, "other words")], "item_id long, text string")
    assert [tuple(r)[:2] for r in decontamination.find_leaks(docs, items).collect()] == [(1, None)]
    assert [r.doc_id for r in decontamination.without_leaks(docs, items).collect()] == [2]


# --- 10: the curriculum as a query ---


def test_positions_of_all_passes_are_a_query(spark, tmp_path):
    rows = [(i, "w " * (1 + i % 7), "abc"[i % 3]) for i in range(200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    got = all_queries()["op10_training_positions"](spark, str(tmp_path)).collect()
    mixed = mixing.mix(docs).select("doc_id", "source", F.posexplode("positions"))
    assert sorted(map(tuple, got)) == sorted((d, s, k + 1, p) for d, s, k, p in mixed.collect())
    assert [r.position for r in got] == sorted(r.position for r in got)
    assert "op10_training_positions" in all_sql()


# --- catalogue ---


def test_no_query_ignores_its_folder():
    assert "m13_candidates" not in catalog.all_queries()
