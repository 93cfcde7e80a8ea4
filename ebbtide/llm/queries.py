"""The operators as queries over a folder's tables, and SQL for those SQL can express."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession

from ebbtide.llm import (
    context_tree,
    cover_trees,
    decontamination,
    filter_audit,
    hyper_language,
    jaccard_join,
    mixing,
    pii,
    sharding,
    token_counts,
    token_files,
    toxicity,
    vantage_trees,
)
from ebbtide.llm.shared import table

Query = Callable[[SparkSession, str], DataFrame]


def on_documents(operator: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: operator(table(spark, folder, "documents"))


def nearest_vectors(spark: SparkSession, folder: str) -> DataFrame:
    vectors = table(spark, folder, "embeddings")
    return vantage_trees.nearest(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def leaks(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.find_leaks(
        table(spark, folder, "documents"), table(spark, folder, "benchmark")
    )


def toxic_documents(spark: SparkSession, folder: str) -> DataFrame:
    documents = table(spark, folder, "documents")
    field = toxicity.fit_on(documents, table(spark, folder, "labels"))
    return toxicity.score_documents(documents, field)


def filter_orders(spark: SparkSession, folder: str) -> DataFrame:
    return filter_audit.audit(table(spark, folder, "documents"), table(spark, folder, "labels"))


def vector_codes(spark: SparkSession, folder: str) -> DataFrame:
    return cover_trees.compress(table(spark, folder, "embeddings"))


def all_queries() -> dict[str, Query]:
    return {
        "op1_ngram_jaccard_join": on_documents(jaccard_join.near_duplicates),
        "op2_pii": on_documents(pii.find_pii),
        "op3_token_files": on_documents(token_files.write_and_read),
        "op4_token_counts": on_documents(token_counts.count_tokens),
        "op5_vantage_trees": nearest_vectors,
        "op6_hash_tree_sharding": on_documents(sharding.assign_shards),
        "op7_decontamination": leaks,
        "op8_context_tree_scoring": on_documents(context_tree.score_documents),
        "op9_toxicity": toxic_documents,
        "op10_curriculum_mixing": on_documents(
            lambda docs: mixing.in_training_order(docs).select(
                "doc_id", "size", "source_size", "target", "taken", "first_position"
            )
        ),
        "op10_training_positions": on_documents(mixing.training_positions),
        "op11_hyperdimensional_language": on_documents(hyper_language.identify),
        "op12_filter_audit": filter_orders,
        "op13_cover_tree_codes": vector_codes,
    }


#: Sizes, sources and targets, on which the queries of the mix are built.
MIXING_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(text, '') AS body FROM documents
), sized AS (
  SELECT doc_id, source,
    CAST(len(regexp_extract_all(body, '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), 'none') || '|' || body), 1, 15) AS BIGINT) AS h
  FROM d
), sources AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [5.0::DOUBLE, 2.0, 1.0][1 + (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3] AS weight
  FROM sized GROUP BY source
), levels AS (
  SELECT *, ((sum(source_size) OVER ())::DOUBLE
      - coalesce(sum(3.0::DOUBLE * source_size) OVER (r ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
    / sum(weight) OVER (r ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM sources
  WINDOW r AS (ORDER BY 3.0::DOUBLE * source_size / weight, source NULLS LAST)
), targets AS (
  SELECT source, source_size,
    least((max(level) OVER ()) * weight, 3.0::DOUBLE * source_size) AS target
  FROM levels
)
"""


def _position_sql(share: str, schedule: Sequence[tuple[float, float]]) -> str:
    """``mixing.position`` in SQL; numbers as text, which is read without rounding."""

    def number(x: float) -> str:
        return f"CAST('{x!r}' AS DOUBLE)"

    branches = []
    for t0, w0, slope, so_far, length in mixing.pieces(schedule):
        rest = f"greatest({share} - {number(so_far)}, 0::DOUBLE)"
        if abs(slope) < 1e-12:
            time = f"{rest} / {number(w0)}"
        else:
            inner = f"greatest({number(w0 * w0)} + {rest} * {number(2.0 * slope)}, 0::DOUBLE)"
            time = f"{rest} * 2::DOUBLE / (sqrt({inner}) + {number(w0)})"
        here = f"{number(t0)} + least({time}, {number(length)})"
        branches.insert(0, f"WHEN {share} >= {number(so_far)} THEN {here}")
    return f"CASE {' '.join(branches)} END"


def _placed_sql() -> str:
    """MIXING_SQL with each document's place, and the position of a share by its source's schedule."""
    return MIXING_SQL + """, turns AS (
  SELECT *, (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 AS turn FROM targets
), placed AS (
  SELECT s.doc_id, s.source, s.size, t.source_size, t.target, t.turn,
    sum(s.size) OVER (PARTITION BY s.source ORDER BY s.h, s.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - s.size + s.size / 2.0::DOUBLE AS middle
  FROM sized s JOIN turns t ON s.source IS NOT DISTINCT FROM t.source
)"""


def _turns_sql() -> str:
    branches = " ".join(
        f"WHEN {k} THEN {_position_sql('share', s)}" for k, s in enumerate(mixing.SCHEDULES)
    )
    return f"CASE turn {branches} END"


def mixing_sql() -> str:
    return _placed_sql() + f""", counted AS (
  SELECT *, middle / greatest(target, CAST('1e-9' AS DOUBLE)) AS share,
    CAST(CASE WHEN size = 0 THEN 0
      ELSE least(3, greatest(0, ceil((target - middle) / source_size))) END AS BIGINT) AS passes
  FROM placed
)
SELECT doc_id, size, source_size, target, size * passes AS taken,
  CASE WHEN passes > 0 THEN {_turns_sql()} END AS first_position
FROM counted
"""


def training_positions_sql() -> str:
    """Each pass's share of its source's demand, inverted."""
    return _placed_sql() + f""", passes AS (
  SELECT *, (middle + k::DOUBLE * greatest(source_size::DOUBLE, 1::DOUBLE))
      / greatest(target, CAST('1e-9' AS DOUBLE)) AS share
  FROM placed, (SELECT unnest([0, 1, 2]) AS k)
  WHERE size > 0 AND k < ceil((target - middle) / source_size)
)
SELECT doc_id, source, CAST(k + 1 AS INTEGER) AS pass, {_turns_sql()} AS position
FROM passes
"""


def _draw_sql(key: str, name: str, weight: float) -> str:
    digits = f"CAST('0x' || substr(md5({key} || '|{name}'), 1, 12) AS BIGINT)"
    return f"-ln(({digits} + 0.5::DOUBLE) / 281474976710656.0) / {weight}"


def _reach_sql(key: str, node: sharding.Node) -> str:
    """The shard of a key: the leaf below the child with the smallest draw, level by level."""
    if node.shard is not None:
        return str(node.shard)
    if len(node.children) == 1:
        return _reach_sql(key, node.children[0])
    draws = ", ".join(_draw_sql(key, c.name, c.weight) for c in node.children)
    branches = " ".join(
        f"WHEN {k + 1} THEN {_reach_sql(key, c)}" for k, c in enumerate(node.children)
    )
    return f"CASE list_position([{draws}], list_min([{draws}])) {branches} END"


def sharding_sql(shards: int = 40) -> str:
    tree = sharding.uniform_tree(shards)
    return f"""
WITH steps AS (
  SELECT list_transform(range(256), lambda b: list_reduce(
    [CAST(b AS BIGINT), 0, 0, 0, 0, 0, 0, 0, 0],
    lambda x, k: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc_of
), d AS (
  SELECT doc_id, coalesce(CAST(doc_id AS VARCHAR), 'none') AS key, hex(encode(coalesce(text, ''))) AS body
  FROM documents
), summed AS (
  SELECT doc_id, key, CAST(length(body) // 2 + 16 AS BIGINT) AS size,
    xor(list_reduce([4294967295::BIGINT] || list_transform(range(length(body) // 2),
        lambda k: CAST('0x' || substr(body, 1 + 2 * k, 2) AS BIGINT)),
      lambda crc, byte: xor(crc >> 8, crc_of[1 + (xor(crc, byte) & 255)])), 4294967295) AS text_crc32
  FROM d, steps
), sharded AS (
  SELECT *, CAST({_reach_sql("key", tree)} AS INTEGER) AS shard,
    CAST({_reach_sql("key", sharding.with_new_shard(tree, shards))} AS INTEGER) AS grown_shard,
    CAST('0x' || substr(md5(key || '|' || text_crc32 || '|' || size), 1, 2) AS INTEGER) % 64 AS bucket
  FROM summed
)
SELECT doc_id, size, text_crc32, 'key' AS law, shard,
  row_number() OVER (PARTITION BY shard ORDER BY bucket, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot,
  grown_shard
FROM sharded
"""


def filter_audit_sql() -> str:
    """Masks of the failed filters, counted by part, and summed for every order and step."""
    steps = ", ".join(map(str, filter_audit.every_step()))
    return rf"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS body,
    regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
), flagged AS (
  SELECT doc_id, part,
    CAST(len(words) < 100 AS INTEGER)
    + 2 * CAST(100 * len(list_distinct(words)) < 80 * len(words) AS INTEGER)
    + 4 * CAST(100 * length(regexp_replace(body, '[^A-Z]+', '', 'g')) > 10 * length(body) AS INTEGER)
    + 8 * CAST(regexp_matches(body, '[#$%&*|]') AS INTEGER)
    + 16 * CAST(coalesce(doc_id > min(doc_id) OVER (PARTITION BY body), false) AS INTEGER) AS mask
  FROM d
), marks AS (
  SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic
  FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id
), counts AS (
  SELECT part, mask, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (toxic) AS toxic
  FROM flagged LEFT JOIN marks USING (doc_id) GROUP BY part, mask
), steps(filter_order, step, bit, before) AS (VALUES {steps}
), report AS (
  SELECT part, filter_order, step, bit,
    sum(CASE WHEN mask & (bit | before) = 0 THEN n ELSE 0 END) AS kept,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN n ELSE 0 END) AS removed,
    sum(CASE WHEN mask & bit <> 0 AND mask & before <> 0 THEN n ELSE 0 END) AS redundant,
    sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS unique_fails,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN good ELSE 0 END) AS good_lost,
    sum(CASE WHEN mask & bit <> 0 AND mask & before = 0 THEN toxic ELSE 0 END) AS toxic_lost
  FROM counts, steps GROUP BY part, filter_order, step, bit
)
SELECT part, filter_order, CAST(step AS INTEGER) AS step, CAST(kept AS BIGINT) AS kept,
  CAST(removed AS BIGINT) AS removed, CAST(redundant AS BIGINT) AS redundant,
  CAST(unique_fails AS BIGINT) AS unique_fails, CAST(good_lost AS BIGINT) AS good_lost,
  CAST(toxic_lost AS BIGINT) AS toxic_lost,
  CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
FROM report
"""


def vector_codes_sql(parts: int = 8, entries: int = 16, rounds: int = 6) -> str:
    """Lloyd rounds as one step of SQL after the other, over all vectors and entries."""
    nearest = """SELECT v.vec_id, v.part, min({'square': list_sum(list_transform(
      range(1, len(v.v) + 1), lambda i: (v.v[i] - e.v[i]) * (v.v[i] - e.v[i]))), 'entry': e.entry}) AS best
  FROM cut v JOIN book%d e ON v.part = e.part GROUP BY v.vec_id, v.part"""
    steps = []
    for k in range(rounds):
        steps.append(f"""near{k} AS MATERIALIZED ({nearest % k}
), mean{k} AS MATERIALIZED (
  SELECT part, entry, list(CAST((total - ((total % n) + n) % n) // n AS BIGINT) ORDER BY i) AS v FROM (
    SELECT part, entry, i, CAST(sum(x) AS HUGEINT) AS total, count(*) AS n FROM (
      SELECT v.part, best.entry AS entry, unnest(v.v) AS x, unnest(range(1, len(v.v) + 1)) AS i
      FROM near{k} JOIN cut v USING (vec_id, part))
    GROUP BY part, entry, i) GROUP BY part, entry
), book{k + 1} AS MATERIALIZED (
  SELECT b.part, b.entry, coalesce(m.v, b.v) AS v FROM book{k} b LEFT JOIN mean{k} m USING (part, entry)
)""")
    return f"""
WITH kept AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(4096 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), cut AS MATERIALIZED (
  SELECT vec_id, part, v[part * len(v) // {parts} + 1 : (part + 1) * len(v) // {parts}] AS v
  FROM kept, (SELECT unnest(range({parts})) AS part)
), book0 AS MATERIALIZED (
  SELECT part, entry, v FROM cut JOIN (
    SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept
    ORDER BY vec_id LIMIT {entries}) USING (vec_id)
), {", ".join(steps)}, last AS MATERIALIZED ({nearest % rounds}
), digest AS (
  SELECT sha256(string_agg(array_to_string(v, ','), ',' ORDER BY part, entry)) AS codebooks_sha256 FROM book{rounds}
), coded AS (
  SELECT vec_id, string_agg(printf('%02x', CAST(best.entry AS INTEGER)), '' ORDER BY part) AS code,
    CAST(sum(best.square) AS BIGINT) AS error
  FROM last GROUP BY vec_id
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id), digest
"""


def all_sql() -> dict[str, str]:
    return {
        "op6_hash_tree_sharding": sharding_sql(),
        "op10_curriculum_mixing": mixing_sql(),
        "op10_training_positions": training_positions_sql(),
        "op12_filter_audit": filter_audit_sql(),
        "op13_cover_tree_codes": vector_codes_sql(),
    }
