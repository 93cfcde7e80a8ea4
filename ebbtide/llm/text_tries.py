"""Exact duplicates of whole texts by compressed tries over ranges of adaptive prefixes.

Texts are range-partitioned by a prefix that is as long as it must be: prefixes holding
too many bytes of different texts are extended until none does. Each range inserts its
full texts into a radix trie, whose terminals hold the smallest identifier; a traversal
gives the first row of each text. Map tasks reduce their own texts by such tries before
the shuffle, so a group of copies, however large, reaches its range as one row a task.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import in_arrow, text_of

#: Code points of the first prefix, and how many times longer each next one is.
FIRST_PREFIX = 8
GROWTH = 4
#: A prefix is too heavy from this share of a range's even part of all bytes.
HEAVY_SHARE = 0.25
RANGE_BYTES = 64 << 20
BUFFER_CHARACTERS = 16 << 20
BATCH_CHARACTERS = 4 << 20
WHOLE = (1 << 31) - 1


class Node:
    """A node, the text of the edge that leads to it and, at a terminal, (least id, fingerprint)."""

    __slots__ = ("edge", "children", "held")

    def __init__(self, edge: str, held: tuple[int, int] | None = None):
        self.edge = edge
        self.children: dict[str, Node] = {}
        self.held = held


def shared_length(edge: str, text: str, at: int) -> int:
    """How many leading characters of ``edge`` stand in ``text`` at ``at``."""
    low, high = 0, min(len(edge), len(text) - at)
    while low < high:
        middle = (low + high + 1) // 2
        if text.startswith(edge[low:middle], at + low):
            low = middle
        else:
            high = middle - 1
    return low


class Trie:
    """A compressed trie of whole texts; each terminal keeps the smallest identifier."""

    def __init__(self):
        self.root = Node("")
        self.characters = 0

    def insert(self, text: str, held: tuple[int, int]) -> None:
        node, at = self.root, 0
        while at < len(text):
            child = node.children.get(text[at])
            if child is None:
                child = Node(text[at:], held)
                node.children[text[at]] = child
                self.characters += len(text) - at
                return
            if text.startswith(child.edge, at):
                node, at = child, at + len(child.edge)
                continue
            same = shared_length(child.edge, text, at)
            upper = Node(child.edge[:same])
            child.edge = child.edge[same:]
            upper.children[child.edge[0]] = child
            node.children[text[at]] = upper
            node, at = upper, at + same
        node.held = held if node.held is None else min(node.held, held)

    def terminals(self) -> Iterator[tuple[list[str], tuple[int, int]]]:
        """Edges from the root and what is held, for each distinct text."""
        path: list[str] = []
        stack = [(self.root, 0)]
        while stack:
            node, depth = stack.pop()
            del path[depth:]
            path.append(node.edge)
            if node.held is not None:
                yield path, node.held
            stack.extend((child, depth + 1) for child in node.children.values())


def heavy_prefixes(texts: DataFrame, ranges: int, total: int) -> dict[int, list[int]]:
    """Per prefix length, the fingerprints of the prefixes that need a longer one.

    A prefix of one text only, however often it is there, needs none. All texts count; at
    most ``ranges`` / HEAVY_SHARE fingerprints of a length are returned.
    """
    found: dict[int, list[int]] = {}
    length, left = FIRST_PREFIX, texts
    while True:
        stats = left.groupBy(F.xxhash64(F.substring("text", 1, length)).alias("prefix")).agg(
            F.sum("bytes").alias("bytes"), (F.min("print") != F.max("print")).alias("several")
        )
        limit = max(1, int(total / ranges * HEAVY_SHARE))
        heavy = [r["prefix"] for r in stats.where(F.col("several") & (F.col("bytes") > limit)).collect()]
        if not heavy:
            return found
        found[length] = sorted(heavy)
        left = texts.where(is_heavy(length, found[length]))
        length = min(length * GROWTH, WHOLE)


def is_heavy(length: int, prints: list[int]) -> Column:
    return F.xxhash64(F.substring("text", 1, length)).isin(prints)


def prefix_length(heavy: dict[int, list[int]]) -> Column:
    """Code points of a text's prefix: the first length at which it is not too heavy."""
    lengths = sorted(heavy)
    after = F.lit(lengths[-1] * GROWTH if lengths else FIRST_PREFIX)
    for length in reversed(lengths):
        after = F.when(is_heavy(length, heavy[length]), after).otherwise(F.lit(length))
    return after.cast("int")


def _reduced(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per distinct text of each buffer: prefix, text, least identifier, fingerprint."""

    def emptied(trie: Trie) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        size = 0
        for path, (least, mark, length) in trie.terminals():
            text = "".join(path)
            rows.append((text[:length], text, least, mark))
            size += len(text)
            if size > BATCH_CHARACTERS:
                yield _batch(rows)
                rows, size = [], 0
        if rows:
            yield _batch(rows)

    trie = Trie()
    for batch in batches:
        for text, least, mark, length in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            trie.insert(text, (least, mark, length))
            if trie.characters > BUFFER_CHARACTERS:
                yield from emptied(trie)
                trie = Trie()
    yield from emptied(trie)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    prefix, text, least, mark = zip(*rows, strict=True)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(prefix, pa.string()),
            pa.array(text, pa.string()),
            pa.array(least, pa.int64()),
            pa.array(mark, pa.int64()),
        ],
        names=["prefix", "text", "least", "print"],
    )


def _firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The least identifier and the fingerprint of each distinct text of a range."""
    trie = Trie()
    for batch in batches:
        for text, least, mark in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            trie.insert(text, (least, mark))
    found = [held for _, held in trie.terminals()]
    for low in range(0, len(found), 1 << 16):
        part = found[low : low + (1 << 16)]
        yield pa.RecordBatch.from_arrays(
            [pa.array([x[k] for x in part], pa.int64()) for k in (0, 1)], names=["doc_id", "print"]
        )


def first_rows(docs: DataFrame) -> DataFrame:
    """For each distinct text of ``docs`` its smallest doc_id: (doc_id, print).

    ``print`` is the text's fingerprint (``xxhash64``), which tells the texts of a repeated
    doc_id apart. Texts are compared whole; a missing one counts as empty. Rows without
    doc_id take no part, so a text that only such rows have is not returned. Repeated rows
    and other columns change nothing; an empty table gives an empty result.

    Every range holds about RANGE_BYTES of distinct texts, which is what a task keeps.
    """
    rows = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), text_of().alias("text")
    )
    texts = rows.select("*", F.xxhash64("text").alias("print"), F.octet_length("text").alias("bytes"))
    total = texts.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0
    ranges = max(int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-total // RANGE_BYTES))
    length = prefix_length(heavy_prefixes(texts, ranges, total))
    reduced = in_arrow(
        texts.select("text", "doc_id", "print", length.alias("length")),
        _reduced,
        "prefix string, text string, least long, print long",
    )
    placed = reduced.repartitionByRange(ranges, "prefix").select("text", "least", "print")
    return in_arrow(placed, _firsts, "doc_id long, print long")
