"""Benchmark decontamination by templates: questions found again with other numbers and names.

Words become template tokens: numbers, names and units turn into typed placeholders.
Windows of template tokens of the benchmark are hash-joined with those of the documents,
matches are lined up, and what stands in the slots must map consistently from the item to
the document. Windows of the plain lower-cased tokens are joined beside them, so that what
templates cannot tell apart or find inconsistent is still found as a copy.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import in_arrow, text_of
from ebbtide.llm.words import LOWER, U64, Texts, chunks_of, mixed, runs, span_hashes

WINDOW = 8
#: Share of an item's tokens that its lined-up windows must cover.
COVERAGE = 0.5
#: Windows with more placeholders than this share say too little to be used.
MOST_SLOTS = 0.5
#: Items matched per pass over the documents; bounds what is broadcast.
BLOCK_ITEMS = 20_000

#: Units of measure that become a placeholder.
UNITS = (
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg ton tons ounce ounces "
    "pound pounds ml l liter liters litre litres gallon gallons second seconds minute minutes "
    "hour hours day days week weeks month months year years dollar dollars cent cents euro "
    "euros percent degree degrees volt volts watt watts"
).split()

NUMBER, NAME, UNIT = 1, 2, 3

_LETTER = np.ones(256, dtype=bool)
_LETTER[:48] = _LETTER[58:65] = _LETTER[91:97] = _LETTER[123:128] = False
_DIGIT = np.zeros(256, dtype=bool)
_DIGIT[48:58] = True
_STOP = np.zeros(256, dtype=bool)
_STOP[[10, 33, 46, 58, 63, 124]] = True  # new line ! . : ? |


def _hash_of(words: list[str]) -> np.ndarray:
    data = np.frombuffer(" ".join(words).encode(), np.uint8)
    starts, ends, _ = runs(_LETTER[data], np.array([0, len(data)]))
    return np.sort(span_hashes(data, starts, ends)[0])


_UNIT_HASHES = _hash_of(UNITS)


@dataclass
class Template:
    """Tokens of texts: template hash, slot type (0: none), hash of what stands there."""

    tokens: np.ndarray
    kinds: np.ndarray
    values: np.ndarray
    first: np.ndarray


def templates(texts: Texts) -> Template:
    """Canonical tokens of all texts of a slice.

    A token is a run of letters and digits (bytes above 127 count as letters), lower-cased;
    a dot or comma between digits belongs to a number. A number placeholder stands for a
    number, a unit one for a listed unit, and a name one for a capitalised word that is not
    the first of a sentence, unless its text is mostly capitals.
    """
    raw = texts.data
    inside = _LETTER[raw]
    digit = _DIGIT[raw]
    if len(raw) > 2:
        joint = ((raw[1:-1] == 46) | (raw[1:-1] == 44)) & digit[:-2] & digit[2:]
        inside[1:-1] |= joint
    else:
        joint = np.zeros(0, bool)
    starts, ends, first = runs(inside, texts.offsets)
    if len(starts) == 0:
        none = np.zeros(0, U64)
        return Template(none, np.zeros(0, np.int8), none, first)
    values = span_hashes(LOWER[raw], starts, ends)[0]
    numeric = digit.copy()
    numeric[1:-1] |= joint
    upto = np.concatenate([[0], np.cumsum(numeric)])
    number = upto[ends] - upto[starts] == ends - starts
    stops = np.concatenate([[0], np.cumsum(_STOP[raw])])
    after = np.concatenate([[0], ends[:-1]])
    opening = stops[starts] > stops[after]
    opening[first[:-1][first[:-1] < first[1:]]] = True
    capital = (raw[starts] >= 65) & (raw[starts] <= 90)
    capitals = np.concatenate([[0], np.cumsum(capital)])
    share = (capitals[first[1:]] - capitals[first[:-1]]) / np.maximum(np.diff(first), 1)
    loud = np.repeat(share > 0.5, np.diff(first))
    place = np.minimum(np.searchsorted(_UNIT_HASHES, values), len(_UNIT_HASHES) - 1)
    unit = _UNIT_HASHES[place] == values
    kinds = np.zeros(len(starts), np.int8)
    kinds[capital & ~opening & ~loud] = NAME
    kinds[unit] = UNIT
    kinds[number] = NUMBER
    return Template(np.where(kinds > 0, kinds.astype(U64), values), kinds, values, first)


def window_hashes(
    t: Template, low: int, high: int, size: int, plain: bool = False
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the windows of ``size`` tokens from low to high, and which are telling.

    Windows of template tokens, or of the ``plain`` ones, which all are telling.
    """
    tokens = t.values if plain else t.tokens
    n = high - low - size + 1
    if n <= 0:
        return np.zeros(0, U64), np.zeros(0, bool)
    rolled = np.zeros(n, U64)
    for k in range(size):
        rolled += tokens[low + k : low + k + n] * U64(0x9E3779B97F4A7C15 * (2 * k + 1) % (1 << 64) | 1)
    if plain:
        return mixed(rolled), np.ones(n, bool)
    slots = np.concatenate([[0], np.cumsum(t.kinds[low:high] > 0)])
    return mixed(rolled), (slots[size:] - slots[:-size]) <= MOST_SLOTS * size


class Index:
    """The benchmark's windows: sorted hashes with item and position, and a bit table."""

    def __init__(self, items: list[tuple[int | None, str]], size: int = WINDOW):
        self.size = size
        self.ids = [i for i, _ in items]
        self.templates: list[Template] = []
        by_length: dict[tuple[int, bool], list] = defaultdict(list)
        for place, (_, text) in enumerate(items):
            for texts in chunks_of(pa.array([text], pa.string())):
                t = templates(texts)
                self.templates.append(t)
                n = len(t.tokens)
                for plain in (True, False):
                    hashes, telling = window_hashes(t, 0, n, min(size, max(n, 1)), plain)
                    at = np.flatnonzero(telling)
                    by_length[min(size, n), plain].append((hashes[at], np.full(len(at), place), at))
        self.tables = {}
        for (length, plain), rows in by_length.items():
            hashes, owners, positions = (np.concatenate(x) for x in zip(*rows, strict=True))
            if len(hashes) and length > 2:
                order = np.argsort(hashes, kind="stable")
                bits = np.zeros(1 << 20, bool)
                bits[(hashes >> U64(44)).astype(np.int64)] = True
                self.tables[length, plain] = (hashes[order], owners[order], positions[order], bits)

    def matches(self, t: Template) -> Iterator[tuple[int, int, int, int, bool]]:
        """(token position, item's place, position in the item, window size, plain) of equal windows."""
        for (length, plain), (hashes, owners, positions, bits) in self.tables.items():
            found, telling = window_hashes(t, 0, len(t.tokens), length, plain)
            likely = np.flatnonzero(bits[(found >> U64(44)).astype(np.int64)] & telling)
            low = np.searchsorted(hashes, found[likely], side="left")
            high = np.searchsorted(hashes, found[likely], side="right")
            for where, a, b in zip(likely, low, high, strict=True):
                for k in range(a, b):
                    yield int(where), int(owners[k]), int(positions[k]), length, plain

    def consistent(self, t: Template, item: Template, at: np.ndarray) -> bool:
        """Does each slot value of the item stand for one value of the document throughout?"""
        seen: dict[tuple[int, int], int] = {}
        for k in np.flatnonzero((at >= 0) & (item.kinds > 0)):
            value = int(t.values[at[k]])
            if seen.setdefault((int(item.kinds[k]), int(item.values[k])), value) != value:
                return False
        return True

    def hits(self, t: Template, coverage: float) -> list[tuple[int, int, float, int]]:
        """(text's place, item's place, covered share, slots filled otherwise) above the threshold.

        What plain windows cover is a copy by itself; what templates add must be consistent.
        """
        lined: dict[tuple[int, int], tuple[dict, dict]] = {}
        for where, item, position, length, plain in self.matches(t):
            doc = int(np.searchsorted(t.first, where, side="right")) - 1
            if where + length <= t.first[doc + 1]:
                copied, either = lined.setdefault((doc, item), (defaultdict(list), defaultdict(list)))
                for runs_of in (copied, either) if plain else (either,):
                    runs_of[where - position].append((position, length))
        best: dict[tuple[int, int], tuple[float, int]] = {}
        for (doc, place), kinds in lined.items():
            item = self.templates[place]
            for plain, shifts in zip((True, False), kinds, strict=True):
                for at in alignments(shifts, len(item.tokens), coverage):
                    share = round(float((at >= 0).mean()), 6)
                    old = best.get((doc, place))
                    if (old is None or share > old[0]) and (plain or self.consistent(t, item, at)):
                        slots = np.flatnonzero((at >= 0) & (item.kinds > 0))
                        changed = int((item.values[slots] != t.values[at[slots]]).sum())
                        best[doc, place] = (share, changed)
        return [(d, p, *v) for (d, p), v in sorted(best.items())]


def alignments(
    shifts: dict[int, list[tuple[int, int]]], n: int, coverage: float
) -> Iterator[np.ndarray]:
    """Where each of an item's ``n`` tokens stands in the document (-1: nowhere), if enough do.

    First the matches of each shift (place in the document less that in the item) by
    themselves, then the best chain of all: runs that follow each other in the item and in
    the document, their shifts apart by the item's length at most, so that words put in or
    left out do not part a copy.
    """
    segments = []
    union = np.zeros(n, bool)
    most = 0.0
    for shift, found in shifts.items():
        covered = np.zeros(n, bool)
        for position, length in found:
            covered[position : position + length] = True
        union |= covered
        share = float(covered.mean())
        most = max(most, share)
        if share >= coverage:
            yield np.where(covered, np.arange(n) + shift, -1)
        edges = np.flatnonzero(np.diff(np.concatenate([[False], covered, [False]]).astype(np.int8)))
        segments += [(int(a) + shift, int(a), int(b)) for a, b in edges.reshape(-1, 2)]
    whole = float(union.mean())
    if whole < coverage or whole <= most:
        return
    segments.sort()
    score, start, before = [], [], []
    for i, (where, low, high) in enumerate(segments):
        gain, own_start, previous = high - low, low, -1
        for j in range(i - 1, -1, -1):
            where_j, low_j, high_j = segments[j]
            if where - where_j > 2 * n:
                break
            apart = (where - low) - (where_j - low_j)
            if abs(apart) > n or high_j >= high:
                continue
            # what both cover, in the item or in the document, counts for the earlier one
            begin = max(low, high_j, high_j - apart)
            if begin < high and score[j] + high - begin > gain:
                gain, own_start, previous = score[j] + high - begin, begin, j
        score.append(gain)
        start.append(own_start)
        before.append(previous)
    i = int(np.argmax(score))
    if score[i] < coverage * n or score[i] <= most * n:
        return
    at = np.full(n, -1)
    while i >= 0:
        where, low, high = segments[i]
        at[start[i] : high] = np.arange(start[i], high) + (where - low)
        i = before[i]
    yield at


def _item_blocks(benchmark: DataFrame, block: int) -> Iterator[list[tuple[int | None, str]]]:
    """The benchmark in blocks of about ``block`` items, dealt by a hash of the item's text."""
    items = benchmark.where(F.length(text_of()) > 0).select("item_id", "text").distinct()
    blocks = max(1, -(-items.count() // block))
    deal = F.pmod(F.xxhash64("text"), F.lit(blocks))
    for k in range(blocks):
        part = items.where(deal == k).collect()
        rows = [(r["item_id"], r["text"]) for r in part]
        yield sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))


SCHEMA = "doc_id long, item_id long, coverage double, changed_slots int"


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    size: int = WINDOW,
    block: int = BLOCK_ITEMS,
) -> DataFrame:
    """One row per document and benchmark item found in it: doc_id, item_id, coverage, changed_slots.

    A document holds an item if lined-up windows of plain tokens cover ``coverage`` of the
    item's tokens, or windows of both kinds do with consistent slots; ``changed_slots``
    counts slots filled otherwise than in the item (0: a plain copy). Runs of windows in the
    item's order count together, whatever was put in or left out between them. An item
    shorter than a window is one window; items of under three tokens match nothing, and
    items of mostly placeholders only as plain copies. Missing and empty
    texts match nothing; repeated rows give repeated rows; items equal in text both match;
    a missing doc_id or item_id stays; empty tables give an empty result; other columns are
    ignored.

    Documents are scanned once per block of items and not shuffled; a block's index is
    broadcast and is bounded by its number of items.
    """
    context = docs.sparkSession.sparkContext
    rows = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    result = None
    for items in _item_blocks(benchmark, block):
        shared = context.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, size)
            for batch in batches:
                for texts in chunks_of(batch.column(1)):
                    hits = index.hits(templates(texts), coverage)
                    doc, item, share, changed = zip(*hits, strict=True) if hits else ([],) * 4
                    ids = batch.column(0).slice(texts.first, len(texts))
                    yield pa.RecordBatch.from_arrays(
                        [
                            ids.take(pa.array(doc, pa.int64())),
                            pa.array([index.ids[k] for k in item], pa.int64()),
                            pa.array(share, pa.float64()),
                            pa.array(changed, pa.int32()),
                        ],
                        names=["doc_id", "item_id", "coverage", "changed_slots"],
                    )

        found = in_arrow(rows, run, SCHEMA)
        result = found if result is None else result.unionByName(found)
    return result


def without_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    coverage: float = COVERAGE,
    size: int = WINDOW,
    block: int = BLOCK_ITEMS,
) -> DataFrame:
    """The rows of ``docs`` that hold no item, with all columns; a filter per block, no shuffle."""
    context = docs.sparkSession.sparkContext
    for items in _item_blocks(benchmark, block):
        shared = context.broadcast(items)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            index = Index(shared.value, size)
            for batch in batches:
                keep = np.ones(batch.num_rows, bool)
                for texts in chunks_of(batch.column("text")):
                    for doc, *_ in index.hits(templates(texts), coverage):
                        keep[texts.first + doc] = False
                yield batch.filter(pa.array(keep))

        docs = in_arrow(docs, run, docs.schema)
    return docs
