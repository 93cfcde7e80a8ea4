"""Language identification by hyperdimensional profiles.

Every letter has a random vector of +1 and -1, drawn from its code point. An n-gram is its
letters' vectors, each permuted by its place (a cyclic shift), bound by multiplication;
a text is the sum (bundle) of its n-grams, a language the sum of its learning texts. The
language whose prototype has the largest cosine with the text is predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import crc_of_id, in_arrow, text_of
from ebbtide.llm.words import U64, Texts, chunks_of, mixed

DIMENSIONS = 1024  # a multiple of 64
SIZE = 3
#: More languages than this stop the job: prototypes go to the driver and to every task.
MOST_LANGUAGES = 4096
UNKNOWN = "und"
#: n-grams bundled at a time.
SLICE = 1 << 13
_PLACE = U64(21)  # bits of a code point
_CODES = 0x110000


@cache
def folded_letters() -> np.ndarray:
    """Per code point: that of its lower-case letter, 0 for all that is no letter."""
    out = np.zeros(_CODES, np.uint32)
    for k in range(_CODES):
        c = chr(k)
        if c.isalpha():
            low = c.lower()
            out[k] = ord(low) if len(low) == 1 else k
    return out


def letter_vectors(letters: np.ndarray, dimensions: int = DIMENSIONS) -> np.ndarray:
    """A row of +1 and -1 for each code point, the same wherever it is drawn."""
    words = dimensions // 64
    seeds = letters.astype(U64)[:, None] * U64(words) + np.arange(1, words + 1, dtype=U64)
    bits = np.unpackbits(mixed(mixed(seeds * U64(0x9E3779B97F4A7C15))).view(np.uint8), axis=1)
    return (bits.astype(np.int8) << 1) - 1


def grams(texts: Texts, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the letter n-grams, and the position of each text's first (one more than texts).

    Letters are lower-cased; what stands between letters, and the two ends, are one gap each,
    code point 0. Texts without letters have no n-grams.
    """
    points = np.frombuffer(texts.data.tobytes().decode().encode("utf-32-le"), np.uint32)
    leads = np.append(0, np.cumsum((texts.data & 0xC0) != 0x80))
    cuts = leads[texts.offsets]
    symbols = folded_letters()[points]
    # a gap before and behind each text
    at = np.sort(np.concatenate([cuts[:-1], cuts[1:]]))
    symbols = np.insert(symbols, at, 0)
    first = cuts + 2 * np.arange(len(cuts))
    starts = np.zeros(len(symbols), bool)
    starts[first[:-1]] = True
    keep = symbols != 0
    keep[1:] |= symbols[:-1] != 0
    keep |= starts
    place = np.append(0, np.cumsum(keep))[first]
    symbols = symbols[keep]
    owner = np.repeat(np.arange(len(texts)), np.diff(place))
    n = max(0, len(symbols) - size + 1)
    codes = np.zeros(n, U64)
    for k in range(size):
        codes = (codes << _PLACE) | symbols[k : k + n].astype(U64)
    # windows inside one text that hold a letter
    inside = owner[:n] == owner[size - 1 : size - 1 + n]
    codes, owner = codes[inside & (codes != 0)], owner[:n][inside & (codes != 0)]
    return codes, np.searchsorted(owner, np.arange(len(texts) + 1))


class Bundler:
    """Sums of n-gram vectors; the vectors of a letter at each place are drawn once a chunk."""

    def __init__(self, codes: np.ndarray, size: int = SIZE, dimensions: int = DIMENSIONS):
        self.size, self.dimensions = size, dimensions
        mask = U64((1 << 21) - 1)
        parts = [np.unique(codes >> U64(21 * k) & mask) for k in range(size)]
        self.letters = np.unique(np.concatenate(parts)) if len(codes) else np.zeros(1, U64)
        plain = letter_vectors(self.letters, dimensions)
        self.at_place = [np.roll(plain, size - 1 - k, axis=1) for k in range(size)]
        self.row = np.zeros(int(self.letters[-1]) + 1, np.int32)
        self.row[self.letters.astype(np.int64)] = np.arange(len(self.letters))

    def bundle(self, codes: np.ndarray) -> np.ndarray:
        """The sum of the vectors of all ``codes``, exact (whole numbers in floats)."""
        distinct, counts = np.unique(codes, return_counts=True)
        kind = np.float32 if len(codes) < 1 << 24 else np.float64
        total = np.zeros(self.dimensions)
        for low in range(0, len(distinct), SLICE):
            part = distinct[low : low + SLICE]
            bound = None
            for k in range(self.size):
                letters = self.row[(part >> U64(21 * (self.size - 1 - k)) & U64((1 << 21) - 1)).astype(np.int64)]
                own = self.at_place[k][letters]
                bound = own if bound is None else np.multiply(bound, own, out=bound)
            total += counts[low : low + SLICE].astype(kind) @ bound.astype(kind)
        return total


def _learn(size: int, dimensions: int):
    """Per language of a task's rows the sum of its n-gram vectors."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            langs = np.array(batch.column(1).to_pylist(), object)
            for texts in chunks_of(batch.column(0)):
                codes, first = grams(texts, size)
                bundler = Bundler(codes, size, dimensions)
                own = langs[texts.first : texts.first + len(texts)]
                owner = np.repeat(np.arange(len(texts)), np.diff(first))
                names, which = np.unique(own.astype(str), return_inverse=True)
                for k, name in enumerate(names):
                    add = bundler.bundle(codes[which[owner] == k]).astype(np.int64)
                    sums[name] = sums[name] + add if name in sums else add
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums), pa.string()), pa.array([s.tolist() for s in sums.values()], pa.list_(pa.int64()))],
                names=["lang", "sums"],
            )

    return run


def learn(docs: DataFrame, size: int = SIZE, dimensions: int = DIMENSIONS) -> dict[str, np.ndarray]:
    """Prototypes by language, from the rows with a lang whose crc32(doc_id) mod 4 is not 2.

    Every such text counts whole. Languages whose texts have no letter are not learnt. A
    task sends one vector per language, and those are summed component by component.
    """
    rows = docs.where(F.col("lang").isNotNull() & (F.pmod(crc_of_id(), F.lit(4)) != 2))
    found = in_arrow(
        rows.select(text_of().alias("text"), "lang"), _learn(size, dimensions), "lang string, sums array<long>"
    )
    totals = (
        found.select("lang", F.posexplode("sums").alias("at", "value"))
        .groupBy("lang", "at")
        .agg(F.sum("value").alias("value"))
    )
    books: dict[str, np.ndarray] = {}
    for r in totals.limit(MOST_LANGUAGES * dimensions + 1).collect():
        books.setdefault(r["lang"], np.zeros(dimensions))[r["at"]] = r["value"]
    if len(books) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages")
    return {name: books[name] for name in sorted(books) if books[name].any()}


def _predict(shared, size: int, dimensions: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, prototypes = shared.value
        lengths = np.sqrt((prototypes**2).sum(axis=1))
        for batch in batches:
            best, scores = [], []
            for texts in chunks_of(batch.column(2)):
                codes, first = grams(texts, size)
                bundler = Bundler(codes, size, dimensions)
                for low, high in zip(first[:-1], first[1:], strict=True):
                    if low == high or not names:
                        best.append(UNKNOWN)
                        scores.append(0.0)
                        continue
                    own = bundler.bundle(codes[low:high])
                    norm = np.sqrt((own**2).sum()) or 1.0
                    cosines = prototypes @ own / (lengths * norm)
                    k = int(cosines.argmax())
                    best.append(names[k])
                    scores.append(float(min(max(cosines[k], 0.0), 1.0)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).cast(pa.int64()),
                    batch.column(1),
                    pa.array(best, pa.string()),
                    pa.array(scores, pa.float64()),
                ],
                names=["doc_id", "held_out", "lang_pred", "score"],
            )

    return run


def predict(
    docs: DataFrame, prototypes: dict[str, np.ndarray], size: int = SIZE, dimensions: int = DIMENSIONS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, lang_pred and score, the cosine from 0 to 1.

    A text that is missing or has no letter is ``und`` with score 0, as all are if no
    language was learnt. Of equally near languages the first by code point is taken.
    Repeated rows give equal rows, a missing doc_id stays, an empty table gives an empty
    result; lang, source and other columns are not looked at. Whole texts are scored, and
    nothing is shuffled; the prototypes, one vector per language and at most MOST_LANGUAGES,
    are broadcast.
    """
    names = list(prototypes)
    matrix = np.array([prototypes[n] for n in names]).reshape(len(names), dimensions)
    shared = docs.sparkSession.sparkContext.broadcast((names, matrix))
    rows = docs.select("doc_id", (F.pmod(crc_of_id(), F.lit(4)) == 2).alias("held_out"), text_of().alias("text"))
    return in_arrow(
        rows, _predict(shared, size, dimensions), "doc_id long, held_out boolean, lang_pred string, score double"
    )


def identify(docs: DataFrame) -> DataFrame:
    """Learn from the rows that are not held out, and predict all rows."""
    return predict(docs, learn(docs))
