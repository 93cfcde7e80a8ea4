"""Token counts: lengths only, from batches balanced by bytes and texts cut at safe borders."""

from __future__ import annotations

import os
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import in_arrow, text_of, vocabulary

VOCABULARY = "byte_bpe_50k.json"
BATCH_BYTES = 1 << 18
MEMO_PIECES = 600_000
LIMIT = 512


def safe_pieces(text: str) -> list[str]:
    """Cut before each single space that a character other than white space follows.

    The vocabulary's pattern lets such a space only begin the next token, whatever stands
    before it, so pieces have the tokens of the whole. Special strings hold no space.
    """
    pieces = text.split(" ")
    if all(p and not p[0].isspace() for p in pieces[1:]):
        return [pieces[0], *[" " + p for p in pieces[1:]]]
    out = [pieces[0]]
    for p in pieces[1:]:
        if p and not p[0].isspace():
            out.append(" " + p)
        else:
            out[-1] += " " + p
    return out


class Counter:
    """Tokens of pieces by the library; lengths of pieces seen before are remembered.

    The memory is emptied when it holds ``memo`` pieces, so a worker's use is bounded.
    """

    def __init__(self, path: str, memo: int = MEMO_PIECES):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = memo
        self.known: dict[str, int] = {}

    def _learn(self, new: list[str]) -> None:
        batch: list[str] = []
        room = BATCH_BYTES
        for k, piece in enumerate(new):
            batch.append(piece)
            room -= len(piece)
            if room <= 0 or k + 1 == len(new):
                encoded = self.tokenizer.encode_batch_fast(batch, add_special_tokens=False)
                self.known.update(zip(batch, map(len, encoded), strict=True))
                batch, room = [], BATCH_BYTES

    def counts(self, texts: list[str]) -> list[int]:
        pieces = [safe_pieces(t) for t in texts]
        new = set().union(*pieces).difference(self.known)
        if len(self.known) + len(new) > self.memo:
            self.known.clear()
            new = set().union(*pieces)
        self._learn(list(new))
        of = self.known.__getitem__
        return [sum(map(of, p)) for p in pieces]


_counters: dict[str, Counter] = {}


def balanced(lengths: list[int], room: int = 4 * BATCH_BYTES) -> Iterator[tuple[int, int]]:
    """Runs of rows of about ``room`` characters each; a longer text is a run of its own."""
    start = total = 0
    for k, n in enumerate(lengths):
        if k > start and total + n > room:
            yield start, k
            start, total = k, 0
        total += n
    if start < len(lengths):
        yield start, len(lengths)


SCHEMA = "doc_id long, n_bytes long, n_tokens long"


def count_tokens(docs: DataFrame, path: str | None = None, limit: int = LIMIT) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_bytes (UTF-8), n_tokens, over_limit.

    A missing text counts as empty (0 tokens). Whole texts are counted, however long; a
    long one is cut at safe borders into pieces that the library gets in batches. A missing
    doc_id stays, repeated rows give equal rows, an empty table an empty result, other
    columns are ignored. Nothing is shuffled.
    """
    path = path or vocabulary(VOCABULARY)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counters.setdefault(path, None) or Counter(path)
        _counters[path] = counter
        for batch in batches:
            lengths = [x.as_py() for x in batch.column(1)]
            for low, high in balanced(lengths):
                texts = batch.column(2).slice(low, high - low).to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(low, high - low),
                        batch.column(1).slice(low, high - low),
                        pa.array(counter.counts(texts), pa.int64()),
                    ],
                    names=["doc_id", "n_bytes", "n_tokens"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long"),
        F.octet_length(text_of()).cast("long").alias("n_bytes"),
        text_of().alias("text"),
    )
    return in_arrow(rows, run, SCHEMA).withColumn("over_limit", F.col("n_tokens") > limit)
