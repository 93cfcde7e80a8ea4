"""Token-ID files: ids of whole texts, range-coded in independently checksummed blocks.

Ids are predicted by their last two, by their last one and by how often they occur. What
follows what, and how far to trust it, is counted over a chunk's ids before they are
coded and stands at the head of its payload. The resulting probabilities drive a range
coder with a state per block (asymmetric numeral systems). A block of 4,096 ids needs the
chunk's head and its own words only, and all blocks of a chunk are coded in step by array
operations.

A file's rows are chunks of whole documents. A chunk's payload is: ``EBT2``, the number of
blocks, the length of the head and its crc32 (32 bits each), the head, then for each block
its number of ids, number of code words and the crc32 of its ids as 32-bit little-endian
numbers, then all blocks' 16-bit code words. Numbers of the payload are little-endian.
"""

from __future__ import annotations

import json
import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ebbtide.llm.shared import in_arrow, stored, text_of, vocabulary
from ebbtide.llm.token_counts import balanced

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
BLOCK_IDS = 4096
LANES = 2048
CHUNK_IDS = BLOCK_IDS * LANES
MEMO_WORDS = 1_500_000
MAGIC = b"EBT2"

_CONTEXTS = 128
_IDS_A_SLOT = 64
_PIECE = 1 << 20
_WORDS_A_TEXT = 256
_BETWEEN = " ^ "
#: What the vocabulary parts a text into; its special strings hold one of <, | and >.
_RULES = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_LETTERS = r"^\pL+$"
#: The last letter is one that no normal form or lower case turns into a letter and a mark.
_BEFORE_TAIL = r"^\pL*[A-Za-zÀ-ÖØ-öø-įı-ſΑ-ΡΣ-Ωα-ωЀ-џ]$"
_TAIL = '!"#$%&()*+,-./:;=?@[\\]^_`{}~'
#: Characters of the texts that are split at once; the known words are hashed anew for each lot.
TEXT_CHARACTERS = 3 << 23


class _Model:
    """How the ids of a chunk follow each other: what the coder and the reader share.

    Ids are numbered by rank among those of the chunk. ``after1`` names for each last id,
    ``after2`` for each slot of the last two, the id that follows most often (rank times 8)
    and in how many eighths of the cases it does. These two, and whether both name the same
    id, are the context of an event: 0, the id after the last two; 1, the one after the
    last; 2, any other id, which is then coded by how often it was left to that.
    """

    def __init__(self, known: np.ndarray, after1: np.ndarray, after2: np.ndarray):
        self.known, self.after1, self.after2 = known, after1, after2
        self.start = len(known)  # stands for the ids before a block
        self.shift = np.uint32(32 - max(1, len(after2).bit_length() - 1))

    def slots(self, last1: np.ndarray, last2: np.ndarray) -> np.ndarray:
        return ((last1 * np.uint32(0x9E3779B1)) ^ (last2 * np.uint32(0x85EBCA6B))) * np.uint32(0xC2B2AE35) >> self.shift

    def named(self, last1: np.ndarray, last2: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The ids after the last two and after the last, and the context of the event."""
        two, one = self.after2.take(self.slots(last1, last2)), self.after1.take(last1)
        first, second = two >> 3, one >> 3
        return first, second, ((two & 7) << 4) | ((one & 7) << 1) | (first == second)

    def set_frequencies(self, events: np.ndarray, others: np.ndarray) -> None:
        """Of 65,536 each: those of the three events in each context and of other ids."""
        self.events, self.others = events, others
        self.event_size = events.ravel().astype(np.uint32)
        self.event_start = (np.cumsum(events, axis=1) - events).ravel().astype(np.uint32)
        # the last entry takes all of the range, which leaves a coder's state as it is
        self.size = np.append(others, 1 << 16).astype(np.uint32)
        self.place = np.append(np.cumsum(others) - others, 0).astype(np.uint32)

    def to_bytes(self) -> bytes:
        heads = np.array([len(self.known), len(self.after2)], "<u4")
        parts = (self.known, "<u2"), (self.after1, "<u4"), (self.after2, "<u4"), (self.events, "<u4"), (self.others, "<u4")
        return zlib.compress(b"".join([heads.tobytes(), *(a.astype(t).tobytes() for a, t in parts)]), 1)

    @classmethod
    def from_bytes(cls, data: bytes) -> _Model:
        data = zlib.decompress(data)
        n, slots = np.frombuffer(data, "<u4", 2).tolist()
        at, parts = 8, []
        for count, kind in ((n, "<u2"), (n + 1, "<u4"), (slots, "<u4"), (3 * _CONTEXTS, "<u4"), (n, "<u4")):
            parts.append(np.frombuffer(data, kind, count, at).astype(np.uint32))
            at += count * int(kind[-1])
        model = cls(*parts[:3])
        model.set_frequencies(parts[3].reshape(_CONTEXTS, 3).astype(np.int64), parts[4].astype(np.int64))
        return model


def _scaled(counts: np.ndarray) -> np.ndarray:
    """Frequencies of 65,536 together, at least 1 for each that occurs."""
    total = int(counts.sum())
    if not total:
        return np.append((1 << 16), np.zeros(len(counts) - 1, np.int64))
    seen = counts > 0
    out = seen + counts * ((1 << 16) - int(seen.sum())) // total
    out[np.argmax(out)] += (1 << 16) - out.sum()
    return out


def _most(context: np.ndarray, follows: np.ndarray, size: int) -> np.ndarray:
    """For each context the id that follows most often, times 8, plus eighths of the cases."""
    key = (context.astype(np.int64) << 16) | follows
    key.sort()
    first = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
    count = np.diff(np.append(first, len(key)))
    key = key[first]
    here = key >> 16
    start = np.flatnonzero(np.append(True, here[1:] != here[:-1]))
    best = np.maximum.reduceat((count << 16) | (0xFFFF - (key & 0xFFFF)), start)
    top, total = best >> 16, np.add.reduceat(count, start)
    out = np.zeros(size, np.uint32)
    # an id that followed once only is no sign
    out[here[start]] = ((0xFFFF - (best & 0xFFFF)) << 3) | np.where(top > 1, np.minimum(8 * top // total, 7), 0)
    return out


def _by_step(ids: np.ndarray, fill: int) -> np.ndarray:
    """A row for each step of all blocks; a last block that is shorter is filled up."""
    steps = min(BLOCK_IDS, len(ids))
    blocks = -(-len(ids) // steps)
    out = np.full(blocks * steps, fill, ids.dtype)
    out[: len(ids)] = ids
    return np.ascontiguousarray(out.reshape(blocks, steps).T)


def _learn(ids: np.ndarray) -> tuple[_Model, np.ndarray, np.ndarray, np.ndarray]:
    """The model of a chunk; each id's event with its context, and its rank where it is another id."""
    counts = np.bincount(ids, minlength=1 << 16)
    known = np.flatnonzero(counts)
    rank = np.zeros(1 << 16, np.uint16)
    rank[known] = np.arange(len(known))
    x = rank[ids]
    last1, last2 = np.empty(len(x), np.uint32), np.empty(len(x), np.uint32)
    last1[1:], last2[2:] = x[:-1], x[:-2]
    last1[::BLOCK_IDS] = last2[::BLOCK_IDS] = last2[1::BLOCK_IDS] = len(known)  # a block's own start
    slots = 1 << max(1, (len(x) // _IDS_A_SLOT).bit_length() - 1)
    model = _Model(known, _most(last1, x, len(known) + 1), np.zeros(slots, np.uint32))
    model.after2 = _most(model.slots(last1, last2), x, slots)
    none = len(known)
    entry, other = np.empty(len(x), np.uint16), np.empty(len(x), np.min_scalar_type(none))
    for low in range(0, len(x), _PIECE):
        part = slice(low, low + _PIECE)
        first, second, context = model.named(last1[part], last2[part])
        event = np.where(x[part] == first, 0, np.where(x[part] == second, 1, 2))
        entry[part] = 3 * context + event
        other[part] = np.where(event == 2, x[part], none)
    events = np.bincount(entry, minlength=3 * _CONTEXTS).reshape(_CONTEXTS, 3)
    # every event keeps a place, so that each context adds up
    events = np.stack([_scaled(row + 1) for row in events])
    others = np.bincount(other, minlength=none + 1)[:none]
    model.set_frequencies(events, _scaled(others))
    return model, entry, other


def encode(ids: np.ndarray) -> bytes:
    """The payload of a chunk for its ids (each below 65,536)."""
    ids = np.asarray(ids)
    if not len(ids):
        return MAGIC + bytes(12)
    model, entry, other = _learn(ids)
    entry, other = _by_step(entry, 0), _by_step(other, 0)
    steps, blocks = entry.shape
    last = len(ids) - (blocks - 1) * steps
    words = np.zeros((2 * steps, blocks), np.uint16)
    out = np.zeros((2 * steps, blocks), bool)
    state = np.full(blocks, 1 << 16, np.uint32)
    high = np.uint32(16)
    for t in range(steps - 1, -1, -1):  # a reader meets what was coded last first
        live = blocks if t < last else blocks - 1
        at, e = other[t, :live], entry[t, :live]
        for k, size, start in (
            (2 * t + 1, model.size.take(at), model.place.take(at)),
            (2 * t, model.event_size.take(e), model.event_start.take(e)),
        ):
            now = state[:live]
            full = (now >> high) >= size
            words[k, :live] = now & np.uint32(0xFFFF)
            out[k, :live] = full
            now = now >> (full.astype(np.uint32) << np.uint32(4))
            whole = now // size
            state[:live] = (whole << high) + (now - whole * size) + start
    coded = words.T[out.T]
    lengths = out.sum(axis=0) + 2
    ends = np.cumsum(lengths)
    stream = np.empty(ends[-1], "<u2")
    own = np.ones(len(stream), bool)
    own[ends - lengths] = own[ends - lengths + 1] = False
    stream[own] = coded
    stream[ends - lengths], stream[ends - lengths + 1] = state >> high, state & np.uint32(0xFFFF)
    plain = ids.astype("<u4")
    header = np.zeros((blocks, 3), "<u4")
    header[:, 0], header[:, 1] = steps, lengths
    header[-1, 0] = last
    header[:, 2] = [zlib.crc32(plain[k * steps : (k + 1) * steps].tobytes()) for k in range(blocks)]
    learnt = model.to_bytes()
    counts = np.array([blocks, len(learnt), zlib.crc32(learnt)], "<u4")
    return b"".join([MAGIC, counts.tobytes(), learnt, header.tobytes(), stream.tobytes()])


def _decoded(model: _Model, words: np.ndarray, starts: np.ndarray, steps: int, last: int) -> np.ndarray:
    """Ranks by step and block; the last block has ``last`` of the steps.

    A word is looked up for all blocks and taken by those whose state is low.
    """
    blocks = len(starts)
    of_place = np.repeat(np.arange(len(model.others), dtype=np.uint16), model.others)
    second_from, third_from = model.events[:, 0].astype(np.uint32), model.events[:, :2].sum(axis=1).astype(np.uint32)
    state = (words[starts].astype(np.uint32) << np.uint32(16)) | words[starts + 1]
    at = starts + 2
    low, high, none = np.uint32(0xFFFF), np.uint32(16), np.uint32(model.start)
    last1, last2 = np.full(blocks, none), np.full(blocks, none)
    ranks = np.zeros((steps, blocks), np.uint32)
    for t in range(steps):
        if t == last:
            state, at, last1, last2 = state[:-1], at[:-1], last1[:-1], last2[:-1]
        first, second, context = model.named(last1, last2)
        place = state & low
        event = (place >= second_from.take(context)).astype(np.uint32) + (place >= third_from.take(context))
        e = 3 * context + event
        state = model.event_size.take(e) * (state >> high) + place - model.event_start.take(e)
        more = state <= low
        state = np.where(more, (state << high) | words.take(at, mode="clip"), state)
        at = at + more
        other = event == 2
        place = state & low
        x = of_place.take(place)
        entry = np.where(other, x, none)
        state = model.size.take(entry) * (state >> high) + place - model.place.take(entry)
        more = state <= low
        state = np.where(more, (state << high) | words.take(at, mode="clip"), state)
        at = at + more
        x = np.where(other, x, np.where(event == 0, first, second))
        ranks[t, : len(x)] = x
        last1, last2 = x, last1
    return ranks


def decode(payload: bytes) -> np.ndarray:
    """The ids of a chunk; raises if the payload or one of its blocks is damaged."""
    if payload[:4] != MAGIC:
        raise ValueError("not a token chunk")
    if len(payload) < 16:
        raise ValueError("token chunk of a wrong length")
    count, size, crc = np.frombuffer(payload, "<u4", 3, 4).tolist()
    if not count:
        return np.zeros(0, np.int64)
    body = 16 + size + 12 * count
    learnt = payload[16 : 16 + size]
    if len(payload) < body or zlib.crc32(learnt) != crc:
        raise ValueError("the model of a token chunk is damaged")
    header = np.frombuffer(payload, "<u4", 3 * count, 16 + size).reshape(count, 3).astype(np.int64)
    steps, last = int(header[0, 0]), int(header[-1, 0])
    ends = np.cumsum(header[:, 1])
    if len(payload) != body + 2 * ends[-1] or (header[:, 1] < 2).any() or (header[:-1, 0] != steps).any() or not 0 < last <= steps <= BLOCK_IDS:
        raise ValueError("token chunk of a wrong length")
    model = _Model.from_bytes(learnt)
    words = np.frombuffer(payload[body:], "<u2")  # a copy, since look-ups in a shifted array are slow
    ranks = _decoded(model, words, ends - header[:, 1], steps, last)
    out = model.known.astype(np.uint16)[ranks.T].ravel()[: (count - 1) * steps + last]
    plain = out.astype("<u4")
    for k in range(count):
        if zlib.crc32(plain[k * steps : (k + 1) * steps].tobytes()) != header[k, 2]:
            raise ValueError(f"block {k} of a token chunk is damaged")
    return out.astype(np.int64)


def _gathered(pool: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The runs of ``pool`` that begin at ``starts``, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    out = np.empty(ends[-1] if len(ends) else 0, pool.dtype)
    for low in range(0, len(ends), _PIECE):  # places take four times the room of ids
        n, upto = sizes[low : low + _PIECE], ends[low : low + _PIECE]
        first, last = upto[0] - n[0], upto[-1]
        places = np.repeat(starts[low : low + _PIECE] - upto + n, n)
        places += np.arange(first, last)
        pool.take(places, out=out[first:last], mode="clip")
    return out


class Encoder:
    """Ids of whole texts by the library, which gets each word once while it is remembered.

    The vocabulary drops white space, so words at ASCII white space are encoded alone as
    they are in the text. Where its rules are those below, a word of letters before a run
    of punctuation is two, and its A-Z are lower-cased before it is looked up: the library
    does the same. The memory is emptied when it holds ``memo`` words.
    """

    def __init__(self, path: str, memo: int = MEMO_WORDS):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.memo = memo
        between = self.tokenizer.encode(_BETWEEN, add_special_tokens=False).ids
        self.between = between[0] if len(between) == 1 else -1
        self.splits = self._has_rules()
        #: ids that end what the rules part, by their name in the vocabulary
        self.ends = np.zeros(1 << 16, bool)
        if self.splits:
            suffix = self.tokenizer.model.end_of_word_suffix
            self.ends[[k for name, k in self.tokenizer.get_vocab(False).items() if name.endswith(suffix)]] = True
        self._forget()

    def _has_rules(self) -> bool:
        """Whether letters and punctuation are parted and A-Z lower-cased.

        Special strings, which the rules leave alone, must hold what neither part of a word can.
        """
        tokenizer, model = self.tokenizer, self.tokenizer.model
        if not getattr(model, "end_of_word_suffix", None) or tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
            return False
        normal, parts = (json.loads(x.__getstate__()) for x in (tokenizer.normalizer, tokenizer.pre_tokenizer))
        kinds = [x.get("type") for x in normal.get("normalizers", [])]
        named = "type", "pattern", "behavior", "invert", "use_regex"
        rules = [tuple(x.get(k) for k in named) for x in parts.get("pretokenizers", [])]
        return (
            kinds == ["NFC", "Replace", "Lowercase"]
            and normal["normalizers"][1].get("pattern") == {"Regex": r"\s+"}
            and rules == [("Split", {"Regex": _RULES}, "Removed", True, None), ("ByteLevel", None, None, None, False)]
            and all(set("<|>") & set(x.content) for x in tokenizer.get_added_tokens_decoder().values())
        )

    def _forget(self) -> None:
        """Known are no word, which has no ids, and the end id."""
        self.known = pa.array([""], pa.string())
        self.pool = np.array([END_ID], np.uint16)
        self.starts, self.sizes = np.zeros(1, np.int64), np.zeros(1, np.int64)

    def _encoded(self, words: pa.Array, between: str) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids. Many words are one text of the library.

        No token reaches over white space, so a word of its own between them parts their
        ids; words of letters have one end each. Where ends are found more often, words are
        encoded one by one.
        """
        sizes, parts = [np.zeros(0, np.int64)], [np.zeros(0, np.uint16)]
        bounds = np.append(np.arange(0, len(words), _WORDS_A_TEXT), len(words)).astype(np.int32)
        texts = pc.binary_join(pa.ListArray.from_arrays(bounds, words), between).to_pylist()
        for low in range(0, len(texts), 100):
            encoded = self.tokenizer.encode_batch_fast(texts[low : low + 100], add_special_tokens=False)
            for k, e in enumerate(encoded, low):
                ids, count = np.array(e.ids, np.uint16), int(bounds[k + 1] - bounds[k])
                if between == " ":
                    ends = np.flatnonzero(self.ends[ids])
                    if len(ends) == count and ends[-1] == len(ids) - 1:
                        sizes.append(np.diff(ends, prepend=-1))
                        parts.append(ids)
                        continue
                else:
                    own = ids != self.between
                    ends = np.flatnonzero(~own)
                    if len(ends) == count - 1:
                        sizes.append(np.diff(ends, prepend=-1, append=len(ids)) - 1)
                        parts.append(ids[own])
                        continue
                group = words.slice(int(bounds[k]), count).to_pylist()
                alone = [one.ids for one in self.tokenizer.encode_batch_fast(group, add_special_tokens=False)]
                sizes.append(np.array([len(x) for x in alone]))
                parts += [np.array(x, np.uint16) for x in alone]
        return np.concatenate(sizes), np.concatenate(parts)

    def _places(self, words: pa.Array) -> np.ndarray:
        """The place of each of the different words among the known ones; new ones are learnt."""
        found = pc.index_in(words, value_set=self.known)
        if len(self.known) + found.null_count > self.memo:
            self._forget()
            found = pc.index_in(words, value_set=self.known)
        places = found.fill_null(-1).to_numpy().copy()
        new = np.flatnonzero(places < 0)
        if len(new):
            letters = pc.match_substring_regex(words, _LETTERS).to_numpy(False)[new] & self.splits
            for own, between in ((new[letters], " "), (new[~letters], _BETWEEN)):
                some = words.take(pa.array(own))
                sizes, ids = self._encoded(some, between)
                places[own] = len(self.known) + np.arange(len(own))
                self.known = pa.concat_arrays([self.known, some])
                self.starts = np.append(self.starts, len(self.pool) + np.cumsum(sizes) - sizes)
                self.sizes = np.append(self.sizes, sizes)
                self.pool = np.append(self.pool, ids)
        return places

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Number of ids of each word, and all ids."""
        if self.splits:
            stems = pc.ascii_rtrim(words, _TAIL)
            plain = pc.match_substring_regex(stems, _BEFORE_TAIL)
            tailed = pc.and_(plain, pc.not_equal(pc.binary_length(stems), pc.binary_length(words)))
            stems = pc.if_else(plain, pc.ascii_lower(stems), words).dictionary_encode()
            tails = pc.replace_substring_regex(words.filter(tailed), r"^\pL+", "").dictionary_encode()
            different = pa.concat_arrays([stems.dictionary, tails.dictionary]).dictionary_encode()
            places = self._places(different.dictionary)[different.indices.to_numpy()]
            both = np.zeros((len(words), 2), np.int64)  # no word stands for no tail
            both[:, 0] = places[stems.indices.to_numpy()]
            both[tailed.to_numpy(False), 1] = places[len(stems.dictionary) + tails.indices.to_numpy()]
        else:
            both = self._places(words)[:, None]
        sizes = self.sizes[both]
        return sizes.sum(axis=1), _gathered(self.pool, self.starts[both].ravel(), sizes.ravel())

    def ids(self, texts: pa.Array) -> list[np.ndarray]:
        """16-bit ids of each text, the end id last."""
        split = pc.ascii_split_whitespace(texts)
        ends = split.value_lengths().to_numpy().cumsum(dtype=np.int64)
        coded = split.flatten().dictionary_encode()
        sizes, pool = self._words(coded.dictionary)
        starts, sizes = np.append(np.cumsum(sizes) - sizes, len(pool)), np.append(sizes, 1)
        of = np.insert(coded.indices.to_numpy(), ends, len(coded.dictionary))  # the end id is a word more
        n = sizes[of]
        found = _gathered(np.append(pool, np.uint16(END_ID)), starts[of], n)
        return np.split(found, np.cumsum(n)[ends + np.arange(len(ends))])[:-1]


_encoders: dict[str, Encoder] = {}

CHUNK = "part int, seq int, n_ids long, doc_ids array<long>, lengths array<long>, payload binary"


def write_tokens(docs: DataFrame, path: str | None = None, label: str = "token_files") -> DataFrame:
    """Write the ids of all texts in ascending order of doc_id; returns the table of chunks.

    Documents are range-partitioned and sorted by doc_id (a missing one first; rows equal in
    doc_id by a hash of the text). A chunk is written when it holds 8 million ids and always
    ends with a document, so a very long text makes its chunk longer and is never cut.
    """
    path = path or vocabulary(VOCABULARY)
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = (
        docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
        .repartitionByRange(parts, "doc_id", F.xxhash64("text"))
        .sortWithinPartitions("doc_id", F.xxhash64("text"))
        .select(F.spark_partition_id().alias("part"), "doc_id", "text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _encoders:
            _encoders[path] = Encoder(path)
        names: list = []
        ids: list[np.ndarray] = []
        size = seq = part = 0

        def chunk() -> pa.RecordBatch:
            arrays = [
                pa.array([part], pa.int32()),
                pa.array([seq], pa.int32()),
                pa.array([size], pa.int64()),
                pa.array([names], pa.list_(pa.int64())),
                pa.array([[len(x) for x in ids]], pa.list_(pa.int64())),
                pa.array([encode(np.concatenate(ids))], pa.binary()),
            ]
            return pa.RecordBatch.from_arrays(arrays, names=[f.split()[0] for f in CHUNK.split(", ")])

        for batch in batches:
            lengths = pc.utf8_length(batch.column(2)).to_pylist()
            for low, high in balanced(lengths, TEXT_CHARACTERS):
                piece = batch.slice(low, high - low)
                part = piece.column(0)[0].as_py()
                for name, own in zip(
                    piece.column(1).to_pylist(), _encoders[path].ids(piece.column(2)), strict=True
                ):
                    names.append(name)
                    ids.append(own)
                    size += len(own)
                    if size >= CHUNK_IDS:
                        yield chunk()
                        names, ids, size, seq = [], [], 0, seq + 1
        if ids:
            yield chunk()

    return stored(in_arrow(rows, run, CHUNK), label)


READ = "part int, seq int, doc_id long, before long, n_tokens long, ids_crc32 long"


def read_tokens(chunks: DataFrame) -> DataFrame:
    """One row per document of the files: doc_id, start, n_tokens, ids_crc32, in any order.

    All blocks are decoded and checked. ``start`` adds the ids of earlier parts, of earlier
    chunks of the part and of earlier documents of the chunk.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                row = batch.slice(k, 1)
                ids = decode(row.column(4)[0].as_py()).astype("<u4")
                lengths = np.array(row.column(3)[0].as_py(), np.int64)
                ends = np.cumsum(lengths)
                crcs = [
                    zlib.crc32(ids[e - n : e].tobytes()) for e, n in zip(ends, lengths, strict=True)
                ]
                n = len(lengths)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([row.column(0)[0].as_py()] * n, pa.int32()),
                        pa.array([row.column(1)[0].as_py()] * n, pa.int32()),
                        pa.array(row.column(2)[0].as_py(), pa.int64()),
                        pa.array(ends - lengths),
                        pa.array(lengths),
                        pa.array(crcs, pa.int64()),
                    ],
                    names=[f.split()[0] for f in READ.split(", ")],
                )

    read = in_arrow(chunks.select("part", "seq", "doc_ids", "lengths", "payload"), run, READ)
    before = Window.partitionBy("part").orderBy("seq")
    in_part = chunks.select("part", "seq", (F.sum("n_ids").over(before) - F.col("n_ids")).alias("_in_part"))
    totals = chunks.groupBy("part").agg(F.sum("n_ids").alias("_n"))
    earlier = Window.partitionBy(F.lit(0)).orderBy("part")  # a row per part of the files
    of_part = totals.select("part", (F.sum("_n").over(earlier) - F.col("_n")).alias("_of_part"))
    starts = in_part.join(of_part, "part")
    return read.join(starts, ["part", "seq"]).select(
        "doc_id",
        (F.col("_of_part") + F.col("_in_part") + F.col("before")).cast("long").alias("start"),
        "n_tokens",
        "ids_crc32",
    )


def write_and_read(docs: DataFrame, path: str | None = None) -> DataFrame:
    """Write the files, read them back: one row per row of ``docs``.

    A missing or empty text has the end id alone. Repeated rows are documents of their own,
    one after the other; a missing doc_id comes first; an empty table gives an empty
    result; other columns are ignored.
    """
    return read_tokens(write_tokens(docs, path))
