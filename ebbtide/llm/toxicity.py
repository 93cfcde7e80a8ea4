"""Toxic spans by a linear-chain conditional random field, and document scores from them.

Training words of toxic documents are labelled from the documents' labels: a word is
toxic there if its form, or the way it begins, is far likelier in toxic documents. The
field learns weights of hashed word features and of the transitions between clean and
toxic words. Forward-backward marginals of its two states tell how likely each word is
toxic; a logistic model of their largest and their sum scores the document.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import crc_of_id, in_arrow, ship_package, text_of
from ebbtide.llm.words import U64, Texts, chunks_of, runs, span_hashes, words

FEATURE_BITS = 20
#: A word's features: its whole form and its first 4, 5 and 6 bytes.
PREFIXES = (4, 5, 6)
#: The bound of the training sample, documents of each label.
SAMPLE_TOXIC = 2000
SAMPLE_CLEAN = 4000
#: A feature marks toxic words from this log ratio and from so many toxic documents.
MARK_LOG_RATIO = 3.5
MARK_DOCUMENTS = 3
EPOCHS = 6
#: The scorer of documents learns from fields trained without them, in so many parts.
SCORER_FOLDS = 2
PENALTY = 1e-4

_LETTER = np.ones(256, dtype=bool)
_LETTER[:48] = _LETTER[58:65] = _LETTER[91:97] = _LETTER[123:128] = False


def tokens(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and first positions of runs of letters and digits."""
    return runs(_LETTER[texts.data], texts.offsets)


def features(texts: Texts) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Feature numbers (tokens by kinds of feature), starts, ends and first positions."""
    data, _, _, _ = words(texts)
    starts, ends, first = tokens(texts)
    cut = [np.minimum(ends, starts + k) for k in PREFIXES]
    hashed = span_hashes(data, starts, ends, *cut)
    shift = U64(64 - FEATURE_BITS)
    salted = [(h * U64(2 * k + 0x5851F42D4C957F2D)) >> shift for k, h in enumerate(hashed)]
    return np.stack(salted, axis=1).astype(np.int32), starts, ends, first


def scan(a: np.ndarray, b: np.ndarray, c: np.ndarray, d: np.ndarray, lane: int = 64) -> np.ndarray:
    """x[i] = (a[i] x[i-1] + b[i]) / (c[i] x[i-1] + d[i]) for non-negative values; x[-1] = 1.

    The steps are linear fractional maps, which compose. The sequence is cut into lanes;
    all lanes compose their maps in step, lane ends are chained, and all lanes are then
    evaluated in step. That is exact, and takes 2 * ``lane`` array operations plus one
    scalar step per lane.
    """
    n = len(a)
    count = -(-n // lane)
    one = [np.ones(count * lane), np.zeros(count * lane), np.zeros(count * lane), np.ones(count * lane)]
    for whole, part in zip(one, (a, b, c, d), strict=True):
        whole[:n] = part
    a, b, c, d = (x.reshape(count, lane).T.copy() for x in one)
    ca, cb, cc, cd = a[0].copy(), b[0].copy(), c[0].copy(), d[0].copy()
    for k in range(1, lane):
        ca, cb, cc, cd = (
            a[k] * ca + b[k] * cc,
            a[k] * cb + b[k] * cd,
            c[k] * ca + d[k] * cc,
            c[k] * cb + d[k] * cd,
        )
        scale = 1.0 / np.maximum(np.maximum(ca, cb), np.maximum(cc, cd))
        ca, cb, cc, cd = ca * scale, cb * scale, cc * scale, cd * scale
    x, into = 1.0, np.empty(count)
    for k, (p, q, r, s) in enumerate(zip(ca.tolist(), cb.tolist(), cc.tolist(), cd.tolist(), strict=True)):
        into[k] = x
        x = min(max((p * x + q) / max(r * x + s, 1e-300), 1e-300), 1e300)
    out = np.empty((lane, count))
    for k in range(lane):
        into = (a[k] * into + b[k]) / (c[k] * into + d[k])
        out[k] = into
    return out.T.reshape(-1)[:n]


@dataclass
class Field:
    """Weights of the features for the toxic state, log transition weights, and the scorer."""

    weights: np.ndarray
    moves: np.ndarray  # moves[i, j]: from state i to state j
    start: float
    document: np.ndarray  # intercept, logit of the largest marginal, log1p of their sum
    prior: float
    trained: bool = True

    def evidence(self, numbers: np.ndarray) -> np.ndarray:
        return np.clip(self.weights[numbers].sum(axis=1, dtype=np.float64), -30, 30)

    def forward_backward(self, u: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Odds of the toxic state from the left (with the word) and from the right."""
        m, e = np.exp(self.moves), np.exp(u)
        n = len(u)
        begins = np.zeros(n, bool)
        begins[first[:-1][first[:-1] < first[1:]]] = True
        ahead = scan(
            np.where(begins, 0.0, e * m[1, 1]),
            np.where(begins, e * np.exp(self.start), e * m[0, 1]),
            np.where(begins, 0.0, m[1, 0]),
            np.where(begins, 1.0, m[0, 0]),
        )
        ends = np.zeros(n, bool)
        ends[:-1] = begins[1:]
        ends[-1:] = True
        follow = np.append(e[1:], 1.0)
        rest = [
            np.where(ends, 0.0, m[1, 1] * follow),
            np.where(ends, 1.0, m[1, 0]),
            np.where(ends, 0.0, m[0, 1] * follow),
            np.where(ends, 1.0, m[0, 0]),
        ]
        back = scan(*(x[::-1] for x in rest))[::-1]
        return ahead, back

    def marginals(self, numbers: np.ndarray, first: np.ndarray) -> np.ndarray:
        """How likely each word is toxic."""
        if len(numbers) == 0:
            return np.zeros(0)
        ahead, back = self.forward_backward(self.evidence(numbers), first)
        odds = ahead * back
        return odds / (1.0 + odds)

    def document_inputs(self, marginals: np.ndarray, first: np.ndarray) -> np.ndarray:
        """Per text: 1, logit of its largest marginal, log1p of their sum."""
        count = len(first) - 1
        largest, total = np.full(count, 1e-6), np.zeros(count)
        filled = np.flatnonzero(first[:-1] < first[1:])
        if len(filled):
            at = first[:-1][filled]
            largest[filled] = np.clip(np.maximum.reduceat(marginals, at), 1e-6, 1 - 1e-6)
            total[filled] = np.add.reduceat(marginals, at)
        return np.stack([np.ones(count), np.log(largest / (1 - largest)), np.log1p(total)], axis=1)

    def scores(self, marginals: np.ndarray, first: np.ndarray) -> np.ndarray:
        if not self.trained:
            return np.full(len(first) - 1, self.prior)
        z = self.document_inputs(marginals, first) @ self.document
        return 1.0 / (1.0 + np.exp(-np.clip(z, -30, 30)))


def _logistic(x: np.ndarray, y: np.ndarray, weight: np.ndarray, ridge: float = 1.0) -> np.ndarray:
    """Penalised logistic regression by Newton's method (the intercept is free)."""
    w = np.zeros(x.shape[1])
    penalty = np.diag([1e-6] + [ridge] * (x.shape[1] - 1))
    for _ in range(30):
        p = 1.0 / (1.0 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (weight * (p - y)) + penalty @ w
        curve = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty
        step = np.linalg.solve(curve, gradient)
        w -= np.clip(step, -4, 4)
        if np.abs(step).max() < 1e-8:
            break
    return w


def _document_counts(numbers: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> np.ndarray:
    """In how many of the chosen texts each feature occurs."""
    counts = np.zeros(1 << FEATURE_BITS, np.int32)
    for k in np.flatnonzero(chosen):
        counts[np.unique(numbers[first[k] : first[k + 1]])] += 1
    return counts


def fit(texts: list[str], toxic: np.ndarray, share: float) -> Field:
    """Fit the field on a bounded list of labelled texts; ``share`` of all labels are toxic."""
    size = 1 << FEATURE_BITS
    prior = float(np.clip(share, 1e-3, 1 - 1e-3))
    blank = Field(np.zeros(size, np.float32), np.zeros((2, 2)), 0.0, np.zeros(3), prior, False)
    if toxic.sum() == 0 or toxic.sum() == len(toxic):
        return blank
    parts = [features(c)[::3] for c in chunks_of(pa.array(texts, pa.string()))]
    numbers = np.concatenate([p[0] for p in parts])
    at = np.cumsum([0, *(len(p[0]) for p in parts)])
    first = np.concatenate([p[1][:-1] + o for p, o in zip(parts, at, strict=False)] + [at[-1:]])
    toxic = toxic.astype(bool)
    everyone = np.arange(len(texts))
    field = _tagged_field(numbers, first, toxic, everyone)
    # the scorer learns from fields that have not seen its documents; else it trusts
    # words that are toxic by chance in the few documents they were marked in
    x = np.empty((len(texts), 3))
    for k in range(SCORER_FOLDS):
        own = everyone[k::SCORER_FOLDS]
        rest = np.setdiff1d(everyone, own)
        other = _tagged_field(numbers, first, toxic, rest) if toxic[rest].any() else field
        for low in range(0, len(own), 500):
            part, part_first = _subset(numbers, first, own[low : low + 500])
            x[own[low : low + 500]] = other.document_inputs(other.marginals(part, part_first), part_first)
    weight = np.where(toxic, prior / toxic.mean(), (1 - prior) / (1 - toxic.mean()))
    field.document = _logistic(x, toxic.astype(float), weight)
    field.prior = prior
    return field


def _subset(numbers: np.ndarray, first: np.ndarray, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Feature numbers and first positions of the chosen texts alone."""
    own = np.concatenate([np.arange(first[k], first[k + 1]) for k in chosen] or [np.zeros(0, np.int64)])
    return numbers[own], np.concatenate([[0], np.cumsum(first[chosen + 1] - first[chosen])])


def _surprise(inside: np.ndarray, all_: np.ndarray, share: float) -> np.ndarray:
    """Minus the log of (a bound of) the chance that so many of a feature's documents are toxic.

    Chernoff's bound of the binomial tail. Where it exceeds the log of the number of features,
    less than one of them is expected to be marked by chance.
    """
    with np.errstate(divide="ignore", invalid="ignore"):
        p = inside / all_
        gain = np.nan_to_num(p * np.log(p / share)) + np.nan_to_num((1 - p) * np.log((1 - p) / (1 - share)))
    return np.where(p > share, all_ * gain, 0.0)


def _tagged_field(numbers: np.ndarray, first: np.ndarray, toxic: np.ndarray, chosen: np.ndarray) -> Field:
    """A field trained on the chosen texts, whose toxic words are marked by their labels."""
    toxic = toxic[chosen]
    numbers, first = _subset(numbers, first, chosen)
    inside = _document_counts(numbers, first, toxic)
    outside = _document_counts(numbers, first, ~toxic)
    ratio = np.log((inside + 0.1) / (toxic.sum() + 1)) - np.log((outside + 0.1) / ((~toxic).sum() + 1))
    mark = (ratio >= MARK_LOG_RATIO) & (inside >= MARK_DOCUMENTS)
    mark &= _surprise(inside, inside + outside, toxic.mean()) >= np.log(max(1, (inside + outside > 0).sum()))
    owner = np.repeat(np.arange(len(chosen)), np.diff(first))
    tags = (mark[numbers].any(axis=1) & toxic[owner]).astype(np.float64)
    return _train(numbers, first, tags)


def _train(numbers: np.ndarray, first: np.ndarray, tags: np.ndarray) -> Field:
    """Maximum likelihood with a small penalty, by adaptive steps over groups of texts."""
    size = 1 << FEATURE_BITS
    field = Field(np.zeros(size, np.float32), np.zeros((2, 2)), 0.0, np.zeros(3), 0.5)
    share = np.clip(tags.mean() if len(tags) else 0.0, 1e-5, 0.5)
    field.moves[:, 1] = field.start = np.log(share)
    squares, move_squares = np.full(size, 1e-6), np.full((2, 2), 1.0)
    groups = np.array_split(np.arange(len(first) - 1), max(1, (len(first) - 1) // 150))
    for epoch in range(EPOCHS):
        for k in np.random.default_rng(epoch).permutation(len(groups)):
            group = groups[k]
            low, high = first[group[0]], first[group[-1] + 1]
            if low == high:
                continue
            own, y = numbers[low:high], tags[low:high]
            own_first = first[group[0] : group[-1] + 2] - low
            ahead, back = field.forward_backward(field.evidence(own), own_first)
            p = ahead * back / (1.0 + ahead * back)
            error = p - y
            used, where = np.unique(own, return_inverse=True)
            gradient = np.bincount(where.reshape(-1), np.repeat(error, own.shape[1]), len(used))
            gradient += PENALTY * field.weights[used]
            squares[used] += gradient**2
            field.weights[used] -= (0.3 * gradient / np.sqrt(squares[used])).astype(np.float32)
            pairs = np.ones(len(y) - 1, bool)
            borders = own_first[1:-1]
            pairs[borders[(borders > 0) & (borders < len(y))] - 1] = False
            left = np.stack([1 / (1 + ahead), ahead / (1 + ahead)])[:, :-1][:, pairs]
            right = np.stack([1 / (1 + back), back / (1 + back)])[:, 1:][:, pairs]
            e = np.exp(field.evidence(own)[1:][pairs])
            right[1] *= e
            m = np.exp(field.moves)
            joint = left[:, None] * m[:, :, None] * right[None]
            joint /= joint.sum(axis=(0, 1))
            seen = np.zeros((2, 2))
            np.add.at(seen, (y[:-1][pairs].astype(int), y[1:][pairs].astype(int)), 1)
            change = joint.sum(axis=2) - seen
            move_squares += change**2
            field.moves -= 0.1 * change / np.sqrt(move_squares)
    return field


def fit_on(
    docs: DataFrame,
    labels: DataFrame,
    sample_toxic: int = SAMPLE_TOXIC,
    sample_clean: int = SAMPLE_CLEAN,
) -> Field:
    """Fit on a bounded sample of the labelled rows whose crc32(doc_id) mod 5 is not 0.

    The sample is the first rows of each label in the order of a hash of doc_id, so it is
    the same in every run. Labels other than 0 and 1 and missing ones are left out; of a
    doc_id with several labels the largest counts, and of several texts one is taken. Only
    doc_ids are sorted; the texts of the chosen ones come by a join with a table of at most
    ``sample_toxic + sample_clean`` rows. One task learns from that bounded sample.
    """
    training = (
        labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull())
        .where(F.pmod(crc_of_id(), F.lit(5)) != 0)
        .groupBy("doc_id")
        .agg(F.max("toxic").cast("int").alias("toxic"))
    )
    counts = {r["toxic"]: r["count"] for r in training.groupBy("toxic").count().collect()}
    chosen = None
    for label, most in ((1, sample_toxic), (0, sample_clean)):
        part = training.where(F.col("toxic") == label).orderBy(F.md5(F.col("doc_id").cast("string")))
        chosen = part.limit(most) if chosen is None else chosen.unionByName(part.limit(most))
    rows = (
        docs.select("doc_id", text_of().alias("text"))
        .join(F.broadcast(chosen), "doc_id")
        .groupBy("doc_id", "toxic")
        .agg(F.min("text").alias("text"))
    )
    share = (counts.get(1, 0) + 0.5) / (sum(counts.values()) + 1)

    def learn(sample: pd.DataFrame) -> pd.DataFrame:
        sample = sample.sort_values("doc_id")
        field = fit(sample["text"].tolist(), sample["toxic"].to_numpy(), share)
        return pd.DataFrame({"field": [pickle.dumps(field)]})

    ship_package(docs.sparkSession)
    found = rows.groupBy(F.lit(0).alias("all")).applyInPandas(learn, "field binary").first()
    return fit([], np.zeros(0), share) if found is None else pickle.loads(found["field"])


def _code_points(data: np.ndarray, positions: np.ndarray) -> np.ndarray:
    return np.cumsum((data & 0xC0) != 0x80)[np.maximum(positions - 1, 0)] * (positions > 0)


SCHEMA = "doc_id long, held_out boolean, score double, predicted int, offsets string"


def score_documents(docs: DataFrame, field: Field, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted and offending offsets.

    Every word of every whole text is scored; ``offsets`` lists the words whose marginal is
    at least 0.5 as start:end in code points, end exclusive. Empty and missing texts have
    no toxic words and get the score that goes with none. Without labels of both kinds to
    learn from, every score is the share of toxic labels. Ties and repeated rows give equal
    rows, a missing doc_id stays, an empty table gives an empty result, other columns are
    ignored. Nothing is shuffled; the field (some 4 MB, fixed) is broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(field)
    rows = docs.select(
        "doc_id", (F.pmod(crc_of_id(), F.lit(5)) == 0).alias("held_out"), text_of().alias("text")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            for texts in chunks_of(batch.column(2)):
                numbers, starts, ends, first = features(texts)
                marginals = model.marginals(numbers, first)
                scores = model.scores(marginals, first)
                hits = np.flatnonzero(marginals >= 0.5)
                offsets = [""] * len(texts)
                owners = np.searchsorted(first, hits, side="right") - 1
                for doc in np.unique(owners):
                    low, high = texts.offsets[doc], texts.offsets[doc + 1]
                    own = hits[owners == doc]
                    data = texts.data[low:high]
                    a = _code_points(data, starts[own] - low)
                    b = _code_points(data, ends[own] - low)
                    offsets[doc] = ",".join(f"{x}:{y}" for x, y in zip(a, b, strict=True))
                part = batch.slice(texts.first, len(texts))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).cast(pa.int64()),
                        part.column(1),
                        pa.array(scores),
                        pa.array((scores >= threshold).astype(np.int32)),
                        pa.array(offsets, pa.string()),
                    ],
                    names=["doc_id", "held_out", "score", "predicted", "offsets"],
                )

    return in_arrow(rows, run, SCHEMA)


def without_toxic(docs: DataFrame, field: Field, threshold: float = 0.5) -> DataFrame:
    """The rows of ``docs`` the field does not find toxic, with all columns; no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(field)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        for batch in batches:
            keep = []
            for texts in chunks_of(batch.column("text")):
                numbers, _, _, first = features(texts)
                keep.append(model.scores(model.marginals(numbers, first), first) < threshold)
            yield batch.filter(pa.array(np.concatenate(keep))) if keep else batch

    return in_arrow(docs, run, docs.schema)
