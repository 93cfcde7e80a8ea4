"""LM scoring by context-tree weighting over bytes, next to a plain word model.

A byte is eight binary decisions. Each decision has a Krichevsky-Trofimov estimate in the
context of the last 0 to ``depth`` bytes, and context-tree weighting mixes all depths by
how well each coded the training texts. The result is a probability for every byte in
every context, and so a code length for every text.

The tree is a set of tables, one per depth, with a row per context and decision. A row's
key holds the raw bytes of its context above eight bits for the decision, so a shorter
context is a key without its highest byte. Weights are summed from the deepest table up and
handed down again by joins on these keys, so the tree grows with the corpus and no process
holds it. A parent has at most 256 children, so no key of these joins is hot.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ebbtide.llm.shared import Temporary, crc_of_id, eager_jobs, in_arrow, stored, text_of
from ebbtide.llm.words import Texts, chunks_of, word_hashes

DEPTH = 5
MAX_DEPTH = 6  # a context, its byte and one further bit must fit in a signed 64-bit key
START = 32  # before a text's first byte stands a space

#: The most frequent words and grams whose counts or logarithms are broadcast; all others are joined.
HEAD_WORDS = 1 << 19
HEAD_GRAMS = 1 << 20
END_HASH = -1

#: Different grams that a task gathers before it hands them on.
GATHERED = 1 << 21


def grams_of(texts: Texts, depth: int) -> np.ndarray:
    """For each byte a key: the byte itself in the lowest eight bits, the ones before it above.

    The end of a text is coded as a byte 0 after its last byte.
    """
    count = len(texts)
    data = np.zeros(len(texts.data) + count, np.int64)
    shift = np.repeat(np.arange(count), np.diff(texts.offsets))
    data[np.arange(len(texts.data)) + shift] = texts.data
    begins = texts.offsets[:-1] + np.arange(count)
    ends = np.append(begins[1:], len(data))
    key = data.copy()
    for back in range(1, depth + 1):
        before = np.full(len(data), START, np.int64)
        before[back:] = data[:-back]
        for k in range(back):
            at = begins + k
            before[at[at < ends]] = START
        key |= before << (8 * back)
    return key


def merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Sums of counts per different key."""
    found, where = np.unique(np.concatenate(keys), return_inverse=True)
    return found, np.bincount(where, weights=np.concatenate(counts)).astype(np.int64)


def gram_counts(docs: DataFrame, learns: Column, depth: int) -> DataFrame:
    """(gram, n, m): how often each byte in its context occurs where ``learns`` holds, and in all.

    Grams of texts that are only scored are in the table with n = 0: their contexts are
    nodes of the tree without counts. A task hands its sums on whenever it holds many.
    """
    flag = 8 * (depth + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for batch in batches:
            learning = batch.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            for texts in chunks_of(batch.column(0)):
                marks = learning[texts.first : texts.first + len(texts)] << flag
                grams = grams_of(texts, depth) | np.repeat(marks, np.diff(texts.offsets) + 1)
                found, seen = np.unique(grams, return_counts=True)
                keys.append(found)
                counts.append(seen)
                held += len(found)
                if held > 2 * GATHERED:
                    found, seen = merged(keys, counts)
                    keys, counts, held = [found], [seen], len(found)
                    if held > GATHERED:
                        yield from out(found, seen)
                        keys, counts, held = [], [], 0
        if keys:
            yield from out(*merged(keys, counts))

    def out(found: np.ndarray, seen: np.ndarray) -> Iterator[pa.RecordBatch]:
        for low in range(0, len(found), 100_000):
            part = [pa.array(a[low : low + 100_000], pa.int64()) for a in (found, seen)]
            yield pa.RecordBatch.from_arrays(part, names=["key", "seen"])

    rows = docs.select(text_of().alias("text"), learns.alias("learns"))
    return (
        in_arrow(rows, run, "key long, seen long")
        .groupBy(F.col("key").bitwiseAND(F.lit((1 << flag) - 1)).alias("gram"))
        .agg(
            F.sum(F.when(F.shiftright("key", flag) == 1, F.col("seen")).otherwise(0)).alias("n"),
            F.sum("seen").alias("m"),
        )
    )


def log_gamma(x: Column) -> Column:
    """Log of the gamma function for positive numbers, by Stirling's series eight places up."""
    y = x + 8.0
    square = 1.0 / (y * y)
    series = (1 / 12 - square * (1 / 360 - square * (1 / 1260 - square / 1680))) / y
    product = x
    for step in range(1, 8):
        product = product * (x + float(step))
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + series - F.log(product)


def log_kt() -> Column:
    """Natural log of the Krichevsky-Trofimov probability of a row's zeros and ones."""
    zeros, ones = F.col("zeros").cast("double"), F.col("ones").cast("double")
    return (
        log_gamma(zeros + 0.5) + log_gamma(ones + 0.5) - log_gamma(zeros + ones + 1.0) - math.log(math.pi)
    )


def odds() -> Column:
    """The estimate that a row's next decision is a one."""
    return (F.col("ones") + 0.5) / (F.col("zeros") + F.col("ones") + 1.0)


def decision(byte: Column, bit: int) -> tuple[Column, Column]:
    """The node of a byte's ``bit``-th decision (in heap order) and the bit taken there."""
    return F.shiftright(byte, 8 - bit) + F.lit(1 << bit), F.shiftright(byte, 7 - bit).bitwiseAND(F.lit(1))


def prefix(depth: int) -> Column:
    """The key of the same decision in the context's last ``depth`` bytes."""
    return F.col("key").bitwiseAND(F.lit((1 << (8 * (depth + 1))) - 1))


def code_lengths(grams: DataFrame, depth: int, temporary: Temporary) -> DataFrame:
    """(gram, log10_p, m): the log10 probability of each gram's byte in its context.

    The weighted probability of a node is the mean of its own estimate and the product of
    its children's; a node's share in the mixture is that of its estimate in this mean. So
    the predictive probability of a decision is the mean over depths, each depth weighing
    its node's share times what shallower nodes left over.
    """
    byte = F.col("gram").bitwiseAND(F.lit(255)).cast("int")
    by_context = grams.withColumn("context", F.shiftright("gram", 8)).repartition("context")
    # a context has at most 256 bytes; its decisions are summed where its grams lie, without a shuffle
    steps = F.array(*[F.struct(node.alias("node"), taken.alias("taken")) for node, taken in (decision(byte, bit) for bit in range(8))])
    level = (
        by_context.select("context", "n", F.explode(steps).alias("step"))
        .groupBy("context", F.col("step.node").alias("node"))
        .agg(
            F.sum(F.when(F.col("step.taken") == 0, F.col("n")).otherwise(0)).alias("zeros"),
            F.sum(F.when(F.col("step.taken") == 1, F.col("n")).otherwise(0)).alias("ones"),
        )
        .select((F.shiftleft("context", 8) + F.col("node")).alias("key"), "zeros", "ones", log_kt().alias("mixed"))
    )
    levels = [temporary.stored(level, f"depth_{depth}")]
    half = math.log(2)
    for d in range(depth - 1, -1, -1):
        sums = levels[0].groupBy(prefix(d).alias("key")).agg(
            F.sum("zeros").alias("zeros"), F.sum("ones").alias("ones"), F.sum("mixed").alias("below")
        )
        high, low = F.greatest("own", "below"), F.least("own", "below")
        level = (
            sums.withColumn("own", log_kt())
            .withColumn("mixed", high + F.log1p(F.exp(low - high)) - half)
            .select("key", odds().alias("one"), "zeros", "ones", "mixed", F.exp(F.col("own") - half - F.col("mixed")).alias("share"))
        )
        levels.insert(0, temporary.stored(level, f"depth_{d}"))
    found = levels[0].select(
        "key", (F.col("share") * F.col("one")).alias("sum_so_far"), (1.0 - F.col("share")).alias("left")
    )
    for d in range(1, depth + 1):
        above = found.withColumnRenamed("key", "parent")
        met = levels[d].withColumn("parent", prefix(d - 1)).join(above, "parent")
        if d < depth:
            found = met.select(
                "key",
                (F.col("sum_so_far") + F.col("left") * F.col("share") * F.col("one")).alias("sum_so_far"),
                (F.col("left") * (1.0 - F.col("share"))).alias("left"),
            )
        else:
            found = met.select("key", (F.col("sum_so_far") + F.col("left") * odds()).alias("one"))
    node = F.col("key").bitwiseAND(F.lit(255)).cast("int")
    per_context = found.groupBy(F.shiftright("key", 8).alias("context")).agg(
        F.map_from_entries(F.collect_list(F.struct(node.alias("node"), "one"))).alias("odds")
    )

    def log_taken(bit: int) -> Column:
        at, taken = decision(byte, bit)
        one = F.least(F.greatest(F.element_at("odds", at), F.lit(1e-12)), F.lit(1 - 1e-12))
        return F.log10(F.when(taken == 1, one).otherwise(1.0 - one))

    log10_p = sum((log_taken(bit) for bit in range(1, 8)), log_taken(0))
    return by_context.join(per_context, "context").select("gram", log10_p.alias("log10_p"), "m")


def most_frequent(lengths: DataFrame, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted grams and log10 probabilities of at most ``limit`` grams, the most frequent ones.

    Frequencies are cut by sixteenths of powers of two: at most 1,024 sums come to the
    driver, and then whole classes of frequency up to the limit.
    """
    grade = F.floor(F.log2(F.col("m")) * 16).cast("long")
    sizes = {r["grade"]: r["n"] for r in lengths.groupBy(grade.alias("grade")).agg(F.count(F.lit(1)).alias("n")).collect()}
    lowest, held = None, 0
    for each in sorted(sizes, reverse=True):
        held += sizes[each]
        if held > limit:
            break
        lowest = each
    if lowest is None:
        return np.zeros(0, np.int64), np.zeros(0)
    head = lengths.where(grade >= F.lit(lowest)).select("gram", "log10_p").toArrow()
    grams = head["gram"].to_numpy()
    order = np.argsort(grams)
    return grams[order], head["log10_p"].to_numpy()[order]


def word_counts(docs: DataFrame) -> DataFrame:
    """Count of each word of ``docs`` (by hash) and of the end, which is counted per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes = np.concatenate([word_hashes(t)[0] for t in chunks_of(batch.column(0))] or [[]])
            found, counts = np.unique(hashes.astype(np.uint64).view(np.int64), return_counts=True)
            found = np.append(found, END_HASH)
            counts = np.append(counts, batch.num_rows)
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, pa.int64()), pa.array(counts, pa.int64())], names=["word", "n"]
            )

    counted = in_arrow(docs.select(text_of().alias("text")), run, "word long, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where("n > 0")


def looked_up(keys: np.ndarray, values: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The value of each wanted key among sorted ``keys`` (0 where absent), and whether it is there."""
    if not len(keys):
        return np.zeros(len(wanted)), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
    hit = keys[at] == wanted
    return np.where(hit, values[at], 0.0), hit


SCHEMA = (
    "row long, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "log_sum double, score double, n_bytes long, rest array<long>, grams array<long>"
)


def score_documents(
    docs: DataFrame, head_words: int = HEAD_WORDS, depth: int = DEPTH, head_grams: int = HEAD_GRAMS
) -> DataFrame:
    """One row per row of ``docs``: the word model's and the context tree's log10 probability.

    Learns from the rows whose crc32(doc_id) mod 7 is not 2 (a missing doc_id counts as
    empty text). Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score and bits_per_byte (of the tree, the end included). A missing text counts as
    empty: its only token is the end. Ties and repeated rows give equal rows; an empty
    table gives an empty result; other columns are ignored.

    Word counts cover all training texts. Those of the ``head_words`` most frequent words
    are broadcast (a fixed bound); a text's other words leave the scan as hashes and meet
    their counts in a join, so no word is cut off and no vocabulary must fit in memory. So do
    bytes in their contexts beyond the ``head_grams`` most frequent ones. ``depth`` (at most
    6) is the number of bytes a context reaches back.
    """
    if not 0 <= depth <= MAX_DEPTH:
        raise ValueError(f"depth must be from 0 to {MAX_DEPTH}, not {depth}")
    spark = docs.sparkSession
    context = spark.sparkContext
    learns = F.pmod(crc_of_id(), F.lit(7)) != 2
    with eager_jobs(spark), Temporary(spark) as temporary:
        grams = temporary.stored(gram_counts(docs, learns, depth), "gram_counts")
        lengths = stored(code_lengths(grams, depth, temporary), "code_lengths")
        counts = stored(word_counts(docs.where(learns)), "word_counts")
    head_gram, head_log = most_frequent(lengths, head_grams)
    sums = counts.agg(F.sum("n").alias("n"), F.count(F.lit(1)).alias("v")).first()
    total, distinct = sums["n"] or 0, sums["v"]
    head = counts.orderBy(F.col("n").desc(), "word").limit(head_words).toArrow()
    order = np.argsort(head["word"].to_numpy())
    head_hash, head_count = head["word"].to_numpy()[order], head["n"].to_numpy()[order]
    shared = context.broadcast((head_hash, head_count, head_gram, head_log))
    divisor = float(np.log10(total + distinct + 1))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        head_hash, head_count, head_gram, head_log = shared.value
        known = int(head_count[head_hash == END_HASH].sum())
        for batch in batches:
            for texts in chunks_of(batch.column(3)):
                count = len(texts)
                hashes, first = word_hashes(texts)
                hashes = hashes.view(np.int64)
                at = np.minimum(np.searchsorted(head_hash, hashes), max(len(head_hash) - 1, 0))
                hit = head_hash[at] == hashes if len(head_hash) else np.zeros(len(hashes), bool)
                logs = np.zeros(len(hashes) + 1)
                logs[:-1][hit] = np.log10(head_count[at[hit]] + 1.0)
                cut = np.concatenate([[0.0], np.cumsum(logs[:-1])])
                log_sum = cut[first[1:]] - cut[first[:-1]] + np.log10(known + 1.0)
                hits = np.concatenate([[0], np.cumsum(hit)])
                n_known = hits[first[1:]] - hits[first[:-1]] + (known > 0)
                out = ~hit
                misses = np.concatenate([[0], np.cumsum(out)])
                rest = pa.ListArray.from_arrays(
                    pa.array(misses[first], pa.int32()), pa.array(hashes[out], pa.int64())
                )
                lengths = np.diff(texts.offsets) + 1
                begins = np.concatenate([[0], np.cumsum(lengths)[:-1]])
                keys = grams_of(texts, depth)
                found, where = np.unique(keys, return_inverse=True)
                value, listed = looked_up(head_gram, head_log, found)
                score = np.add.reduceat(value[where], begins)
                unlisted = ~listed[where]
                before = np.concatenate([[0], np.cumsum(unlisted)])
                more = pa.ListArray.from_arrays(
                    pa.array(before[np.append(begins, len(keys))], pa.int32()),
                    pa.array(keys[unlisted], pa.int64()),
                )
                part = batch.slice(texts.first, count)
                columns = [part.column(0), part.column(1), part.column(2)]
                columns += [
                    pa.array(np.diff(first) + 1, pa.int64()),
                    pa.array(n_known, pa.int64()),
                    pa.array(log_sum),
                    pa.array(score),
                    pa.array(lengths, pa.int64()),
                    rest,
                    more,
                ]
                yield pa.RecordBatch.from_arrays(columns, names=[f.split()[0] for f in SCHEMA.split(", ")])

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"),
        F.col("doc_id").cast("long"),
        (F.pmod(crc_of_id(), F.lit(7)) == 2).alias("held_out"),
        text_of().alias("text"),
    )
    scored = stored(in_arrow(rows, run, SCHEMA), "scored")
    rare = (
        scored.select("row", F.explode("rest").alias("word"))
        .groupBy("row", "word")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(counts, "word")
        .groupBy("row")
        .agg(
            F.sum("times").alias("more_known"),
            F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_sum"),
        )
    )
    rare_grams = (
        scored.select("row", F.explode("grams").alias("gram"))
        .groupBy("row", "gram")
        .agg(F.count(F.lit(1)).alias("times"))
        .join(lengths, "gram")
        .groupBy("row")
        .agg(F.sum(F.col("times") * F.col("log10_p")).alias("more_score"))
    )
    score = F.col("score") + F.coalesce("more_score", F.lit(0.0))
    return scored.join(rare, "row", "left").join(rare_grams, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(int(total)).cast("long").alias("train_tokens"),
        (
            F.col("log_sum") + F.coalesce("more_sum", F.lit(0.0)) - F.col("n_tokens") * F.lit(divisor)
        ).alias("base_score"),
        score.alias("score"),
        (-score / F.log10(F.lit(2.0)) / F.col("n_bytes")).alias("bits_per_byte"),
    )
