"""Language-model scores: prediction by partial matching over bytes, and a unigram base.

Training is one pass over the training documents, which counts words and byte five-grams
per task and sums the counts by a shuffle; what is gathered grows with the corpus.

The five-grams are the byte-context trie down to depth 4, with the counts of every shorter
context as sums.  Escape probabilities follow method C (t distinct symbols after a context
seen n times: escape t / (n + t)).  After an escape, the symbols of the longer context are
excluded from the shorter one.  As those symbols are a subset of the shorter context's,
each probability is a function of the context alone, so every five-gram that occurs has one
log probability, its escapes and exclusions already in it, and scoring a text is one look-up
a byte.  Below order 0 all of the 257 symbols (bytes and the end) are equally likely.

No task and not the driver holds the trie.  Documents are dealt into blocks of about
``BLOCK_BYTES`` of text (or one document).  A block's distinct five-grams travel packed: a
row for each pair of last two context symbols, with the other three symbols in four bytes.
They are merged by pair (at most 257 ** 3 five-grams each), ``FAN`` blocks at a time in as
many rounds as it takes, and give the log probabilities of the orders 2 to 4; the counts of
the orders 0 and 1 are a table of 257 x 257.  The log probabilities then meet the blocks by
pair and ``FAN`` blocks, and go back to each block as four bytes a five-gram, in its order.

Words: the most frequent ones (at most ``MOST_HOT``, by a cut at a power of two) are
looked up in the tasks; the others are joined by a shuffle on the word, which is free of
frequent keys by then.

Defined results: a null text is empty and scored as its end alone; with no training
documents each base term is log10(0.5 / 0.5) = 0 and each symbol costs log10(257); a null
doc_id counts as the empty text; a very long text is read in pieces of ``CHUNK`` that overlap
by a context; repeated rows are scored and counted each; extra columns are ignored; an empty
table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import keep, table

END, SYMBOLS = 256, 257
FOLDS, HELD_OUT = 5, 1
MOST_HOT = 1 << 17
DEPTH = 4
BLOCK_BYTES = 32 << 20
FAN = 256
FREE = 27  # bits of the symbols of a five-gram other than its pair
CHUNK = 2 << 20
ROWS = 4096
MERGE = 1 << 22
FLUSH = 16 << 20


def fold(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def as_bytes(column: pa.Array) -> list[bytes]:
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Symbols of about ``CHUNK`` bytes of texts at a time, how many of each text's piece are new, and which text it is of.

    Each piece has the ``DEPTH`` symbols before it first; a text starts after ends, and its own end is its last symbol.
    """
    ends = np.full(DEPTH, END, np.int64)
    rows, new, of, size = [], [], [], 0
    for k, text in enumerate(texts):
        for at in range(0, max(1, len(text)), CHUNK):
            body = np.frombuffer(text[max(0, at - DEPTH) : at + CHUNK], np.uint8)
            last = at + CHUNK >= len(text)
            rows += [ends] * (not at) + [body] + [ends[:1]] * last
            new.append(min(CHUNK, len(text) - at) + last)
            of.append(k)
            size += new[-1]
            if size >= CHUNK:
                yield np.concatenate(rows).astype(np.int64), np.array(new), np.array(of)
                rows, new, of, size = [], [], [], 0
    if new:
        yield np.concatenate(rows).astype(np.int64), np.array(new), np.array(of)


def codes_of(symbols: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Code of the five-gram that ends in each new symbol: the last two of the context, then the other two and the symbol."""
    a, b, c, d, e = (symbols[i : len(symbols) - DEPTH + i] for i in range(DEPTH + 1))
    code = c << 36 | d << 27 | a << 18 | b << 9 | e
    between = (np.cumsum(new + DEPTH) - DEPTH)[:-1, None] + np.arange(DEPTH)
    return np.delete(code, between.ravel())


def merged(codes: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order, and the sums of their counts."""
    found, at = np.unique(codes, return_inverse=True)
    return found, np.bincount(at, n, len(found)).astype(np.int64)


class Sums:
    """Codes and counts added up, merged whenever ``MERGE`` of them have come together."""

    def __init__(self):
        self.parts: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, codes: np.ndarray, n: np.ndarray) -> None:
        self.parts.append((codes, n))
        self.size += len(codes)
        if self.size > MERGE and len(self.parts) > 1:
            self.parts = [self.all()]
            self.size = len(self.parts[0][0])

    def all(self) -> tuple[np.ndarray, np.ndarray]:
        return merged(*map(np.concatenate, zip(*self.parts, strict=True)))


def packed(codes: np.ndarray, *values: np.ndarray) -> tuple[np.ndarray, list[pa.Array]]:
    """The pairs of the sorted ``codes``, and for each a binary of its codes without it and a binary of each of ``values``."""
    pairs = codes >> FREE
    edges = np.append(0, np.flatnonzero(np.diff(pairs)) + 1)[: len(codes)]
    out = []
    for x in ((codes & ((1 << FREE) - 1)).astype("<u4"), *values):
        offsets = (np.append(edges, len(codes)) * x.itemsize).astype(np.int32)
        out.append(pa.Array.from_buffers(pa.binary(), len(edges), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(x))]))
    return pairs[edges], out


def blocks_of(known: DataFrame) -> DataFrame:
    """``known`` (doc_id, held_out, text) with a number of each row and of its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        row = block = TaskContext.get().partitionId() << 33
        size = 0
        for batch in batches:
            blocks = []
            for n in batch["text"].cast(pa.binary()):
                n = len(n.as_buffer() or b"")
                if size and size + n > BLOCK_BYTES:
                    block, size = block + 1, 0
                size += n
                blocks.append(block)
            numbers = pa.array(np.arange(row, row + len(batch)), pa.int64())
            row += len(batch)
            yield pa.RecordBatch.from_arrays(
                [numbers, pa.array(blocks, pa.int64()), *batch.columns], names=["row", "block", *batch.schema.names]
            )

    id_type = known.schema["doc_id"].dataType.simpleString()
    return known.mapInArrow(run, f"row long, block long, doc_id {id_type}, held_out boolean, text string")


def counts_of(blocks: DataFrame) -> DataFrame:
    """(word, times, block, pair, free, n): counts of words (the end is the empty word) of training texts, and packed ones of each block's five-grams.

    Held-out texts count as none, but their five-grams are there.  Words may repeat; so may the pairs of a block.
    """
    names = ["word", "times", "block", "pair", "free", "n"]

    def grams_of(block: int, codes: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        pairs, (free, times) = packed(codes, n.astype("<u8"))
        none = pa.nulls(len(pairs), pa.binary()), pa.nulls(len(pairs), pa.int64())
        return pa.RecordBatch.from_arrays([*none, pa.array(np.full(len(pairs), block)), pa.array(pairs.astype(np.int32)), free, times], names=names)

    def words_of(words: Counter) -> pa.RecordBatch:
        none = [pa.nulls(len(words), t) for t in (pa.int64(), pa.int32(), pa.binary(), pa.binary())]
        return pa.RecordBatch.from_arrays([pa.array(list(words), pa.binary()), pa.array(list(words.values()), pa.int64()), *none], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: Counter = Counter()
        since = 0  # bytes of text counted into ``words``
        block, some = 0, Sums()
        for batch in batches:
            blocks = batch["block"].to_numpy()
            held = batch["held_out"].to_numpy(zero_copy_only=False)
            cuts = np.flatnonzero(np.diff(blocks)) + 1
            for lo, hi in zip([0, *cuts], [*cuts, len(blocks)], strict=True):
                if lo == hi:
                    continue
                if blocks[lo] != block:
                    if some.size:
                        yield grams_of(block, *some.all())
                    block, some = int(blocks[lo]), Sums()
                texts = as_bytes(batch["text"].slice(lo, hi - lo))
                training = [t for t, h in zip(texts, held[lo:hi], strict=True) if not h]
                for text in training:
                    words.update(text.lower().split())
                    words[b""] += 1
                    since += len(text)
                    if since > FLUSH:
                        yield words_of(words)
                        words, since = Counter(), 0
                for own, times in ((training, 1), ([t for t, h in zip(texts, held[lo:hi], strict=True) if h], 0)):
                    for symbols, new, _ in pieces(own):
                        codes, n = np.unique(codes_of(symbols, new), return_counts=True)
                        some.add(codes, n * times)
        if some.size:
            yield grams_of(block, *some.all())
        yield words_of(words)

    rows = blocks.select("block", "held_out", "text").where("block IS NOT NULL")
    return rows.mapInArrow(run, "word binary, times long, block long, pair int, free binary, n binary")


def unpacked(batch: pa.RecordBatch, value: str, kind: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes and values of all rows of a batch (pair, free, value)."""
    free = np.frombuffer(b"".join(batch["free"].to_pylist()), "<u4").astype(np.int64)
    sizes = np.fromiter((len(x.as_buffer()) // 4 for x in batch["free"]), np.int64, len(batch))
    return np.repeat(batch["pair"].to_numpy().astype(np.int64), sizes) << FREE | free, np.frombuffer(b"".join(batch[value].to_pylist()), kind)


def whole_pairs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.RecordBatch]:
    """The rows of sorted batches, never cutting between rows of equal ``keys``."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        own = np.stack([batch[k].to_numpy() for k in keys])
        if held:
            before = np.array([held[-1][k][-1].as_py() for k in keys])
            first = int(np.argmin(np.append((own == before[:, None]).all(0), False)))
            if first:
                held.append(batch.slice(0, first))
            if first < len(batch):
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            batch, own = batch.slice(first), own[:, first:]
        if len(batch):
            last = int(np.argmax((own == own[:, -1:]).all(0)))
            if last:
                yield batch.slice(0, last)
            held.append(batch.slice(last))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def summed(counts: DataFrame, parts: int) -> DataFrame:
    """(pair, part, free, n): packed counts summed within each of ``parts`` groups of ``part``."""
    dealt = counts.withColumn("part", F.pmod("part", F.lit(parts))).repartition("pair", "part").sortWithinPartitions("pair", "part")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in whole_pairs(batches, ["pair", "part"]):
            part = batch["part"].to_numpy()
            for p in np.unique(part):
                own = batch.filter(pa.array(part == p))
                codes, n = merged(*unpacked(own, "n", "<u8"))
                pairs, (free, times) = packed(codes, n.astype("<u8"))
                yield pa.RecordBatch.from_pydict(
                    {"pair": pa.array(pairs.astype(np.int32)), "part": pa.array(np.full(len(pairs), p)), "free": free, "n": times}
                )

    return dealt.select("pair", "part", "free", "n").mapInArrow(run, "pair int, part long, free binary, n binary")


def next_order(grams: np.ndarray, c: np.ndarray, below: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """(counts, total and distinct symbols of the context, probability as escaped to, probability) of each of the sorted ``grams``.

    ``below`` is the same of the gram without its first symbol; all grams that were seen after a context are there.
    """
    c1, n1, t1, escaped1, p1 = below
    at = np.unique(grams >> 9, return_inverse=True)[1]
    n, t = np.bincount(at, c)[at], np.bincount(at, c > 0)[at]
    t2 = t1 - t
    rest = np.maximum(n1 - np.bincount(at, np.where(c > 0, c1, 0.0))[at] + t2, 1.0)  # without the excluded symbols
    escaped = np.where(c1 > 0, c1 / rest, np.where(t2 > 0, t2 / rest, 1.0) * escaped1)
    whole = np.maximum(n + t, 1.0)
    return c, n, t, escaped, np.where(n > 0, np.where(c > 0, c / whole, t / whole * escaped), p1)


def short_contexts(pairs: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """The distinct codes of two symbols, sorted, and what ``next_order`` gives for them, from their counts."""
    zero = np.bincount(pairs & 511, counts, 512)
    n0, t0 = zero.sum(), int((zero > 0).sum())
    unseen = 1.0 / max(1, SYMBOLS - t0)
    p0 = np.where(zero > 0, zero / max(1.0, n0 + t0), unseen * (t0 / (n0 + t0) if t0 else 1.0))
    sort = np.argsort(pairs)
    pairs, c = pairs[sort], counts[sort].astype(float)
    s, one = pairs & 511, np.ones(len(pairs))
    return pairs, next_order(pairs, c, (zero[s], n0 * one, t0 * one, unseen * one, p0[s]))


def log_probabilities(codes: np.ndarray, counts: np.ndarray, short: tuple[np.ndarray, tuple[np.ndarray, ...]]) -> np.ndarray:
    """Log10 probability of five-grams: of all, seen or not, of some pairs of last symbols of the context."""
    inner = (codes >> 9 & ((1 << 18) - 1)) << 27 | codes >> FREE << 9 | codes & 511  # in the order of the text
    below_grams, below = short
    for order in range(2, DEPTH + 1):
        grams, at = np.unique(inner & ((1 << (9 * (order + 1))) - 1), return_inverse=True)
        parent = np.searchsorted(below_grams, grams & ((1 << (9 * order)) - 1))
        below = next_order(grams, np.bincount(at, counts), tuple(x[parent] for x in below))
        below_grams = grams
    return np.log10(below[-1][at])


def known_grams(counts: DataFrame, blocks: int) -> DataFrame:
    """(pair, free, log): packed log10 probabilities of all five-grams, from packed counts (block, pair, free, n)."""
    spark = counts.sparkSession
    parts = -(-blocks // FAN)
    each = counts.select("pair", F.xxhash64("block").alias("part"), "free", "n")
    while True:
        each = summed(each, parts)
        if parts == 1:
            break
        parts = -(-parts // FAN)
    each = keep(each, "lm-grams")

    def read_two(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = np.zeros(1 << 18), np.zeros(1 << 18, bool)
        for batch in batches:
            if len(batch):
                codes, n = unpacked(batch, "n", "<u8")
                two = (codes >> FREE & 511) << 9 | codes & 511
                total += np.bincount(two, n, 1 << 18)
                seen[two] = True
        two = np.flatnonzero(seen)
        yield pa.RecordBatch.from_pydict({"two": pa.array(two), "n": pa.array(total[two])})

    twos = each.select("pair", "free", "n").mapInArrow(read_two, "two long, n double")
    got = twos.groupBy("two").agg(F.sum("n").alias("n")).toArrow()  # at most 257 x 257 rows
    short = spark.sparkContext.broadcast(short_contexts(got["two"].to_numpy(), got["n"].to_numpy()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), ROWS):
                codes, n = unpacked(batch.slice(at, ROWS), "n", "<u8")
                pairs, (free, logs) = packed(codes, log_probabilities(codes, n.astype(float), short.value).astype("<f4"))
                yield pa.RecordBatch.from_pydict({"pair": pa.array(pairs.astype(np.int32)), "free": free, "log": logs})

    ordered = each.sortWithinPartitions("pair").select("pair", "free", "n")
    out = keep(ordered.mapInArrow(run, "pair int, free binary, log binary"), "lm-logs")
    short.destroy()
    return out


def logs_of_blocks(counts: DataFrame, logs: DataFrame, blocks: int) -> DataFrame:
    """(block, pair, log): the packed log probabilities of each row of ``counts``."""
    salts = -(-blocks // FAN)
    known = logs.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1)))).select(
        "pair", "salt", F.lit(-1).cast("long").alias("block"), "free", "log"
    )
    asked = counts.select(
        "pair", F.pmod(F.xxhash64("block"), F.lit(salts)).cast("int").alias("salt"), "block", "free", F.lit(None).cast("binary").alias("log")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        free, log = np.empty(0, "<u4"), np.empty(0, "<f4")
        for batch in batches:
            blocks, pairs, out = [], [], []
            for block, pair, f, own in zip(*(batch[k] for k in ("block", "pair", "free", "log")), strict=True):
                f = np.frombuffer(f.as_buffer(), "<u4")
                if own.is_valid:
                    free, log = f, np.frombuffer(own.as_buffer(), "<f4")
                    continue
                blocks.append(block.as_py())
                pairs.append(pair.as_py())
                out.append(log[np.searchsorted(free, f)].tobytes())
            yield pa.RecordBatch.from_pydict({"block": pa.array(blocks, pa.int64()), "pair": pa.array(pairs, pa.int32()), "log": pa.array(out, pa.binary())})

    dealt = known.unionByName(asked).repartition("pair", "salt").sortWithinPartitions("pair", "salt", "block")
    return dealt.mapInArrow(run, "block long, pair int, log binary")


def scores_of(texts: list[bytes], codes: np.ndarray, logs: np.ndarray) -> np.ndarray:
    """Log10 probability of each text and its end, from its five-grams' in ``codes`` (sorted)."""
    out = np.zeros(len(texts))
    for symbols, new, of in pieces(texts):
        sums = np.add.reduceat(logs[np.searchsorted(codes, codes_of(symbols, new))], np.cumsum(new) - new, dtype=float)
        out += np.bincount(of, sums, len(texts))
    return out


def hot_words(words: DataFrame) -> tuple[int, list[tuple[bytes, int]]]:
    """A least count, and the at most ``MOST_HOT`` words that reach it."""
    level = F.floor(F.log2("n")).cast("int")
    sizes = dict(words.groupBy(level.alias("k")).agg(F.count(F.lit(1))).collect())  # at most 64 rows
    k, held = max(sizes, default=-1) + 1, 0
    while k > 0 and held + sizes.get(k - 1, 0) <= MOST_HOT:
        k -= 1
        held += sizes.get(k, 0)
    return 1 << k, [(bytes(r[0]), r[1]) for r in words.where(F.col("n") >= (1 << k)).select("word", "n").collect()]


def scored(docs: DataFrame) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of ``docs`` (doc_id, text)."""
    sc = docs.sparkSession.sparkContext
    known = docs.select("doc_id", (fold(F.col("doc_id")) == HELD_OUT).alias("held_out"), F.coalesce("text", F.lit("")).alias("text"))
    blocks = keep(blocks_of(known), "lm-blocks")
    counts = keep(counts_of(blocks), "lm-counts")
    words = keep(counts.where("word IS NOT NULL").groupBy("word").agg(F.sum("times").alias("n")), "lm-words")
    total, distinct = words.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    whole = total + 0.5 * (distinct + 1)
    cut, hot = hot_words(words)
    hot_ids = sc.broadcast({w: i for i, (w, _) in enumerate(hot)})
    hot_logs = sc.broadcast(np.log10((np.array([n for _, n in hot], float) + 0.5) / whole))
    grams = counts.where("block IS NOT NULL").select("block", "pair", "free", "n")
    n_blocks = max(1, grams.select("block").distinct().count())
    logs = logs_of_blocks(grams, known_grams(grams, n_blocks), n_blocks)

    def read(docs: pa.Table, found: pa.Table) -> pa.Table:
        ids, word_logs = hot_ids.value, hot_logs.value
        order = np.argsort(found["pair"].to_numpy())
        packs = found["log"].to_pylist()
        gram_logs = np.frombuffer(b"".join(packs[i] for i in order), "<f4")
        del packs
        parts = [as_bytes(b["text"]) for b in docs.select(["text"]).combine_chunks().to_batches(max_chunksize=ROWS)]
        some = Sums()
        for texts in parts:
            for symbols, new, _ in pieces(texts):
                codes, n = np.unique(codes_of(symbols, new), return_counts=True)
                some.add(codes, n)
        codes = some.all()[0]
        done = []
        for batch, texts in zip(docs.combine_chunks().to_batches(max_chunksize=ROWS), parts, strict=True):
            n, n_hot, base, rare, times = [], [], [], [], []
            for text in texts:
                w = text.lower().split()
                w.append(b"")
                at = np.fromiter(map(ids.get, w, repeat(-1)), np.int64, len(w))
                inside = at[at >= 0]
                base.append(float(word_logs[inside].sum()))
                n.append(len(w))
                n_hot.append(len(inside))
                others = Counter(w[i] for i in np.flatnonzero(at < 0)) if len(inside) < len(w) else {}
                rare.append(list(others))
                times.append(list(others.values()))
            part = pa.RecordBatch.from_pydict(
                {
                    "row": batch["row"],
                    "doc_id": batch["doc_id"],
                    "held_out": batch["held_out"],
                    "n_tokens": pa.array(n, pa.int64()),
                    "n_hot": pa.array(n_hot, pa.int64()),
                    "base": pa.array(base, pa.float64()),
                    "score": pa.array(scores_of(texts, codes, gram_logs), pa.float64()),
                    "rare": pa.array(rare, pa.list_(pa.binary())),
                    "times": pa.array(times, pa.list_(pa.int64())),
                }
            )
            done.append(part)
        return pa.Table.from_batches(done)

    id_type = docs.schema["doc_id"].dataType.simpleString()
    first = keep(
        blocks.groupBy("block")
        .cogroup(logs.groupBy("block"))
        .applyInArrow(
            read,
            f"row long, doc_id {id_type}, held_out boolean, n_tokens long, n_hot long, base double, score double, "
            "rare array<binary>, times array<long>",
        ),
        "lm-first",
    )
    hot_ids.destroy()
    hot_logs.destroy()
    each = first.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    c = F.coalesce("n", F.lit(0))
    rest = (
        each.join(words.where(F.col("n") < cut), "word", "left")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10((c + 0.5) / F.lit(whole))).alias("rare_base"),
            F.sum(F.when(c > 0, F.col("times")).otherwise(0)).alias("rare_known"),
        )
    )
    out = first.join(rest, "row", "left")
    return out.select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("n_hot") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )


def op8_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base and PPM scores of every document."""
    return scored(table(spark, sf_dir, "documents"))
