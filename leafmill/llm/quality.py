"""Quality classifier from weak labels.

Overlapping heuristic labellers vote good, bad or nothing on every document, for two
questions: is it prose of quality, and is it toxic.  The labels of documents that have them
are one more labeller of each.  One pass reads the texts and writes votes and hashed
features; votes are joined with the labels and counted by pattern (a few thousand patterns
at most), and expectation-maximisation finds how accurate each labeller is and how likely
each pattern is to be good.  Those posteriors label a training sample, on which a hashed
linear scorer is trained (follow-the-regularised-leader, whose L1 term leaves weights at
zero for words that say nothing).  The scorer decides, from the features written: a
document is accepted if it scores as quality and not as toxic.

Labellers of toxicity are a short list of insults, a word list learned from labelled rows,
and the label.  The list counts a word once for each distinct context (its neighbours where
the text has it first), so near copies count once whoever comes first, and takes it by one
smoothed share of toxic contexts.  Bounds, all documented parameters: the list reads at
most ``LABELLED_ROWS`` labelled documents (the smallest hashes of doc_id), the scorer about
``TRAIN_ROWS`` documents (by hash).  Votes, their counts and scores cover all documents.

Defined results: a null or empty text has no words, gets no votes but that on length, and
scores by the features it has; labels that are null, repeated or of unknown documents do
no harm (the largest value of a repeated one holds); equal texts score alike; without
labels the learned list is empty; extra columns pass through (one named like a score gets
``_in`` after its name); an empty table gives no rows.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, ByteType, IntegerType

from .scratch import column, free, keep, own_names, table

LABELLED_ROWS, TRAIN_ROWS = 20_000, 20_000
BITS = 18
STEM = 6  # bytes
CACHE = 1 << 19
LEXICON_PRECISION = 0.9
EPOCHS, ALPHA, BETA, L1, L2 = 3, 0.3, 1.0, 1.0, 1.0

# Insults.
INSULTS = frozenset(
    b"idiot idiots stupid moron morons loser losers scum pathetic worthless disgusting trash clown dumb imbecile jerk".split()
)
SYMBOL = re.compile(rb"[^\w\s\x80-\xff]")
MARKED = re.compile(rb"[\w\x80-\xff][.,;:]?[^\w\s\x80-\xff]{2,}(?=\s|\Z)")
BARE = re.compile(rb"(?:\s|\A)[^\w\s\x80-\xff]+(?=\s|\Z)")
UPPER, LETTERS = bytes(range(65, 91)), bytes([*range(65, 91), *range(97, 123)])
PLAIN = bytes([*LETTERS, *b"0123456789 \t\n\r\x0b\x0c.,;:'\"()?-", *range(128, 256)])
EDGES = bytes(c for c in range(33, 127) if not chr(c).isalnum())

# name, above which share a document is bad, below which it is good
STATISTICS = (
    ("symbols", 0.06, 0.03),
    ("capitals", 0.4, 0.15),
    ("repeats", 0.15, 0.05),
    ("marked", 0.2, 0.05),
    ("bare", 0.1, 0.03),
    ("sameness", 0.5, 0.3),
    ("longest_run", 0.06, 0.03),
    ("compression", 0.8, 0.75),
)
MOST_FALSE = 0.005  # the labellers' thresholds are set so that few good documents get a bad vote
TOXIC = ("insults", "learned")


def statistics_of(raw: bytes, words: list[bytes]) -> list[float | None]:
    """Shares by ``STATISTICS``; None where the text is too short to tell."""
    n, letters = len(words), len(raw) - len(raw.translate(None, LETTERS))
    if not n:
        return [None] * len(STATISTICS)
    again = bytes(map(eq, words, words[1:]))
    symbols = len(raw.translate(None, PLAIN))
    return [
        symbols / len(raw),
        (len(raw) - len(raw.translate(None, UPPER))) / letters if letters >= 20 else None,
        again.count(1) / n if n >= 5 else None,
        len(MARKED.findall(raw)) / n if symbols else 0.0,  # both by unusual symbols
        len(BARE.findall(raw)) / n if symbols else 0.0,
        1 - len(set(words)) / n if 20 <= n <= 200 else None,
        min(1.0, (1 + max(map(len, again.split(b"\0")))) / 50) if n >= 5 else None,
        1 - len(zlib.compress(raw, 1)) / len(raw) if n >= 50 else None,
    ]


def stripped(words: list[bytes]) -> set[bytes]:
    """Distinct words, lower-cased, without punctuation at their edges, and their stems: byte 1 and the first bytes."""
    found = {w.strip(EDGES) for w in set(b" ".join(words).lower().split())} - {b""}
    return found | {b"\1" + w[:STEM] for w in found if len(w) >= STEM}


def first_contexts(raw: bytes) -> dict[bytes, int]:
    """A hash of the neighbours of each word of ``stripped``, where the text has it first."""
    words = [w.strip(EDGES) for w in raw.lower().split()]
    words = [b"", *(w for w in words if w), b""]
    found: dict[bytes, int] = {}
    for i in range(1, len(words) - 1):
        w = words[i]
        for key in (w, b"\1" + w[:STEM]) if len(w) >= STEM else (w,):
            if key not in found:
                found[key] = xxhash.xxh3_64_intdigest(words[i - 1] + b"\0" + words[i + 1]) - (1 << 63)
    return found


def votes_of(shares: list[float | None], distinct: set[bytes], lexicon: frozenset) -> tuple[int, ...]:
    """1 good, -1 bad, 0 nothing: the quality labellers, then those of toxicity (-1 toxic)."""
    quality = [0 if s is None else -1 if s > bad else 1 if s < good else 0 for s, (_, bad, good) in zip(shares, STATISTICS, strict=True)]
    return (*quality, -1 if distinct & INSULTS else 1, 0 if not lexicon else -1 if distinct & lexicon else 1)


def estimated(patterns: np.ndarray, counts: np.ndarray, rounds: int = 50) -> np.ndarray:
    """Posterior that each vote pattern is bad: two classes, labellers independent given the class."""
    bad = np.where((patterns < 0).any(1), 0.8, 0.05)
    for _ in range(rounds):
        prior = (counts @ bad + 1) / (counts.sum() + 2)
        log = np.tile(np.log([1 - prior, prior]), (len(patterns), 1))
        for votes in patterns.T:
            for c, share in enumerate((1 - bad, bad)):
                own = counts * share
                said = own[votes != 0].sum()
                # a labeller's accuracy; a bad vote on a good document is taken to be rare
                rate = (own[votes < 0].sum() + (0.01 if c == 0 else 0.5)) / (said + 1)
                rate = min(rate, MOST_FALSE) if c == 0 else rate
                log[:, c] += np.where(votes < 0, np.log(rate), np.where(votes > 0, np.log1p(-rate), 0))
        log -= log.max(1, keepdims=True)
        p = np.exp(log)
        bad = p[:, 1] / p.sum(1)
    return bad


class Hashes(dict):
    """Feature numbers of words, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh32_intdigest(word) & ((1 << BITS) - 1)
        return value


HASHES = Hashes()


def features(shares: list[float | None], distinct: set[bytes]) -> np.ndarray:
    """Hashed features: bias, each share in steps, each word."""
    steps = [b"\0%d:%d" % (i, -1 if s is None else min(20, int(s * 40))) for i, s in enumerate(shares)]
    names = [b"\0bias", *steps, *distinct]
    out = np.fromiter(map(HASHES.__getitem__, names), np.int64, len(names))
    out.sort()  # so that equal texts add up in the same order
    return out


class Scorer:
    """A linear scorer over hashed binary features, with logistic loss."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.w: np.ndarray | None = None

    def weights(self, x: np.ndarray) -> np.ndarray:
        z, n = self.z[x], self.n[x]
        return np.where(np.abs(z) <= L1, 0.0, -(z - np.sign(z) * L1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def fit(self, rows: list[np.ndarray], y: np.ndarray, seed: int = 0) -> None:
        rng = np.random.default_rng(seed)
        for _ in range(EPOCHS):
            for i in rng.permutation(len(rows)):
                x = rows[i]
                w = self.weights(x)
                g = 1 / (1 + np.exp(-np.clip(w.sum(), -30, 30))) - y[i]
                n = self.n[x]
                self.z[x] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA * w
                self.n[x] = n + g * g
        self.w = self.weights(np.arange(1 << BITS)).astype(np.float32)
        self.z = self.n = np.empty(0)


def learned_lexicon(docs: DataFrame, labels: DataFrame) -> frozenset:
    """Words whose contexts in labelled documents are mostly of toxic ones."""
    sample = (
        labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL")
        .groupBy("doc_id")
        .agg((F.max("toxic") > 0).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(LABELLED_ROWS)
    )
    read = docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")  # at most LABELLED_ROWS ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 256):
                part = batch.slice(at, 256)
                found = {
                    (word, context, toxic)
                    for raw, toxic in zip(part["text"].cast(pa.binary()).to_pylist(), part["toxic"].to_pylist(), strict=True)
                    for word, context in first_contexts(raw or b"").items()
                }
                words, contexts, said = zip(*found, strict=True) if found else ((), (), ())
                yield pa.RecordBatch.from_pydict(
                    {"word": pa.array(words, pa.binary()), "context": pa.array(contexts, pa.int64()), "toxic": pa.array(said, pa.int32())}
                )

    contexts = read.select("text", "toxic").mapInArrow(run, "word binary, context long, toxic int").distinct()
    found = (
        contexts.groupBy("word")
        .agg(F.sum("toxic").alias("a"), F.count(F.lit(1)).alias("n"))
        .where((F.col("a") + 0.5) / (F.col("n") + 1) >= LEXICON_PRECISION)
    )
    return frozenset(bytes(r["word"]) for r in found.select("word").collect())  # words of the bounded sample


def read_texts(batch: pa.RecordBatch) -> Iterator[tuple[list, set]]:
    for raw in batch["text"].cast(pa.binary()):
        raw = raw.as_py() or b""
        words = raw.split()
        yield statistics_of(raw, words), stripped(words)


def read_once(docs: DataFrame, lexicon: frozenset, keep_text: bool, key: str, votes: str, x: str) -> DataFrame:
    """``docs`` with a hash of each row's id and text, its votes and its features, written to a table."""
    shared = docs.sparkSession.sparkContext.broadcast(lexicon)
    known = docs.withColumn(key, F.xxhash64("doc_id", "text"))
    names = [c for c in known.columns if keep_text or c != "text"]
    schema = known.select(*map(column, names)).schema.add(votes, ArrayType(ByteType())).add(x, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            said, found = [], []
            for shares, distinct in read_texts(batch):
                said.append(votes_of(shares, distinct, shared.value))
                found.append(features(shares, distinct))
            columns = [pa.array(said, pa.list_(pa.int8())), pa.array(found, pa.list_(pa.int32()))]
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *columns], names=[*names, votes, x])

    out = keep(known.mapInArrow(run, schema), "quality-features")
    shared.destroy()
    return out


def with_labels(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """``rows`` (doc_id, others) with the quality and toxic label of their documents, null where there is none."""
    own = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max("quality").cast("int").alias("quality"), F.max("toxic").cast("int").alias("toxic")
    )
    without = rows.where("doc_id IS NULL").withColumn("quality", F.lit(None).cast("int")).withColumn("toxic", F.lit(None).cast("int"))
    return rows.where("doc_id IS NOT NULL").join(own, "doc_id", "left").unionByName(without)


def split_votes(votes: np.ndarray, quality: np.ndarray, toxic: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The votes on each of the two questions, the label (1, 0 or -1 for none) last."""
    said = lambda label, bad: np.where(label < 0, 0, np.where(label == bad, -1, 1))[:, None]
    q = len(STATISTICS)
    return np.hstack((votes[:, :q], said(quality, 0))), np.hstack((votes[:, q:], said(np.minimum(toxic, 1), 1)))


def trained(read: DataFrame, labels: DataFrame, key: str, votes: str, x: str) -> tuple[Scorer, Scorer]:
    """The scorers of quality and of toxicity, from the table of ``read_once``."""
    rows = read.select("doc_id", F.col(key).alias("k"), F.col(votes).alias("votes"), F.col(x).alias("x"))
    none = [F.coalesce(c, F.lit(-1)).alias(c) for c in ("quality", "toxic")]
    counted = with_labels(rows.select("doc_id", "votes"), labels).groupBy("votes", *none).agg(F.count(F.lit(1)).alias("n"))
    counts = sorted((tuple(r["votes"]), r["quality"], r["toxic"], r["n"]) for r in counted.collect())  # bounded: three votes, few labellers
    n = np.array([r[3] for r in counts], float)
    width = len(STATISTICS) + len(TOXIC)
    stacked = np.array([r[0] for r in counts], np.int8).reshape(len(counts), width)
    models = []
    for part in split_votes(stacked, *(np.array([r[i] for r in counts], int) for i in (1, 2))):
        unique, at = np.unique(part, axis=0, return_inverse=True)
        bad = estimated(unique, np.bincount(at.ravel(), n, len(unique)))
        models.append({p.tobytes(): float(b) for p, b in zip(unique.astype(np.int8), bad, strict=True)})

    place = F.pmod("k", F.lit(1 << 62)) / float(1 << 62)
    sample = rows.where(place < TRAIN_ROWS / max(1.0, n.sum()))  # about TRAIN_ROWS
    if sample.count() > 2 * TRAIN_ROWS:  # one row, repeated over and over
        sample = sample.orderBy("k").limit(2 * TRAIN_ROWS)
    got = with_labels(sample, labels).select("k", "votes", "x", *none).toArrow()
    order = np.argsort(got["k"].to_numpy(), kind="stable")  # the same order however the rows arrive
    own = np.array(got["votes"].to_pylist(), np.int8).reshape(got.num_rows, width)
    posteriors = [
        np.array([m[v.tobytes()] for v in part.astype(np.int8)])
        for m, part in zip(models, split_votes(own, got["quality"].to_numpy(), got["toxic"].to_numpy()), strict=True)
    ]
    lists = pa.concat_arrays(got["x"].chunks) if got.num_rows else pa.array([], pa.list_(pa.int32()))
    flat, edges = lists.flatten().to_numpy(), lists.offsets.to_numpy()
    edges = edges - edges[0]
    del got, lists
    out = []
    for y in (1 - posteriors[0], posteriors[1]):
        scorer = Scorer()
        scorer.fit([flat[edges[i] : edges[i + 1]] for i in order], y[order])
        out.append(scorer)
    return tuple(out)


def scored(docs: DataFrame, labels: DataFrame, quality: str, toxic: str, keep_text: bool = True) -> DataFrame:
    """``docs`` with the scores ``quality`` and ``toxic``, which are no columns of it."""
    key, votes, x = free(docs.withColumn(quality, F.lit(0)).withColumn(toxic, F.lit(0)), "_key", "_votes", "_x")
    read = read_once(docs, learned_lexicon(docs, labels), keep_text, key, votes, x)
    model = docs.sparkSession.sparkContext.broadcast([s.w for s in trained(read, labels, key, votes, x)])
    names = [c for c in docs.columns if keep_text or c != "text"]
    schema = read.select(*map(column, names)).schema.add(quality, "double").add(toxic, "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            offsets = batch[x].offsets.to_numpy()
            flat = batch[x].values.to_numpy()[offsets[0] : offsets[-1]]
            found = []
            for w in model.value:
                sums = np.add.reduceat(w[flat], offsets[:-1] - offsets[0]) if len(batch) else np.empty(0)
                found.append(pa.array(1 / (1 + np.exp(-np.clip(sums, -30, 30))), pa.float64()))
            yield pa.RecordBatch.from_arrays([*(batch[n] for n in names), *found], names=[*names, quality, toxic])

    return read.select(*map(column, names), x).mapInArrow(run, schema)


def judged(docs: DataFrame, labels: DataFrame, keep_text: bool = True) -> DataFrame:
    """``docs`` with ``p_quality`` and ``p_toxic``."""
    names = own_names(docs, "p_quality", "p_toxic")
    return scored(docs.select(*(column(c).alias(n) for c, n in names.items())), labels, "p_quality", "p_toxic", keep_text)


def accepts(quality: str, toxic: str) -> Column:
    return (F.col(quality) >= 0.5) & (F.col(toxic) < 0.5)


def accepted(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier accepts."""
    names = free(docs, "_p_quality", "_p_toxic")
    return scored(docs, labels, *names).where(accepts(*names)).select(*map(column, docs.columns))


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both scores of every document, and whether it is accepted."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out = judged(docs, table(spark, sf_dir, "labels"), keep_text=False)
    return out.withColumn("accepted", accepts("p_quality", "p_toxic"))
