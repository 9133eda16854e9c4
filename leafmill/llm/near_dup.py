"""Near-duplicate documents: min-max hashing, banding, exact links, components.

Each document is the set of its distinct word shingles.  Every permutation gives two values,
the minimum and the maximum over the set, so a signature of m values costs m / 2 hash
evaluations a shingle, and its share of equal values is an unbiased estimate of similarity
with less variance than m minima.  Of each value 16 bits are kept; bands of ``rows`` values,
as many as make a miss at the threshold rarer than ``MISS``, are the buckets.

Documents of equal words form one class, by a 128-bit digest of the words (copies are never
paired).  In the buckets of classes

1. each class is linked with the bucket's first class, if their exact sets confirm it, and
   the components of these links are found.  Large groups of near copies mostly fall
   together here, at one candidate a member;
2. where a bucket still holds several components, every pair between two of them is compared
   by signature, and all that are not far below the threshold are confirmed: no link is lost
   by 1.

Links are confirmed on full sets, as 64-bit hashes of all shingles.  In 1 a first class's set
travels once for ``FAN`` of its candidates.  Step 2 compares in blocks of at most ``BLOCK``
members and about ``BLOCK_BYTES`` of sets a side (a large bucket is as many tasks as it has
pairs of blocks) and takes a pair only in the first band that it shares.  A task has the
signatures and sets of its two blocks, and gives only the links that join two components
there, fewer than it has members: a group of near copies that are just too unlike costs
comparisons, not rows.  Components are found by contracting to the least neighbour; ids of
classes are hashes, so paths shrink by a constant share in each round.

Defined results: words are maximal runs of other than ASCII white space, A-Z lower-cased; a
document of fewer words than ``width`` has one shingle of all its words; one without words
or text has none, and is linked with nothing; documents of equal sets are linked; rows of
one doc_id are one document if their words are equal and else stand by themselves; a null
doc_id is linked with nothing; ties go to the smaller doc_id; extra columns are ignored
(components) or pass through (filter), whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .decontaminate import words_of
from .scratch import column, free, keep, table

MISS = 1e-7
SIGMAS = 4.3
BLOCK, BLOCK_BYTES = 1024, 16 << 20
FAN = 4096  # candidates of one class in a group
CACHE = 1 << 19
HALF = 1 << 12  # shingles hashed at once


class Words(dict):
    """Word hashes, remembered up to a bound."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE:
            self.clear()
        self[word] = value = xxhash.xxh3_64_intdigest(word)
        return value


def mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


def shingle_hashes(words: list[bytes], width: int, known: Words) -> np.ndarray:
    """Sorted distinct hashes of the shingles, of which there is at least one."""
    h = np.fromiter(map(known.__getitem__, words), np.uint64, len(words))
    n = min(width, len(h))
    out = np.full(len(h) - n + 1, n, np.uint64)
    for i in range(n):
        out = mixed(out + h[i : len(h) - n + 1 + i])
    return np.unique(out)


def class_of(words: list[bytes]) -> bytes:
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest()


class Scheme:
    """Shingle width, threshold as a fraction, and the bands that follow from it."""

    def __init__(self, width: int, num: int, den: int):
        self.width, self.num, self.den = width, num, den
        t = num / den
        self.rows = 5 if t >= 0.83 else 4
        self.bands = math.ceil(math.log(MISS) / math.log(1 - t**self.rows))
        self.bands += self.bands % 2 * (self.rows % 2)  # an even number of values
        self.values = self.rows * self.bands
        self.least = t - SIGMAS * math.sqrt(t * (1 - t) / self.values)
        rng = np.random.default_rng(7)
        half = self.values // 2
        self.xor = rng.integers(0, 1 << 63, half, dtype=np.uint64)
        self.mul = rng.integers(0, 1 << 63, half, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

    def signature(self, h: np.ndarray) -> bytes:
        """16 bits of the minimum and of the maximum under each permutation."""
        low = np.full(len(self.mul), np.iinfo(np.uint64).max, np.uint64)
        high = np.zeros(len(self.mul), np.uint64)
        for at in range(0, len(h), HALF):
            x = h[at : at + HALF, None] ^ self.xor
            x *= self.mul
            np.minimum(low, x.min(0), out=low)
            np.maximum(high, x.max(0), out=high)
        return ((np.concatenate((low, high)) >> np.uint64(20)) & np.uint64(0xFFFF)).astype("<u2").tobytes()

    def linked(self, shared: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
        """Which counts of shared shingles of sets of n and m reach the threshold."""
        return (shared > 0) & (self.den * shared >= self.num * (n + m - shared))


def hashed(docs: DataFrame) -> DataFrame:
    return docs.select("doc_id", "text", F.xxhash64("text").alias("th"))


def signatures(docs: DataFrame, scheme: Scheme) -> DataFrame:
    """(doc_id, th, n, c, sig): hash of the text, size of the set, digest of its words and signature (null without shingles)."""
    doc_id = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            n, c, sig = [], [], []
            for doc, text in zip(batch["doc_id"], batch["text"], strict=True):
                words = words_of(text.as_py())
                h = shingle_hashes(words, scheme.width, known) if words else ()
                n.append(len(h))
                if not words or not doc.is_valid:
                    c.append(None)
                    sig.append(None)
                    continue
                c.append(class_of(words))
                sig.append(scheme.signature(h))
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": batch["doc_id"],
                    "th": batch["th"],
                    "n": pa.array(n, pa.int64()),
                    "c": pa.array(c, pa.binary()),
                    "sig": pa.array(sig, pa.binary()),
                }
            )

    return hashed(docs).mapInArrow(run, f"doc_id {doc_id}, th long, n long, c binary, sig binary")


def buckets(classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(band, key, c) for each band of each class."""
    size = 2 * scheme.rows
    key = lambda i: F.xxhash64(i, F.substring("sig", i * size + 1, F.lit(size)))
    keys = F.transform(F.sequence(F.lit(0), F.lit(scheme.bands - 1)), lambda i: key(i))
    return classes.select("c", F.posexplode(keys).alias("band", "key"))


def class_sets(docs: DataFrame, wanted: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """(c, set): the sorted shingle hashes of each class in ``wanted`` (c)."""
    ids = wanted.distinct().join(classes.select("c", "rep.doc_id", "rep.th"), "c")
    texts = hashed(docs).join(ids, ["doc_id", "th"]).select("c", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Words()
        for batch in batches:
            sets = []
            for c, text in zip(batch["c"].to_pylist(), batch["text"], strict=True):
                words = words_of(text.as_py())
                sets.append(shingle_hashes(words, scheme.width, known).tobytes() if class_of(words) == c else None)
            out = pa.RecordBatch.from_pydict({"c": batch["c"], "set": pa.array(sets, pa.binary())})
            yield out.filter(out["set"].is_valid())

    # a class's first document may be repeated
    return texts.mapInArrow(run, "c binary, set binary").dropDuplicates(["c"])


def confirmed(pairs: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose full sets reach the threshold."""
    group = F.pmod(F.xxhash64("b"), F.ceil(F.col("of") / FAN)).cast("int")
    sizes = pairs.groupBy("a").agg(F.count(F.lit(1)).alias("of"))
    other = pairs.join(sizes, "a").withColumn("group", group).join(sets.withColumnRenamed("c", "b"), "b").select("a", "group", "b", "set")
    every = F.explode(F.sequence(F.lit(0), (F.ceil(F.col("of") / FAN) - 1).cast("int")))
    own = sizes.withColumn("group", every).join(sets.withColumnRenamed("c", "a"), "a")
    own = own.select("a", "group", F.lit(None).cast("binary").alias("b"), "set")
    dealt = own.unionByName(other).repartition("a", "group").sortWithinPartitions("a", "group", F.asc_nulls_first("b"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = np.empty(0, np.uint64)
        for batch in batches:
            kept = []
            for b, own in zip(batch["b"], batch["set"], strict=True):
                own = np.frombuffer(own.as_buffer(), np.uint64)
                if not b.is_valid:
                    first = own
                    kept.append(False)
                    continue
                shared = len(np.intersect1d(first, own, assume_unique=True))
                kept.append(bool(scheme.linked(shared, len(first), len(own))))
            yield batch.select(["a", "b"]).filter(pa.array(kept, pa.bool_()))

    return dealt.mapInArrow(run, "a binary, b binary")


def estimated(pairs: DataFrame, classes: DataFrame, scheme: Scheme) -> DataFrame:
    """The pairs (a, b) whose signatures and sizes do not rule them out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            sa, sb = (np.frombuffer(b"".join(batch[x].to_pylist()), "<u2").reshape(batch.num_rows, -1) for x in ("sa", "sb"))
            yield batch.select(["a", "b"]).filter(pa.array((sa == sb).mean(1) >= scheme.least, pa.bool_()))

    one = lambda k: classes.select(F.col("c").alias(k), F.col("sig").alias(f"s{k}"), F.col("n").alias(f"n{k}"))
    near = scheme.den * F.least("na", "nb") >= scheme.num * F.greatest("na", "nb")
    joined = pairs.join(one("a"), "a").join(one("b"), "b").where(near)
    return joined.select("a", "b", "sa", "sb").mapInArrow(run, "a binary, b binary")


def components(links: DataFrame) -> DataFrame:
    """(c, root) for every end of ``links`` (a, b); ends of one component share the root."""
    labels, edges = None, links.select("a", "b")
    while True:
        both = edges.union(edges.select("b", "a"))
        to = keep(both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("to")), "dup-to")
        if labels is None:
            labels = to.select(F.col("a").alias("c"), F.col("to").alias("root"))
        else:
            labels = labels.join(to, labels["root"] == to["a"], "left").select("c", F.coalesce("to", "root").alias("root"))
        labels = keep(labels, "dup-labels")
        ends = (
            edges.join(to.withColumnRenamed("to", "x"), "a")
            .join(to.select(F.col("a").alias("b"), F.col("to").alias("y")), "b")
            .where("x <> y")
        )
        edges = keep(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(), "dup-edges")
        if edges.isEmpty():
            return labels


def open_rows(members: DataFrame, labels: DataFrame, classes: DataFrame) -> DataFrame:
    """Rows (band, key, c, root, n, blocks) of the buckets whose members are in several components.

    ``members`` is (band, key, c, p), p the bucket's first class, without the row of p.
    """
    known = members.join(labels, "c", "left").withColumn("root", F.coalesce("root", "c")).join(classes.select("c", "n"), "c")
    blocks = F.greatest(F.count(F.lit(1)) / BLOCK, 8 * F.sum("n") / BLOCK_BYTES)
    open_ = (
        known.groupBy("band", "key")
        .agg(F.min("root").alias("x"), F.max("root").alias("y"), F.ceil(blocks).cast("int").alias("blocks"))
        .where("x <> y")
        .select("band", "key", "blocks")
    )
    return known.join(open_, ["band", "key"]).drop("p")


class Forest:
    """Components that grow together by links."""

    def __init__(self, n: int):
        self.to = list(range(n))

    def root(self, x: int) -> int:
        while (y := self.to[x]) != x:
            self.to[x] = x = self.to[y]
        return x


def joining_links(band: int, same: bool, block: np.ndarray, root: list[bytes], sig: np.ndarray, sets: list[np.ndarray], scheme: Scheme) -> list[tuple]:
    """Links (positions) that join the components of two blocks (block: 0 or 1 of each member), or of one with itself.

    Taken are only the pairs that no band before ``band`` has in one bucket.
    """
    left, right = (np.arange(len(sets)),) * 2 if same else (np.flatnonzero(block == 0), np.flatnonzero(block == 1))
    n = np.array([len(x) for x in sets])
    every = np.concatenate([sets[i] for i in right])
    order = np.argsort(every, kind="stable")
    every, owner = every[order], np.repeat(np.arange(len(right)), n[right])[order]
    number = {r: i for i, r in enumerate(dict.fromkeys(root))}
    of = np.array([number[r] for r in root])
    forest, out = Forest(len(number)), []
    for x in left:
        equal = sig[right] == sig[x]
        near = (equal.mean(1) >= scheme.least) & (scheme.den * np.minimum(n[x], n[right]) >= scheme.num * np.maximum(n[x], n[right]))
        near &= ~equal[:, : band * scheme.rows].reshape(len(right), band, scheme.rows).all(2).any(1)
        if same:
            near &= right > x
        own = forest.root(of[x])
        candidates = [y for y in np.flatnonzero(near) if forest.root(of[right[y]]) != own]
        if not candidates:
            continue
        lo, hi = np.searchsorted(every, sets[x], "left"), np.searchsorted(every, sets[x], "right")
        length = hi - lo
        at = np.repeat(lo - np.cumsum(length) + length, length) + np.arange(length.sum())
        shared = np.bincount(owner[at], minlength=len(right))
        linked = scheme.linked(shared, n[x], n[right])
        for y in candidates:
            a, b = forest.root(of[x]), forest.root(of[right[y]])
            if linked[y] and a != b:
                forest.to[a] = b
                out.append((x, right[y]))
    return out


def open_links(rows: DataFrame, classes: DataFrame, sets: DataFrame, scheme: Scheme) -> DataFrame:
    """Links (a, b) between components of the open buckets, enough to join all that are linked."""
    own = F.pmod(F.xxhash64("c"), F.col("blocks")).cast("int")
    rows = rows.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("band", "key", "c", "root", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    rows = rows.join(classes.select("c", "sig"), "c").join(sets, "c")
    dealt = rows.repartition("key", "i", "j").sortWithinPartitions("key", "band", "i", "j")
    keys = ["band", "key", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list = []
        last = None

        def flush() -> pa.RecordBatch:
            c, root, block, sig, sets = zip(*held, strict=True)
            sig = np.frombuffer(b"".join(sig), "<u2").reshape(len(held), -1)
            sets = [np.frombuffer(x, np.uint64) for x in sets]
            _, _, i, j = last
            block = (np.array(block) == j).astype(int) if i != j else np.zeros(len(held), int)
            out = joining_links(last[0], i == j, block, root, sig, sets, scheme) if i == j or 0 < block.sum() < len(block) else []
            return pa.RecordBatch.from_pydict({k: pa.array([c[r[x]] for r in out], pa.binary()) for x, k in enumerate("ab")})

        for batch in batches:
            columns = [batch[k].to_pylist() for k in (*keys, "c", "root", "own", "sig", "set")]
            for row in zip(*columns, strict=True):
                if row[:4] != last:
                    if held:
                        yield flush()
                    held, last = [], row[:4]
                held.append(row[4:])
        if held:
            yield flush()

    return dealt.mapInArrow(run, "a binary, b binary")


def near_duplicates(docs: DataFrame, width: int, num: int, den: int) -> DataFrame:
    """(doc_id, th, n_shingles, component_id) of every document, linked at a similarity of num / den."""
    scheme = Scheme(width, num, den)
    known = keep(signatures(docs, scheme), "dup-signatures")
    classes = keep(
        known.where("c IS NOT NULL")
        .groupBy("c")
        .agg(F.min(F.struct("doc_id", "th")).alias("rep"), F.first("n").alias("n"), F.first("sig").alias("sig"), F.count(F.lit(1)).alias("copies")),
        "dup-classes",
    )
    every = buckets(classes, scheme)
    shared = every.groupBy("band", "key").agg(F.min("c").alias("p"), F.max("c").alias("q")).where("p <> q").drop("q")
    members = keep(every.join(shared, ["band", "key"]).where("c <> p"), "dup-buckets")

    star = members.select(F.col("p").alias("a"), F.col("c").alias("b")).distinct()
    star = keep(estimated(star, classes, scheme), "dup-star")
    ends = star.select(F.explode(F.array("a", "b")).alias("c"))
    sets = keep(class_sets(docs, ends, classes, scheme), "dup-sets")
    links = keep(confirmed(star, sets, scheme), "dup-links")
    labels = components(links)

    rows = keep(open_rows(members, labels, classes), "dup-open")
    if not rows.isEmpty():
        more = keep(class_sets(docs, rows.select("c").join(sets, "c", "left_anti"), classes, scheme), "dup-sets")
        new = keep(open_links(rows, classes, sets.unionByName(more), scheme), "dup-links")
        if not new.isEmpty():
            labels = components(links.unionByName(new))

    grouped = labels.join(classes.select("c", "rep.doc_id"), "c")
    first = grouped.groupBy("root").agg(F.min("doc_id").alias("component"))
    linked = grouped.join(first, "root").select("c", "component")
    copied = classes.where("copies > 1").join(linked, "c", "left_anti").select("c", F.col("rep.doc_id").alias("component"))
    of_class = keep(linked.unionByName(copied), "dup-components")
    return known.join(of_class, "c", "left").select(
        "doc_id", "th", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id")
    )


def without_near_duplicates(docs: DataFrame, width: int = 5, num: int = 8, den: int = 10) -> DataFrame:
    """``docs`` with one document of each component, that of the smallest id."""
    gone = near_duplicates(docs, width, num, den).where("doc_id <> component_id").select("doc_id", "th").distinct()
    th = free(docs, "th")
    known = docs.withColumn(th, F.xxhash64("text"))
    return known.join(keep(gone.withColumnRenamed("th", th), "dup-gone"), ["doc_id", th], "left_anti").select(*map(column, docs.columns))


def op6_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shingles, component and whether it is kept of every document: three words, similarity 0.85."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = near_duplicates(docs, 3, 85, 100).drop("th")
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
