"""Benchmark decontamination: containment search with size-partitioned MinHash sketches.

A document is contaminated by an item if it holds at least ``threshold`` of the item's
distinct word shingles, wherever they stand.  Comparing a short item with a long document
by Jaccard similarity is hopeless, so the test is on the item's side alone: an item of n
shingles may miss n - ceil(threshold * n), hence of its n - ceil(threshold * n) + 1
smallest shingles in any fixed random order (the bottom of its MinHash ranking) at least
one is in every document that contains it.  Items are partitioned by size, each class with
the sketch length that its largest size needs; the union of the sketches is the index.
Documents are searched whole, in one pass without a shuffle, and a hit is verified by exact
containment of word tuples.  No link is lost and none is invented.

The benchmark is sent to the tasks in pieces of at most ``PIECE_BYTES`` of text; a larger
benchmark takes further passes over the documents, each written to a table before the next
piece is sent, so that the driver and the tasks hold one piece at a time.

Defined results: words are maximal runs of other than ASCII white space, A-Z lower-cased;
an item of fewer words than ``width`` is one shingle of all its words, looked for as such;
items or documents without words or text match nothing; equal items match alike, each with
its own row; repeated documents keep their rows; extra columns are ignored (pairs) or pass
through (filter); empty tables give no pairs.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.core.broadcast import Broadcast
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import keep, table

WIDTH, THRESHOLD = 5, 0.8
PIECE_BYTES = 16 << 20
MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def words_of(text: str | None) -> list[bytes]:
    """Maximal runs of other than ASCII white space, A-Z lower-cased (``bytes`` does exactly both)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingles_of(words: list[bytes], width: int) -> set[tuple[bytes, ...]]:
    if not words:
        return set()
    if len(words) < width:
        return {tuple(words)}
    return set(zip(*(words[i:] for i in range(width)), strict=False))


def rank_of(shingle: tuple[bytes, ...]) -> bytes:
    """The place of a shingle in the fixed random order."""
    return hashlib.blake2b(b"\0".join(shingle), digest_size=8).digest()


def least_shared(n: int, threshold: float) -> int:
    """The fewest of n shingles that reach the threshold."""
    least = max(1, int(threshold * n))
    while least < threshold * n - 1e-9:
        least += 1
    return least


class Index:
    """Sketches of the items, by shingle width and size class."""

    def __init__(self, items: list[tuple[object, str | None]], width: int, threshold: float):
        self.width, self.threshold = width, threshold
        self.items: list[tuple[object, set]] = []
        sketches: dict[int, dict[tuple, list[int]]] = defaultdict(lambda: defaultdict(list))
        for item_id, text in items:
            words = words_of(text)
            shingles = shingles_of(words, width)
            if not shingles:
                continue
            n = len(shingles)
            largest = (1 << n.bit_length()) - 1  # of the size class
            length = min(n, largest - least_shared(largest, threshold) + 1)
            at = len(self.items)
            self.items.append((item_id, shingles))
            for s in sorted(shingles, key=rank_of)[:length]:
                sketches[min(width, len(words))][s].append(at)
        self.sketches = {w: dict(x) for w, x in sketches.items()}
        known = sorted({word for x in self.sketches.values() for s in x for word in s})
        self.ids = {word: i for i, word in enumerate(known)}
        self.codes = {
            w: np.unique(np.array([self.code([self.ids[x] for x in s]) for s in sketch], np.uint64))
            for w, sketch in self.sketches.items()
        }

    @staticmethod
    def code(ids: list[int]) -> int:
        total = 0
        for i in ids:
            total = (total * int(MULTIPLIER) + i + 1) % (1 << 64)
        return total

    def candidates(self, words: list[bytes]) -> set[int]:
        """Items of which a sketch entry stands in the document."""
        ids = np.fromiter(map(self.ids.get, words, repeat(-1)), np.int64, len(words))
        found: set[int] = set()
        for w, codes in self.codes.items():
            if len(ids) < w:
                continue
            known = ids >= 0
            starts = np.ones(len(ids) - w + 1, bool)
            for j in range(w):
                starts &= known[j : len(ids) - w + 1 + j]
            starts = np.flatnonzero(starts)
            if not len(starts):
                continue
            code = np.zeros(len(starts), np.uint64)
            for j in range(w):
                code = code * MULTIPLIER + (ids[starts + j] + 1).astype(np.uint64)
            place = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
            for s in starts[codes[place] == code]:
                found.update(self.sketches[w].get(tuple(words[s : s + w]), ()))
        return found

    def matches(self, text: str | None) -> list[tuple[object, int, int]]:
        """(item, its shingles, those shared) of the items that the document contains."""
        words = words_of(text)
        found = self.candidates(words) if words else ()
        if not found:
            return []
        held: dict[int, set] = {}
        out = []
        for at in sorted(found):
            item_id, shingles = self.items[at]
            w = len(next(iter(shingles)))
            if w not in held:
                held[w] = shingles_of(words, w) if len(words) >= w else set()
            shared = len(shingles & held[w])
            if shared >= least_shared(len(shingles), self.threshold):
                out.append((item_id, len(shingles), shared))
        return out


def pieces(benchmark: DataFrame, width: int, threshold: float) -> Iterator[tuple[Index, bool]]:
    """Indexes of bounded parts of the benchmark (item_id, text), and whether there is but one."""
    items = benchmark.select("item_id", "text")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-total // PIECE_BYTES) or 1
    for i in range(n):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) if n > 1 else items
        yield Index([(r[0], r[1]) for r in part.collect()], width, threshold), n == 1


def passed(found: DataFrame, shared: Broadcast, alone: bool) -> DataFrame:
    """The result of one piece; of several, each is written at once and its index let go."""
    if alone:
        return found
    kept = keep(found, "decontaminate")
    shared.destroy()
    return kept


def contaminated_pairs(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) of every document (doc_id, text) and item it contains."""
    spark = docs.sparkSession
    narrow = docs.select("doc_id", "text")
    kinds = {"doc_id": docs.schema["doc_id"].dataType, "item_id": benchmark.schema["item_id"].dataType}
    schema = narrow.drop("text").schema.add("item_id", kinds["item_id"]).add("n_item", "long").add("n_shared", "long")
    out = None
    for index, alone in pieces(benchmark, width, threshold):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            kind = None
            for batch in batches:
                ids, rows = batch["doc_id"], []
                kind = pa.array([x[0] for x in shared.value.items]).type if kind is None else kind
                for i, text in enumerate(batch["text"]):
                    rows += [(i, *m) for m in shared.value.matches(text.as_py())]
                yield pa.RecordBatch.from_pydict(
                    {
                        "doc_id": ids.take(pa.array([r[0] for r in rows], pa.int64())),
                        "item_id": pa.array([r[1] for r in rows], kind),
                        "n_item": pa.array([r[2] for r in rows], pa.int64()),
                        "n_shared": pa.array([r[3] for r in rows], pa.int64()),
                    }
                )

        part = passed(narrow.mapInArrow(run, schema), shared, alone)
        out = part if out is None else out.unionByName(part)
    return out


def decontaminate(docs: DataFrame, benchmark: DataFrame, width: int = WIDTH, threshold: float = THRESHOLD) -> DataFrame:
    """``docs`` without the documents that contain a benchmark item."""
    spark = docs.sparkSession
    for index, alone in pieces(benchmark, width, threshold):
        shared = spark.sparkContext.broadcast(index)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                clean = [not shared.value.matches(text.as_py()) for text in batch["text"]]
                yield batch.filter(pa.array(clean, pa.bool_()))

        docs = passed(docs.mapInArrow(run, docs.schema), shared, alone)
    return docs


def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every contaminated document with the item it contains and the exact shingle counts."""
    return contaminated_pairs(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


OP3_SQL = r"""
WITH dw AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), bw AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM benchmark
), lens AS (
  SELECT DISTINCT least(len(ws), 5) AS m FROM bw WHERE len(ws) > 0
), ds AS (
  SELECT DISTINCT doc_id, array_to_string(ws[i:i + m - 1], ' ') AS s FROM dw, lens, unnest(range(1, len(ws) - m + 2)) AS u(i)
), bs AS (
  SELECT DISTINCT item_id, array_to_string(ws[i:i + least(len(ws), 5) - 1], ' ') AS s FROM bw, unnest(range(1, len(ws) - least(len(ws), 5) + 2)) AS u(i)
  WHERE len(ws) > 0
), sizes AS (
  SELECT item_id, count(*) AS n_item FROM bs GROUP BY item_id
), shared AS (
  SELECT doc_id, item_id, count(*) AS n_shared FROM ds JOIN bs USING (s) GROUP BY doc_id, item_id
)
SELECT doc_id, item_id, CAST(n_item AS BIGINT) AS n_item, CAST(n_shared AS BIGINT) AS n_shared
FROM shared JOIN sizes USING (item_id) WHERE 10 * n_shared >= 8 * n_item
"""
