"""Exact top-k search by inner product: the three-phase uniform threshold.

Vectors are cut into ``LISTS`` slices of their dimensions; the partial products of a query
with one slice are one list, and an object's score is the sum over the lists.

1. Each list gives its local best entries for a query.  The objects gathered are scored in
   full; the k-th best score among them bounds the query's k-th score from below.
2. The cutoff, that bound divided by the number of lists, goes to every list.  An object
   below it in all lists has a sum below the bound, so the objects that reach it in some
   list are sufficient.
3. The scores of those still open are resolved exactly, and the k best are kept, ties to the
   smaller id.

The stated queries meet all rows in blocks: rows are grouped by a hash of their id into
groups of about ``ROWS``, queries into blocks of about ``QUERIES``, and each pair of group
and block is one bounded task, which has that group's part of every list as one matrix
product; whole scores are added up only for the entries gathered (1) or sufficient (2).
The lists of a group stay together because, of dense vectors, about a fifth of all entries
reach the cutoff: as rows between tasks they would cost far more than the products.
Cutoffs travel with the query blocks.  Only local winners (k for a query and group) leave
a task, and they are cut to k again before and after the shuffle.

Whole scores are exact: in double precision while ``LISTS`` times the largest possible sum
stays below 2 ** 53, and beyond that in Python integers (also where 256 times a component is no double).  Scores beyond the range of a long
are the nearest long, and rank as that.

Defined results: rows whose vector is null, or has a null or non-finite component, take no
part, as query or candidate; neither do rows without id; a vector id on several rows stands
for one vector (the first in array order); vectors of unequal length are compared as if
padded with zeros; fewer than k candidates give as many ranks; a query alone gives none;
extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import keep, table

K, LISTS, SCALE = 5, 4, 256
ROWS, QUERIES = 1024, 1024
EXACT = 2.0**53
LEAST, MOST = -(1 << 63), (1 << 63) - 1


def usable(vector: Column) -> Column:
    """Not null, and without null or non-finite components."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(fine(x), F.lit(False)))


def matrix(vectors: pd.Series, width: int) -> np.ndarray:
    """Rows of floor(SCALE * component), padded with zeros; as Python integers where a double cannot hold one."""
    out = np.zeros((len(vectors), width))
    for row, v in zip(out, vectors, strict=True):
        row[: len(v)] = v
    with np.errstate(over="ignore"):
        scaled = np.floor(out * SCALE)
    if np.isfinite(scaled).all():
        return scaled
    return np.array([[int(c) * SCALE if abs(c) > EXACT else math.floor(c * SCALE) for c in row] for row in out.tolist()], object).reshape(out.shape)


def integers(a: np.ndarray) -> np.ndarray:
    """The same whole numbers as Python integers."""
    return np.array([[int(c) for c in r] for r in a], object).reshape(a.shape)


def lists_of(q: np.ndarray, x: np.ndarray) -> list[np.ndarray]:
    """The exact partial products of all queries and rows, one array for each slice of the dimensions."""
    huge = object in (q.dtype, x.dtype)
    if huge or not np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * max(1, q.shape[1]) * LISTS < EXACT:
        q, x = integers(q), integers(x)
    return [q[:, s] @ x[:, s].T for s in slices(q.shape[1])]


def whole(lists: list[np.ndarray], i: int, own: np.ndarray) -> np.ndarray:
    """Scores of query ``i`` with the rows ``own``, within the range of a long."""
    total = sum(p[i, own] for p in lists)
    return total if total.dtype != object else np.array([min(max(t, LEAST), MOST) for t in total], object)


def best(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best of one row, ties to the smaller id."""
    if scores.dtype == object:
        return np.array(sorted(range(len(scores)), key=lambda i: (-scores[i], ids[i]))[:k], np.int64)
    if len(scores) > k:
        cut = np.partition(scores, len(scores) - k)[len(scores) - k]
        own = np.flatnonzero(scores >= cut)
    else:
        own = np.arange(len(scores))
    return own[np.lexsort((ids[own], -scores[own]))][:k]


def deduplicated(rows: pd.DataFrame, vector: str, key: str) -> pd.DataFrame:
    """One row for each id: the first vector in array order."""
    if not rows[key].duplicated().any():
        return rows
    order = rows[vector].map(tuple)
    return rows.assign(_o=order).sort_values([key, "_o"]).drop_duplicates(key).drop(columns="_o")


def loaded(rows: pd.DataFrame, queries: pd.DataFrame) -> tuple:
    rows = deduplicated(rows, "vector", "vec_id")
    queries = deduplicated(queries, "asked", "query_id")
    width = max(rows["vector"].map(len).max(), queries["asked"].map(len).max())
    x, q = matrix(rows["vector"], width), matrix(queries["asked"], width)
    return rows["vec_id"].to_numpy(), x, queries, queries["query_id"].to_numpy(), q, width


def slices(width: int) -> list[slice]:
    edges = [width * i // LISTS for i in range(LISTS + 1)]
    return [slice(a, b) for a, b in zip(edges, edges[1:], strict=False) if b > a] or [slice(0, 0)]


def winners(query_ids: list, ids: list, scores: list) -> pd.DataFrame:
    return pd.DataFrame({"query_id": query_ids, "vec_id": ids, "score": [int(s) for s in scores]}).astype("int64")


def gather(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Phase 1 in one group: the k best, by whole scores, of the lists' local best."""
    if rows.empty or queries.empty:
        return winners([], [], [])
    ids, x, _, query_ids, q, _ = loaded(rows, queries)
    lists = lists_of(q, x)
    out: tuple[list, list, list] = ([], [], [])
    for i, query in enumerate(query_ids):
        other = np.flatnonzero(ids != query)
        own = other[np.unique(np.concatenate([best(p[i, other], ids[other], K) for p in lists]))]
        total = whole(lists, i, own)
        top = best(total, ids[own], K)
        out[0].extend([query] * len(top))
        out[1].extend(ids[own[top]])
        out[2].extend(total[top])
    return winners(*out)


def below(bound: int) -> float | int:
    """A number no greater than ``bound`` that compares exactly with doubles; all of them if there is no bound."""
    if bound == LEAST:
        return -np.inf
    return float(bound) if abs(bound) < EXACT else float(np.nextafter(float(bound), -np.inf))


def resolve(rows: pd.DataFrame, queries: pd.DataFrame) -> pd.DataFrame:
    """Phases 2 and 3 in one group: the entries that reach the cutoff in a list, scored, and the k best kept."""
    if rows.empty or queries.empty:
        return winners([], [], [])
    ids, x, queries, query_ids, q, _ = loaded(rows, queries)
    lists = lists_of(q, x)
    out: tuple[list, list, list] = ([], [], [])
    for i, (query, bound) in enumerate(zip(query_ids, map(int, queries["bound"]), strict=True)):
        bound = below(bound)
        sufficient = ids != query
        sufficient &= np.logical_or.reduce([len(lists) * p[i] >= bound for p in lists]).astype(bool)
        own = np.flatnonzero(sufficient)
        total = whole(lists, i, own)
        reach = np.asarray(total >= bound, bool)
        own, total = own[reach], total[reach]
        top = best(total, ids[own], K)
        out[0].extend([query] * len(top))
        out[1].extend(ids[own[top]])
        out[2].extend(total[top])
    return winners(*out)


def ranked(lists: DataFrame) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best entries of each query."""
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return lists.withColumn("rank", rank).where(F.col("rank") <= K).select("query_id", "rank", "vec_id", "score")


def top_k(vectors: DataFrame, is_query: Column) -> DataFrame:
    """query_id, rank, vec_id, score: the k best of ``vectors`` (vec_id, vector) for each row that ``is_query``."""
    fine = vectors.where(F.col("vec_id").isNotNull() & usable(F.col("vector"))).select(
        F.col("vec_id").cast("long"), F.col("vector").cast("array<double>")
    )
    asked = fine.where(is_query)
    n, n_queries = fine.agg(F.count(F.lit(1)), F.count_if(is_query)).first()
    groups, blocks = max(1, -(-n // ROWS)), max(1, -(-n_queries // QUERIES))
    every = lambda k: F.explode(F.sequence(F.lit(0), F.lit(k - 1)))
    hashed = lambda c, k: F.pmod(F.xxhash64(c), F.lit(k)).cast("int")
    rows = fine.withColumn("g", hashed("vec_id", groups)).withColumn("b", every(blocks))
    queries = asked.select(F.col("vec_id").alias("query_id"), F.col("vector").alias("asked"))
    queries = queries.withColumn("b", hashed("query_id", blocks))

    def in_blocks(asked: DataFrame, task) -> DataFrame:
        spread = asked.withColumn("g", every(groups))
        schema = "query_id long, vec_id long, score long"
        return rows.groupBy("g", "b").cogroup(spread.groupBy("g", "b")).applyInPandas(task, schema)

    bounds = ranked(in_blocks(queries, gather)).where(F.col("rank") == K).select("query_id", F.col("score").alias("bound"))
    known = queries.join(keep(bounds, "topk-bounds"), "query_id", "left").withColumn("bound", F.coalesce("bound", F.lit(LEAST)))
    return ranked(in_blocks(known, resolve))


def op2_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 best of all other vectors for each vector whose id is divisible by 50."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").alias("vector"))
    return top_k(vectors, F.col("vec_id") % 50 == 0)


OP2_SQL = r"""
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), pairs AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_sum(list_transform(list_zip(q.e, c.e), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM v AS q JOIN v AS c ON q.vec_id <> c.vec_id
  WHERE q.vec_id % 50 = 0
), ranked AS (
  SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank, vec_id, score
  FROM pairs
)
SELECT query_id, rank, vec_id, score FROM ranked WHERE rank <= 5
"""
