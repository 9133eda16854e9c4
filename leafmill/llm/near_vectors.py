"""Near-duplicate embeddings: spherical k-means cells, blocked cosines within cells, components, one kept of each.

Vectors of one label and equal components are one class (copies are never paired).  Of
classes, as unit vectors:

1. k-means on the sphere, fitted on a bounded sample (``SAMPLE`` classes for each centre, by
   hash), gives the centres.  Centres as near to each other as links are merged, so that a
   large group of near copies does not draw several.
2. Each class has a home, the cell of its nearest centre.  For two linked vectors the way to
   the plane between the centres of their homes is, added up, at most their own distance, so
   one of the two is within half of it: each class also visits the cells whose plane is that
   near, and every linked pair meets in a cell that is the home of one of them.  A pair that
   meets in both homes counts in the smaller.
3. Homes of a cell within half the linking angle of its centre are its core: they are all
   linked with each other, which their number says without a product.  All other pairs of a
   cell (but of two visitors) are compared in blocks of at most ``BLOCK`` classes a side; a large
   cell is as many tasks as it has pairs of blocks.  A task gives each member's number of
   links and only the links that join components, fewer than it has members.
4. Components are found by contraction.

No link is lost by the sample, the cells or the blocks: they only say where a pair is compared.

Defined results: vectors that are null, empty, zero or have a null or non-finite component, and those
without label or id, are linked with nothing; vectors of unequal length are padded with
zeros; rows that repeat id, label and vector are one vector and get equal rows; rows of one id that
differ stand by themselves; ties go to the smaller id; extra columns are ignored (links) or pass
through (filter), whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .near_dup import components
from .scratch import column, free, keep, table

NEAR = 0.93
CELL, LEAST_CELLS, MOST_CELLS = 1024, 4, 2048  # classes of the largest label for each centre; how many centres
CENTRE_BYTES = 32 << 20  # of all centres, which every task has
SAMPLE, ROUNDS = 64, 4
LEAST_BLOCK, BLOCK, BLOCK_BYTES = 256, 4096, 32 << 20
STRIP = 512  # rows of a matrix of cosines held at once
SLACK = 1e-9
CORE, HOME, VISITOR = 0, 1, 2


def unit_vectors(vectors: DataFrame) -> DataFrame:
    """(vec_id, label, c, u) of ``vectors`` (vec_id, label, vector): digest of label and vector, and unit vector, null where it links with nothing."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            c, u = [], []
            for vec_id, label, vector in zip(batch["vec_id"], batch["label"], batch["vector"], strict=True):
                v = vector.values.cast(pa.float64()).to_numpy(zero_copy_only=False) if vector.is_valid else np.zeros(0)
                if not (vec_id.is_valid and label.is_valid and len(v) and np.isfinite(v).all() and v.any()):
                    c.append(None)
                    u.append(None)
                    continue
                v = v[: np.flatnonzero(v)[-1] + 1] + 0.0  # no zeros at its end, no negative zero
                c.append(hashlib.blake2b(label.as_py().encode() + b"\0" + v.tobytes(), digest_size=16).digest())
                v = v / np.abs(v).max()
                u.append((v / np.linalg.norm(v)).tobytes())
            yield pa.RecordBatch.from_arrays([batch["vec_id"], batch["label"], pa.array(c, pa.binary()), pa.array(u, pa.binary())], ["vec_id", "label", "c", "u"])

    kind = vectors.schema["vec_id"].dataType.simpleString()
    return vectors.select("vec_id", F.col("label").cast("string"), "vector").mapInArrow(run, f"vec_id {kind}, label string, c binary, u binary")


def matrix(u: pa.Array, d: int) -> np.ndarray:
    """Unit vectors as rows, padded with zeros to ``d``."""
    out = np.zeros((len(u), d))
    for row, x in zip(out, u, strict=True):
        own = np.frombuffer(x.as_buffer())
        row[: len(own)] = own
    return out


def distinct_centres(centres: np.ndarray, near: float) -> np.ndarray:
    """The centres of which none before them is as near as ``near``."""
    alike = centres @ centres.T >= near
    held: list[int] = []
    for i in range(len(centres)):
        if not alike[i, held].any():
            held.append(i)
    return centres[held]


def fitted_centres(classes: DataFrame, n: int, k: int, d: int, near: float) -> np.ndarray:
    """About ``k`` unit centres, by k-means on the sphere over about ``SAMPLE * k`` of the ``n`` classes."""
    place = F.pmod(F.xxhash64("c"), F.lit(1 << 62)) / float(1 << 62)
    sample = classes.select("c", "u", place.alias("place")).where(F.col("place") < SAMPLE * k / n)
    sample = keep(sample, "cell-sample")
    first = sample.orderBy("place", "c").limit(k).select("u").toArrow()["u"].combine_chunks()
    centres = distinct_centres(matrix(first, d), near)

    def one_round(centres: np.ndarray) -> DataFrame:
        def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, rows = np.zeros(centres.shape), np.zeros(len(centres), np.int64)
            for batch in batches:
                x = matrix(batch["u"], d)
                home = (x @ centres.T).argmax(1)
                np.add.at(total, home, x)
                rows += np.bincount(home, minlength=len(centres))
            own = np.flatnonzero(rows)
            yield pa.RecordBatch.from_pydict({"cell": pa.array(own, pa.int32()), "rows": pa.array(rows[own]), "s": pa.array([total[i].tobytes() for i in own], pa.binary())})

        def whole(_key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total, rows, cell = np.zeros(d), 0, None
            for batch in batches:
                total += matrix(batch["s"], d).sum(0)
                rows += sum(batch["rows"].to_pylist())
                cell = batch["cell"][0].as_py()
            yield pa.RecordBatch.from_pydict({"cell": pa.array([cell], pa.int32()), "rows": pa.array([rows]), "s": pa.array([total.tobytes()], pa.binary())})

        schema = "cell int, rows long, s binary"
        return sample.mapInArrow(sums, schema).groupBy("cell").applyInArrow(whole, schema)

    for _ in range(ROUNDS):
        found = one_round(centres).orderBy(F.desc("rows"), "cell").toArrow()  # at most k rows
        total = matrix(found["s"].combine_chunks(), d)
        size = np.linalg.norm(total, axis=1)
        centres = distinct_centres(total[size > 0] / size[size > 0, None], near)
    return centres


def dealt(classes: DataFrame, centres: np.ndarray, near: float) -> DataFrame:
    """(label, cell, part, c, copies, u, home, cells): each class in its home and the cells that it visits, all of which it carries."""
    d = centres.shape[1]
    reach = math.sqrt((1 - near) / 2) + SLACK  # half the distance of two vectors at the threshold
    inner = math.sqrt((1 + near) / 2) + SLACK  # cosine of half their angle

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        apart = np.sqrt(np.maximum(2 - 2 * centres @ centres.T, 1e-300))
        for batch in batches:
            for at in range(0, batch.num_rows, STRIP):
                part = batch.slice(at, STRIP)
                if not part.num_rows:
                    continue
                cos = matrix(part["u"], d) @ centres.T
                home = cos.argmax(1)
                best = cos[np.arange(len(home)), home]
                row, cell = np.nonzero((best[:, None] - cos) <= reach * apart[home])
                kind = np.where(cell != home[row], VISITOR, np.where(best[row] >= inner, CORE, HOME))
                ends = np.cumsum(np.bincount(row, minlength=len(home)))
                lists = [x.astype(np.int32).tobytes() for x in np.split(cell, ends[:-1])]
                take = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [take["label"], pa.array(cell, pa.int32()), pa.array(kind, pa.int32()), take["c"], take["copies"], take["u"],
                     pa.array(home[row], pa.int32()), pa.array([lists[i] for i in row], pa.binary())],
                    ["label", "cell", "part", "c", "copies", "u", "home", "cells"],
                )

    schema = "label string, cell int, part int, c binary, copies long, u binary, home int, cells binary"
    return classes.select("label", "c", "copies", "u").mapInArrow(run, schema)


def in_tasks(members: DataFrame, block: int) -> DataFrame:
    """``members`` of the cells, once for each task that they have a part in: tasks are pairs (lo, hi) of blocks of a cell."""
    count = lambda part: F.ceil(F.count_if(F.col("part") == part) / block).cast("int")
    cells = members.groupBy("label", "cell").agg(
        F.count(F.lit(1)).alias("of"), count(CORE).alias("cores"), count(HOME).alias("homes"), count(VISITOR).alias("visitors"),
        F.count_if(F.col("part") == CORE).alias("inner"), F.count_if(F.col("part") == VISITOR).alias("outer"),
    )
    cells = cells.where("inner < of AND outer < of AND of > 1").drop("inner", "outer")
    known = members.join(cells, ["label", "cell"])
    hashed = lambda n: F.pmod(F.xxhash64("c"), n).cast("int")
    one = F.col("of") <= block
    own = F.when(one, 0).when(F.col("part") == CORE, hashed(F.col("cores"))).when(F.col("part") == HOME, F.col("cores") + hashed(F.col("homes")))
    own = own.otherwise(F.col("cores") + F.col("homes") + hashed(F.col("visitors")))
    low = F.when(one | (F.col("part") != CORE), 0).otherwise(F.col("cores"))
    high = F.when(one, 1).when(F.col("part") == VISITOR, F.col("cores") + F.col("homes")).otherwise(F.col("cores") + F.col("homes") + F.col("visitors"))
    known = known.withColumns({"own": own, "low": low, "high": high}).where("low < high")
    known = known.withColumn("other", F.explode(F.sequence("low", F.col("high") - 1)))
    return known.select(
        "label", "cell", "part", "c", "copies", "u", "home", "cells", "own", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi")
    )


class Side:
    """Members of one block of a task."""

    def __init__(self, rows: pa.Table, d: int):
        rows = rows.combine_chunks()
        one = lambda name: rows[name].combine_chunks() if isinstance(rows[name], pa.ChunkedArray) else rows[name]
        self.c, self.u, self.n = rows["c"].to_pylist(), matrix(one("u"), d), rows.num_rows
        self.part, self.home, self.copies = (rows[x].to_numpy() for x in ("part", "home", "copies"))
        self.cells = [np.frombuffer(x, np.int32) for x in rows["cells"].to_pylist()]

    def holds(self, cells: np.ndarray, most: int) -> np.ndarray:
        """Which of ``cells`` each member has among its own."""
        out = np.zeros((self.n, most), bool)
        for row, own in zip(out, self.cells, strict=True):
            row[own] = True
        return out[:, cells]


def compared(cell: int, a: Side, b: Side | None, near: float) -> tuple[list, list, list]:
    """Links of the members of two blocks, or of one with itself: rows (c, None, number of links) and (c, c, 0) for links that join."""
    other = a if b is None else b
    most = int(max(x.max(initial=0) for side in (a, other) for x in side.cells)) + 1
    joined = np.arange(a.n + (0 if b is None else b.n))
    shift = 0 if b is None else a.n
    counts = np.zeros(len(joined), np.int64)
    out: tuple[list, list, list] = ([], [], [])
    names = a.c if b is None else a.c + b.c
    # a pair that meets in the other's home too counts there if that is smaller
    again_a = a.holds(other.home, most) & (other.home < cell)[None, :]
    again_b = (other.holds(a.home, most) & (a.home < cell)[None, :]).T
    for at in range(0, a.n, STRIP):
        rows = slice(at, at + STRIP)
        link = a.u[rows] @ other.u.T >= near
        part = a.part[rows, None]
        link &= ~((part == other.part) & (part != HOME)) & ~again_a[rows] & ~again_b[rows]
        if b is None:
            link &= np.arange(a.n)[rows, None] < np.arange(other.n)[None, :]
        counts[: a.n][rows] += link @ other.copies
        counts[shift:][: other.n] += a.copies[rows] @ link
        for i in np.flatnonzero(link.any(1)):
            x, ends = at + i, shift + np.flatnonzero(link[i])
            roots, first = np.unique(joined[ends], return_index=True)
            new = roots != joined[x]
            for y in ends[first[new]]:
                out[0].append(names[x])
                out[1].append(names[y])
                out[2].append(0)
            if new.any():
                joined[np.isin(joined, roots)] = joined[x]
    own = np.flatnonzero(counts)
    out[0].extend(names[i] for i in own)
    out[1].extend([None] * len(own))
    out[2].extend(counts[own].tolist())
    return out


def found_links(tasks: DataFrame, d: int, near: float) -> DataFrame:
    """(a, b, links) of all tasks, as ``compared`` gives them."""

    def run(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = pa.Table.from_batches(list(batches))
        cell, lo, hi = (key[i].as_py() for i in (1, 2, 3))
        if lo == hi:
            out = compared(cell, Side(rows, d), None, near)
        else:
            own = rows["own"].to_numpy()
            sides = [rows.filter(pa.array(own == x)) for x in (lo, hi)]
            if not all(s.num_rows for s in sides):
                return
            out = compared(cell, *(Side(s, d) for s in sides), near)
        yield pa.RecordBatch.from_arrays([pa.array(x, t) for x, t in zip(out, (pa.binary(), pa.binary(), pa.int64()), strict=True)], ["a", "b", "links"])

    return tasks.groupBy("label", "cell", "lo", "hi").applyInArrow(run, "a binary, b binary, links long")


def near_vectors(vectors: DataFrame, near: float = NEAR) -> DataFrame:
    """(vec_id, c, n_links, component_id) of each row of ``vectors`` (vec_id, label, vector)."""
    known = keep(unit_vectors(vectors), "cell-units")
    usable = known.where("c IS NOT NULL")
    ids = usable.select("vec_id", "c").distinct().groupBy("c").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    one = usable.groupBy("c").agg(F.first("label").alias("label"), F.first("u").alias("u"))
    classes = keep(one.join(ids, "c"), "cell-classes")
    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n"), F.max(F.octet_length("u")).alias("width"))
    n, largest, width = sizes.agg(F.sum("n"), F.max("n"), F.max("width")).first()
    rows = known.select("vec_id", "c")
    if not n:
        return rows.select("vec_id", "c", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))

    d = width // 8
    k = max(LEAST_CELLS, min(-(-largest // CELL), MOST_CELLS, CENTRE_BYTES // width))
    centres = fitted_centres(classes, n, k, d, near)
    members = keep(dealt(classes, centres, near), "cell-members")
    block = max(LEAST_BLOCK, min(BLOCK, BLOCK_BYTES // width))
    found = keep(found_links(in_tasks(members, block), d, near), "cell-links")

    cores = members.where(F.col("part") == CORE)
    core = cores.groupBy("label", "cell").agg(F.sum("copies").alias("all"), F.min("c").alias("b"), F.count(F.lit(1)).alias("of")).where("of > 1")
    inside = keep(cores.join(core, ["label", "cell"]).select(F.col("c").alias("a"), "b", (F.col("all") - F.col("copies")).alias("links")), "cell-cores")
    links = found.where("b IS NOT NULL").select("a", "b").unionByName(inside.where("a <> b").select("a", "b"))
    counts = found.where("b IS NULL").select("a", "links").unionByName(inside.select("a", "links")).groupBy("a").agg(F.sum("links").alias("links"))

    labels = components(links) if not links.isEmpty() else None
    of_class = classes.select("c", "rep", "copies").join(counts.withColumnRenamed("a", "c"), "c", "left")
    if labels is not None:
        grouped = of_class.join(labels, "c", "left")
        first = grouped.where("root IS NOT NULL").groupBy("root").agg(F.min("rep").alias("least"))
        of_class = grouped.join(first, "root", "left").withColumn("rep", F.coalesce("least", "rep"))
    linked = of_class.select("c", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("links"), F.col("rep").alias("component"))
    return rows.join(keep(linked.where("links > 0"), "cell-components"), "c", "left").select(
        "vec_id", "c", F.coalesce("links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component", "vec_id").alias("component_id")
    )


def representatives(vectors: DataFrame, vector: str, label: str, key: str = "vec_id", near: float = NEAR) -> DataFrame:
    """``vectors`` without the rows of groups of near copies but one, that of the smallest id."""
    names = dict(zip(("vec_id", "label", "vector"), (key, label, vector), strict=True))
    known = vectors.select(*(column(c).alias(name) for name, c in names.items()))
    gone = keep(near_vectors(known, near).where("vec_id <> component_id").select("vec_id").distinct(), "cell-gone")
    own = free(vectors, "gone")
    return vectors.join(gone.withColumnRenamed("vec_id", own), column(key) == F.col(own), "left_anti")


def op13_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links, component and whether it is kept of every embedding: cosine of 0.93 within its label."""
    vectors = table(spark, sf_dir, "embeddings").select("vec_id", "label", F.col("embedding").alias("vector"))
    found = near_vectors(vectors).drop("c")
    return found.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


OP13_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
), links AS MATERIALIZED (
  SELECT a.vec_id AS a, b.vec_id AS b
  FROM v AS a JOIN v AS b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.93
), reached AS (
  SELECT a AS vec_id, a AS other FROM links
  UNION
  SELECT r.vec_id, l.b FROM reached AS r JOIN links AS l ON l.a = r.other
), least AS (
  SELECT vec_id, min(other) AS component_id FROM reached GROUP BY vec_id
), counts AS (
  SELECT a AS vec_id, count(*) AS n_links FROM links GROUP BY a
)
SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id, coalesce(component_id, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least USING (vec_id) LEFT JOIN counts USING (vec_id)
"""
