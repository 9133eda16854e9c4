"""Operators on rows in order.  Every order is total, and every window has a key.

``global_rank`` numbers rows of a whole table without gathering them in one task: integer
keys are cut into buckets, buckets into buckets of buckets, and so on; totals are summed up
inside one bucket of each kind, of which no task sees more than ``width`` parts, however
sparse the keys are, and rows are ranked inside their bucket.

``rank_within``, ``guarded_rows`` and ``smoothed_rows`` do the same inside a key that may hold
any share of all rows: ``bucket`` is a whole number that never falls along the order (an hour,
a range of ids), a task sees the rows of one bucket of one key, and only a row a bucket is
gathered for the key.  A null bucket comes first, as null does in the order.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F
from pyspark.sql import types as S


def global_rank(rows: DataFrame, key: str, ties: list[str] | None = None, width: int = 1 << 16, name: str = "rank") -> DataFrame:
    """``rows`` with their 1-based rank by an integer key; a null key comes first."""
    shift = width.bit_length() - 1
    kinds = -(-64 // shift)
    up = lambda c: F.call_function("shiftright", c, F.lit(shift))
    own = rows.withColumn("_b", up(F.coalesce(F.col(key).cast("long"), F.lit(-(1 << 63)))))
    totals = [own.groupBy("_b").agg(F.count(F.lit(1)).alias("_n")).withColumnRenamed("_b", "_b0")]
    for k in range(1, kinds):  # of the last kind there are two, below zero and not
        totals.append(totals[-1].groupBy(up(F.col(f"_b{k - 1}")).alias(f"_b{k}")).agg(F.sum("_n").alias("_n")))

    def before(frame: DataFrame, k: int) -> DataFrame:
        """Rows of the parts before each, inside the next greater bucket."""
        spec = Window.orderBy(f"_b{k}") if k == kinds - 1 else Window.partitionBy(up(F.col(f"_b{k}"))).orderBy(f"_b{k}")
        spec = spec.rowsBetween(Window.unboundedPreceding, -1)
        return frame.select(f"_b{k}", up(F.col(f"_b{k}")).alias(f"_b{k + 1}"), F.coalesce(F.sum("_n").over(spec), F.lit(0)).alias(f"_off{k}"))

    offsets = before(totals[0], 0)
    for k in range(1, kinds):
        offsets = offsets.join(before(totals[k], k), f"_b{k}")
    offsets = offsets.select(F.col("_b0").alias("_b"), sum((F.col(f"_off{k}") for k in range(1, kinds)), F.col("_off0")).alias("_off"))
    inside = F.row_number().over(Window.partitionBy("_b").orderBy(key, *(ties or [])))
    return own.withColumn("_r", inside).join(offsets, "_b").withColumn(name, F.col("_r") + F.col("_off")).drop("_b", "_r", "_off")


def bucketed(rows: DataFrame, key: str, bucket: Column) -> DataFrame:
    """``rows`` with ``_k``, the key as a struct so that null joins null, and ``_b``, the bucket."""
    return rows.withColumn("_k", F.struct(key)).withColumn("_b", F.coalesce(bucket.cast("long"), F.lit(-(1 << 63))))


def rank_within(rows: DataFrame, key: str, *order: str, bucket: Column, name: str = "rank", total: str = "total") -> DataFrame:
    """``rows`` with their 1-based rank in the key, and the key's number of rows."""
    own = bucketed(rows, key, bucket)
    sizes = own.groupBy("_k", "_b").agg(F.count(F.lit(1)).alias("_n"))
    up_to = F.sum("_n").over(Window.partitionBy("_k").orderBy("_b"))
    offsets = sizes.select("_k", "_b", (up_to - F.col("_n")).alias("_off"), F.sum("_n").over(Window.partitionBy("_k")).alias(total))
    inside = F.row_number().over(Window.partitionBy("_k", "_b").orderBy(*order))
    return own.withColumn("_r", inside).join(offsets, ["_k", "_b"]).withColumn(name, F.col("_r") + F.col("_off")).drop("_k", "_b", "_r", "_off")


def running_total(rows: DataFrame, key: str, *order: str, bucket: Column, value: Column, name: str = "start") -> DataFrame:
    """``rows`` with the sum of ``value`` over the rows of their key before each: where a piece begins in the whole."""
    own = bucketed(rows, key, bucket).withColumn("_v", F.coalesce(value, F.lit(0)).cast("long"))
    earlier = lambda *by: Window.partitionBy("_k", *by[:-1]).orderBy(*by[-1]).rowsBetween(Window.unboundedPreceding, -1)
    sums = own.groupBy("_k", "_b").agg(F.sum("_v").alias("_n"))
    offsets = sums.select("_k", "_b", F.coalesce(F.sum("_n").over(earlier(["_b"])), F.lit(0)).alias("_off"))
    inside = F.coalesce(F.sum("_v").over(earlier("_b", list(order))), F.lit(0))
    return own.withColumn("_r", inside).join(offsets, ["_k", "_b"]).withColumn(name, F.col("_r") + F.col("_off")).drop("_k", "_b", "_v", "_r", "_off")


def interpolated(pos: Column, n: Column, low: float = 5.8, high: float = 95.8) -> Column:
    """Place of the 1-based ``pos`` of ``n`` between two bounds; the middle for one alone."""
    return F.when(n == 1, 50.0).otherwise(F.lit(low) + (pos - 1) / (n - 1) * (high - low))


def evenly(first: Column, last: Column, i: Column, n: Column) -> Column:
    """Even spacing of 0-based ``i`` of ``n``."""
    return F.when(n == 1, first.cast("double")).otherwise(first + i * (last - first) / (n - 1))


def midpoints(value: str, w: WindowSpec, nominal: Column | float, overlap: float = 0.0) -> tuple[Column, Column]:
    """Edges half way to both neighbours; the outer ones at a nominal distance."""
    v = F.col(value)
    before = F.coalesce(F.lag(value).over(w), v - nominal)
    after = F.coalesce(F.lead(value).over(w), v + nominal)
    return (before + v) / 2 - overlap, (v + after) / 2 + overlap


def guarded(snapped: Column, expected: Column, least: float = 28) -> Column:
    """Array of snapped values, each replaced by the expected one where it is not beyond its predecessor.

    The predecessor is the adjusted one.  For the lines of a page; ``guarded_rows`` takes keys of any size.
    """
    pairs = F.arrays_zip(snapped.alias("s"), expected.alias("e"))
    none = F.array().cast("array<double>")

    def step(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        fine = last.isNull() | (x["s"] > last + least)
        return F.concat(done, F.array(F.when(fine, x["s"]).otherwise(x["e"]).cast("double")))

    return F.aggregate(pairs, none, step)


def guarded_rows(
    rows: DataFrame, key: str, *order: str, bucket: Column, snapped: Column, expected: Column, least: float = 28, name: str = "guarded"
) -> DataFrame:
    """``rows`` with the guarded value of each and whether it is the snapped one (W3), by key in order.

    A row keeps one of two values, so all it hands on is one bit, and a row maps the bit before
    it: to itself, to its opposite, or to a constant.  The bit of a row is thus the last constant
    at or before it, turned over by the number of opposites since; so windows do it, first inside
    a bucket, then over the buckets' maps.  The first row of a key is snapped, as is one after a
    null; a null is not beyond anything, so it gives the expected value.
    """
    w, over = Window.partitionBy("_k", "_b").orderBy(*order), Window.partitionBy("_k").orderBy("_b")
    beyond = lambda s, before: F.coalesce(before.isNull() | (s > before + least), F.lit(False))

    def mapped(frame: DataFrame, s: Column, before: Column) -> DataFrame:
        """With ``_same``, the constant of a row or null, and ``_turn``, whether it gives the opposite."""
        after_snapped, after_expected = beyond(s, before["s"]), beyond(s, before["e"])
        return frame.withColumn("_same", F.when(after_snapped == after_expected, after_snapped)).withColumn("_turn", ~after_snapped & after_expected)

    def composed(frame: DataFrame, same: Column, turn: Column, spec: WindowSpec, known: str, odd: str) -> DataFrame:
        """The map of all rows up to each: ``known``, the last constant or null, turned over if ``odd``."""
        frame = frame.withColumn("_turns", F.sum(turn.cast("long")).over(spec))
        frame = frame.withColumn("_last", F.last(F.when(same.isNotNull(), F.struct(same.alias("v"), F.col("_turns").alias("at"))), ignorenulls=True).over(spec))
        since = F.col("_turns") - F.coalesce("_last.at", F.lit(0))
        return frame.withColumn(known, F.col("_last.v")).withColumn(odd, since % 2 == 1).drop("_turns", "_last")

    own = bucketed(rows, key, bucket).withColumn("_v", F.struct(snapped.cast("double").alias("s"), expected.cast("double").alias("e")))
    own = own.withColumn("_i", F.row_number().over(w)).withColumn("_before", F.lag("_v").over(w))
    own, inner = mapped(own, F.col("_v.s"), F.col("_before")), F.col("_i") > 1  # a bucket's first row waits for the bucket before
    own = composed(own, F.when(inner, F.col("_same")), inner & F.col("_turn"), w, "_known", "_odd")

    ends = own.groupBy("_k", "_b").agg(F.min_by("_v", "_i").alias("first"), F.max_by(F.struct("_v", "_known", "_odd"), "_i").alias("last"))
    ends = mapped(ends, F.col("first.s"), F.lag("last._v").over(over)).withColumnsRenamed({"_same": "_same1", "_turn": "_turn1"})
    whole = F.coalesce("last._known", "_same1") != F.col("last._odd")
    ends = composed(ends, whole, F.col("_turn1") != F.col("last._odd"), over, "_known_b", "_odd_b")
    ends = ends.withColumn("_end", F.lag(F.col("_known_b") != F.col("_odd_b")).over(over))
    starts = ends.select("_k", "_b", F.coalesce("_same1", F.col("_end") != F.col("_turn1")).alias("_start"))

    fine = F.coalesce("_known", "_start") != F.col("_odd")
    out = own.join(starts, ["_k", "_b"]).withColumn(f"{name}_snapped", fine).withColumn(name, F.when(fine, F.col("_v.s")).otherwise(F.col("_v.e")))
    return out.drop("_k", "_b", "_v", "_i", "_before", "_same", "_turn", "_known", "_odd", "_start")


def islands(rows: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """Runs of neighbours with equal values: key, value, first and last position, size."""
    w = Window.partitionBy(key).orderBy(*order)
    numbered = rows.withColumn("pos", F.row_number().over(w)).withColumn(
        "_g", F.row_number().over(w) - F.row_number().over(Window.partitionBy(key, value).orderBy(*order))
    )
    return numbered.groupBy(key, value, "_g").agg(
        F.min("pos").alias("first_pos"), F.max("pos").alias("last_pos"), F.count(F.lit(1)).alias("size")
    ).drop("_g")


def coalesced_runs(runs: Column) -> Column:
    """Neighbouring runs of equal style as one (W4), for an array of structs with ``text``."""
    style = lambda r: F.struct(r["typeface"], r["placement"], r["layout"], r["line_span"], r["span_id"])

    def step(done: Column, r: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        front = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
        same = last.isNotNull() & style(last).eqNullSafe(style(r))
        return F.when(same, F.concat(front, F.array(last.withField("text", F.concat(last["text"], r["text"]))))).otherwise(
            F.concat(done, F.array(r))
        )

    return F.aggregate(runs, F.slice(runs, 1, 0), step)


def out_of_sequence(rows: DataFrame, number: Column, position: Column) -> DataFrame:
    """Rows whose number is not their position."""
    return rows.where(~number.eqNullSafe(position))


def reflected_weights(sigma: float = 4.0, truncate: float = 4.0) -> list[float]:
    """A normalised Gaussian kernel."""
    import math

    radius = int(truncate * sigma + 0.5)
    raw = [math.exp(-0.5 * (i / sigma) ** 2) for i in range(-radius, radius + 1)]
    return [x / sum(raw) for x in raw]


def smoothed(values: Column, weights: list[float]) -> Column:
    """Weighted sum about each element of an array, reflected at the edges."""
    radius, n = len(weights) // 2, F.size(values)
    kernel = F.array(*[F.lit(w) for w in weights])
    fold = lambda i: F.when(F.pmod(i, 2 * n) < n, F.pmod(i, 2 * n)).otherwise(2 * n - 1 - F.pmod(i, 2 * n))

    def at(i: Column) -> Column:
        term = lambda acc, k: acc + F.element_at(kernel, k + 1) * F.element_at(values, (fold(i + k - radius) + 1).cast("int"))
        return F.aggregate(F.sequence(F.lit(0), F.lit(len(weights) - 1)), F.lit(0.0), term)

    return F.when(n > 0, F.transform(F.sequence(F.lit(0), n - 1), at)).otherwise(F.array().cast("array<double>"))


def smoothed_rows(
    rows: DataFrame, key: str, *order: str, bucket: Column, value: str, weights: list[float], name: str = "smooth", place: str = "place", chunk: int = 4096
) -> DataFrame:
    """``rows`` with the weighted sum about each, reflected at the ends of the key, and their 0-based place.

    Ranks are cut into chunks of ``chunk`` rows with a halo of the kernel's radius on either side; rows
    near the ends also stand at their mirror images, so each sum sees the whole kernel.
    """
    radius = len(weights) // 2
    if chunk < 2 * radius:
        raise ValueError("a chunk must hold the kernel")
    kernel, p, n, v = F.array(*[F.lit(w) for w in weights]), F.col(place), F.col("_total"), F.col("_at")
    ranked = rank_within(rows, key, *order, bucket=bucket, name="_rank", total="_total").withColumn(place, F.col("_rank") - 1)
    times = F.ceil(F.lit(radius) / (2 * n)) + 1
    images = F.flatten(F.transform(F.sequence(-times, times), lambda m: F.array(p + 2 * n * m, 2 * n * m - 1 - p)))
    images = F.filter(images, lambda x: (x >= -radius) & (x < n + radius))
    standing = ranked.withColumn("_at", F.explode(F.when((p >= radius) & (p < n - radius), F.array(p)).otherwise(images)))
    homes = F.array_distinct(F.array(F.floor((v - radius) / chunk), F.floor((v + radius) / chunk)))
    near = standing.withColumn("_c", F.explode(homes)).withColumn("_k", F.struct(key))
    about = F.collect_list(F.struct(F.col(value).cast("double").alias("x"))).over(
        Window.partitionBy("_k", "_c").orderBy("_at").rowsBetween(-radius, radius)
    )
    own = near.withColumn("_about", about).where((v == p) & (F.floor(v / chunk) == F.col("_c")))
    terms = F.zip_with(kernel, "_about", lambda w, x: w * x["x"])
    return own.withColumn(name, F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x)).drop("_rank", "_total", "_at", "_c", "_k", "_about")


def first_maximum(values: Column, start: Column, stop: Column) -> Column:
    """0-based place of the first largest element in [start, stop)."""
    part = F.slice(values, (start + 1).cast("int"), F.greatest(stop - start, F.lit(0)).cast("int"))
    return start + F.array_position(part, F.array_max(part)) - 1


def neighbours(value: str, w: WindowSpec) -> tuple[Column, Column]:
    """Values before and after."""
    return F.lag(value).over(w), F.lead(value).over(w)


def assembled(segments: Column) -> Column:
    """struct(text, valid) of ordered segments (text, join).

    ``space``, ``none`` and ``newline`` join as they say; ``word`` needs a division mark before
    it, drops it and the spaces after it.
    """

    def step(acc: Column, x: Column) -> Column:
        divided = acc["text"].endswith("-") | acc["text"].endswith("=")
        cut = F.substring(acc["text"], F.lit(1), F.length(acc["text"]) - 1)
        glue = F.when(x["join"] == "none", "").when(x["join"] == "newline", "\n").otherwise(" ")
        word = x["join"] == "word"
        return F.struct(
            F.when(acc["first"], x["text"])
            .when(word & divided, F.concat(cut, F.regexp_replace(x["text"], r"^\s+", "")))
            .when(word, acc["text"])
            .otherwise(F.concat(acc["text"], glue, x["text"]))
            .alias("text"),
            (acc["valid"] & (acc["first"] | ~word | divided)).alias("valid"),
            F.lit(False).alias("first"),
        )

    start = F.struct(F.lit("").alias("text"), F.lit(True).alias("valid"), F.lit(True).alias("first"))
    return F.aggregate(segments, start, step, lambda a: F.struct(F.when(a["valid"], a["text"]).alias("text"), a["valid"].alias("valid")))


def assembled_digests(rows: DataFrame, key: str, *order: str, text: str, join: str) -> DataFrame:
    """(key, digest): MD5 of each key's segments as ``assembled`` joins them; null if not valid or a text is null.

    A pass over sorted rows that holds one digest and the division marks at the end, so a key may be of any length.
    """

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        nothing = object()
        now, digest, tail, valid = nothing, None, "", True
        kind = None

        def row() -> pa.RecordBatch:
            said = digest.copy()
            said.update(tail.encode())
            return pa.RecordBatch.from_arrays([pa.array([now], kind), pa.array([said.hexdigest() if valid else None], pa.string())], [key, "digest"])

        for batch in batches:
            kind = batch.column(0).type
            for k, piece, how in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if now is nothing or k != now:
                    if now is not nothing:
                        yield row()
                    now, digest, tail, valid, added = k, hashlib.md5(), "", piece is not None, piece or ""
                elif piece is None or not valid:
                    valid = False
                    continue
                elif how == "word":
                    valid = tail != ""
                    tail, added = tail[:-1], piece.lstrip(" \t\n\x0b\f\r")
                else:
                    added = {"none": "", "newline": "\n"}.get(how, " ") + piece
                whole = tail + added
                done = whole.rstrip("-=")
                digest.update(done.encode())
                tail = whole[len(done) :]
        if now is not nothing:
            yield row()

    parts = rows.repartition(key).sortWithinPartitions(key, *order).select(key, text, join)
    return parts.mapInArrow(folded, S.StructType([rows.schema[key], S.StructField("digest", S.StringType())]))


def filled_forward(value: str, key: str, *order: str) -> Column:
    """The last value at or before each row."""
    return F.last(value, ignorenulls=True).over(Window.partitionBy(key).orderBy(*order))


def chunk(rank: Column, size: int) -> Column:
    """0-based chunk of a 1-based rank."""
    return F.floor((rank - 1) / size)


def systematic(rank: Column, n: Column, take: int) -> Column:
    """Whether a row is one of ``take`` evenly spaced of ``n``."""
    step = lambda r: F.floor(r * take / n)
    return (rank == 1) | (step(rank - 1) > step(rank - 2))


def seconds_between(a: Column, b: Column) -> Column:
    """Whole seconds from one time to another."""
    micros = lambda x: F.unix_micros(x.cast("timestamp"))
    return F.floor((micros(b) - micros(a)) / 1_000_000)


def until_gap(rows: DataFrame, key: str, ts: str, *order: str, gap: int = 1800, idle: int = 3600) -> DataFrame:
    """The 30-60 stopping rule (W13): rows up to and including the first after a gap, none after an idle time."""
    w = Window.partitionBy(key).orderBy(ts, *order)
    seconds = seconds_between(F.lag(ts).over(w), F.col(ts))
    before = w.rowsBetween(Window.unboundedPreceding, -1)
    now = w.rowsBetween(Window.unboundedPreceding, 0)
    marked = rows.withColumn("_gap", F.coalesce(seconds, F.lit(0)))
    stopped = F.coalesce(F.max((F.col("_gap") > gap).cast("int")).over(before), F.lit(0)) == 0
    alive = F.max((F.col("_gap") > idle).cast("int")).over(now) == 0
    return marked.withColumn("_keep", stopped & alive).where("_keep").drop("_gap", "_keep")


def sessions(rows: DataFrame, key: str, ts: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions separated by a gap."""
    return rows.groupBy(key, F.session_window(ts, gap).alias("w")).agg(F.count(F.lit(1)).alias("n")).select(
        key, F.col("w.start").alias("start"), "n"
    )


def is_repeat(key: list[str], *order: str) -> Column:
    """Whether an equal key came before."""
    return F.row_number().over(Window.partitionBy(*key).orderBy(*order)) > 1


def missing_between(rows: DataFrame, key: str, width: int = 1 << 16) -> DataFrame:
    """Integers between the least and largest key that no row has."""
    ends = rows.agg(F.min(key).alias("a"), F.max(key).alias("b")).where("a IS NOT NULL")
    step = F.explode(F.expr(f"sequence(a, b, {width}L)"))
    starts = ends.select(step.alias("s"), "b").repartition("s")
    each = starts.select(F.explode(F.expr(f"sequence(s, least(b, s + {width - 1}L))")).alias(key))
    return each.join(rows.select(key).distinct(), key, "left_anti")


def most_recent(rows: DataFrame, date: str, id_: str, n: int | None = None) -> DataFrame:
    """By date, latest first and missing ones last, then by id (O2); ``n`` rows at most."""
    ordered = rows.orderBy(F.coalesce(F.col(date).cast("string"), F.lit("")).desc(), F.col(id_).asc())
    return ordered if n is None else ordered.limit(n)
