"""Mixing sources to target weights, in DataFrame operations only.

The words of a source form a line: its documents in a fixed random order (by MD5 of seed,
id and text).  A source's target is a stretch of that line, at most twice its length, and is
cut into blocks of about ``block_words``.  A splitting tree deals the exact block quotas
of all sources to the output shards: each node splits its quotas between its halves by a
multivariate hypergeometric draw (drawn without replacement, block by block, with hashed
uniforms), so that every shard holds its share of blocks and every block is in one shard.
The blocks a shard gets are disjoint runs of a random permutation of the source's blocks,
and ``slot`` is the random order inside a shard.  What a document gives to the mix is what
its blocks' shards take: a copy without a shard is not drawn.

At scale: texts are counted where they lie.  The line of a source is laid out from bucket
totals (buckets are slices of the random order, so a source with a third of all rows fills
as many buckets as any other, with more rows in each), and the offsets join the documents
on (source, bucket), in the partitioning that the running sum needs anyway.  The tree's
nodes are rows, dealt out again every ``SPREAD`` levels, and hold only the sources that
still have blocks there; blocks are rows from the leaves on, permuted by ranks of their
hashes in slices of the hash range, and meet the buckets by (source, block).  In one row is
only the list of sources, and at the root the draw of its blocks.

Defined results: a null text has size 0; null sources form the last source; rows of equal
id and text are taken in either order, which gives the same counts; a document of size 0
is never taken; of the document that a target's end cuts, only the first words are taken;
extra columns pass through (one named like an output gets ``_in`` after its name); an empty
table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import column, keep, own_names, table

WEIGHTS = (3, 1, 2)
SHARE, MOST = 1.5, 2
SHARD_WORDS, BLOCKS_PER_SHARD, LEAST_SHARDS = 1 << 24, 16, 4
ROWS_PER_BUCKET, LEAST_BUCKETS, MOST_BUCKETS = 1 << 20, 1024, 1 << 16
SPREAD, SLICES = 4, 4096
WORD = r"[^\x20\x09-\x0D]+"


def uniform(*keys: Column) -> Column:
    """A double in [0, 1) from a hash of the keys."""
    return F.shiftrightunsigned(F.xxhash64(*keys), 11) / F.lit(float(1 << 53))


def sized(docs: DataFrame, seed: int, with_text: bool) -> DataFrame:
    """(row: the columns of ``docs``, size, s: the source key, perm: the place in the random order)."""
    named = F.concat(
        F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.md5(F.coalesce("text", F.lit("")))
    )
    return docs.select(
        F.struct(*(column(c) for c in docs.columns if with_text or c != "text")).alias("row"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.coalesce(F.concat(F.lit("0"), "source"), F.lit("1")).alias("s"),
        F.md5(named).alias("perm"),
    )


def with_bucket(rows: DataFrame, buckets: int) -> DataFrame:
    slice_of = F.conv(F.substring("perm", 1, 4), 16, 10).cast("int")
    return rows.withColumn("bucket", F.floor(slice_of / (65536 // buckets)).cast("int"))


def targets(sources: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """One row: an array of (s, z, w, target) by source, from rows of (s, z).

    The level is found by filling the sources up in the order in which they reach their
    limits; that is where resharing the excess ends.
    """
    w = F.array(*[F.lit(float(x)) for x in weights])
    listed = sources.agg(F.array_sort(F.collect_list(F.struct(F.col("s"), F.col("z")))).alias("a"))
    weighed = F.transform(
        "a",
        lambda x, i: F.struct(
            x["s"].alias("s"), x["z"].alias("z"), F.element_at(w, (i % len(weights) + 1).cast("int")).alias("w")
        ),
    )
    plan = listed.select(weighed.alias("a"))
    by_limit = F.array_sort(F.transform("a", lambda x: F.struct((x["z"] * most / x["w"]).alias("r"), x["z"].alias("z"), x["w"].alias("w"))))
    total = lambda f: F.aggregate("a", F.lit(0.0), lambda acc, x: acc + f(x))
    start = F.struct((total(lambda x: x["z"]) * share).alias("rest"), total(lambda x: x["w"]).alias("w"))

    def fill(acc: Column, x: Column) -> Column:
        full = x["z"] * most * acc["w"] <= x["w"] * acc["rest"]
        return F.struct(
            F.when(full, acc["rest"] - x["z"] * most).otherwise(acc["rest"]).alias("rest"),
            F.when(full, acc["w"] - x["w"]).otherwise(acc["w"]).alias("w"),
        )

    level = F.aggregate(by_limit, start, fill, lambda acc: F.when(acc["w"] > 0, acc["rest"] / acc["w"]))
    plan = plan.withColumn("level", level)
    target = lambda x: F.when(
        F.col("level").isNull() | (x["z"] * most <= x["w"] * F.col("level")), (x["z"] * most).cast("double")
    ).otherwise(x["w"] * F.col("level"))
    return plan.select(
        F.transform("a", lambda x: F.struct(x["s"].alias("s"), x["z"].alias("z"), target(x).alias("target"))).alias("a")
    )


def drawn_left(quotas: Column, left: Column, node: Column, seed: int) -> Column:
    """How many of the blocks of ``quotas`` (i, q) go left, in order: a multivariate hypergeometric draw of ``left`` blocks."""
    zero = F.lit(0).cast("long")
    total = F.aggregate(quotas, zero, lambda a, x: a + x["q"])
    none = F.array().cast("array<bigint>")

    def source(acc: Column, x: Column) -> Column:
        def block(b: Column, j: Column) -> Column:
            hit = uniform(F.lit(seed), node, x["i"], j) * b["n"] < b["k"]
            one = F.when(hit, 1).otherwise(0).cast("long")
            return F.struct((b["n"] - 1).alias("n"), (b["k"] - one).alias("k"), (b["h"] + one).alias("h"))

        begin = F.struct(acc["n"].alias("n"), acc["k"].alias("k"), zero.alias("h"))
        after = F.aggregate(F.sequence(F.lit(1).cast("long"), x["q"]), begin, block)
        return F.struct(after["n"].alias("n"), after["k"].alias("k"), F.concat(acc["out"], F.array(after["h"])).alias("out"))

    begin = F.struct(total.alias("n"), left.cast("long").alias("k"), none.alias("out"))
    return F.aggregate(quotas, begin, source, lambda acc: acc["out"])


def splitting_tree(root: DataFrame, levels: int, seed: int) -> DataFrame:
    """(shard, quotas) for the 2**levels leaves under the one row of ``root`` (quotas: array of (i, q), q > 0)."""
    nodes = root.select(F.lit(1).cast("long").alias("node"), "quotas")
    for level in range(levels):
        total = F.aggregate("quotas", F.lit(0).cast("long"), lambda a, x: a + x["q"])
        # an odd block goes to either half at random
        extra = F.when(uniform(F.lit(seed), F.lit(-1), F.col("node")) < 0.5, 1).otherwise(0)
        split = nodes.withColumn("left", drawn_left(F.col("quotas"), F.floor((total + extra) / 2), F.col("node"), seed))
        part = lambda f: F.filter(
            F.zip_with("quotas", "left", lambda x, n: F.struct(x["i"].alias("i"), f(x["q"], n).alias("q"))), lambda x: x["q"] > 0
        )
        both = F.array(
            F.struct((F.col("node") * 2).alias("node"), part(lambda q, n: n).alias("quotas")),
            F.struct((F.col("node") * 2 + 1).alias("node"), part(lambda q, n: q - n).alias("quotas")),
        )
        nodes = split.select(F.explode(both).alias("x")).select("x.*")
        if level % SPREAD == SPREAD - 1:
            nodes = nodes.repartition("node")
    return nodes.select((F.col("node") - (1 << levels)).cast("int").alias("shard"), "quotas")


def permuted_blocks(leaves: DataFrame, seed: int) -> DataFrame:
    """(i, block, shard): the blocks of each source in a random permutation, from the quotas of the shards."""
    slots = leaves.select("shard", F.explode("quotas").alias("x")).select("shard", "x.i", F.explode(F.sequence(F.lit(1).cast("long"), F.col("x.q"))).alias("k"))
    slots = slots.withColumn("h", F.xxhash64(F.lit(seed), F.lit(-2), "i", "shard", "k"))
    slots = slots.withColumn("slice", F.floor((F.shiftright("h", 32) + (1 << 31)) / ((1 << 32) // SLICES)).cast("int"))
    before = Window.partitionBy("i").orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    sizes = slots.groupBy("i", "slice").agg(F.count(F.lit(1)).alias("n")).withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0)))
    rank = F.row_number().over(Window.partitionBy("i", "slice").orderBy("h", "shard", "k"))
    placed = slots.withColumn("rank", rank).join(sizes.select("i", "slice", "first"), ["i", "slice"])
    return placed.select("i", (F.col("first") + F.col("rank") - 1).alias("block"), "shard")


def block_plan(sources: DataFrame, words: float, seed: int, shard_words: int, blocks_per_shard: int) -> tuple[DataFrame, DataFrame]:
    """Rows of (i, s, z, target, stop, w: words in a block) by source, and (i, block, shard) of all blocks."""
    levels = max(int(math.log2(LEAST_SHARDS)), math.ceil(math.log2(max(1.0, words / shard_words))))
    block = max(1, math.ceil(words / ((1 << levels) * blocks_per_shard)))
    listed = targets(sources).select(F.posexplode("a").alias("i", "x")).select(
        "i", "x.s", "x.z", "x.target", F.floor(F.col("x.target") + 0.5).alias("stop"), F.lit(block).cast("long").alias("w")
    )
    listed = keep(listed, "mix-plan")
    quota = F.struct("i", F.ceil(F.col("stop") / F.col("w")).cast("long").alias("q"))
    root = listed.where("stop > 0").agg(F.array_sort(F.collect_list(quota)).alias("quotas"))
    return listed, keep(permuted_blocks(splitting_tree(root, levels, seed), seed), "mix-blocks")


def drawn_rows(docs: DataFrame, seed: int, shard_words: int, blocks_per_shard: int, narrow: bool) -> DataFrame:
    """(row: the columns of ``docs``, size, z, target, drawn: an array of (copy, words, shard, slot)); ``narrow`` leaves the text out of ``row``.

    A narrow row is kept in a table first; else ``docs`` is read twice.
    """
    rows = sized(docs, seed, not narrow)
    if narrow:
        rows = keep(rows, "mix-sized")
    n, words = rows.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    buckets = min(MOST_BUCKETS, max(LEAST_BUCKETS, 1 << math.ceil(math.log2(max(1, n / ROWS_PER_BUCKET)))))
    rows = with_bucket(rows, buckets)
    totals = keep(rows.groupBy("s", "bucket").agg(F.sum("size").alias("total")), "mix-totals")
    plan, blocks = block_plan(totals.groupBy("s").agg(F.sum("total").alias("z")), float(words) * SHARE, seed, shard_words, blocks_per_shard)
    before = Window.partitionBy("s").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    spread = totals.withColumn("off", F.coalesce(F.sum("total").over(before), F.lit(0))).join(plan, "s")
    first = lambda p: F.floor((F.col("off") + p * F.col("z")) / F.col("w"))
    last = lambda p: F.least(F.floor((F.col("off") + F.col("total") + p * F.col("z")) / F.col("w")), F.ceil(F.col("stop") / F.col("w")) - 1)
    wanted = [F.when(first(p) <= last(p), F.struct(F.lit(p).alias("p"), first(p).alias("a"), last(p).alias("b"))) for p in range(MOST)]
    ranges = spread.select("i", "s", "bucket", F.explode(F.filter(F.array(*wanted), lambda x: x.isNotNull())).alias("x"))
    cells = ranges.select("i", "s", "bucket", "x.p", F.explode(F.sequence("x.a", "x.b")).alias("block")).join(blocks, ["i", "block"])
    one = lambda p: F.array_sort(F.collect_list(F.when(F.col("p") == p, F.struct("block", "shard"))))
    shards = cells.groupBy("s", "bucket").agg(*(one(p).alias(f"shards{p}") for p in range(MOST)))  # those of one bucket
    offsets = spread.join(shards, ["s", "bucket"], "left")

    so_far = Window.partitionBy("s", "bucket").orderBy("perm", "size").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("start", F.coalesce(F.sum("size").over(so_far), F.lit(0))).join(offsets, ["s", "bucket"])
    copies = []
    for p in range(MOST):
        at = F.col("off") + F.col("start") + p * F.col("z")
        take = F.greatest(F.lit(0).cast("long"), F.least(F.col("size"), F.col("stop") - at))
        index = (F.floor(at / F.col("w")) - first(p) + 1).cast("int")
        shard = F.when(take > 0, F.try_element_at(f"shards{p}", index)["shard"])
        slot = F.xxhash64(F.lit(seed), F.lit(-3), "perm", "start", F.lit(p))
        copies.append(F.struct(F.lit(p).alias("copy"), take.alias("words"), shard.alias("shard"), slot.alias("slot")))
    drawn = F.filter(F.array(*copies), lambda c: c["shard"].isNotNull())
    return placed.select("row", "size", "z", "target", drawn.alias("drawn"))


def mix(
    docs: DataFrame, seed: int = 0, shard_words: int = SHARD_WORDS, blocks_per_shard: int = BLOCKS_PER_SHARD, narrow: bool = False
) -> DataFrame:
    """``docs`` with _size, _z, _target and _drawn: an array of (copy, words, shard, slot); ``narrow`` leaves the text out."""
    outputs = {"_size": "size", "_z": "z", "_target": "target", "_drawn": "drawn"}
    out = drawn_rows(docs, seed, shard_words, blocks_per_shard, narrow)
    own = [F.col("row")[c].alias(n) for c, n in own_names(docs, *outputs).items() if not narrow or c != "text"]
    return out.select(*own, *(F.col(c).alias(n) for n, c in outputs.items()))


def mixed_rows(docs: DataFrame, seed: int = 0) -> DataFrame:
    """The mix itself: a row for each copy of a document that is taken, with its text (cut at the target's end)."""
    out = drawn_rows(docs, seed, SHARD_WORDS, BLOCKS_PER_SHARD, False).select("row", "size", F.explode("drawn").alias("d"))
    text, words = F.col("row.text"), F.col("d.words").cast("int")
    some = F.array_join(F.slice(F.regexp_extract_all(text, F.lit(WORD + r"[\x20\x09-\x0D]*"), F.lit(0)), F.lit(1), words), "")
    cut = F.when(F.col("d.words") < F.col("size"), some).otherwise(text)
    outputs = {"mix_copy": "copy", "mix_words": "words", "mix_shard": "shard", "mix_slot": "slot"}
    own = [(cut if c == "text" else F.col("row")[c]).alias(n) for c, n in own_names(docs, *outputs).items()]
    return out.select(*own, *(F.col("d")[c].alias(n) for n, c in outputs.items()))


def op1_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, source size, target and taken words of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    taken = F.aggregate("_drawn", F.lit(0).cast("long"), lambda a, c: a + c["words"])
    return mix(docs, narrow=True).select(
        "doc_id",
        F.col("_size").alias("size"),
        F.col("_z").alias("source_size"),
        F.col("_target").alias("target"),
        taken.alias("taken"),
    )


OP1_SQL = r"""
WITH sized AS (
  SELECT doc_id, coalesce('0' || source, '1') AS s,
         CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('0:' || coalesce(CAST(doc_id AS VARCHAR), '') || ':' || md5(coalesce(text, ''))) AS perm
  FROM documents
), sources AS (
  SELECT s, CAST(sum(size) AS BIGINT) AS z,
         CASE (row_number() OVER (ORDER BY s) - 1) % 3 WHEN 0 THEN 3.0 WHEN 1 THEN 1.0 ELSE 2.0 END::DOUBLE AS w
  FROM sized GROUP BY s
), filling AS (
  SELECT s, z, w,
         1.5 * sum(z) OVER () - coalesce(sum(2 * z) OVER o, 0)::DOUBLE AS rest,
         sum(w) OVER () - coalesce(sum(w) OVER o, 0) AS wrest
  FROM sources WINDOW o AS (ORDER BY 2 * z / w, z, w, s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), level AS (
  SELECT max(rest / wrest) AS level FROM filling WHERE 2 * z * wrest > w * rest
), goals AS (
  SELECT s, z, CASE WHEN level IS NULL OR 2 * z <= w * level THEN 2.0 * z ELSE w * level END::DOUBLE AS target
  FROM sources, level
), placed AS (
  SELECT doc_id, s, size,
         coalesce(sum(size) OVER (PARTITION BY s ORDER BY perm, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS st
  FROM sized
)
SELECT doc_id, size, z AS source_size, target,
       CAST(greatest(0, least(size, floor(target + 0.5) - st)) + greatest(0, least(size, floor(target + 0.5) - st - z)) AS BIGINT) AS taken
FROM placed JOIN goals USING (s)
"""
