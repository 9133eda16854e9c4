"""Merkle manifest of a dataset: level strings in aligned blocks, roots that recurse.

Each row is a leaf: the digest of its fields, each with its length, so that no two rows of
different fields look alike.  Leaves of one source, in the order of their ids, are the
bottom of a tree whose nodes have ``RUN`` children; the tops of the sources, in the order
of the sources' names, are the bottom of the tree that gives the root.

Trees are built in rounds.  A round cuts the nodes of a source into aligned blocks of
``RUN ** DEEP``, and a block keeps each of its levels as one string of hex digests: a
fixed-width substring of three digests is the input of a parent, and the parents in a row
are the next string.  The digest that a block ends with is one node of the next round, until
each source has one node left; then the sources are the nodes.  The siblings of a node are
the substrings on its two flanks.  On the way back down, a block gets the siblings of
its own node from the round above once for all its members, so no row's proof is shuffled.

Positions within a source come from one sort by ranges of (source, id): rows are counted
for each range, and a range starts at the sum of the ranges before it, so that a source may
hold any share of all rows.  Only digests, ids and sources are sorted, never texts.

Defined results: a null source is the first source and the empty string the next; null ids
come first in their source; rows of one id go by their leaf, and equal rows stand beside
each other, each with its own place and proof; a null field is ``-``; a source of one row
has that row's leaf as its subroot, a dataset of one source that subroot as its root; a
dataset of one row has an empty proof; a null id is never altered by the query; extra columns are
ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .scratch import keep, table

RUN, DEEP = 3, 5  # children of a node; levels that a block goes up
WIDTH = 64  # hex digits of a digest
BLOCK = RUN**DEEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def said(value: Column) -> Column:
    """A field as it enters its row's digest: its length in bytes and its value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_of(*fields: Column) -> Column:
    """The digest of a row of ``fields``."""
    return F.sha2(F.concat(*map(said, fields)), 256)


def leaves(docs: DataFrame, received: Column | None = None) -> DataFrame:
    """(key, id, leaf, seen): ``seen`` is the leaf of the row with ``received`` as its text, null where that is the same leaf."""
    own = leaf_of(*map(F.col, FIELDS))
    other = own if received is None else leaf_of(*map(F.col, FIELDS[:-1]), received)
    key = F.coalesce(F.concat(F.lit("="), F.col("source")), F.lit("-"))  # null first, then by bytes
    found = docs.select(key.alias("key"), F.col("doc_id").alias("id"), own.alias("leaf"), other.alias("seen"))
    return found.withColumn("seen", F.when(F.col("seen") != F.col("leaf"), F.col("seen")))


def numbered(rows: DataFrame, *order: str) -> DataFrame:
    """``rows`` with their position ``at`` (from 0) in the order within ``key``, and ``of``, the rows of the key."""
    dealt = rows.withColumn("tie", F.monotonically_increasing_id())  # equal rows need not lie in one range
    dealt = dealt.repartitionByRange("key", *order, "tie").sortWithinPartitions("key", *order, "tie").drop("tie")
    place = F.monotonically_increasing_id()
    placed = keep(dealt.withColumn("range", F.shiftright(place, 33)).withColumn("place", place.bitwiseAND((1 << 33) - 1)), "merkle-order")
    counts = placed.groupBy("key", "range").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("rows"))
    before, all_ = Window.partitionBy("key").orderBy("range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("key")
    starts = counts.select(
        "key", "range", (F.coalesce(F.sum("rows").over(before), F.lit(0)) - F.col("first")).alias("start"), F.sum("rows").over(all_).alias("of")
    )
    found = placed.join(starts, ["key", "range"]).withColumn("at", F.col("place") + F.col("start"))
    return found.drop("range", "place", "start")


def parents(level: Column) -> Column:
    """The level above one level string: the digests of its runs, in a row."""
    runs = F.sequence(F.lit(0), F.ceil(F.length(level) / (RUN * WIDTH)).cast("int") - 1)
    return F.array_join(F.transform(runs, lambda i: F.sha2(F.substring(level, i * (RUN * WIDTH) + 1, F.lit(RUN * WIDTH)), 256)), "").cast("binary")


def blocks_of(nodes: DataFrame) -> DataFrame:
    """(key, b, of, members, levels): aligned blocks of nodes (key, at, of, digest, member), all levels as strings of hex."""
    held = F.sort_array(F.collect_list(F.struct((F.col("at") % BLOCK).cast("int").alias("i"), "digest", "member")))
    cut = nodes.groupBy("key", F.floor(F.col("at") / BLOCK).alias("b")).agg(F.first("of").alias("of"), held.alias("members"))
    bottom = F.array_join(F.col("members.digest"), "").cast("binary")
    alone = F.col("of") <= BLOCK  # the only block of its key stops at one node
    last = lambda levels: F.element_at(levels, -1)
    up = lambda levels, _: F.when(~alone | (F.length(last(levels)) > WIDTH), F.concat(levels, F.array(parents(last(levels))))).otherwise(levels)
    return cut.withColumn("levels", F.aggregate(F.sequence(F.lit(1), F.lit(DEEP)), F.array(bottom), up))


def flanks(levels: Column, i: Column) -> Column:
    """The siblings of member ``i`` of a block, level by level: digests (in a row) before and after its own in their run."""
    steps = F.array(*(F.lit(RUN**j) for j in range(DEEP)))

    def at(level: Column, j: Column) -> Column:
        node = F.floor(i / F.element_at(steps, j + 1)).cast("int")
        k = F.pmod(node, F.lit(RUN))
        return F.struct(
            F.substring(level, (node - k) * WIDTH + 1, k * WIDTH).cast("string").alias("before"),
            F.substring(level, (node + 1) * WIDTH + 1, (RUN - 1 - k) * WIDTH).cast("string").alias("after"),
        )

    return F.transform(F.slice(levels, F.lit(1), F.size(levels) - 1), at)


def members_with_paths(blocks: DataFrame) -> DataFrame:
    """(key, at, digest, member, path, and the block's other columns): its own flanks, then those of its block's node (``up``)."""
    m = F.explode("members").alias("m")
    others = [c for c in blocks.columns if c not in ("key", "b", "of", "members", "levels", "up")]
    rows = blocks.select("key", "b", m, "levels", "up", *others)
    return rows.select(
        "key", (F.col("b") * BLOCK + F.col("m.i")).alias("at"), F.col("m.digest").alias("digest"), F.col("m.member").alias("member"),
        F.concat(flanks(F.col("levels"), F.col("m.i")), F.col("up")).alias("path"), *others,
    )


def climbed(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of each round over ``nodes``, and (key, top) of each key."""
    rounds: list[DataFrame] = []
    while True:
        blocks = keep(blocks_of(nodes), f"merkle-{name}-{len(rounds)}")
        rounds.append(blocks)
        nodes = blocks.select(
            "key", F.col("b").alias("at"), F.ceil(F.col("of") / BLOCK).alias("of"), F.element_at("levels", -1).cast("string").alias("digest"),
            F.lit(None).cast("string").alias("member"),
        )
        if (nodes.agg(F.max("of")).first()[0] or 1) == 1:
            return rounds, nodes.select("key", F.col("digest").alias("top"))


def descended(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Members of the lowest blocks with their whole paths, from ``tops`` (key, up, ...): the path of each key's top node and what else is known of it."""
    ups = tops.withColumn("at", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        known = blocks.join(ups.withColumnRenamed("at", "b"), ["key", "b"])
        found = members_with_paths(known)
        ups = found.drop("digest", "member").withColumnRenamed("path", "up")
    return found


def manifest(docs: DataFrame, received: Column | None = None) -> DataFrame:
    """(source, position, doc_id, leaf, seen, subroot, root, path) of each row of ``docs``.

    ``path`` holds, level by level up to the root, the siblings before and after the node.
    ``received`` is the text as it was read back, in columns of ``docs``: ``seen`` is its row's leaf.
    """
    none = F.array().cast("array<struct<before:string,after:string>>")
    rows = numbered(leaves(docs, received), "id", "leaf")
    bottom, subroots = climbed(rows.select("key", "at", "of", F.col("leaf").alias("digest"), F.struct("id", "seen").alias("member")), "leaves")

    sources = subroots.select(F.lit("").alias("key"), F.col("key").alias("source"), "top")
    ordered = numbered(sources, "source").select("key", "at", "of", F.col("top").alias("digest"), F.col("source").alias("member"))
    upper, root = climbed(ordered, "sources")
    tops = descended(upper, root.select("key", none.alias("up"), F.col("top").alias("root")))
    tops = keep(tops.select(F.col("member").alias("key"), F.col("path").alias("up"), F.col("digest").alias("subroot"), "root"), "merkle-tops")

    found = descended(bottom, tops)
    return found.select(
        F.when(F.col("key") != "-", F.substring("key", 2, 1 << 30)).alias("source"),
        F.col("at").alias("position"), F.col("member.id").alias("doc_id"), F.col("digest").alias("leaf"),
        F.coalesce("member.seen", "digest").alias("seen"), "subroot", "root", "path",
    )


def folded(leaf: Column, path: Column) -> Column:
    """The root that follows from a leaf and the siblings of its path."""
    return F.aggregate(path, leaf, lambda node, s: F.when(s.before.isNull(), node).otherwise(F.sha2(F.concat(s.before, node, s.after), 256)))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, roots and proof of every document, and whether a text without its line ends would still be proved."""
    docs = table(spark, sf_dir, "documents").select(*FIELDS)
    altered = F.crc32(F.col("doc_id").cast("string")) % 2 == 0
    found = manifest(docs, F.when(altered, F.replace("text", F.lit("\n"), F.lit(""))).otherwise(F.col("text")))
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s.before, s.after)), "")
    rows = found.select("doc_id", "source", "position", "leaf", "subroot", "root", F.sha2(siblings, 256).alias("proof_sha256"), folded(F.col("seen"), F.col("path")).alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))


OP11_SQL = r"""
WITH RECURSIVE said AS (
  SELECT doc_id, source,
    concat_ws('', coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-'), coalesce(strlen(source) || ':' || source, '-'),
              coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-')) AS head,
    text,
    CASE WHEN doc_id IS NOT NULL AND (xor(list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT))),
        lambda crc, c: list_reduce(list_prepend(xor(crc, c), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                                   lambda r, _b: CASE WHEN r % 2 = 1 THEN xor(r // 2, 3988292384) ELSE r // 2 END)
      ), 4294967295)) % 2 = 0 THEN replace(text, chr(10), '') ELSE text END AS seen_text
  FROM documents
), hashed AS (
  SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(seen_text) || ':' || seen_text, '-')) AS seen
  FROM said
), leaves AS MATERIALIZED (
  SELECT doc_id, source, leaf, seen,
         row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS position,
         count(*) OVER (PARTITION BY source) AS n
  FROM hashed
), lower_nodes AS (
  SELECT source, 0 AS level, position AS i, n, leaf AS h FROM leaves
  UNION ALL
  SELECT source, level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i))
  FROM lower_nodes WHERE n > 1 GROUP BY source, level, n, i // 3
), subroots AS (
  SELECT source, h, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS place, count(*) OVER () AS n FROM lower_nodes WHERE n = 1
), upper_nodes AS (
  SELECT 0 AS level, place AS i, n, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 3, (n + 2) // 3, sha256(string_agg(h, '' ORDER BY i)) FROM upper_nodes WHERE n > 1 GROUP BY level, n, i // 3
), lower_steps AS (
  SELECT l.source, l.position, c.level, coalesce(string_agg(c.h, '' ORDER BY c.i) FILTER (c.i < l.position // CAST(pow(3, c.level) AS BIGINT)), '') AS before,
         coalesce(string_agg(c.h, '' ORDER BY c.i) FILTER (c.i > l.position // CAST(pow(3, c.level) AS BIGINT)), '') AS after
  FROM leaves AS l JOIN lower_nodes AS c
    ON c.source IS NOT DISTINCT FROM l.source AND c.n > 1 AND c.i // 3 = l.position // CAST(pow(3, c.level + 1) AS BIGINT)
  GROUP BY l.source, l.position, c.level
), upper_steps AS (
  SELECT s.source, c.level, coalesce(string_agg(c.h, '' ORDER BY c.i) FILTER (c.i < s.place // CAST(pow(3, c.level) AS BIGINT)), '') AS before,
         coalesce(string_agg(c.h, '' ORDER BY c.i) FILTER (c.i > s.place // CAST(pow(3, c.level) AS BIGINT)), '') AS after
  FROM subroots AS s JOIN upper_nodes AS c ON c.n > 1 AND c.i // 3 = s.place // CAST(pow(3, c.level + 1) AS BIGINT)
  GROUP BY s.source, s.place, c.level
), lower_paths AS (
  SELECT source, position, list(before || '|' || after ORDER BY level) AS path FROM lower_steps GROUP BY ALL
), upper_paths AS (
  SELECT source, list(before || '|' || after ORDER BY level) AS path FROM upper_steps GROUP BY ALL
), known AS (
  SELECT l.doc_id, l.source, l.position, l.leaf, l.seen, s.h AS subroot, (SELECT h FROM upper_nodes WHERE n = 1) AS root,
         list_concat(coalesce(p.path, []), coalesce(u.path, [])) AS path
  FROM leaves AS l JOIN subroots AS s ON s.source IS NOT DISTINCT FROM l.source
  LEFT JOIN lower_paths AS p ON p.source IS NOT DISTINCT FROM l.source AND p.position = l.position
  LEFT JOIN upper_paths AS u ON u.source IS NOT DISTINCT FROM l.source
), proved AS (
  SELECT doc_id, source, position, leaf, subroot, root, sha256(replace(array_to_string(path, ''), '|', '')) AS proof_sha256,
         list_reduce(list_prepend(seen, path), lambda h, s: sha256(split_part(s, '|', 1) || h || split_part(s, '|', 2))) AS folded_root
  FROM known
)
SELECT *, folded_root = root AS verified FROM proved
"""
