"""The registered queries on the driver's tables, each with the SQL that checks it.

Every query is one operator of the library on whole tables; its name says which.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill import model
from leafmill.functions import content as C
from leafmill.functions import geometry as G
from leafmill.functions import text as T
from leafmill.operators import aggregates as A
from leafmill.operators import checks as V
from leafmill.operators import corrections as R
from leafmill.operators import joins as J
from leafmill.operators import ordered as W
from leafmill.plans import views
from leafmill.sources import pages as P

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The tables of a folder by name."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(sql: str | None = None):
    """Register a function of ``Tables``, with its SQL if SQL can express it."""

    def add(f: Callable[[Tables], DataFrame]) -> Callable:
        QUERIES[f.__name__] = lambda spark, sf_dir: f(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def lines_of(documents: DataFrame) -> DataFrame:
    """Numbered lines of the documents."""
    split = documents.select("doc_id", "lang", "source", F.posexplode(F.split("text", "\n", -1)).alias("pos", "line"))
    return split.select("doc_id", "lang", "source", (F.col("pos") + 1).alias("line_no"), "line")


LINES_SQL = "SELECT d.doc_id, d.lang, d.source, CAST(u.i AS INTEGER) AS line_no, string_split(d.text, chr(10))[u.i] AS line FROM documents d, unnest(range(1, len(string_split(d.text, chr(10))) + 1)) AS u(i)"


@query(f"SELECT doc_id, line_no, line FROM ({LINES_SQL})")
def line_flatten(t: Tables) -> DataFrame:
    return lines_of(t.documents).select("doc_id", "line_no", "line")


@query(f"""
SELECT lang, CAST(sum(n) AS BIGINT) AS occurrences, count(*) FILTER (n > 0) AS lines, count(DISTINCT doc_id) FILTER (n > 0) AS units
FROM (SELECT *, len(regexp_extract_all(line, 'tion')) AS n FROM ({LINES_SQL})) GROUP BY lang""")
def occurrence_by_group(t: Tables) -> DataFrame:
    return A.occurrences(lines_of(t.documents), "line", "tion", ["lang"], "doc_id")


@query(f"""
SELECT CAST(sum(n) AS BIGINT) AS occurrences, count(*) FILTER (n > 0) AS lines, count(DISTINCT doc_id) FILTER (n > 0) AS units
FROM (SELECT *, len(regexp_extract_all(line, '[ãõẽĩũñ]')) AS n FROM ({LINES_SQL}))""")
def occurrence_lines_pages(t: Tables) -> DataFrame:
    return A.occurrences(lines_of(t.documents), "line", "[ãõẽĩũñ]", [], "doc_id")


@query(f"""
SELECT quality, CAST(sum(n) AS BIGINT) AS occurrences, count(*) FILTER (n > 0) AS lines, count(DISTINCT doc_id) FILTER (n > 0) AS units
FROM (SELECT l.*, quality, len(regexp_extract_all(line, 'the')) AS n FROM ({LINES_SQL}) l JOIN labels USING (doc_id)) GROUP BY quality""")
def occurrence_in_subset(t: Tables) -> DataFrame:
    marked = lines_of(t.documents).join(t.labels.select("doc_id", "quality"), "doc_id")
    return A.occurrences(marked, "line", "the", ["quality"], "doc_id")


@query("SELECT carrier, count(*) AS n FROM (SELECT unnest(regexp_extract_all(text, '[áéíóúàèêçñäöüß]')) AS carrier FROM documents) GROUP BY carrier")
def carrier_counts(t: Tables) -> DataFrame:
    return A.carriers(t.documents, "text", "[áéíóúàèêçñäöüß]")


@query("SELECT category, count(*) AS n FROM (SELECT unnest(string_split(lang || ';' || source, ';')) AS category FROM documents) GROUP BY category")
def category_explode(t: Tables) -> DataFrame:
    return A.categories(t.documents.select(F.concat_ws(";", "lang", "source").alias("c")), "c", ";")


@query("SELECT role, count(*) AS n FROM conversations GROUP BY role")
def value_frequency(t: Tables) -> DataFrame:
    return t.conversations.groupBy("role").agg(F.count(F.lit(1)).alias("n"))


@query("SELECT lang, source, count(*) AS n, CAST(grouping(lang, source) AS INTEGER) AS totals FROM documents GROUP BY CUBE (lang, source)")
def crosstab_totals(t: Tables) -> DataFrame:
    return A.crosstab(t.documents, "lang", "source")


@query("SELECT quality, toxic, count(*) AS n FROM labels GROUP BY ALL")
def confusion_matrix(t: Tables) -> DataFrame:
    return A.confusion(t.labels, "quality", "toxic")


@query("""
SELECT avg(r) AS balanced_accuracy
FROM (SELECT avg(CASE WHEN quality = 1 - toxic THEN 1.0 ELSE 0.0 END::DOUBLE) AS r FROM labels GROUP BY quality)""")
def balanced_accuracy(t: Tables) -> DataFrame:
    return A.balanced_accuracy(t.labels.withColumn("predicted", 1 - F.col("toxic")), "quality", "predicted")


@query("""
WITH x AS (SELECT source, quality FROM documents JOIN labels USING (doc_id)),
f AS (SELECT DISTINCT source FROM x), c AS (SELECT quality, count(*) AS n FROM x GROUP BY quality),
o AS (SELECT source, quality, count(*) AS n FROM x GROUP BY ALL),
r AS (SELECT f.source, c.quality, c.n - coalesce(o.n, 0) AS rest FROM f CROSS JOIN c LEFT JOIN o ON o.source = f.source AND o.quality = c.quality)
SELECT source, quality AS predicted FROM r QUALIFY row_number() OVER (PARTITION BY source ORDER BY rest DESC, quality) = 1""")
def leave_one_out(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source").join(t.labels.select("doc_id", "quality"), "doc_id")
    return A.leave_one_out_mode(rows, "source", "quality")


@query("SELECT user_id, event_id, event_type, value FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1")
def latest_per_key(t: Tables) -> DataFrame:
    return A.latest_per_key(t.events, "user_id", "ts", "event_id").select("user_id", "event_id", "event_type", "value")


@query("SELECT conv_id, arg_min(text, turn) AS text FROM conversations WHERE role = 'assistant' GROUP BY conv_id")
def first_match(t: Tables) -> DataFrame:
    return A.first_per_key(t.conversations, "conv_id", "text", "turn", where=F.col("role") == "assistant")


@query("""
WITH c AS (SELECT user_id, event_type, count(*) AS n, min((ts, event_id)) AS f FROM events GROUP BY ALL)
SELECT user_id, event_type, n FROM c QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY n DESC, f) = 1""")
def mode_first_seen(t: Tables) -> DataFrame:
    return A.mode_first_seen(t.events, "user_id", "event_type", "ts", "event_id")


@query("SELECT doc_id, coalesce(quality, -1) AS quality, coalesce(toxic, -1) AS toxic FROM documents LEFT JOIN labels USING (doc_id)")
def left_default(t: Tables) -> DataFrame:
    return J.with_defaults(t.documents.select("doc_id"), t.labels, "doc_id", {"quality": -1, "toxic": -1})


@query("SELECT count(*) AS unresolved FROM (SELECT DISTINCT l_partkey FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10))")
def strict_anti(t: Tables) -> DataFrame:
    parts = t.part.where("p_size > 10").select(F.col("p_partkey").alias("l_partkey"))
    return J.strict(t.lineitem.select("l_partkey"), parts, "l_partkey")[1].agg(F.count(F.lit(1)).alias("unresolved"))


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def set_difference(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").subtract(t.labels.select("doc_id"))


@query("""
SELECT doc_id, 'missing' AS side FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)
UNION ALL SELECT DISTINCT doc_id, 'extra' FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents)""")
def set_symmetric(t: Tables) -> DataFrame:
    return J.reconciled(t.documents, t.labels, "doc_id")


@query("SELECT doc_id FROM (SELECT doc_id FROM documents INTERSECT SELECT doc_id FROM labels)")
def set_intersection(t: Tables) -> DataFrame:
    return t.documents.select("doc_id").intersect(t.labels.select("doc_id"))


@query("SELECT doc_id FROM labels UNION SELECT page_id FROM pages")
def set_union(t: Tables) -> DataFrame:
    return t.labels.select("doc_id").union(t.pages.select("page_id")).distinct()


@query("SELECT doc_id AS id, 'label' AS kind FROM labels UNION ALL SELECT page_id, 'page' FROM pages")
def bag_union(t: Tables) -> DataFrame:
    labels = t.labels.select(F.col("doc_id").alias("id"), F.lit("label").alias("kind"))
    return labels.unionByName(t.pages.select(F.col("page_id").alias("id"), F.lit("page").alias("kind")))


@query("""
WITH r AS (SELECT conv_id, min(turn) AS a, min(turn) + 2 AS b FROM conversations GROUP BY conv_id)
SELECT c.conv_id, c.turn, c.role FROM conversations c
JOIN r ON r.conv_id = c.conv_id JOIN conversations x ON x.conv_id = c.conv_id AND x.turn = r.a JOIN conversations y ON y.conv_id = c.conv_id AND y.turn = r.b
WHERE c.turn BETWEEN x.turn AND y.turn""")
def range_slice(t: Tables) -> DataFrame:
    rows = t.conversations.select("conv_id", "turn", "role", F.concat(F.lit("t"), "turn").alias("id"))
    first = F.min("turn")
    ranges = rows.groupBy("conv_id").agg(F.concat(F.lit("t"), first).alias("first_id"), F.concat(F.lit("t"), first + 2).alias("last_id"))
    return J.range_slice(rows, ranges, ["conv_id"], "id", "turn").select("conv_id", "turn", "role")


@query("SELECT a.doc_id, a.first_id FROM (SELECT doc_id, min(doc_id) OVER (PARTITION BY md5(text)) AS first_id FROM documents) a WHERE a.doc_id <> a.first_id")
def residual_join(t: Tables) -> DataFrame:
    known = t.documents.select("doc_id", F.md5("text").alias("h"), F.length("text").alias("n"))
    first = known.groupBy("h").agg(F.min("doc_id").alias("first_id"), F.min_by("n", "doc_id").alias("first_n"))
    return J.residual(known, first, "h", (F.col("doc_id") != F.col("first_id")) & (F.col("n") == F.col("first_n"))).select("doc_id", "first_id")


@query("SELECT n_nationkey, s.size FROM nation, (VALUES (480), (960), (1920)) AS s(size)")
def cross_sizes(t: Tables) -> DataFrame:
    return J.with_literals(t.nation.select("n_nationkey"), "size", [480, 960, 1920])


@query("""
SELECT n_name, count(*) AS items, CAST(sum(CAST(l_quantity AS BIGINT)) AS BIGINT) AS quantity
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY n_name""")
def multiway_strict(t: Tables) -> DataFrame:
    joined = (
        t.lineitem.join(t.orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .join(t.customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(t.nation, F.col("c_nationkey") == F.col("n_nationkey"))
    )
    return joined.groupBy("n_name").agg(F.count(F.lit(1)).alias("items"), F.sum(F.col("l_quantity").cast("long")).alias("quantity"))


@query("SELECT n_name, r.rule FROM nation JOIN (VALUES (0, 'a'), (2, 'b'), (3, 'c')) AS r(n_regionkey, rule) USING (n_regionkey)")
def static_rules(t: Tables) -> DataFrame:
    return J.with_rules(t.nation, [(0, "a"), (2, "b"), (3, "c")], ["n_regionkey", "rule"], "n_regionkey").select("n_name", "rule")


@query("SELECT doc_id, lang FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)")
def semi_join(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", "lang").join(t.labels, "doc_id", "left_semi")


@query("SELECT doc_id, 'new' AS state FROM labels UNION ALL SELECT doc_id, 'old' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def upsert(t: Tables) -> DataFrame:
    return J.upserted(t.documents.select("doc_id", F.lit("old").alias("state")), t.labels.select("doc_id", F.lit("new").alias("state")), "doc_id")


@query("SELECT doc_id FROM documents JOIN (SELECT doc_id, CASE WHEN quality = 1 THEN 'en' ELSE 'fr' END AS lang FROM labels) p USING (doc_id) WHERE p.lang <> documents.lang")
def version_stale(t: Tables) -> DataFrame:
    pinned = t.labels.select("doc_id", F.when(F.col("quality") == 1, "en").otherwise("fr").alias("lang"))
    return J.stale(pinned, t.documents, "doc_id", "lang").select("doc_id")


@query("""
SELECT o_custkey, count(DISTINCT o_orderkey) AS issues_applied, count(l_partkey) AS accepted_edits, count(DISTINCT l_partkey) AS distinct_lines,
       CAST(arg_max(o_orderdate, o_orderkey) AS DATE) AS last_applied
FROM orders JOIN lineitem ON l_orderkey = o_orderkey GROUP BY o_custkey""")
def history_stats(t: Tables) -> DataFrame:
    log = t.orders.join(t.lineitem, F.col("o_orderkey") == F.col("l_orderkey")).withColumn("day", F.col("o_orderdate").cast("date"))
    return A.correction_stats(log, "o_custkey", "o_orderkey", "l_partkey", "day", "o_orderkey")


@query("""
SELECT count(*) AS pages, count(*) FILTER (quality IS NOT NULL) AS processed, count(*) FILTER (quality IS NULL) AS unprocessed, count(*) FILTER (toxic = 1) AS corrected
FROM documents LEFT JOIN labels USING (doc_id)""")
def status_summary(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    return views.summary(rows.select(F.col("quality").isNotNull().alias("processed"), F.col("toxic").alias("issues_applied")))


@query("""
SELECT source, CASE WHEN n > 0 THEN 'needs_correction' WHEN c = s THEN 'checked' WHEN c > 0 THEN 'partial' ELSE 'pending' END AS state
FROM (SELECT source, count(*) AS s, count(quality) AS c, count(*) FILTER (quality = 0 AND toxic = 1) AS n FROM documents LEFT JOIN labels USING (doc_id) GROUP BY source)""")
def review_summary(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", "source").join(t.labels, "doc_id", "left").groupBy("source")
    n = rows.agg(F.count(F.lit(1)).alias("s"), F.count("quality").alias("c"), F.count_if((F.col("quality") == 0) & (F.col("toxic") == 1)).alias("n"))
    return n.select("source", A.review_state(F.col("c"), F.col("s"), F.col("n")).alias("state"))


@query("""
SELECT count(*) AS records, count(DISTINCT c_custkey) AS unique_ids, count(*) FILTER (c_mktsegment <> '') AS links, count(*) FILTER (CAST(substr(lpad(CAST(c_custkey AS VARCHAR), 6, '0'), 4, 3) AS INTEGER) >= 332) AS supplement
FROM customer""")
def file_summary(t: Tables) -> DataFrame:
    number = T.leading_number(F.substring(F.lpad(F.col("c_custkey").cast("string"), 6, "0"), 4, 3))
    return A.file_summary(t.customer, "c_custkey", F.col("c_mktsegment"), number, 332)


@query("""
SELECT o_custkey, CAST(to_json(list({'k': o_orderkey, 's': o_orderstatus} ORDER BY o_orderkey)) AS VARCHAR) AS records FROM orders GROUP BY o_custkey""")
def nested_report(t: Tables) -> DataFrame:
    rows = t.orders.select("o_custkey", F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("s"))
    return A.nested_report(rows, "o_custkey", "k", "s").select("o_custkey", F.to_json("records").alias("records"))


@query("""
SELECT user_id, coalesce(median(g), 62.0)::DOUBLE AS median_gap
FROM (SELECT user_id, floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000) AS g FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)) GROUP BY user_id""")
def median_gap(t: Tables) -> DataFrame:
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    gaps = t.events.withColumn("g", W.seconds_between(F.lag("ts").over(w), F.col("ts")))
    return gaps.groupBy("user_id").agg(F.coalesce(F.median("g"), F.lit(62.0)).alias("median_gap"))


@query("""
SELECT l_orderkey, coalesce(median(g), 62.0)::DOUBLE AS median_gap
FROM (SELECT l_orderkey, l_quantity - lag(l_quantity) OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey) AS g FROM lineitem) GROUP BY l_orderkey""")
def median_difference(t: Tables) -> DataFrame:
    return A.median_gap(t.lineitem, "l_orderkey", "l_quantity", "l_linenumber", "l_partkey", "l_suppkey")


@query("SELECT md5(text) AS digest, count(*) AS n, min(doc_id) AS first_id FROM documents GROUP BY text HAVING count(*) > 1")
def duplicate_text(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.md5("text").alias("digest"))
    return rows.groupBy("digest").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id")).where("n > 1")


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
       CASE WHEN count(*) OVER (PARTITION BY l_orderkey) = 1 THEN 50.0
            ELSE 5.8 + (row_number() OVER w - 1)::DOUBLE / (count(*) OVER (PARTITION BY l_orderkey) - 1) * (95.8 - 5.8)::DOUBLE END::DOUBLE AS place
FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey)""")
def position_interp(t: Tables) -> DataFrame:
    w = Window.partitionBy("l_orderkey")
    pos = F.row_number().over(w.orderBy("l_linenumber", "l_partkey", "l_suppkey"))
    place = W.interpolated(pos, F.count(F.lit(1)).over(w)).alias("place")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", place)


@query("""
SELECT event_id, (coalesce(lag(value) OVER w, value - 62.0) + value) / 2 - 18.0 AS low, (value + coalesce(lead(value) OVER w, value + 62.0)) / 2 + 18.0 AS high
FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""")
def neighbour_mid(t: Tables) -> DataFrame:
    low, high = W.midpoints("value", Window.partitionBy("user_id").orderBy("ts", "event_id"), 62.0, 18.0)
    return t.events.select("event_id", low.alias("low"), high.alias("high"))


def hour() -> Column:
    return F.floor(F.unix_seconds(F.col("ts").cast("timestamp")) / 3600)


@query("""
WITH RECURSIVE s AS (
  SELECT user_id, value, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events
), g AS (
  SELECT user_id, i, value AS last, 1 AS n FROM s WHERE i = 1
  UNION ALL
  SELECT g.user_id, s.i, CASE WHEN s.value > g.last + 28 THEN s.value ELSE s.value / 2 END, g.n + CASE WHEN s.value > g.last + 28 THEN 1 ELSE 0 END
  FROM g JOIN s ON s.user_id = g.user_id AND s.i = g.i + 1
)
SELECT user_id, last, CAST(n AS BIGINT) AS n_snapped FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY i DESC) = 1""")
def monotone_guard(t: Tables) -> DataFrame:
    done = W.guarded_rows(t.events, "user_id", "ts", "event_id", bucket=hour(), snapped=F.col("value"), expected=F.col("value") / 2)
    return done.groupBy("user_id").agg(
        F.max_by("guarded", F.struct("ts", "event_id")).alias("last"), F.count_if("guarded_snapped").alias("n_snapped")
    )


@query("""
WITH n AS (
  SELECT user_id, event_type, row_number() OVER w AS pos, row_number() OVER w - row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts, event_id) AS g
  FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)
)
SELECT user_id, event_type, CAST(min(pos) AS INTEGER) AS first_pos, CAST(max(pos) AS INTEGER) AS last_pos, count(*) AS size FROM n GROUP BY user_id, event_type, g""")
def run_coalesce(t: Tables) -> DataFrame:
    return W.islands(t.events, "user_id", "event_type", "ts", "event_id")


@query("SELECT conv_id, turn FROM conversations QUALIFY turn <> row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) - 1")
def sequence_check(t: Tables) -> DataFrame:
    pos = F.row_number().over(Window.partitionBy("conv_id").orderBy("turn", "role", "text")) - 1
    return W.out_of_sequence(t.conversations.withColumn("pos", pos), F.col("turn"), F.col("pos")).select("conv_id", "turn")


KERNEL = W.reflected_weights()


@query(f"""
WITH x AS (SELECT user_id, list(value ORDER BY ts, event_id) AS v, count(*) AS n FROM events GROUP BY user_id),
k AS (SELECT [{", ".join(f"CAST({w!r} AS DOUBLE)" for w in KERNEL)}] AS w),
p AS (SELECT user_id, v, n, w, unnest(range(n)) AS i FROM x, k),
s AS (
  SELECT user_id, i, list_sum(list_transform(range(33), lambda j: w[j + 1] * v[CAST(
    CASE WHEN ((i + j - 16) % (2 * n) + 2 * n) % (2 * n) < n THEN ((i + j - 16) % (2 * n) + 2 * n) % (2 * n)
         ELSE 2 * n - 1 - ((i + j - 16) % (2 * n) + 2 * n) % (2 * n) END AS BIGINT) + 1])) AS y FROM p)
SELECT user_id, CAST(i AS INTEGER) AS place FROM s QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY round(y, 9) DESC, i) = 1""")
def smooth_argmax(t: Tables) -> DataFrame:
    smooth = W.smoothed_rows(t.events, "user_id", "ts", "event_id", bucket=hour(), value="value", weights=KERNEL)
    return smooth.groupBy("user_id").agg(F.max_by("place", F.struct(F.round("smooth", 9), -F.col("place"))).cast("int").alias("place"))


@query("""
SELECT conv_id, turn, lag(role) OVER w AS before, lead(role) OVER w AS after, CAST(row_number() OVER w AS INTEGER) AS k, count(*) OVER (PARTITION BY conv_id) AS n
FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn, role, text)""")
def prev_next(t: Tables) -> DataFrame:
    w = Window.partitionBy("conv_id").orderBy("turn", "role", "text")
    before, after = W.neighbours("role", w)
    n = F.count(F.lit(1)).over(Window.partitionBy("conv_id"))
    return t.conversations.select("conv_id", "turn", before.alias("before"), after.alias("after"), F.row_number().over(w).alias("k"), n.alias("n"))


@query("SELECT conv_id, md5(string_agg(ltrim(text), ' ' ORDER BY turn, role, text)) AS digest FROM conversations GROUP BY conv_id")
def ordered_fold(t: Tables) -> DataFrame:
    parts = t.conversations.select("conv_id", "turn", "role", F.ltrim("text").alias("text"), F.lit("space").alias("join"))
    return W.assembled_digests(parts, "conv_id", "turn", "role", "text", text="text", join="join")


@query("""
WITH l AS (SELECT conv_id, turn, role, text, lag(text) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS b FROM conversations)
SELECT conv_id, count(*) FILTER (b IS NOT NULL AND NOT regexp_matches(b, '[-=]$')) AS n FROM l GROUP BY conv_id""")
def word_joins(t: Tables) -> DataFrame:
    rows = t.conversations.select(F.col("conv_id").alias("id"), F.struct("turn", "role", "text").alias("pos"), "text", F.lit("word").alias("join"))
    found = V.joined_word_violations(rows).groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    every = t.conversations.select("conv_id").distinct()
    joined = every.join(found, every["conv_id"].cast("string") == found["key"], "left")
    return joined.select("conv_id", F.coalesce("n", F.lit(0)).alias("n"))


@query("SELECT chunk, count(*) AS n, min(doc_id) AS first_id FROM (SELECT doc_id, CAST(floor((row_number() OVER (ORDER BY doc_id) - 1) / 8) AS BIGINT) AS chunk FROM documents) GROUP BY chunk")
def chunk_groups(t: Tables) -> DataFrame:
    ranked = W.global_rank(t.documents.select("doc_id"), "doc_id").withColumn("chunk", W.chunk(F.col("rank"), 8))
    return ranked.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("first_id"))


@query("""
WITH r AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rank, count(*) OVER () AS n FROM documents)
SELECT doc_id FROM r WHERE rank = 1 OR floor((rank - 1) * 48 / n) > floor((rank - 2) * 48 / n)""")
def systematic_sample(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id")
    n = docs.agg(F.count(F.lit(1))).scalar()
    return W.global_rank(docs, "doc_id").withColumn("n", n).where(W.systematic(F.col("rank"), F.col("n"), 48)).select("doc_id")


@query("""
WITH m AS (SELECT user_id, ts, CASE WHEN epoch_us(ts) - epoch_us(lag(ts) OVER w) < 1800000000 THEN 0 ELSE 1 END AS new FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
s AS (SELECT user_id, ts, sum(new) OVER (PARTITION BY user_id ORDER BY ts) AS k FROM m)
SELECT user_id, min(ts) AS start, count(*) AS n FROM s GROUP BY user_id, k""")
def session_rule(t: Tables) -> DataFrame:
    return W.sessions(t.events, "user_id", "ts")


@query("""
WITH g AS (SELECT event_id, user_id, ts, coalesce(floor((epoch_us(ts) - epoch_us(lag(ts) OVER w)) / 1000000), 0) AS gap FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
m AS (SELECT *, coalesce(max(CASE WHEN gap > 1800 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS stopped,
      max(CASE WHEN gap > 3600 THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS idle FROM g)
SELECT event_id, user_id FROM m WHERE stopped = 0 AND idle = 0""")
def stopping_rule(t: Tables) -> DataFrame:
    return W.until_gap(t.events, "user_id", "ts", "event_id").select("event_id", "user_id")


@query("SELECT doc_id, row_number() OVER (PARTITION BY md5(text) ORDER BY doc_id) > 1 AS repeat FROM documents")
def first_seen(t: Tables) -> DataFrame:
    rows = t.documents.select("doc_id", F.md5("text").alias("h"))
    return rows.select("doc_id", W.is_repeat(["h"], "doc_id").alias("repeat"))


TILES_SQL = """
WITH p AS (SELECT page_id, length(html) AS h FROM pages), t AS (SELECT page_id, h, unnest(range(4)) AS i FROM p)
SELECT page_id, CAST(i AS INTEGER) AS i, CAST(floor(h * i / 4) - CASE WHEN i = 0 THEN 0 ELSE {up} END AS INTEGER) AS t,
       CAST(floor(h * (i + 1) / 4) + CASE WHEN i = 3 THEN 0 ELSE {down} END AS INTEGER) AS b FROM t"""


def tiled(t: Tables, overlap: int) -> DataFrame:
    box = F.struct(F.lit(0).alias("l"), F.lit(0).alias("t"), F.lit(100).alias("r"), F.length("html").alias("b"))
    cut = t.pages.select("page_id", F.posexplode(G.tiles(box, F.lit(4), F.lit(overlap))).alias("i", "box"))
    return cut.select("page_id", "i", "box.t", "box.b")


@query(TILES_SQL.format(up=0, down=0))
def tile_slices(t: Tables) -> DataFrame:
    return tiled(t, 0)


@query(TILES_SQL.format(up=12, down=13))
def tile_overlap(t: Tables) -> DataFrame:
    return tiled(t, 25)


@query("SELECT unnest(range((SELECT min(doc_id) FROM labels), (SELECT max(doc_id) FROM labels) + 1)) AS doc_id EXCEPT SELECT doc_id FROM labels")
def range_gaps(t: Tables) -> DataFrame:
    return W.missing_between(t.labels, "doc_id")


@query("""
SELECT o_orderkey, CAST(rank AS INTEGER) AS rank FROM (
  SELECT o_orderkey, row_number() OVER (ORDER BY coalesce(d, '') DESC, o_orderkey) AS rank
  FROM (SELECT o_orderkey, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(CAST(o_orderdate AS DATE) AS VARCHAR) END AS d FROM orders)) WHERE rank <= 10""")
def recent_sort_topk(t: Tables) -> DataFrame:
    dated = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.col("o_orderdate").cast("date")).alias("d"))
    top = W.most_recent(dated, "d", "o_orderkey", 10)
    rank = F.row_number().over(Window.orderBy(F.coalesce(F.col("d").cast("string"), F.lit("")).desc(), "o_orderkey"))  # of ten rows
    return top.select("o_orderkey", rank.alias("rank"))


@query("""SELECT doc_id, 'sha256:' || sha256('{"id":' || to_json(CAST(doc_id AS VARCHAR)) || ',"lang":' || to_json(lang) || ',"n":' || n_chars || '}') AS version FROM documents""")
def content_hash(t: Tables) -> DataFrame:
    value = F.struct(F.col("doc_id").cast("string").alias("id"), "lang", F.col("n_chars").alias("n"))
    return t.documents.select("doc_id", C.content_hash(value).alias("version"))


@query("""
SELECT conv_id, turn, 'sha256:' || sha256('{"id":' || to_json(CAST(turn AS VARCHAR)) || ',"text":' || to_json(text) || ',"runs":[{"typeface":"roman","text":' || to_json(text) || '}]}') AS version
FROM conversations""")
def line_version(t: Tables) -> DataFrame:
    none = F.lit(None).cast("string")
    run = F.struct(F.lit("roman").alias("typeface"), "text", none.alias("layout"), F.lit(None).cast("int").alias("line_span"))
    return t.conversations.select("conv_id", "turn", C.line_version(F.col("turn").cast("string"), F.array(run)).alias("version"))


@query("SELECT page_id, md5(replace(replace(replace(replace(replace(html, '&', '&amp;'), '<', '&lt;'), '>', '&gt;'), '\"', '&quot;'), '''', '&#x27;')) AS digest FROM pages")
def html_escape(t: Tables) -> DataFrame:
    return t.pages.select("page_id", F.md5(T.html_escape(F.col("html"))).alias("digest"))


@query("SELECT doc_id, nfc_normalize(text) = text AS nfc FROM documents")
def nfc_check(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", T.is_nfc("text").alias("nfc"))


@query("SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events")
def json_field(t: Tables) -> DataFrame:
    return t.events.select("event_id", F.from_json("props", "k int")["k"].alias("k"))


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round_even(l_quantity / 4, 0) AS even, CAST(floor((l_linenumber - 3) / 2) AS BIGINT) AS half FROM lineitem")
def bankers_round(t: Tables) -> DataFrame:
    half = G.floor_div(F.col("l_linenumber") - 3, F.lit(2))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", G.half_even(F.col("l_quantity") / 4).alias("even"), half.alias("half"))


def rect(x, y, w, h):
    return F.struct(F.col(x).cast("int").alias("x"), F.col(y).cast("int").alias("y"), w.cast("int").alias("w"), h.cast("int").alias("h"))


@query("""
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  10 <= CAST(l_quantity AS INTEGER) AND 2 <= l_linenumber AND CAST(l_quantity AS INTEGER) + 10 <= 50 AND l_linenumber + 2 <= 8 AS held,
  CAST(l_quantity AS INTEGER) + 10 <= 45 AND l_linenumber + 2 <= 7 AS in_page
FROM lineitem""")
def rect_contains(t: Tables) -> DataFrame:
    inner = rect("l_quantity", "l_linenumber", F.lit(10), F.lit(2))
    outer = F.struct(F.lit(10).alias("x"), F.lit(2).alias("y"), F.lit(40).alias("w"), F.lit(6).alias("h"))
    return t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
        G.contains(outer, inner).alias("held"), G.in_page(inner, F.lit(45), F.lit(7)).alias("in_page"),
    )


@query("""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity AS q, CAST(l_linenumber * 100 AS DOUBLE) AS y FROM lineitem),
e AS (SELECT *, least(100 + q * (y / 1000), 100 + q * ((y + 60) / 1000)) AS a, greatest(900 + q * (y / 1000), 900 + q * ((y + 60) / 1000)) AS b FROM v)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(floor(a) - 12 AS BIGINT) AS x, CAST(ceil(b) + 12 - (floor(a) - 12) AS BIGINT) AS w FROM e""")
def interp_envelope(t: Tables) -> DataFrame:
    q, y = F.col("l_quantity"), (F.col("l_linenumber") * 100).cast("double")
    sides = ((F.lit(100.0), 100 + q), (F.lit(900.0), 900 + q))
    found = G.envelope(*sides, y, F.lit(60), F.lit(0), F.lit(1000))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", found.alias("e")).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "e.x", "e.w"
    )


@query("""
SELECT o_orderkey, CASE WHEN w <= 1000 THEN w ELSE 1000 END AS width, CAST(CASE WHEN w <= 1000 THEN h ELSE round_even(h * 1000 / w, 0) END AS INTEGER) AS height
FROM (SELECT o_orderkey, CAST(floor(o_totalprice / 100) AS INTEGER) + 1 AS w, CAST(o_custkey AS INTEGER) AS h FROM orders)""")
def variant_size(t: Tables) -> DataFrame:
    w = F.floor(F.col("o_totalprice") / 100).cast("int") + 1
    found = t.orders.select("o_orderkey", G.variant_size(w, F.col("o_custkey").cast("int"), F.lit(1000)).alias("v"))
    return found.select("o_orderkey", "v.width", "v.height")


@query("""
SELECT p_partkey, greatest(0, a - 40) AS l1, CAST(floor((b + c) / 2) AS INTEGER) + 30 AS r1, CAST(floor((b + c) / 2) AS INTEGER) - 30 AS l2, w - CASE WHEN w < 2700 THEN 250 ELSE 70 END AS r2
FROM (SELECT p_partkey, p_size AS a, 1400 + p_size AS b, 1431 AS c, 2600 + 5 * p_size AS w FROM part)""")
def column_bounds(t: Tables) -> DataFrame:
    s = F.col("p_size")
    box = lambda l, r: F.struct(l.alias("l"), F.lit(0).alias("t"), r.alias("r"), F.lit(1).alias("b"))  # noqa: E731, E741
    found = G.column_bounds(2600 + 5 * s, box(s, 1400 + s), box(F.lit(1431), 1431 + s))
    return t.part.select("p_partkey", found.alias("v")).select(
        "p_partkey", F.col("v.first.l").alias("l1"), F.col("v.first.r").alias("r1"), F.col("v.second.l").alias("l2"), F.col("v.second.r").alias("r2")
    )


RULES = ["doc_text", "doc_unique", "label_domain", "label_known", "order_customer", "order_price"]


@query("""
SELECT 'doc_text' AS rule, count(*) FILTER (text IS NULL OR text = '') AS n FROM documents
UNION ALL SELECT 'doc_unique', count(*) FROM (SELECT md5(text) FROM documents GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'label_domain', count(*) FILTER (quality NOT IN (0, 1)) FROM labels
UNION ALL SELECT 'label_known', count(*) FROM (SELECT DISTINCT doc_id FROM labels WHERE doc_id NOT IN (SELECT doc_id FROM documents))
UNION ALL SELECT 'order_customer', count(*) FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer))
UNION ALL SELECT 'order_price', count(*) FILTER (NOT o_totalprice > 1000) FROM orders""")
def violations(t: Tables) -> DataFrame:
    docs = t.documents.select("doc_id", "text", F.md5("text").alias("digest"))
    found = V.all_of(
        V.violations(docs, "doc_text", F.coalesce("text", F.lit("")) == "", F.col("doc_id")),
        V.duplicates(docs, "doc_unique", "digest"),
        V.outside(t.labels, "label_domain", "quality", [0, 1], "doc_id"),
        V.unresolved(t.labels, t.documents, "label_known", "doc_id"),
        V.unresolved(t.orders.withColumnRenamed("o_custkey", "k"), t.customer.withColumnRenamed("c_custkey", "k"), "order_customer", "k"),
        V.violations(t.orders, "order_price", ~(F.col("o_totalprice") > 1000), F.col("o_orderkey")),
    )
    return V.counts(found, RULES)


@query(r"""
SELECT doc_id, regexp_replace(lower(substr(text, 1, 40)), '\s+', ' ', 'g') AS head, length(text) AS n FROM documents""")
def text_preview(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.regexp_replace(F.lower(T.preview(F.col("text"), 40)), r"\s+", " ").alias("head"), F.length("text").cast("long").alias("n"))


@query("""
SELECT p.page_id, format('bnf-f{:04d}', p.page_id + 1) AS id, 'f' || (p.page_id + 1) AS view, l.doc_id IS NOT NULL AS processed
FROM pages p LEFT JOIN labels l ON l.doc_id = p.page_id""")
def snapshot(t: Tables) -> DataFrame:
    leaves = t.pages.select("page_id", (F.col("page_id") + 1).cast("int").alias("leaf"))
    known = t.labels.select(C.page_id((F.col("doc_id") + 1).cast("int")).alias("id"))
    return views.snapshot(leaves, known, {}).select("page_id", "id", "view", "processed")


@query("SELECT id, side, count(*) AS n FROM (SELECT doc_id AS id, 'generated' AS side FROM (SELECT doc_id FROM documents EXCEPT ALL SELECT doc_id FROM labels) UNION ALL SELECT doc_id, 'existing' FROM (SELECT doc_id FROM labels EXCEPT ALL SELECT doc_id FROM documents)) GROUP BY ALL")
def check_mode(t: Tables) -> DataFrame:
    found = views.differs(t.documents.select(F.col("doc_id").alias("id")), t.labels.select(F.col("doc_id").alias("id")))
    return found.groupBy("id", "side").agg(F.count(F.lit(1)).alias("n"))


@query("""
SELECT conv_id, turn, CASE WHEN gone THEN 'orphan' WHEN before = now THEN 'keep' WHEN after = now THEN 'drop' ELSE 'rebase' END AS action
FROM (SELECT conv_id, turn, turn % 5 = 4 AS gone, nfc_normalize(text) AS now, CASE WHEN turn % 5 <= 1 THEN text ELSE '~' || text END AS before,
             nfc_normalize(CASE WHEN turn % 5 = 2 THEN text ELSE text || '!' END) AS after FROM conversations)""")
def edit_reconcile(t: Tables) -> DataFrame:
    """Edits of every turn: kept, already satisfied, rebased, or of a line that is gone."""
    said = t.conversations
    ref, k = F.concat_ws(":", "conv_id", "turn").alias("line_ref"), F.col("turn") % 5
    old = F.when(k <= 1, F.col("text")).otherwise(F.concat(F.lit("~"), "text"))
    new = F.when(k == 2, F.col("text")).otherwise(F.concat(F.col("text"), F.lit("!")))
    edits = said.select("conv_id", "turn", ref, old.alias("before"), T.nfc(new).alias("after"), F.lit(None).cast("string").alias("comment"), F.lit(None).cast("string").alias("base_line_version"))
    none = F.lit(None).cast("string")
    run = F.struct(
        F.lit("roman").alias("typeface"), T.nfc("text").alias("text"), none.alias("placement"), none.alias("layout"),
        F.lit(None).cast("int").alias("line_span"), none.alias("span_id"),
    )
    lines = said.where(k != 4).select(ref, F.array(run).alias("runs"), F.lit("now").alias("version"))
    out = R.reconciled_edits(edits, lines)
    at = F.split("line_ref", ":")
    return out.select(at[0].cast("long").alias("conv_id"), at[1].cast("long").alias("turn"), "action")


@query(r"""
SELECT conv_id, turn, CASE WHEN text IS NULL THEN NULL ELSE len(w) END AS runs, md5(new) AS digest,
       md5(array_to_string(list_transform(range(1, len(w) + 1), lambda i: (CASE i % 2 WHEN 1 THEN 'r' ELSE 'i' END)
         || CAST(length(w[i]) + 1 + CASE WHEN i = 1 AND new <> old THEN 1 ELSE 0 END AS VARCHAR)), '')) AS faces
FROM (SELECT *, regexp_replace(old, '^(\S+) ', '\1, ') AS new FROM
      (SELECT conv_id, turn, text, string_split(text, ' ') AS w, text || ' ' AS old FROM conversations))""")
def style_rewrite(t: Tables) -> DataFrame:
    """Every turn rewritten with a comma after its first word, its styles kept (F16)."""
    words = F.split("text", " ")
    runs = F.transform(
        words,
        lambda w, i: F.struct(
            F.when(i % 2 == 0, "roman").otherwise("italic").alias("typeface"), F.concat(w, F.lit(" ")).alias("text"),
            F.lit(None).cast("string").alias("placement"), F.lit(None).cast("string").alias("layout"),
            F.lit(None).cast("int").alias("line_span"), F.lit(None).cast("string").alias("span_id"),
        ),
    )
    none = F.array().cast("array<struct<s:int,e:int>>")
    target = F.regexp_replace(C.line_text(runs), "^(\\S+) ", "$1, ")
    lines = t.conversations.select("conv_id", "turn", runs.alias("runs"), target.alias("target"), none.alias("roman"), none.alias("italic"))
    new = R.rewrite_runs(lines, "runs", "target", "roman", "italic", "new")
    faces = F.array_join(F.transform("new", lambda r: F.concat(F.substring(r["typeface"], 1, 1), F.length(r["text"]).cast("string"))), "")
    return new.select("conv_id", "turn", F.size("new").alias("runs"), F.md5(C.line_text(F.col("new"))).alias("digest"), F.md5(faces).alias("faces"))


@query()
def tilde_move(t: Tables) -> DataFrame:
    """Every word with a tilde, and what it is with the tilde on the other vowel (F2): checked by unit cases."""
    words = t.documents.select(F.explode(F.array_distinct(F.regexp_extract_all("text", F.lit(r"\p{L}*[ãõñ]\p{L}*"), F.lit(0)))).alias("word"))
    at = F.regexp_instr("word", F.lit("[ãõñ]")) - 1
    return words.groupBy("word").agg(F.count(F.lit(1)).alias("n")).withColumn("moved", T.move_tilde(F.col("word"), at))


@query(r"""
WITH w AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations WHERE NOT regexp_matches(text, '[\[\]{}]')),
p AS (SELECT conv_id, turn, w, list_contains(list_transform(range(1, len(w) + 1), lambda i: i % 3 <> 1 AND w[i] = ''), true) OR turn % 7 = 3 AS broken,
      list_transform(range(1, len(w) + 1), lambda i: length(array_to_string(w[1:i - 1], ' ')) + CASE WHEN i > 1 THEN 1 ELSE 0 END) AS place FROM w),
r AS (SELECT *, list_transform(range(1, len(w) + 1), lambda i: concat(place[i], '-', place[i] + length(w[i]))) AS said FROM p)
SELECT conv_id, turn, broken, CASE WHEN NOT broken THEN array_to_string(w, ' ') END AS text,
       CASE WHEN NOT broken THEN array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: i % 3 = 2), lambda i: said[i]), ',') END AS roman,
       CASE WHEN NOT broken THEN array_to_string(list_transform(list_filter(range(1, len(w) + 1), lambda i: i % 3 = 0), lambda i: said[i]), ',') END AS italic
FROM r""")
def notation_parse(t: Tables) -> DataFrame:
    """Every turn as it is marked; those without marks (all the SQL has) get two of three words marked, some with a mark left open."""
    words = F.split("text", " ", -1)
    marked = F.transform(
        words,
        lambda w, i: F.when(i % 3 == 1, F.concat(F.lit("["), w, F.lit("]"))).when(i % 3 == 2, F.concat(F.lit("{"), w, F.lit("}"))).otherwise(w),
    )
    whole = F.concat(F.array_join(marked, " "), F.when(F.col("turn") % 7 == 3, "[").otherwise(""))
    whole = F.when(F.col("text").rlike(r"[\[\]{}]"), F.col("text")).otherwise(whole)
    said = lambda ranges: F.array_join(F.transform(ranges, lambda x: F.concat_ws("-", x["s"].cast("string"), x["e"].cast("string"))), ",")
    read = t.conversations.select("conv_id", "turn", T.parse_notation(whole).alias("x"))
    return read.select(
        "conv_id", "turn", F.col("x.error").isNotNull().alias("broken"), F.col("x.text").alias("text"),
        said(F.col("x.roman")).alias("roman"), said(F.col("x.italic")).alias("italic"),
    )


@query("SELECT 'documents' AS name, count(*) AS n FROM documents UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'labels', count(*) FROM labels")
def global_counts(t: Tables) -> DataFrame:
    return A.global_counts(documents=t.documents, pages=t.pages, labels=t.labels)


@query("SELECT CAST(u.i - 1 AS INTEGER) AS y, count(*) FILTER (CAST(embedding[u.i] AS DOUBLE) < 0.05) AS dark FROM embeddings, unnest(range(1, len(embedding) + 1)) AS u(i) GROUP BY ALL")
def dark_rows(t: Tables) -> DataFrame:
    """Each dimension of the vectors as a row of pixels."""
    pixels = t.embeddings.select(F.posexplode("embedding").alias("y", "x")).withColumn("x", F.col("x").cast("double"))
    return A.dark_rows(pixels, "y", "x", 0.05)


@query("""
SELECT coalesce(l.value, e.value) AS value, coalesce(n, 0) AS n, coalesce(expected, 0) AS expected
FROM (SELECT quality AS value, count(*) AS n FROM labels GROUP BY 1) l
FULL JOIN (VALUES (0, 58::BIGINT), (1, 340::BIGINT), (2, 1::BIGINT)) e(value, expected) ON l.value = e.value
WHERE coalesce(n, 0) <> coalesce(expected, 0)""")
def unlike_distribution(t: Tables) -> DataFrame:
    return A.unlike_distribution(t.labels, "quality", {0: 58, 1: 340, 2: 1})


@query("""
SELECT 'master' AS side, c_custkey AS key, n FROM customer c LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) o ON o_custkey = c_custkey
UNION ALL SELECT 'page', o_custkey, count(*) FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer) GROUP BY 2
UNION ALL SELECT 'review', s_suppkey, NULL FROM supplier WHERE s_suppkey NOT IN (SELECT o_custkey FROM orders)""")
def masters_with_pages(t: Tables) -> DataFrame:
    """Customers as masters, their orders as pages, suppliers of the same number as reviews."""
    pages = t.orders.groupBy(F.col("o_custkey").alias("key")).agg(F.count(F.lit(1)).alias("n"))
    parts = J.masters_with_pages(t.customer.select(F.col("c_custkey").alias("key")), pages, t.supplier.select(F.col("s_suppkey").alias("key")), "key")
    shaped = [
        part.withColumn("n", F.col("n") if "n" in part.columns else F.lit(None).cast("long")).select(F.lit(side).alias("side"), "key", "n")
        for side, part in zip(("master", "page", "review"), parts, strict=True)
    ]
    return shaped[0].unionByName(shaped[1]).unionByName(shaped[2])


@query("SELECT page_id, format('bnf-f{:04d}', page_id) AS id FROM pages WHERE page_id BETWEEN 20 AND 120")
def page_range(t: Tables) -> DataFrame:
    return P.in_page_range(t.pages.select("page_id", C.page_id(F.col("page_id").cast("int")).alias("id")), "id", 20, 120)


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus <> 'F'")
def eligible_columns(t: Tables) -> DataFrame:
    return P.eligible_columns(t.orders.select("o_orderkey", "o_orderdate", "o_orderstatus"), "o_orderdate", "o_orderstatus", "F").drop("o_orderdate")


@query("SELECT doc_id, len(string_split(text, chr(10))) AS n FROM documents WHERE lang = 'en' AND text IS NOT NULL")
def column_bodies(t: Tables) -> DataFrame:
    """English documents as columns."""
    zones = t.documents.select("doc_id", F.when(F.col("lang") == "en", "column").otherwise("signature").alias("kind"), F.split("text", "\n", -1).alias("lines"))
    return P.column_bodies(zones).select("doc_id", F.size("lines").cast("long").alias("n"))


@query(f"SELECT doc_id, line_no FROM ({LINES_SQL}) WHERE contains(line, '=')")
def literal_equals(t: Tables) -> DataFrame:
    """Numbered lines of the documents as raw lines of pages."""
    raw = F.concat(F.lit("["), F.col("line_no").cast("string"), F.lit("] "), "line")
    return lines_of(t.documents).where(P.has_literal_equals(raw)).select("doc_id", "line_no")


@query("SELECT page_id FROM pages WHERE page_id BETWEEN 10 AND 60 OR page_id IN (70, 77, 200)")
def leaf_set(t: Tables) -> DataFrame:
    leaves = P.leaf_set(t.spark, 10, 60, [70, 77, 60, 200])
    return t.pages.select("page_id").join(leaves, F.col("page_id") == F.col("leaf"), "left_semi")


@query(r"""
SELECT doc_id, CASE quality WHEN 1 THEN true WHEN 0 THEN false END AS flag, length(trim(s, chr(9) || ' ')) AS n_bare, true AS digest, false AS short_digest,
       starts_with(s, '  doc') AS prefix, replace('doc_' || doc_id, '_', ' ') AS label, least(greatest(doc_id, 100), 500) AS clamped
FROM (SELECT *, '  doc ' || doc_id || chr(9) AS s FROM labels)""")
def scalar_checks(t: Tables) -> DataFrame:
    """Strict booleans, stripped texts, digests, prefixes, labels and clamped numbers of the labels."""
    said = F.concat(F.lit("  doc "), F.col("doc_id").cast("string"), F.lit("\t"))
    digest = F.sha2(F.col("doc_id").cast("string"), 256)
    return t.labels.select(
        "doc_id",
        T.strict_bool(F.when(F.col("quality") == 1, "true").when(F.col("quality") == 0, "false").otherwise("no")).alias("flag"),
        F.length(T.strip(said)).cast("long").alias("n_bare"),
        C.is_digest(digest).alias("digest"),
        C.is_digest(F.substring(digest, 1, 63)).alias("short_digest"),
        T.has_prefix(said, "  doc").alias("prefix"),
        T.label(F.concat(F.lit("doc_"), F.col("doc_id").cast("string"))).alias("label"),
        G.clamp(F.col("doc_id"), F.lit(100), F.lit(500)).alias("clamped"),
    )


@query("SELECT c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 5.0 ELSE 5 + (c_custkey % 7) * 90.0 / (c_custkey % 7 + 3) END::DOUBLE AS spaced FROM customer")
def even_spacing(t: Tables) -> DataFrame:
    """Line i of n between 5 and 95."""
    i = F.col("c_custkey") % 7
    return t.customer.select("c_custkey", W.evenly(F.lit(5.0), F.lit(95.0), i, i + 4).alias("spaced"))


@query("SELECT doc_id, md5(replace(text, '*', '') || ' naõ') AS digest FROM documents")
def marker_move(t: Tables) -> DataFrame:
    """Every document with a marked word behind it, whose tilde moves."""
    marked = F.concat(F.replace("text", F.lit("*"), F.lit("")), F.lit(" *não"))
    return t.documents.select("doc_id", F.md5(T.resolve_markers(marked)["value"]).alias("digest"))


# Documents as pages of compact text, for the rules of that format and for its parser.
CONTROLS = r"[\x00-\x09\x0B-\x1F\x7F-\x9F\x{2028}\x{2029}]"
PAGE_LINES_SQL = f"""
SELECT doc_id, lang, source, i, l, md5(l) AS id, contains(l, '@') AS bare, NOT contains(l, '@') AND contains(l, '&') AS note,
       NOT contains(l, '@') AND NOT contains(l, '&') AS own, regexp_matches(l, '[0-9]') AS far, string_split(regexp_replace(l, '[*{{}}|]', '', 'g'), ',') AS c
FROM (SELECT doc_id, lang, source, u.i AS i, string_split(regexp_replace(coalesce(text, ''), '{CONTROLS}', ' ', 'g'), chr(10))[u.i] AS l
      FROM documents, unnest(range(1, len(string_split(coalesce(text, ''), chr(10))) + 1)) AS u(i))"""


def dealt(documents: DataFrame) -> DataFrame:
    """The documents dealt evenly, however few row groups hold them: a page is parsed where it is made."""
    return documents.repartition("doc_id")


def rough_pages(documents: DataFrame) -> DataFrame:
    """(path, body): a page for each document, whose language, source and lines decide which rules it breaks."""
    text, lang, source = F.coalesce("text", F.lit("")), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    lines = F.split(F.regexp_replace(text, CONTROLS, " "), "\n", -1)

    def line(x: Column, i: Column) -> Column:
        flags = F.concat(F.when(x.rlike("[0-9]"), " >>").otherwise(""), F.when(i == 0, " initial=2").otherwise(""))
        content = F.replace(F.regexp_replace(x, "[*{}|]", ""), F.lit(","), F.lit(" || {x}"))
        own = F.concat(F.lit("["), F.md5(x), flags, F.lit("] "), content)
        return F.when(F.contains(x, F.lit("@")), F.concat(F.lit("! "), x)).when(F.contains(x, F.lit("&")), F.concat(F.lit("> "), x)).otherwise(own)

    pair = lambda key, value: F.concat(F.lit(f"{key}: "), value)
    some = lambda test, *rows: F.when(test, F.array(*rows)).otherwise(F.array().cast("array<string>"))
    zoned = source != "src7"
    head = F.array(
        F.lit("---"), pair("format", F.lit(model.COMPACT_FORMAT)), pair("version", F.when(lang == "fr", "2").otherwise(model.COMPACT_VERSION)),
        pair("id", F.md5(text)), *[pair(k, F.lit("x")) for k in ("source", "view", "url", "origin")], pair("wikisource", F.lit("false")),
        pair("sha256", F.when(lang == "en", F.sha2(text, 256)).otherwise(F.md5(text))),
        pair("lineation", F.when(source == "src2", "open").otherwise("checked")), pair("status", F.when(lang == "es", "odd").otherwise("human_checked")),
    )
    second = F.concat(F.lit("## "), F.when(F.contains(text, F.lit("&")), "header").otherwise("column-1"), F.lit(" [column] C"))
    parts = [
        head, some(F.length(text) <= 2000, F.lit("scope: all")), some(source == "src5", F.lit("no key")), F.array(F.lit("---"), F.lit("")),
        some(zoned, F.lit("## header [running_header] H"), F.lit("")), some(lang != "de", F.lit("[h] 1")), some(zoned, F.lit(""), second, F.lit("")),
        F.transform(lines, line),
    ]
    return dealt(documents).select(F.col("doc_id").cast("string").alias("path"), F.array_join(F.concat(*parts), "\n").alias("body"))


PAGE_RULES = [f"V{i}" for i in range(1, 20)] + ["V28"]


@query(f"""
WITH d AS (SELECT *, coalesce(text, '') AS x FROM documents), l AS ({PAGE_LINES_SQL}), whole AS (SELECT *, NOT list_contains(c, '') AS fine FROM l WHERE own)
SELECT 'V1' AS rule, count(*) AS n FROM d WHERE nfc_normalize(x) <> x
UNION ALL SELECT 'V2', 0
UNION ALL SELECT 'V3', count(*) FROM d WHERE source = 'src5'
UNION ALL SELECT 'V4', count(*) FROM d WHERE lang = 'fr'
UNION ALL SELECT 'V5', count(*) FROM d WHERE length(x) > 2000
UNION ALL SELECT 'V6', count(*) FROM d WHERE lang IS DISTINCT FROM 'en'
UNION ALL SELECT 'V7', count(*) FROM d WHERE source = 'src2'
UNION ALL SELECT 'V8', count(*) FROM d WHERE lang = 'es'
UNION ALL SELECT 'V9', count(*) FROM l WHERE bare
UNION ALL SELECT 'V10', (SELECT count(*) FROM l WHERE NOT bare AND source = 'src7') + (SELECT count(*) FROM d WHERE source = 'src7' AND lang IS DISTINCT FROM 'de')
UNION ALL SELECT 'V11', count(*) FROM (SELECT doc_id FROM l WHERE note AND source IS DISTINCT FROM 'src7' GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'V12', count(*) FROM (SELECT doc_id FROM l WHERE own GROUP BY doc_id, id HAVING count(*) > 1)
UNION ALL SELECT 'V13', count(*) FROM d WHERE contains(x, '&') AND source IS DISTINCT FROM 'src7'
UNION ALL SELECT 'V14', count(*) FROM whole WHERE far AND len(c) > 1
UNION ALL SELECT 'V15', 0
UNION ALL SELECT 'V16', count(*) FROM whole WHERE i = 1 AND fine AND (far OR starts_with(c[1], ' '))
UNION ALL SELECT 'V17', count(*) FROM (SELECT doc_id FROM whole WHERE fine GROUP BY doc_id, id HAVING sum(len(c) - 1) > 1)
UNION ALL SELECT 'V18', count(*) FROM d WHERE lang = 'de' AND doc_id NOT IN (SELECT doc_id FROM l WHERE own)
UNION ALL SELECT 'V19', count(*) FROM (SELECT md5(x) FROM d GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'V28', count(*) FROM whole WHERE NOT fine""")
def page_rules(t: Tables) -> DataFrame:
    """Violations of each rule of the compact text (V1-V19, V28) over all documents as pages."""
    return V.counts(V.page_violations(rough_pages(t.documents)), PAGE_RULES)


@query(f"""
SELECT doc_id, id AS line_id, CASE WHEN far THEN '>>' ELSE '' END AS flag, CASE WHEN i = 1 THEN '2' ELSE '' END AS initial, len(c) AS cells,
       CASE WHEN NOT list_contains(c, '') THEN len(c) + CASE WHEN i = 1 AND length(c[1]) > 1 THEN 1 ELSE 0 END ELSE -1 END AS runs,
       CASE WHEN NOT list_contains(c, '') THEN md5(array_to_string(c, '')) END AS digest,
       CASE WHEN NOT list_contains(c, '') THEN CASE WHEN far THEN 0 WHEN i = 1 AND length(c[1]) > 1 THEN 2 ELSE 1 END ELSE -1 END AS main
FROM ({PAGE_LINES_SQL}) WHERE own
UNION ALL SELECT doc_id, 'h', '', '', 1, 1, md5('1'), 1 FROM documents WHERE lang IS DISTINCT FROM 'de'""")
def page_lines(t: Tables) -> DataFrame:
    """The parsed lines of all documents as pages."""
    lines = P.flat_lines(P.numbered(rough_pages(t.documents)))
    return lines.select(
        F.col("path").cast("long").alias("doc_id"), "line_id", "flag", "initial", F.size(T.cells(F.col("content"))).cast("long").alias("cells"),
        F.coalesce(F.when(F.col("runs").isNotNull(), F.size("runs")), F.lit(-1)).cast("long").alias("runs"), F.md5(C.line_text(F.col("runs"))).alias("digest"),
        F.coalesce(F.when(F.col("runs").isNotNull(), F.size(P.placed(F.col("runs"))["main"])), F.lit(-1)).alias("main"),
    )


def clean_pages(documents: DataFrame, *keep: str) -> DataFrame:
    """(path, body): a page without faults for each document, with its columns ``keep``."""
    plain = F.regexp_replace(F.regexp_replace(F.coalesce("text", F.lit("")), CONTROLS, " "), "[*{}|]", "")
    documents, text = dealt(documents).withColumn("text", plain), F.col("text")
    lines = F.transform(F.split(text, "\n", -1), lambda x, i: F.concat(F.lit("[l-"), i.cast("string"), F.lit("] x"), x, F.lit(".")))
    head = [
        "---", f"format: {model.COMPACT_FORMAT}", f"version: {model.COMPACT_VERSION}", F.concat(F.lit("id: d"), F.col("doc_id").cast("string")), "source: s", "view: v",
        "url: u", F.concat(F.lit("sha256: "), F.sha2(text, 256)), "scope: all", "origin: scan", "wikisource: false", "lineation: checked", "status: human_checked",
        "---", "", "## column-1 [column] C", "",
    ]
    whole = F.concat(F.array(*[h if isinstance(h, Column) else F.lit(h) for h in head]), lines)
    return documents.select(*keep, F.col("doc_id").cast("string").alias("path"), F.concat(F.array_join(whole, "\n"), F.lit("\n")).alias("body"))


@query(f"""
SELECT 'd' || doc_id AS id, md5(array_to_string(['---', 'format: {model.COMPACT_FORMAT}', 'version: {model.COMPACT_VERSION}', 'id: d' || doc_id, 'source: s', 'view: v', 'url: u',
  'sha256: ' || sha256(x), 'scope: all', 'origin: scan', 'wikisource: false', 'lineation: checked', 'status: human_checked', '---', '', '## column-1 [column] C', ''], chr(10)) || chr(10)
  || array_to_string(list_transform(range(len(w)), lambda i: '[l-' || i || '] x' || w[i + 1] || '.'), chr(10)) || chr(10)) AS digest
FROM (SELECT doc_id, x, string_split(x, chr(10)) AS w FROM
      (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), '{CONTROLS}', ' ', 'g'), '[*{{}}|]', '', 'g') AS x FROM documents))""")
def page_round_trip(t: Tables) -> DataFrame:
    """The compact text of all documents, compiled as pages and exported again."""
    return P.exported(P.compiled(clean_pages(t.documents))).select("id", F.md5("body").alias("digest"))


def found_counts(found: DataFrame) -> DataFrame:
    """Violations by rule and detail."""
    return found.groupBy("rule", F.coalesce("detail", F.lit("")).alias("detail")).agg(F.count(F.lit(1)).alias("n"))


@query("""
WITH r AS (SELECT l_orderkey || ':' || l_linenumber AS key, l_linenumber * 100 AS x, CAST(l_quantity AS INTEGER) * 10 AS y, 300 + CAST(round(l_discount * 100) AS INTEGER) AS w FROM lineitem)
SELECT 'V37' AS rule, key FROM r WHERE x + 300 > 900 OR y + 50 > 520 OR x - 5 + w > 900 OR y - 5 < 0 OR y + 55 > 520
UNION ALL SELECT 'V38', key FROM r WHERE w < 305""")
def geometry_rules(t: Tables) -> DataFrame:
    """Order lines as rectangles and their context on a page of 900 by 520."""
    x, y = F.col("l_linenumber") * 100, F.col("l_quantity").cast("int") * 10
    rect = lambda a, b, w, h: F.struct(a.alias("x"), b.alias("y"), w.alias("w"), F.lit(h).alias("h"))
    wide = F.lit(300) + F.round(F.col("l_discount") * 100).cast("int")
    rects = t.lineitem.select(
        F.concat_ws(":", "l_orderkey", "l_linenumber").alias("line_ref"), rect(x, y, F.lit(300), 50).alias("crop"),
        rect(x - 5, y - 5, wide, 60).alias("context_crop"), F.lit(900).alias("width"), F.lit(520).alias("height"),
    )
    return V.geometry_violations(rects).select("rule", "key")


@query("""
WITH c AS (SELECT p_partkey, p_partkey % 10 AS l, p_size * 20 AS r, CAST(floor(p_retailprice) AS INTEGER) AS b, p_size, p_partkey % 5 AS n FROM part)
SELECT 'V30' AS rule, CAST(p_partkey AS VARCHAR) AS key FROM c WHERE NOT (l < r AND r <= 600 AND 0 < b AND b <= 1000 AND 0 < p_size AND p_size * 3 <= 100)
UNION ALL SELECT 'V55', CAST(p_partkey AS VARCHAR) FROM c WHERE NOT (n >= 1 AND n <= b AND (n = 1 OR p_size * 10 < ceil(b / n)))""")
def tile_rules(t: Tables) -> DataFrame:
    """Parts as tile settings of images of 600 by 1000."""
    size = F.col("p_size")
    box = F.struct((F.col("p_partkey") % 10).alias("l"), F.lit(0).alias("t"), (size * 20).alias("r"), F.floor("p_retailprice").cast("int").alias("b"))
    configs = t.part.select(
        F.col("p_partkey").alias("id"), box.alias("box"), F.lit(600).alias("width"), F.lit(1000).alias("height"), F.array(size, size * 3).alias("line_span"),
        (F.col("p_partkey") % 5).alias("tiles"), (size * 10).alias("overlap"),
    )
    return V.tile_violations(configs).select("rule", "key")


@query("""
WITH l AS (SELECT l_orderkey AS issue, CAST(l_partkey AS VARCHAR) AS line, l_tax = 0 AS lost FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders))
SELECT 'V43' AS rule, CAST(o_orderkey AS VARCHAR) AS key FROM orders
WHERE o_orderstatus = 'P' OR o_orderpriority = '5-LOW' OR o_orderkey = 0 OR o_orderkey NOT IN (SELECT issue FROM l)
UNION ALL SELECT 'V44', CAST(issue AS VARCHAR) FROM l WHERE lost
UNION ALL SELECT 'V44', issue || ':' || line FROM l GROUP BY issue, line HAVING count(*) > 1""")
def payload_rules(t: Tables) -> DataFrame:
    """Orders as correction payloads, their lines as changes."""
    change = F.struct(F.col("l_partkey").cast("string").alias("line"), F.col("l_returnflag").alias("before"), F.when(F.col("l_tax") != 0, "x").alias("after"))
    changes = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(change).alias("changes"))
    payload = F.struct(
        F.when(F.col("o_orderstatus") == "P", 1).otherwise(2).alias("schema"), F.concat(F.lit("f"), "o_orderkey").alias("page"),
        F.when(F.col("o_orderpriority") != "5-LOW", "c").alias("base_commit"), F.lit("v").alias("base_transcription_version"), "changes",
    )
    payloads = t.orders.join(changes, "o_orderkey", "left").select(F.col("o_orderkey").alias("issue"), payload.alias("payload"))
    return V.payload_violations(payloads).select("rule", "key")


@query("""
WITH e AS (SELECT event_type, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events)
SELECT * FROM (
  SELECT 'V57' AS rule, 'step' AS detail, count(*) AS n FROM e WHERE k < 1
  UNION ALL SELECT 'V57', 'no change', count(*) FROM e WHERE value < 100
  UNION ALL SELECT 'V57', 'outcome', count(*) FROM e WHERE event_type NOT IN ('click', 'view')
  UNION ALL SELECT 'V57', 'empty', count(*) FROM e WHERE event_type = 'signup') WHERE n > 0""")
def correction_rules(t: Tables) -> DataFrame:
    """Events as the correction log."""
    kind = F.col("event_type")
    log = t.events.select(
        F.concat(F.lit("e-"), F.col("event_id").cast("string")).alias("event_id"), F.concat(F.lit("f"), F.col("user_id").cast("string")).alias("page"),
        F.get_json_object("props", "$.k").alias("step"), F.lit("a").alias("before"), F.when(F.col("value") < 100, "a").otherwise("b").alias("after"),
        F.when(kind == "click", "accepted").when(kind == "view", "rejected").otherwise(kind).alias("outcome"),
        F.when(kind != "signup", kind).alias("categories"), F.lit("p").alias("provenance"),
    )
    return found_counts(V.correction_violations(log))


@query("""
WITH s AS (SELECT s_suppkey, s_nationkey, s_acctbal, row_number() OVER (ORDER BY s_suppkey) AS pos FROM supplier)
SELECT 'V51' AS rule, CAST(s_suppkey AS VARCHAR) AS key, 'sequence' AS detail FROM s WHERE s_suppkey <> pos
UNION ALL SELECT 'V51', CAST(s_suppkey AS VARCHAR), 'link' FROM s WHERE s_acctbal < 0
UNION ALL SELECT 'V51', 'h' || s_nationkey, CAST(count(*) AS VARCHAR) FROM s GROUP BY s_nationkey HAVING count(*) > 1""")
def headword_rules(t: Tables) -> DataFrame:
    """Suppliers as headwords, their nations as ids."""
    ranked = W.global_rank(t.supplier, "s_suppkey", name="pos")
    link = F.when(F.col("s_acctbal") < 0, "http://other.org/").otherwise("https://example.org/x")
    rows = ranked.select(F.col("s_suppkey").cast("string").alias("number"), F.concat(F.lit("h"), "s_nationkey").alias("id"), link.alias("link"), "pos")
    return V.headword_violations(rows, "number", "id", "link", "https://example.org/", "pos")


@query("""
WITH d AS (SELECT o_orderkey, o_orderstatus AS s, o_orderpriority AS p, o_totalprice AS v FROM orders)
SELECT CAST(o_orderkey AS VARCHAR) AS key, CASE WHEN s = 'P' THEN 'pending or unknown' WHEN s = 'F' THEN 'rejected line changed' ELSE 'no qualified value' END AS detail
FROM d WHERE s = 'P' OR (s = 'F' AND v > 200000) OR (s = 'O' AND p = '5-LOW')""")
def decision_rules(t: Tables) -> DataFrame:
    """Orders as decisions on proposals."""
    status = F.col("o_orderstatus")
    decisions = t.orders.select(
        F.col("o_orderkey").cast("string").alias("line_ref"), F.when(status == "F", "reject").when(status == "O", "qualify").otherwise("pending").alias("decision"),
        F.lit("a").alias("before"), F.when(F.col("o_orderpriority") != "5-LOW", "q").alias("qualified"),
        F.when(F.col("o_totalprice") > 200000, "b").otherwise("a").alias("now"),
    )
    return R.decision_violations(decisions).select("key", "detail")


@query("""
SELECT rule, key FROM (SELECT 'V33' AS rule, c_name AS key FROM customer WHERE c_acctbal < 0 OR c_mktsegment NOT IN ('BUILDING', 'MACHINERY')
UNION ALL SELECT 'V48', 'f' || o_custkey FROM (SELECT DISTINCT o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 5000)))""")
def state_rules(t: Tables) -> DataFrame:
    """Customers as columns with a state, their orders as changed paths."""
    columns = t.customer.select(F.col("c_name").alias("key"), F.col("c_mktsegment").alias("state"), F.when(F.col("c_acctbal") >= 0, "box").alias("geometry"))
    path = lambda c: F.concat(F.lit("f"), c).alias("path")
    found = V.path_violations(t.orders.select(path("o_custkey")), t.customer.where("c_acctbal > 5000").select(path("c_custkey")))
    return V.all_of(V.state_violations(columns, ["BUILDING", "MACHINERY"]), found).select("rule", "key")


@query("""
SELECT rule, detail, count(*) AS n FROM (
  SELECT 'V39' AS rule, '' AS detail FROM orders WHERE o_orderstatus <> 'F'
  UNION ALL SELECT 'V40', 'text' FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE (left(o_orderpriority, 1) = CAST(c_nationkey % 5 + 1 AS VARCHAR)) IS NOT TRUE
  UNION ALL SELECT 'V40', 'image' FROM orders LEFT JOIN customer ON o_custkey = c_custkey WHERE (c_custkey IS NOT NULL AND o_totalprice > 100000) IS NOT TRUE) GROUP BY ALL""")
def external_rules(t: Tables) -> DataFrame:
    """Orders as external reviews of their customers' pages."""
    reviews = t.orders.select(
        F.col("o_custkey").alias("page"), F.when(F.col("o_orderstatus") == "F", "complete").otherwise("partial").alias("response_status"),
        F.lit("partial").alias("geometry_review_status"), F.left("o_orderpriority", F.lit(1)).alias("text_sha256"), F.lit("s").alias("sha256"),
        F.when(F.col("o_totalprice") > 100000, 9).otherwise(8).alias("width"), F.lit(5).alias("height"),
    )
    current = t.customer.select(
        F.col("c_custkey").alias("page"), (F.col("c_nationkey") % 5 + 1).cast("string").alias("now_text_sha256"), F.lit("s").alias("now_sha256"),
        F.lit(9).alias("now_width"), F.lit(5).alias("now_height"),
    )
    return found_counts(V.external_review_violations(reviews, current))


@query(f"""
SELECT r.rule, coalesce(n, 0) AS n FROM (VALUES ('V21'), ('V22'), ('V23'), ('V24'), ('V58')) r(rule)
LEFT JOIN (SELECT 'V58' AS rule, count(*) AS n FROM ({LINES_SQL}) WHERE contains(line, '=')
           UNION ALL SELECT 'V22', count(*) FROM ({LINES_SQL}) WHERE nfc_normalize(line) <> line) USING (rule)""")
def run_rules(t: Tables) -> DataFrame:
    """Rules of compiled lines (V21-V24, V58) over all documents as pages."""
    return V.counts(V.run_violations(P.registry(P.compiled(clean_pages(t.documents)))), ["V21", "V22", "V23", "V24", "V58"])


@query("""
WITH c AS (SELECT *, lead(turn) OVER (PARTITION BY conv_id ORDER BY turn) AS after FROM conversations)
SELECT rule, detail, count(*) AS n FROM (
  SELECT 'V25' AS rule, CAST(count(*) AS VARCHAR) AS detail FROM conversations GROUP BY conv_id HAVING count(*) > 1
  UNION ALL SELECT 'V26', 'lost' FROM c WHERE after IS DISTINCT FROM turn + 1
  UNION ALL SELECT 'V26', role FROM c WHERE role <> 'none') GROUP BY ALL""")
def structure_rules(t: Tables) -> DataFrame:
    """Turns as sequences that select the turn behind them."""
    said = t.conversations
    ref = lambda turn: F.concat_ws(":", F.col("conv_id").cast("string"), turn.cast("string"))
    none = F.lit(None).cast("string")
    run = F.struct(
        F.lit("roman").alias("typeface"), F.col("text").alias("text"), none.alias("placement"), none.alias("layout"), F.lit(None).cast("int").alias("line_span"), none.alias("span_id")
    )
    lines = said.select(ref(F.col("turn")).alias("line_ref"), F.array(run).alias("runs"))
    one = F.struct(ref(F.col("turn") + 1).alias("line"), F.col("role").alias("join"), none.alias("span"), F.lit(None).cast("array<int>").alias("runs"))
    items = said.select(F.col("conv_id").cast("string").alias("id"), F.lit("sequence").alias("kind"), F.array(one).alias("refs"))
    found = V.structure_violations(items, lines)
    lost = (F.col("rule") == "V26") & F.contains("detail", F.lit(":"))
    return found_counts(found.withColumn("detail", F.when(lost, "lost").otherwise(F.col("detail"))))
