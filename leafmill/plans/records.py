"""Queries of rules, geometry, images and page parts over the driver's tables; importing this registers them."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leafmill.functions import geometry as G
from leafmill.operators import checks as V
from leafmill.plans import views
from leafmill.plans.catalog import CONTROLS, Tables, clean_pages, query
from leafmill.shared import fresh
from leafmill.sources import files
from leafmill.sources import pages as P

RULES = ["V20", "V29", "V31", "V34", "V36", "V41", "V54", "V56"]


@query("""
WITH a AS (SELECT DISTINCT p_partkey AS k FROM part WHERE p_size < 40), b AS (SELECT DISTINCT l_partkey AS k FROM lineitem WHERE l_quantity < 25),
s AS (SELECT s_suppkey AS k FROM supplier WHERE s_suppkey % 7 <> 3), o AS (SELECT o_orderkey, o_custkey, o_orderkey % 6 AS size, o_orderkey % 35 = 4 AS hole FROM orders),
m AS (SELECT doc_id, CASE WHEN doc_id % 9 = 4 THEN 'x' ELSE sha256(coalesce(text, '')) END AS said, sha256(coalesce(text, '')) AS own FROM documents)
SELECT 'V20' AS rule, (SELECT count(*) FROM a WHERE k NOT IN (SELECT k FROM b)) + (SELECT count(*) FROM b WHERE k NOT IN (SELECT k FROM a)) AS n
UNION ALL SELECT 'V29', count(*) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')
UNION ALL SELECT 'V31', (SELECT max(k) - min(k) + 1 - count(*) FROM s)
UNION ALL SELECT 'V34', count(DISTINCT l_partkey) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size > 10)
UNION ALL SELECT 'V36', (SELECT count(DISTINCT o_custkey) FROM o WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey < 20))
                      + (SELECT count(*) FROM o WHERE size NOT IN (1, 4) OR hole)
UNION ALL SELECT 'V41', count(*) FROM (SELECT o_custkey FROM orders GROUP BY 1 HAVING count(*) > 1)
UNION ALL SELECT 'V54', count(*) FROM m WHERE doc_id % 11 = 0 OR said <> own
UNION ALL SELECT 'V56', 1""")
def record_rules(t: Tables) -> DataFrame:
    """Rules of sets, ranges, overrides and digests over parts, suppliers, orders and documents."""
    keys = lambda rows, c: rows.select(F.col(c).alias("key")).distinct()
    own = F.sha2(F.coalesce("text", F.lit("")), 256)
    manifest = t.documents.select(F.col("doc_id").alias("id"), F.col("doc_id").alias("path"), F.when(F.col("doc_id") % 9 == 4, "x").otherwise(own).alias("sha256"))
    found = t.documents.where("doc_id % 11 <> 0").select(F.col("doc_id").alias("path"), own.alias("sha256"))
    hole = F.when(F.col("o_orderkey") % 35 == 4, F.lit(None).cast("int")).otherwise(F.lit(7))
    overrides = t.orders.select(F.col("o_custkey").alias("line_ref"), F.array_repeat(hole, (F.col("o_orderkey") % 6).cast("int")).alias("values"))
    lines = t.customer.where("c_nationkey < 20").select(F.col("c_custkey").alias("line_ref"))
    broken = V.all_of(
        V.unequal_sets(keys(t.part.where("p_size < 40"), "p_partkey"), keys(t.lineitem.where("l_quantity < 25"), "l_partkey"), "V20", "key"),
        V.outside(t.orders, "V29", "o_orderstatus", ["F", "O"], "o_orderkey"),
        V.gaps(t.supplier.where("s_suppkey % 7 <> 3"), "V31", "s_suppkey"),
        V.unresolved(keys(t.lineitem, "l_partkey"), keys(t.part.where("p_size > 10"), "p_partkey"), "V34", "key"),
        V.override_violations(overrides, lines),
        V.duplicates(t.orders, "V41", "o_custkey"),
        V.digest_violations(manifest, found),
        V.wrong_count(t.nation, "V56", 24),
    )
    return V.counts(broken, RULES)


BOX_SQL = """SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_linenumber * 10 AS l, CAST(l_quantity AS INTEGER) AS t, l_linenumber * 10 + CAST(l_partkey % 90 AS INTEGER) - 5 AS r,
  CAST(l_quantity AS INTEGER) + 300 AS b, 100 + CAST(l_suppkey % 40 AS INTEGER) AS w, 320 AS h, CAST(l_partkey % 12 AS INTEGER) + 1 AS n, CAST(l_linenumber AS INTEGER) - 1 AS i FROM lineitem"""


@query(f"""
WITH x AS ({BOX_SQL}), c AS (
  SELECT *, CASE WHEN n = 1 THEN t + 150.0::DOUBLE ELSE t + 300.0::DOUBLE * (5.8::DOUBLE + i::DOUBLE / (n - 1) * (95.8::DOUBLE - 5.8::DOUBLE)) / 100 END AS centre,
         CASE WHEN n = 1 THEN 15.0::DOUBLE ELSE 300.0::DOUBLE * (95.8::DOUBLE - 5.8::DOUBLE) / 100 / (n - 1) END AS step FROM x WHERE i < n
)
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l >= 0 AND l < r AND r <= w AND b <= h AS valid, r - l AS wide,
  CAST(greatest(t, round_even(centre - step * 0.78::DOUBLE, 0)) AS INTEGER) AS crop_y,
  CAST(least(b, round_even(centre + step * 0.70::DOUBLE, 0)) - greatest(t, round_even(centre - step * 0.78::DOUBLE, 0)) AS INTEGER) AS crop_h,
  CAST(greatest(t, round_even(centre - step * 2.6::DOUBLE, 0)) AS INTEGER) AS context_y,
  (CAST(round_even(w * (6 / 100::DOUBLE), 0) AS INTEGER) + CAST(round_even(w * (94 / 100::DOUBLE), 0) AS INTEGER)) // 2 + CAST(round_even(w * (2.5::DOUBLE / 100), 0) AS INTEGER) AS first_r,
  (CAST(round_even(w * (6 / 100::DOUBLE), 0) AS INTEGER) + CAST(round_even(w * (94 / 100::DOUBLE), 0) AS INTEGER)) // 2 - CAST(round_even(w * (2.5::DOUBLE / 100), 0) AS INTEGER) AS second_l,
  round(l * 100.0::DOUBLE / w, 6) AS percent_left, least(60.0::DOUBLE, pow(2.0::DOUBLE, n - 1)) AS wait
FROM c""")
def geometry_functions(t: Tables) -> DataFrame:
    """Boxes of order lines: valid or not, crops of lines, estimated columns, percent, waiting times."""
    q, part, supp = F.col("l_quantity").cast("int"), F.col("l_partkey"), F.col("l_suppkey")
    left = F.col("l_linenumber") * 10
    box = F.struct(left.alias("l"), q.alias("t"), (left + (part % 90).cast("int") - 5).alias("r"), (q + 300).alias("b"))
    rows = t.lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", box.alias("box"), (100 + (supp % 40).cast("int")).alias("w"), F.lit(320).alias("h"),
        ((part % 12).cast("int") + 1).alias("n"), (F.col("l_linenumber") - 1).alias("i"),
    ).where("i < n")
    b, w, h = F.col("box"), F.col("w"), F.col("h")
    rect = G.as_rect(G.as_box(G.as_rect(b)))
    known = rows.withColumn("crop", G.line_crop(F.col("i"), F.col("n"), b)).withColumn("columns", G.column_estimate(w, h)).withColumn("rect", rect)
    return known.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", G.box_is_valid(b, w, h).alias("valid"), F.col("rect.w").alias("wide"), F.col("crop.crop.y").alias("crop_y"),
        F.col("crop.crop.h").alias("crop_h"), F.col("crop.context.y").alias("context_y"), F.col("columns.first.r").alias("first_r"),
        F.col("columns.second.l").alias("second_l"), F.round(G.percent_place(F.col("rect"), w, h)["left"], 6).alias("percent_left"), G.back_off(F.col("n")).alias("wait"),
    )


@query("""
WITH p AS (SELECT s_suppkey AS k, CASE WHEN s_suppkey % 10 = 7 THEN '00d8' ELSE 'ffd8' END || 'ffe00004abcd' || 'ffc0001108' || printf('%04x%04x', 200 + s_suppkey % 60, 100 + s_suppkey % 50)
  || '03012200021101031101' || repeat('00', CASE WHEN s_suppkey % 5 = 2 THEN 9000 ELSE 10000 END) AS x FROM supplier)
SELECT CAST(k AS INTEGER) AS leaf, length(x) // 2 AS bytes, CASE WHEN k % 10 <> 7 THEN CAST(100 + k % 50 AS INTEGER) ELSE -1 END AS width,
       CASE WHEN k % 10 <> 7 THEN CAST(200 + k % 60 AS INTEGER) ELSE -1 END AS height, sha256(unhex(x)) AS sha256, k % 10 = 7 OR length(x) // 2 < 10000 AS broken FROM p""")
def image_files(t: Tables) -> DataFrame:
    """Suppliers as files of image headers, found by their names, measured and judged."""
    folder, k = fresh(t.spark, "images"), F.col("s_suppkey")
    word = lambda c: F.lpad(F.hex(c), 4, "0")
    code = F.concat(
        F.when(k % 10 == 7, "00D8").otherwise("FFD8"), F.lit("FFE00004ABCDFFC0001108"), word(200 + k % 60), word(100 + k % 50), F.lit("03012200021101031101"),
        F.repeat(F.lit("00"), F.when(k % 5 == 2, 9000).otherwise(10000)),
    )
    files.write_files(t.supplier.select(F.format_string("f%04d.jpg", k).alias("name"), F.unhex(code).alias("content")), folder)
    found = files.images(t.spark, folder)
    broken = V.image_violations(found).select(F.col("key").alias("path"), F.lit(True).alias("broken"))
    known = files.by_leaf(t.spark, folder).join(found, "path").join(broken, "path", "left")
    size = lambda f: F.coalesce(f"size.{f}", F.lit(-1)).alias(f)
    return known.select("leaf", "bytes", size("width"), size("height"), "sha256", F.coalesce("broken", F.lit(False)).alias("broken"))


@query("""
WITH x AS (SELECT CAST(l_orderkey AS VARCHAR) AS page_id, l_linenumber AS z, l_partkey AS p, l_returnflag = 'R' AS head, l_quantity < 25 AS digits, 'column-' || (l_suppkey % 3) || CASE WHEN l_quantity > 40 THEN 'a' ELSE '' END AS zone_id FROM lineitem)
SELECT page_id, coalesce(arg_min(CAST(p AS VARCHAR), {'z': z, 'p': p}) FILTER (head AND digits), '') AS printed, count(*) FILTER (zone_id = 'column-1') AS exact, count(*) FILTER (contains(zone_id, 'column-1')) AS split
FROM x GROUP BY page_id""")
def printed_numbers(t: Tables) -> DataFrame:
    """Order lines as lines of pages: the printed number of each, and its lines in a column by both rules."""
    none, part = F.lit(None).cast("string"), F.col("l_partkey")
    said = F.when(F.col("l_quantity") < 25, F.concat(F.lit(" "), part.cast("string"), F.lit(" "))).otherwise(F.concat(part.cast("string"), F.lit("x")))
    run = F.struct(F.lit("roman").alias("typeface"), said.alias("text"), none.alias("placement"))
    lines = t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("page_id"), F.col("l_linenumber").alias("zone_pos"), part.alias("line_pos"), F.array(run).alias("runs"),
        F.when(F.col("l_returnflag") == "R", "running_header").otherwise("column").alias("zone_kind"),
        F.concat(F.lit("column-"), (F.col("l_suppkey") % 3).cast("string"), F.when(F.col("l_quantity") > 40, "a").otherwise("")).alias("zone_id"),
    )
    units = lines.groupBy("page_id").agg(
        F.count_if(P.unit_of(F.col("zone_id"), F.lit("column"), 1)).alias("exact"), F.count_if(P.unit_contains(F.col("zone_id"), F.lit("column-1"))).alias("split")
    )
    return P.printed_number(lines).join(units, "page_id").select("page_id", F.coalesce("printed", F.lit("")).alias("printed"), "exact", "split")


@query("""
WITH c AS (SELECT conv_id, turn, string_split(text, ' ') AS w FROM conversations)
SELECT conv_id, turn, CASE WHEN turn % 4 < len(w) THEN w[1] || w[turn % 4 + 1] ELSE '?' END AS by_index, CASE WHEN turn % 2 = 0 AND len(w) > 1 THEN w[2] ELSE '?' END AS by_name,
       md5(array_to_string(w, '')) AS whole FROM c""")
def selected_runs(t: Tables) -> DataFrame:
    """Words of turns as runs, selected by index, by name and altogether."""
    named = lambda i: F.when((i == 1) & (F.col("turn") % 2 == 0), "m")
    runs = F.transform(F.split("text", " "), lambda w, i: F.struct(w.alias("text"), named(i).alias("span_id")))
    no_index, no_name = F.lit(None).cast("array<int>"), F.lit(None).cast("string")
    rows = t.conversations.select("conv_id", "turn", runs.alias("runs"))
    text = lambda index, name: P.selected_text(F.col("runs"), index, name)
    index = F.array(F.lit(0), (F.col("turn") % 4).cast("int"))
    return rows.select(
        "conv_id", "turn", F.coalesce(text(index, no_name), F.lit("?")).alias("by_index"), F.coalesce(text(no_index, F.lit("m")), F.lit("?")).alias("by_name"),
        F.md5(text(no_index, no_name)).alias("whole"),
    )


@query(f"""
WITH d AS (SELECT doc_id, string_split(regexp_replace(regexp_replace(coalesce(text, ''), '{CONTROLS}', ' ', 'g'), '[*{{}}|]', '', 'g'), chr(10)) AS w FROM documents)
SELECT 'd' || doc_id AS id, md5(array_to_string(list_concat(['# Page view: d' || doc_id, '', 'Source: u', '', 'Scope: `all`', '', '## C', '',
  '| Physical line | Main position | Far right |', '| --- | --- | --- |'], list_transform(range(len(w)), lambda i: '| `l-' || i || '` | x' || w[i + 1] || '. |  |')), chr(10)) || chr(10)) AS digest FROM d""")
def page_views(t: Tables) -> DataFrame:
    """All documents as pages, rendered as tables of their lines (K3)."""
    return views.page_view(P.compiled(clean_pages(t.documents))).select("id", F.md5("body").alias("digest"))
