"""Integrity rules as violation rows ``(rule, key, detail)``; a rule holds if it has no rows.

All violations are reported, not the first only; ``first_violation`` gives that one.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from leafmill import model
from leafmill.functions import content as C
from leafmill.functions import geometry as G
from leafmill.functions import text as T
from leafmill.operators.ordered import missing_between
from leafmill.sources import pages as P


def violations(rows: DataFrame, rule: str, bad: Column, key: Column, detail: Column | None = None) -> DataFrame:
    """Rows that break a rule; a null condition breaks it too."""
    detail = F.lit(None) if detail is None else detail
    return rows.where(F.coalesce(bad, F.lit(True))).select(
        F.lit(rule).alias("rule"), key.cast("string").alias("key"), detail.cast("string").alias("detail")
    )


def several(rows: DataFrame, key: Column, *rules: tuple) -> DataFrame:
    """``violations`` of several rules (rule, bad[, detail]) in one pass over the rows."""
    said = [
        F.when(
            F.coalesce(bad, F.lit(True)),
            F.struct(F.lit(rule).alias("rule"), key.cast("string").alias("key"), (detail[0] if detail else F.lit(None)).cast("string").alias("detail")),
        )
        for rule, bad, *detail in rules
    ]
    return rows.select(F.explode(F.array_compact(F.array(*said))).alias("v")).select("v.*")


def duplicates(rows: DataFrame, rule: str, *keys: str) -> DataFrame:
    """Keys on more than one row."""
    found = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    return found.select(F.lit(rule).alias("rule"), F.concat_ws(":", *[F.col(k).cast("string") for k in keys]).alias("key"), F.col("n").cast("string").alias("detail"))


def sides(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Each key once, with whether ``a`` and ``b`` have it: keys are counted before they are dealt, and none are sorted."""
    side = lambda rows, first: rows.select(key, F.lit(first).alias("_a"), F.lit(not first).alias("_b"))
    return side(a, True).unionByName(side(b, False)).groupBy(key).agg(F.bool_or("_a").alias("_a"), F.bool_or("_b").alias("_b"))


def lacking(found: DataFrame, rule: str, key: str, *said: tuple[str, str, str | None]) -> DataFrame:
    """Keys of ``sides`` that one side has and the other has not; a null is equal to none."""
    null = F.col(key).isNull()
    each = [F.when(F.col(one) & (~F.col(other) | null), F.struct(F.lit(detail).cast("string").alias("detail"))) for one, other, detail in said]
    rows = found.select(key, F.explode(F.array_compact(F.array(*each))).alias("v"))
    return rows.select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), "v.detail")


def unresolved(rows: DataFrame, known: DataFrame, rule: str, key: str) -> DataFrame:
    """Keys without a row in ``known``."""
    return lacking(sides(rows, known, key), rule, key, ("_a", "_b", None))


def unequal_sets(a: DataFrame, b: DataFrame, rule: str, key: str) -> DataFrame:
    """Keys of one side only."""
    return lacking(sides(a, b, key), rule, key, ("_a", "_b", "not in the second"), ("_b", "_a", "not in the first"))


def gaps(rows: DataFrame, rule: str, key: str) -> DataFrame:
    """Integers missing between the least and the largest."""
    return missing_between(rows, key).select(F.lit(rule).alias("rule"), F.col(key).cast("string").alias("key"), F.lit(None).cast("string").alias("detail"))


def outside(rows: DataFrame, rule: str, column: str, domain: list, key: str) -> DataFrame:
    """Values outside a domain."""
    return violations(rows, rule, ~F.col(column).isin(domain), F.col(key), F.col(column))


def wrong_count(rows: DataFrame, rule: str, n: int) -> DataFrame:
    """A table that has not ``n`` rows."""
    return rows.agg(F.count(F.lit(1)).alias("n")).where(F.col("n") != n).select(
        F.lit(rule).alias("rule"), F.lit(None).cast("string").alias("key"), F.col("n").cast("string").alias("detail")
    )


def all_of(*parts: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, parts)


def counts(found: DataFrame, rules: list[str]) -> DataFrame:
    """Violations by rule, zero included."""
    spark = found.sparkSession
    every = spark.createDataFrame([(r,) for r in rules], "rule string")
    n = found.groupBy("rule").agg(F.count(F.lit(1)).alias("n"))
    return every.join(n, "rule", "left").select("rule", F.coalesce("n", F.lit(0)).alias("n"))


def first_violation(found: DataFrame) -> DataFrame:
    """The first violation of each file by line and rule (keys ``path:line``)."""
    at = F.regexp_extract("key", r":(\d+)$", 1)
    order = F.struct(at.try_cast("int"), F.col("rule"))
    return found.groupBy(F.regexp_replace("key", r":\d+$", "").alias("path")).agg(F.min_by(F.struct("rule", "detail"), order).alias("v")).select("path", "v.*")


FOUND = "struct<rule:string,page:string,key:string,detail:string,once:boolean>"


def page_violations(files: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Rules of the compact text (V1-V19, V28; those of ``rules`` only, if given) over (path, body); keys are path or path:line.

    One pass over the pages: what concerns a page as a whole is judged on the array of its lines, and all else on each line by itself.
    Only what may occur once in a page, or in all of them, is counted by its key.
    """
    asked = lambda *own: [v for rule, v in own if rules is None or rule in rules]
    path, body, none = F.col("path"), F.col("body"), F.lit(None).cast("string")

    def found(rule: str, page: Column, key: Column, detail: Column = none, once: bool = False) -> Column:
        return F.struct(
            F.lit(rule).alias("rule"), page.cast("string").alias("page"), key.cast("string").alias("key"), detail.cast("string").alias("detail"), F.lit(once).alias("once")
        )

    known = files.select("path", "body")
    if asked(("V1", True)):  # Python sees only the texts that need it
        plain = T.seems_composed(body)
        known = known.withColumn("composed", T.is_nfc(F.when(~plain, body))).withColumn("composed", F.coalesce("composed", plain))
    rows = P.paged(known, *known.columns[2:])
    m = lambda k: F.col(f"said.{k}")
    rows = rows.withColumns({
        "said": F.struct(*(P.said_in_head(k).alias(k) for k in ("format", "version", *model.HEADER_KEYS))),
        "has_entry": F.exists("head", lambda x: F.contains(x, F.lit(": "))),
    })
    lost = F.array_compact(F.array(*(F.when(m(k).isNull(), F.lit(k)) for k in model.HEADER_KEYS)))
    page = lambda rule, bad, detail=none: (rule, F.when(F.coalesce(bad, F.lit(True)), found(rule, path, path, detail)))
    headed = lambda rule, bad, detail=none: page(rule, F.when(F.coalesce("has_entry", F.lit(False)), F.coalesce(bad, F.lit(True))).otherwise(False), detail)
    is_line = lambda x: x.startswith("[") & x.rlike(P.LINE_HEAD)
    behind = F.when(F.col("closed") > 0, F.slice("lines", F.col("closed") + 1, F.size("lines"))).otherwise(F.array().cast("array<string>"))
    notes = lambda a, b: F.size(F.filter(F.slice("lines", a + 1, b - a - 1), lambda x: x.startswith("> ")))
    noted = lambda a, b: F.when(notes(a, b) > 1, found("V11", path, F.concat_ws(":", path, a.cast("string")), notes(a, b)))
    of_page = asked(
        ("V1", F.when(~F.coalesce(F.col("composed"), F.lit(False)), found("V1", path, path))) if "composed" in known.columns else ("V1", F.lit(None)),
        page("V2", F.coalesce(F.get("lines", 0) != "---", F.lit(False)) | (F.col("lines").isNotNull() & (F.col("closed") == 0))),
        headed("V4", ~(m("format").eqNullSafe(model.COMPACT_FORMAT) & m("version").eqNullSafe(model.COMPACT_VERSION))),
        headed("V5", F.size(lost) > 0, F.array_join(lost, ",")), headed("V6", ~C.is_digest(m("sha256"))), headed("V7", m("lineation") != "checked"),
        headed("V8", ~m("status").isin(model.STATUSES), m("status")), page("V18", ~F.exists(behind, is_line)),
        ("V19", F.when(F.col("has_entry"), found("V19", none, F.coalesce(m("id"), F.lit("")), F.when(m("id").isNull(), "none"), once=True))),
    )
    of_zones = asked(("V11", F.zip_with("zones", P.zone_ends(), noted)))
    rows = rows.withColumn("of_page", F.array_compact(F.concat(F.array(*of_page, F.lit(None).cast(FOUND)), *of_zones)))

    lines = F.posexplode(F.coalesce("lines", F.array(none))).alias("pos", "line")  # a file without a text has one row too
    rows = rows.select("path", "opened", "closed", F.get("zones", 0).alias("zone"), "of_page", lines).withColumn("n", F.col("pos") + 1)
    n, line, opened, closed = F.col("n"), F.col("line"), F.col("opened"), F.col("closed")
    at, colon = F.concat_ws(":", "path", n.cast("string")), F.locate(": ", line)
    in_head = (opened > 0) & (n > opened) & ((closed == 0) | (n < closed))
    kind = F.when(line.startswith("## ") & line.rlike(P.ZONE), "zone").when(line.startswith("> "), "note").when(is_line(line), "line").otherwise("unknown")
    in_body = (closed > 0) & (n > closed) & (line != "---") & (line != "")
    rows = rows.where(in_head | in_body | ((F.col("pos") == 0) & (F.size("of_page") > 0)))
    rows = rows.withColumns({"in_head": in_head, "kind": F.when(in_body, kind)})

    in_head, kind, part = F.col("in_head"), F.col("kind"), lambda i: F.regexp_extract("line", P.LINE_HEAD, i)
    mine = lambda c: F.when(kind == "line", c)
    content = F.substring(line, F.locate("] ", line) + 2, F.length(line))
    own = rows.withColumns({"line_id": mine(part(1)), "flag": mine(part(2)), "initial": mine(part(3)), "content": mine(content)})
    own = own.withColumns({"cells": T.cells(F.col("content")), "runs": P.line_runs(F.col("content"), F.col("flag"), F.col("initial"))})
    first = F.get("runs", 0)
    led = (F.col("flag") == ">>") | first["text"].rlike(r"^\s") | (first["text"] == "")
    split_cell = F.exists("cells", lambda c: c["span_id"].isNotNull() & (F.size(T.parse_emphasis(c["text"])) != 1))
    bad = lambda rule, test, detail=none: (rule, F.when(F.coalesce(test, F.lit(False)), found(rule, path, at, detail)))
    once = lambda rule, test, key: (rule, F.when(F.coalesce(test, F.lit(False)), found(rule, path, F.concat_ws(":", path, key), once=True)))
    labels = F.filter(F.coalesce(F.transform("runs", lambda r: r["span_id"]), F.array().cast("array<string>")), lambda x: x.isNotNull())
    of_line = asked(
        bad("V3", in_head & (colon == 0)), bad("V9", kind == "unknown", line), bad("V10", (kind != "unknown") & (F.col("zone").isNull() | (n < F.col("zone")))),
        bad("V14", mine((F.col("flag") == ">>") & (F.size("cells") > 1))), bad("V15", mine(F.get("cells", 0)["span_id"].isNotNull())),
        bad("V15", mine(split_cell), F.lit("a labelled cell is one run")),
        bad("V16", mine((F.col("initial") != "") & F.col("runs").isNotNull() & F.coalesce(led, F.lit(True)))),
        bad("V28", mine(F.exists("cells", lambda c: ~T.emphasis_is_valid(c["text"])))),
        once("V3", in_head & (colon > 0), line.substr(F.lit(1), colon - 1)), once("V12", kind == "line", F.col("line_id")),
        once("V13", kind == "zone", F.regexp_extract("line", P.ZONE, 1)),
    )
    of_labels = asked(("V17", F.transform(labels, lambda x: found("V17", path, F.concat_ws(":", "path", "line_id", x), once=True))))
    here = F.slice("of_page", F.lit(1), F.when(F.col("pos") == 0, F.size("of_page")).otherwise(0))  # told with the first line
    said = F.concat(here, F.array(*of_line, F.lit(None).cast(FOUND)), *of_labels)
    each = own.select(F.explode(F.array_compact(said)).alias("v")).select("v.*")
    each = each.groupBy("page", "rule", "key", "detail", "once").agg(F.count(F.lit(1)).alias("n")).where("NOT once OR n > 1")
    return each.select("rule", "key", F.when(F.col("once"), F.col("n").cast("string")).otherwise(F.col("detail")).alias("detail"))


def run_violations(lines: DataFrame, rules: list[str] | None = None) -> DataFrame:
    """Rules of compiled lines (V21-V24, V58; those of ``rules`` only, if given) over ``sources.pages.registry``, in one pass over the lines."""
    asked = lambda rule: rules is None or rule in rules
    if asked("V22"):  # Python sees only the lines that need it
        texts = F.transform("runs", lambda r: r["text"])
        plain = F.forall(texts, T.seems_composed)
        lines = lines.withColumns({"_plain": plain, "_composed": T.are_nfc(F.when(plain, None).otherwise(texts))})

    def of_run(r: Column, i: Column) -> Column:
        big = F.coalesce(r["layout"] == "large-initial", F.lit(False))
        placement = F.coalesce(r["placement"], F.lit("normal"))
        fine = (i == 0) & (F.length(r["text"]) == 1) & (F.trim(r["text"]) != "") & (placement == "normal") & (r["line_span"] >= 2)
        led = F.when(big, ~F.coalesce(fine, F.lit(False))).otherwise(r["layout"].isNotNull() | r["line_span"].isNotNull())
        said = [F.when(led, F.lit("V23"))] if asked("V23") else []
        if asked("V22"):
            typed = r["typeface"].isin(model.TYPEFACES) & placement.isin(model.PLACEMENTS) & (F.length(r["text"]) > 0)
            typed = typed & (F.coalesce("_plain", F.lit(False)) | F.get("_composed", i))
            said.append(F.when(~F.coalesce(typed, F.lit(False)), F.lit("V22")))
        return F.array(F.lit(None).cast("string"), *said)

    of_line = [
        F.when(test, F.lit(rule))
        for rule, test in (
            ("V21", F.coalesce("indent", F.lit(0)) < 0), ("V22", F.coalesce(F.size("runs") < 1, F.lit(True))),
            ("V58", F.coalesce(C.line_text(F.col("runs")).contains("="), F.lit(True))), ("V24", F.lit(True)),
        )
        if asked(rule)
    ]
    said = F.array_compact(F.concat(F.array(F.lit(None).cast("string"), *of_line), F.coalesce(F.flatten(F.transform("runs", of_run)), F.array().cast("array<string>"))))
    found = lines.select(F.explode(said).alias("rule"), F.col("line_ref").alias("key")).groupBy("rule", "key").agg(F.count(F.lit(1)).alias("n"))
    once = F.col("rule") == "V24"  # a key that only one line has is no violation; of all else, each is one
    times = F.when(~once, F.col("n")).otherwise((F.col("n") > 1).cast("long")).cast("int")
    detail = F.when(once, F.col("n").cast("string"))
    return found.where(~once | (F.col("n") > 1)).select("rule", "key", F.explode(F.array_repeat(detail, times)).alias("detail"))


def structure_violations(items: DataFrame, lines: DataFrame) -> DataFrame:
    """Rules of assertions and sequences (V25-V27) over (id, kind, refs array of selectors)."""
    refs = items.select("id", "kind", F.explode("refs").alias("s")).withColumn("line_ref", F.col("s.line"))
    found = refs.join(lines.select("line_ref", "runs"), "line_ref", "left")
    said = P.selected_text(F.col("runs"), F.col("s.runs"), F.col("s.span"))
    join = F.coalesce("s.join", F.lit("space"))
    return all_of(
        duplicates(items, "V25", "id"),
        violations(items, "V26", F.size("refs") < 1, F.col("id")),
        violations(found, "V26", F.col("runs").isNull() | said.isNull(), F.col("id"), F.col("line_ref")),
        violations(found.where(F.col("kind") == "sequence"), "V26", ~join.isin(model.JOINS), F.col("id"), join),
    )


def review_violations(reviews: DataFrame) -> DataFrame:
    """Rules of review records (V29) over (id, units map<string, struct<status, reviewer, reviewed_at>>)."""
    units = reviews.select("id", F.explode("units").alias("unit", "u"))
    named = F.array_sort(F.map_keys("units")) == F.array(F.lit("column-1"), F.lit("column-2"), F.lit("furniture"))
    states = ["pending", "partial", "checked", "needs_correction", "not_applicable"]
    signed = F.col("u.reviewer").isNotNull() & F.col("u.reviewed_at").isNotNull()
    return all_of(
        violations(reviews, "V29", ~named, F.col("id")),
        violations(units, "V29", ~F.col("u.status").isin(states), F.col("id"), F.col("u.status")),
        violations(units, "V29", (F.col("u.status") == "checked") & ~signed, F.col("id"), F.col("unit")),
    )


def geometry_violations(rects: DataFrame) -> DataFrame:
    """Rules of line geometry (V37, V38) over (line_ref, crop, context_crop, width, height)."""
    key = F.col("line_ref")
    inside = G.in_page(F.col("crop"), F.col("width"), F.col("height")) & G.in_page(F.col("context_crop"), F.col("width"), F.col("height"))
    return all_of(
        violations(rects, "V37", ~inside, key), violations(rects, "V38", ~G.contains(F.col("context_crop"), F.col("crop")), key)
    )


def override_violations(overrides: DataFrame, lines: DataFrame) -> DataFrame:
    """Rules of overrides (V36) over (line_ref, values array<int>): known lines, one or four numbers."""
    return all_of(
        unresolved(overrides, lines, "V36", "line_ref"),
        violations(overrides, "V36", ~F.size("values").isin(1, 4) | F.exists("values", lambda v: v.isNull()), F.col("line_ref")),
    )


def external_review_violations(reviews: DataFrame, current: DataFrame, geometry_only: bool = False, any_text: bool = False) -> DataFrame:
    """Rules of an external review (V39, V40): complete, and for the text and image that are current."""
    r = reviews.join(current, "page", "left")
    done = (F.col("response_status") == "complete") | (F.lit(geometry_only) & (F.col("geometry_review_status") == "complete"))
    image = (F.col("sha256") == F.col("now_sha256")) & (F.col("width") == F.col("now_width")) & (F.col("height") == F.col("now_height"))
    return all_of(
        violations(r, "V39", ~done, F.col("page")),
        violations(r, "V40", ~(F.lit(any_text) | (F.col("text_sha256") == F.col("now_text_sha256"))), F.col("page"), F.lit("text")),
        violations(r, "V40", ~image, F.col("page"), F.lit("image")),
    )


def tile_violations(configs: DataFrame) -> DataFrame:
    """Rules of tile settings (V30, V55) over (id, box, width, height, line_span array, tiles, overlap)."""
    a, b = F.get("line_span", 0), F.get("line_span", 1)
    span = F.col("line_span").isNull() | ((F.size("line_span") == 2) & (a >= 0) & (a < b) & (b <= 100))
    return all_of(
        violations(configs, "V30", ~(G.box_is_valid(F.col("box"), F.col("width"), F.col("height")) & span), F.col("id")),
        violations(configs, "V55", ~G.tiles_are_valid(F.col("box"), F.col("tiles"), F.col("overlap")), F.col("id")),
    )


def payload_violations(payloads: DataFrame) -> DataFrame:
    """Rules of correction payloads (V43, V44) over (issue, payload)."""
    p = F.col("payload")
    said = lambda c: F.length(F.coalesce(c, F.lit(""))) > 0
    head = (p["schema"] == 2) & said(p["base_commit"]) & said(p["base_transcription_version"]) & p["page"].rlike("^f[1-9][0-9]*$")
    changes = payloads.select("issue", F.explode(p["changes"]).alias("c"))
    whole = F.col("c.line").isNotNull() & F.col("c.before").isNotNull() & F.col("c.after").isNotNull()
    return all_of(
        violations(payloads, "V43", ~(F.coalesce(head, F.lit(False)) & (F.coalesce(F.size(p["changes"]), F.lit(0)) > 0)), F.col("issue")),
        violations(changes, "V44", ~whole, F.col("issue")),
        duplicates(changes.select("issue", F.col("c.line").alias("line")), "V44", "issue", "line"),
    )


def correction_violations(log: DataFrame) -> DataFrame:
    """Rules of the correction log."""
    key = F.col("event_id")
    return all_of(
        violations(log, "V57", ~key.rlike(r"^[a-z0-9]+(-[a-z0-9]+)*$"), key, F.lit("id")),
        violations(log, "V57", ~F.col("page").rlike(r"^(bnf-)?f[0-9]+$"), key, F.lit("page")),
        violations(log, "V57", ~(F.col("step").try_cast("int") >= 1), key, F.lit("step")),
        violations(log, "V57", F.col("before").eqNullSafe(F.col("after")), key, F.lit("no change")),
        violations(log, "V57", ~F.col("outcome").isin(model.OUTCOMES), key, F.lit("outcome")),
        violations(log, "V57", (F.coalesce("categories", F.lit("")) == "") | (F.coalesce("provenance", F.lit("")) == ""), key, F.lit("empty")),
        duplicates(log, "V57", "event_id"),
    )


def history_violations(history: DataFrame) -> DataFrame:
    """Stored aggregates that differ from the issues they stand for."""
    i = F.explode_outer("issues")
    flat = history.select("id", "issues_applied", "accepted_edits", "distinct_lines", "last_applied", i.alias("x"))
    lines = flat.select("*", F.explode_outer("x.lines").alias("line"))
    now = lines.groupBy("id").agg(F.count_distinct("x.number").alias("a"), F.count("line").alias("b"), F.count_distinct("line").alias("c"))
    last = F.try_element_at("issues", F.lit(-1))["applied_at"]
    both = history.withColumn("last", last).join(now, "id")
    same = (F.col("issues_applied") == F.col("a")) & (F.col("accepted_edits") == F.col("b")) & (F.col("distinct_lines") == F.col("c"))
    return violations(both, "V50", ~(same & F.col("last_applied").eqNullSafe(F.col("last"))), F.col("id"))


def headword_violations(rows: DataFrame, number: str, id_: str, link: str, base: str, position: str, n: int | None = None) -> DataFrame:
    """Rules of the headword table."""
    parts = [
        violations(rows, "V51", F.col(number).try_cast("long") != F.col(position), F.col(number), F.lit("sequence")),
        violations(rows, "V51", F.coalesce(F.col(id_), F.lit("")) == "", F.col(number), F.lit("empty id")),
        duplicates(rows, "V51", id_),
        violations(rows, "V51", (F.coalesce(link, F.lit("")) != "") & ~T.has_prefix(F.col(link), base), F.col(number), F.lit("link")),
    ]
    return all_of(*parts, *([wrong_count(rows, "V51", n)] if n is not None else []))


def image_violations(found: DataFrame) -> DataFrame:
    """Rules of images (V53) over ``sources.files.images``."""
    return violations(found, "V53", (F.col("bytes") < 10_000) | F.col("size.error").isNotNull(), F.col("path"), F.col("size.error"))


def digest_violations(manifest: DataFrame, found: DataFrame) -> DataFrame:
    """Recorded digests that are not the files' (V54)."""
    both = manifest.select("id", "path", F.col("sha256").alias("said")).join(found.select("path", "sha256"), "path", "left")
    return violations(both, "V54", ~F.col("said").eqNullSafe(F.col("sha256")), F.col("id"))


def state_violations(columns: DataFrame, allowed: list[str]) -> DataFrame:
    """Columns without geometry or in a state that is not on the list."""
    return violations(columns, "V33", F.col("geometry").isNull() | ~F.col("state").isin(allowed), F.col("key"), F.col("state"))


def path_violations(changed: DataFrame, expected: DataFrame) -> DataFrame:
    """Changed paths that were not expected."""
    return unresolved(changed, expected, "V48", "path")


def joined_word_violations(segments: DataFrame) -> DataFrame:
    """``word`` joins without a division mark before them (V27) over (id, pos, text, join)."""
    w = Window.partitionBy("id").orderBy("pos")
    before = F.lag("text").over(w)
    marked = segments.withColumn("before", before)
    return violations(marked.where((F.col("join") == "word") & F.col("before").isNotNull()), "V27", ~F.col("before").rlike("[-=]$"), F.col("id"))
