"""Page files: the compact text format, its export, and compiled JSON.

A page file is one row (``wholetext``), so its lines have an order inside the row and
windows over them are bounded by the page.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill import model
from leafmill.functions import text as T

ZONE = r"^## ([a-z0-9-]+) \[([a-z0-9_-]+)\] (.+)$"
LINE = r"^\[([a-z0-9-]+)(?: (>>|>))?(?: initial=([2-9][0-9]*))?\] (.*)$"
BREAKS = r"\r\n|[\n\r\u000B\u000C\u001C-\u001E\u0085  ]"
OTHER = "[\r\u000b\u000c\u001c\u001d\u001e\u0085\u2028\u2029]"  # breaks but for \n
LINE_HEAD = LINE.removesuffix("(.*)$")


def compact_files(spark: SparkSession, path: str) -> DataFrame:
    """(path, body): page files as they are."""
    return spark.read.option("wholetext", True).text(path).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("body"))


def text_lines(body: Column) -> Column:
    """The lines of a text; a break at its end begins none.  Only a text with other breaks than ``\\n`` is searched for them."""
    plain = F.when(body.rlike(OTHER), F.regexp_replace(body, BREAKS, "\n")).otherwise(body)
    return F.split(F.regexp_replace(plain, r"\n\z", ""), "\n", -1)


def numbered(files: DataFrame) -> DataFrame:
    """(path, n, line): lines of the files, from 1."""
    lines = text_lines(F.col("body"))
    return files.select("path", F.posexplode(lines).alias("pos", "line")).select("path", (F.col("pos") + 1).alias("n"), "line")


def paged(files: DataFrame, *keep: str) -> DataFrame:
    """A row for each file with ``keep``: its path, ``lines``, the numbers of the first two ``---`` (``opened``, ``closed``; 0 if there is none),
    ``head``, the lines between them, and ``zones``, the numbers of the zone headings behind them."""
    rows = files.select("path", *keep, F.explode(F.array(text_lines(F.col("body")))).alias("lines"))  # exploded, so that no step splits again
    rows = rows.withColumn("opened", F.array_position("lines", "---").cast("int"))
    second = F.array_position(F.slice("lines", F.col("opened") + 1, F.greatest(F.size("lines") - F.col("opened"), F.lit(0))), "---").cast("int")
    rows = rows.withColumn("closed", F.when((F.col("opened") > 0) & (second > 0), F.col("opened") + second).otherwise(0))
    until = F.when(F.col("closed") > 0, F.col("closed") - 1).otherwise(F.size("lines"))
    none = F.array().cast("array<string>")
    head = F.when(F.col("opened") > 0, F.slice("lines", F.col("opened") + 1, until - F.col("opened"))).otherwise(none)
    heading = lambda x, i: F.when((i >= F.col("closed")) & x.startswith("## ") & x.rlike(ZONE), i + 1)
    zones = F.filter(F.transform("lines", heading), lambda i: i.isNotNull())
    return rows.withColumns({"head": head, "zones": F.when(F.col("closed") > 0, zones).otherwise(F.array().cast("array<int>"))})


def zone_ends() -> Column:
    """For each of ``zones``, the number of the line behind it."""
    behind = F.concat(F.slice("zones", F.lit(2), F.greatest(F.size("zones") - 1, F.lit(0))), F.array(F.size("lines") + 1))
    return F.slice(behind, F.lit(1), F.size("zones"))


def said_in_head(key: str) -> Column:
    """The first value of a key in ``head``."""
    line = F.get(F.filter("head", lambda x: x.startswith(f"{key}: ")), 0)
    return F.substring(line, len(key) + 3, 2**31 - 1)


def header(lines: DataFrame) -> DataFrame:
    """(path, n, key, value) of the block between the first two ``---``; key null where the form is wrong."""
    w = Window.partitionBy("path").orderBy("n")
    fences = F.count_if(F.col("line") == "---").over(w)
    at = F.locate(": ", F.col("line"))
    return (
        lines.withColumn("f", fences)
        .where((F.col("f") == 1) & (F.col("line") != "---"))
        .select(
            "path", "n",
            F.when(at > 0, F.col("line").substr(F.lit(1), at - 1)).alias("key"),
            F.when(at > 0, F.col("line").substr(at + 2, F.length("line"))).alias("value"),
        )
    )


def metadata(lines: DataFrame) -> DataFrame:
    """(path, meta map) with the first value of each key."""
    entries = header(lines).where("key IS NOT NULL").groupBy("path", "key").agg(F.min_by("value", "n").alias("value"))
    return entries.groupBy("path").agg(F.map_from_entries(F.collect_list(F.struct("key", "value"))).alias("meta"))


def marked(lines: DataFrame) -> DataFrame:
    """All lines with ``fences``, the ``---`` up to each, the kind of those in the body (else null), and the zone heading they stand under."""
    w = Window.partitionBy("path").orderBy("n")
    kind = (
        F.when(F.col("line").rlike(ZONE), "zone").when(F.col("line").startswith("> "), "note").when(F.col("line").rlike(LINE), "line").otherwise("unknown")
    )
    known = lines.withColumn("fences", F.count_if(F.col("line") == "---").over(w))
    known = known.withColumn("kind", F.when((F.col("fences") >= 2) & (F.col("line") != "---") & (F.col("line") != ""), kind))
    return known.withColumn("zone_n", F.last(F.when(F.col("kind") == "zone", F.col("n")), ignorenulls=True).over(w))


def body(lines: DataFrame) -> DataFrame:
    """Body lines with their kind and the zone heading they stand under."""
    return marked(lines).where("kind IS NOT NULL").drop("fences")


def line_runs(content: Column, flag: Column, initial: Column) -> Column:
    """Runs of a line: cells (the second on far right), emphasis, a large initial."""

    def cell(c: Column, i: Column) -> Column:
        far = (i > 0) | (flag == ">>")
        return F.transform(
            T.parse_emphasis(c["text"]),
            lambda r: F.struct(
                r["typeface"].alias("typeface"), r["text"].alias("text"),
                F.when(far, "far-right").alias("placement"), F.lit(None).cast("string").alias("layout"),
                F.lit(None).cast("int").alias("line_span"), c["span_id"].alias("span_id"),
            ),
        )

    def led(runs: Column) -> Column:
        first = F.try_element_at(runs, F.lit(1))
        big = first.withField("text", F.substring(first["text"], 1, 1)).withField("layout", F.lit("large-initial"))
        big = big.withField("line_span", initial.try_cast("int"))
        rest = first.withField("text", first["text"].substr(F.lit(2), F.length(first["text"])))
        head = F.when(F.length(first["text"]) > 1, F.array(big, rest)).otherwise(F.array(big))
        after = F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 1, F.lit(0)))
        return F.when((initial != "") & (F.size(runs) > 0), F.concat(head, after)).otherwise(runs)

    none = F.lit(None).cast("string")
    one = F.struct(
        F.lit("roman").alias("typeface"), content.alias("text"), F.when(flag == ">>", "far-right").alias("placement"), none.alias("layout"),
        F.lit(None).cast("int").alias("line_span"), none.alias("span_id"),
    )
    plain = (initial == "") & (F.length(content) > 0) & ~F.contains(content, F.lit("*")) & T.is_one_cell(content)
    return F.when(plain, F.array(one)).otherwise(T.bound(F.flatten(F.transform(T.cells(content), cell)), led))


def flat_lines(lines: DataFrame) -> DataFrame:
    """(path, n, zone_n, line_id, flag, initial, content, indent, runs) of the physical lines."""
    return read_lines(body(lines))


def read_lines(rows: DataFrame) -> DataFrame:
    """``flat_lines`` of rows of ``body`` or ``marked``."""
    own = rows.where(F.col("kind") == "line")
    part = lambda i: F.regexp_extract("line", LINE, i)
    read = own.select("path", "n", "zone_n", part(1).alias("line_id"), part(2).alias("flag"), part(3).alias("initial"), part(4).alias("content"))
    return read.withColumn("indent", F.when(F.col("flag") == ">", 1)).withColumn(
        "runs", line_runs(F.col("content"), F.col("flag"), F.col("initial"))
    )


def compiled(files: DataFrame) -> DataFrame:
    """Pages in the schema of the compiled JSON; compare ``checks.page_violations`` first."""
    part = lambda x, i: F.regexp_extract(x, LINE_HEAD, i)

    def record(x: Column) -> Column:
        content = F.substring(x, F.locate("] ", x) + 2, F.length(x))
        return F.struct(part(x, 1).alias("id"), F.when(part(x, 2) == ">", 1).alias("indent"), line_runs(content, part(x, 2), part(x, 3)).alias("runs"))

    def zone(at: Column, until: Column) -> Column:
        head = lambda i: F.regexp_extract(F.get("lines", at - 1), ZONE, i)
        own = F.slice("lines", at + 1, until - at - 1)
        note = F.get(F.filter(own, lambda x: x.startswith("> ")), 0)
        lines = F.transform(F.filter(own, lambda x: x.startswith("[") & x.rlike(LINE_HEAD)), record)
        some = F.filter(F.array(lines), lambda x: F.size(x) > 0)  # null without lines
        return F.struct(
            head(1).alias("id"), head(2).alias("kind"), head(3).alias("label"), F.substring(note, 3, 2**31 - 1).alias("note"), F.get(some, 0).alias("lines")
        )

    rows = paged(files).where((F.size("zones") > 0) & F.exists("head", lambda x: F.contains(x, F.lit(": "))))
    m = said_in_head
    return rows.select(
        "path",
        F.lit(model.PAGE_FORMAT).alias("format"),
        F.lit(model.PAGE_VERSION).alias("format_version"),
        m("id").alias("id"),
        F.struct(m("source").alias("repository"), m("view").alias("view"), m("url").alias("url"), m("sha256").alias("master_sha256")).alias("source"),
        m("scope").alias("scope"),
        F.struct(
            m("origin").alias("origin"),
            T.strict_bool(m("wikisource")).alias("wikisource_used_for_this_trial"),
            (m("lineation") == "checked").alias("physical_lineation_checked"),
            m("status").alias("status"),
            m("external-check").alias("external_check_scope"),
        ).alias("review"),
        F.explode(F.array(F.zip_with("zones", zone_ends(), zone))).alias("zones"),  # exploded, so that no reader of some fields parses again
    )


def exported(pages: DataFrame) -> DataFrame:
    """(id, body): the compact text of compiled pages (K2); parsing it again gives the pages."""
    text = lambda runs: F.array_join(F.transform(runs, T.marked_text), "")

    def line(x: Column) -> Column:
        far = F.filter(x["runs"], lambda r: r["placement"].eqNullSafe("far-right"))
        main = F.filter(x["runs"], lambda r: ~r["placement"].eqNullSafe("far-right"))
        span = F.filter(x["runs"], lambda r: r["layout"].eqNullSafe("large-initial"))
        only_far = (F.size(far) > 0) & (F.size(main) == 0)
        flag = F.when(only_far, " >>").when(x["indent"] == 1, " >").otherwise("")
        initial = F.when(F.size(span) > 0, F.concat(F.lit(" initial="), F.get(span, 0)["line_span"].cast("string"))).otherwise("")
        cell = lambda r: F.when(
            r["span_id"].isNotNull(), F.concat(F.lit(" || {"), r["span_id"], F.lit("}"), T.marked_text(r))
        ).otherwise(F.concat(F.lit(" || "), F.ltrim(T.marked_text(r))))
        cells = F.array_join(F.transform(far, cell), "")
        content = F.when(only_far, text(far)).otherwise(F.concat(text(main), cells))
        return F.concat(F.lit("["), x["id"], flag, initial, F.lit("] "), content)

    def zone(z: Column) -> Column:
        head = F.concat(F.lit("## "), z["id"], F.lit(" ["), z["kind"], F.lit("] "), F.coalesce(z["label"], z["id"]))
        note = F.when(z["note"].isNotNull(), F.array(F.concat(F.lit("> "), z["note"]), F.lit(""))).otherwise(F.array().cast("array<string>"))
        lines = F.coalesce(F.transform(z["lines"], line), F.array().cast("array<string>"))
        return F.concat(F.array(head, F.lit("")), note, lines, F.array(F.lit("")))

    s, r = F.col("source"), F.col("review")
    pairs = [
        ("format", F.lit(model.COMPACT_FORMAT)), ("version", F.lit(model.COMPACT_VERSION)), ("id", F.col("id")), ("source", s["repository"]),
        ("view", s["view"]), ("url", s["url"]), ("sha256", s["master_sha256"]), ("scope", F.col("scope")), ("origin", r["origin"]),
        ("wikisource", r["wikisource_used_for_this_trial"].cast("string")), ("lineation", F.lit("checked")), ("status", r["status"]),
    ]
    head = [F.lit("---"), *[F.concat(F.lit(f"{k}: "), v) for k, v in pairs]]
    extra = F.when(r["external_check_scope"].isNotNull(), F.array(F.concat(F.lit("external-check: "), r["external_check_scope"]))).otherwise(
        F.array().cast("array<string>")
    )
    whole = F.concat(F.array(*head), extra, F.array(F.lit("---"), F.lit("")), F.flatten(F.transform("zones", zone)))
    return pages.select("id", F.concat(F.regexp_replace(F.array_join(whole, "\n"), r"\s+$", ""), F.lit("\n")).alias("body"))


def page_json(spark: SparkSession, path: str) -> DataFrame:
    """Compiled pages, one document a file."""
    return spark.read.schema(model.PAGE).option("multiLine", True).json(path)


def registry(pages: DataFrame) -> DataFrame:
    """Flat lines of compiled pages with their positions and global reference."""
    zones = pages.select(F.col("id").alias("page_id"), F.posexplode("zones").alias("zone_pos", "z"))
    lines = zones.select("page_id", "zone_pos", F.col("z.id").alias("zone_id"), F.col("z.kind").alias("zone_kind"), F.posexplode("z.lines").alias("line_pos", "x"))
    return lines.select(
        "page_id", "zone_pos", "zone_id", "zone_kind", "line_pos", F.col("x.id").alias("line_id"), F.col("x.indent").alias("indent"),
        F.col("x.runs").alias("runs"), F.concat_ws(":", "page_id", "x.id").alias("line_ref"),
    )


def printed_number(lines: DataFrame) -> DataFrame:
    """The first run of a running header that is all digits, for each page; null if none (P5)."""
    runs = lines.where(F.col("zone_kind") == "running_header").select(
        "page_id", "zone_pos", "line_pos", F.posexplode("runs").alias("run_pos", "r")
    )
    said = runs.withColumn("text", T.strip(F.col("r.text"))).where(F.col("text").rlike(r"^\p{Nd}+$"))
    found = said.groupBy("page_id").agg(F.min_by("text", F.struct("zone_pos", "line_pos", "run_pos")).alias("printed"))
    return lines.select("page_id").distinct().join(found, "page_id", "left")


def unit_of(zone_id: Column, kind: Column, n: int) -> Column:
    """Whether a zone is column ``n`` by exact id."""
    return zone_id.isin(f"header-column-{n}", f"column-{n}") if n else kind != "column"


def unit_contains(zone_id: Column, unit: Column) -> Column:
    """The same by substring, split columns included."""
    return zone_id.contains(unit)


def selected_text(runs: Column, indexes: Column, span: Column) -> Column:
    """Text of the runs selected by index or by span name; null if the selection is not valid."""
    named = F.filter(runs, lambda r: r["span_id"] == span)
    fine = F.forall(indexes, lambda i: (i >= 0) & (i < F.size(runs)))
    picked = F.array_join(F.transform(indexes, lambda i: F.get(runs, i)["text"]), "")
    return (
        F.when(indexes.isNotNull() & span.isNotNull(), None)
        .when(span.isNotNull(), F.when(F.size(named) == 1, F.get(named, 0)["text"]))
        .when(indexes.isNotNull(), F.when(fine, picked))
        .otherwise(F.array_join(F.transform(runs, lambda r: r["text"]), ""))
    )


def placed(runs: Column) -> Column:
    """struct(main, far) of the runs of a line."""
    far = lambda r: r["placement"].eqNullSafe("far-right")
    return F.struct(F.filter(runs, lambda r: ~far(r)).alias("main"), F.filter(runs, far).alias("far"))


def in_page_range(rows: DataFrame, page_id: str, first: int | None = None, last: int | None = None) -> DataFrame:
    """Rows whose page id ends in ``f`` and a number within bounds, of which either may be absent (P10)."""
    number = F.regexp_extract(page_id, r"f(\d+)$", 1)
    value = F.when(number != "", number.cast("int"))
    return rows.where((value >= (0 if first is None else first)) & (F.lit(True) if last is None else value <= last))


def eligible_columns(columns: DataFrame, source: str, state: str, target: str) -> DataFrame:
    """Reviewed columns that are not yet in the target state."""
    return columns.where(F.col(source).isNotNull() & ~F.col(state).eqNullSafe(target))


def column_bodies(zones: DataFrame, kind: str = "kind", lines: str = "lines") -> DataFrame:
    """Zones that are columns and have a line."""
    return zones.where((F.col(kind) == "column") & (F.size(lines) > 0))


def has_literal_equals(line: Column) -> Column:
    """Whether a raw line of a page has ``=`` in its text, behind its bracket."""
    return line.startswith("[") & (F.locate("] ", line) > 0) & F.contains(F.substring(line, F.locate("] ", line) + 2, F.length(line)), F.lit("="))


def leaf_set(spark: SparkSession, first: int, last: int, extras: list[int]) -> DataFrame:
    """Leaves of a contiguous range and some beside it, each once."""
    return spark.range(first, last + 1).select(F.col("id").cast("int").alias("leaf")).union(
        spark.range(1).select(F.explode(F.array(*map(F.lit, extras))).alias("leaf"))
    ).distinct()
