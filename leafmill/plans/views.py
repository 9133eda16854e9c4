"""Derived views: the corpus snapshot, page views, reading sequences, reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leafmill.functions import content as C
from leafmill.functions import text as T
from leafmill.operators.ordered import assembled
from leafmill.sources.pages import selected_text


def page_view(pages: DataFrame) -> DataFrame:
    """(id, body): each page as a table of physical lines with main and far-right text (K3)."""
    face = lambda r: F.struct(r["typeface"].alias("typeface"), r["text"].alias("text"))

    def said(runs: Column, far: bool) -> Column:
        own = F.filter(runs, lambda r: r["placement"].eqNullSafe("far-right") == F.lit(far))
        none = F.slice(F.transform(own, face), 1, 0)

        def push(done: Column, r: Column) -> Column:
            last = F.try_element_at(done, F.lit(-1))
            front = F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0)))
            one = F.struct(r["typeface"].alias("typeface"), F.concat(last["text"], r["text"]).alias("text"))
            return F.when(last["typeface"] == r["typeface"], F.concat(front, F.array(one))).otherwise(F.concat(done, F.array(r)))

        joined = F.aggregate(F.transform(own, face), none, push)
        return F.array_join(F.transform(joined, T.marked_text), "")

    def line(x: Column) -> Column:
        indent = F.repeat(F.lit("&emsp;"), F.coalesce(x["indent"], F.lit(0)))
        return F.concat(F.lit("| `"), x["id"], F.lit("` | "), indent, said(x["runs"], False), F.lit(" | "), said(x["runs"], True), F.lit(" |"))

    def zone(z: Column) -> Column:
        empty = F.array().cast("array<string>")
        note = F.when(z["note"].isNotNull(), F.array(z["note"], F.lit(""))).otherwise(empty)
        head = F.array(F.lit("| Physical line | Main position | Far right |"), F.lit("| --- | --- | --- |"))
        table = F.when(F.size(z["lines"]) > 0, F.concat(head, F.transform(z["lines"], line), F.array(F.lit("")))).otherwise(empty)
        return F.concat(F.array(F.concat(F.lit("## "), F.coalesce(z["label"], z["id"])), F.lit("")), note, table)

    top = F.array(
        F.concat(F.lit("# Page view: "), F.col("id")), F.lit(""), F.concat(F.lit("Source: "), F.col("source.url")), F.lit(""),
        F.concat(F.lit("Scope: `"), F.col("scope"), F.lit("`")), F.lit(""),
    )
    whole = F.array_join(F.concat(top, F.flatten(F.transform("zones", zone))), "\n")
    return pages.select("id", F.concat(F.regexp_replace(whole, r"\s+$", ""), F.lit("\n")).alias("body"))


def readings(sequences: DataFrame, lines: DataFrame) -> DataFrame:
    """(id, label, text, valid) of reading sequences (id, label, segments) over the lines."""
    each = sequences.select("id", "label", F.posexplode("segments").alias("pos", "s")).withColumn("line_ref", F.col("s.line"))
    found = each.join(lines.select("line_ref", "runs"), "line_ref", "left")
    text = selected_text(F.col("runs"), F.col("s.runs"), F.col("s.span"))
    item = F.struct("pos", text.alias("text"), F.coalesce("s.join", F.lit("space")).alias("join"))
    grouped = found.groupBy("id", "label").agg(F.array_sort(F.collect_list(item)).alias("parts"))
    return grouped.withColumn("x", assembled(F.col("parts"))).select("id", "label", "x.text", "x.valid")


def snapshot(leaves: DataFrame, pages: DataFrame, sides: dict[str, DataFrame]) -> DataFrame:
    """One row a leaf: page id, whether it is processed, and the side records or null."""
    out = leaves.withColumn("id", C.page_id(F.col("leaf"))).withColumn("view", C.view_id(F.col("leaf")))
    out = out.join(pages.withColumn("_there", F.lit(True)), "id", "left").withColumn("processed", F.coalesce("_there", F.lit(False))).drop("_there")
    for name, side in sides.items():
        fields = [c for c in side.columns if c != "id"]
        out = out.join(side.select("id", F.struct(*fields).alias(name)), "id", "left")
    return out


def summary(rows: DataFrame) -> DataFrame:
    """Pages, processed, unprocessed and corrected ones (A2)."""
    return rows.agg(
        F.count(F.lit(1)).alias("pages"),
        F.count_if("processed").alias("processed"),
        F.count_if(~F.col("processed")).alias("unprocessed"),
        F.count_if(F.coalesce("issues_applied", F.lit(0)) > 0).alias("corrected"),
    )


def overview(rows: DataFrame, show: str) -> DataFrame:
    """The rows of an overview."""
    keep = {
        "all": F.lit(True), "processed": F.col("processed"), "unprocessed": ~F.col("processed"),
        "corrected": F.coalesce("issues_applied", F.lit(0)) > 0,
    }
    return rows.where(keep[show])


def navigation(units: DataFrame) -> DataFrame:
    """(page, unit) in order with the ones before and after, and "k of n" of each page.

    The sequence runs over pages, so neighbours at a page's edge come from the adjacent page.
    """
    first = F.struct("unit_pos", "unit")
    edges = units.groupBy("leaf").agg(F.min(first).alias("first"), F.max(first).alias("last"), F.count(F.lit(1)).alias("n"))
    return units.join(edges, "leaf").select(
        "leaf", "unit", (F.col("unit_pos") + 1).alias("k"), "n",
        (F.col("unit_pos") == F.col("first.unit_pos")).alias("first_of_page"), (F.col("unit_pos") == F.col("last.unit_pos")).alias("last_of_page"),
    )


def differs(generated: DataFrame, existing: DataFrame) -> DataFrame:
    """Rows of one side only, counted (K10): none if a check passes."""
    a = generated.exceptAll(existing).withColumn("side", F.lit("generated"))
    return a.unionByName(existing.exceptAll(generated).withColumn("side", F.lit("existing")))


def write_documents(rows: DataFrame, path: str, body: str = "body") -> None:
    """One text record a row (K1-K5, K8, K9): Spark's commit protocol makes the write atomic."""
    rows.select(body).write.mode("overwrite").text(path)


def write_snapshot(rows: DataFrame, path: str) -> None:
    rows.write.mode("overwrite").json(path)
