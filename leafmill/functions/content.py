"""Content addressing: versions of lines and pages, digests of files."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def line_text(runs: Column) -> Column:
    """The run texts in order."""
    return F.array_join(F.transform(runs, lambda r: r["text"]), "")


def version_struct(line_id: Column, runs: Column) -> Column:
    """What a correction targets: id, text, and of each run typeface, text, layout and span."""
    kept = F.transform(
        runs,
        lambda r: F.struct(
            r["typeface"].alias("typeface"), r["text"].alias("text"), r["layout"].alias("layout"), r["line_span"].alias("line_span")
        ),
    )
    return F.struct(line_id.alias("id"), line_text(runs).alias("text"), kept.alias("runs"))


def content_hash(value: Column) -> Column:
    """``sha256:`` of compact JSON; absent keys are absent, since null fields are not written."""
    return F.concat(F.lit("sha256:"), F.sha2(F.to_json(value), 256))


def line_version(line_id: Column, runs: Column) -> Column:
    return content_hash(version_struct(line_id, runs))


def page_version(lines: Column) -> Column:
    """Version of an ordered array of lines (id, runs)."""
    return content_hash(F.transform(lines, lambda x: version_struct(x["id"], x["runs"])))


def is_digest(text: Column) -> Column:
    """64 lower-case hexadecimal digits."""
    return F.coalesce(text.rlike("^[0-9a-f]{64}$"), F.lit(False))


def file_digest(content: Column) -> Column:
    """SHA-256 of bytes."""
    return F.sha2(content, 256)


def page_id(leaf: Column) -> Column:
    """The page id of a leaf."""
    return F.format_string("bnf-f%04d", leaf)


def view_id(leaf: Column) -> Column:
    return F.concat(F.lit("f"), leaf.cast("string"))


def line_ref(page: Column, line: Column) -> Column:
    """A reference that is unique in the corpus."""
    return F.concat_ws(":", page, line)


def style_key(style: Column) -> Column:
    """A canonical key of a style (F26): JSON in the order of the struct's fields."""
    return F.to_json(style)
