"""Aggregates that are kept and brought up to date by what is new.

Kept are, for each page, the numbers, and beside them the exact keys that distinct counts rest on.
A change costs what it brings: its keys are looked up in those that are kept, and only pages that it touches
change.  ``differences`` proves the kept numbers against the whole log.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

COUNTS = ("issues_applied", "accepted_edits", "distinct_lines")


@dataclass
class Kept:
    """``stats`` (page, the counts, last_seq, last_applied), ``issues`` (page, issue) and ``lines`` (page, line)."""

    stats: DataFrame
    issues: DataFrame
    lines: DataFrame


def aggregated(log: DataFrame) -> Kept:
    """What is kept of a whole log (page, issue, line, seq, applied_at); ``last_applied`` is that of the record appended last."""
    issues, lines = log.select("page", "issue").distinct(), log.select("page", "line").distinct()
    stats = log.groupBy("page").agg(
        F.count_distinct("issue").alias("issues_applied"), F.count(F.lit(1)).alias("accepted_edits"), F.count_distinct("line").alias("distinct_lines"),
        F.max("seq").alias("last_seq"), F.max_by("applied_at", "seq").alias("last_applied"),
    )
    return Kept(stats, issues, lines)


def merged(kept: Kept, new: DataFrame) -> Kept:
    """What is kept after the records of ``new``, which the log did not have."""
    fresh = lambda column, have: new.select("page", column).distinct().join(have, ["page", column], "left_anti")
    issues, lines = fresh("issue", kept.issues), fresh("line", kept.lines)
    number = lambda rows, name: rows.groupBy("page").agg(F.count(F.lit(1)).alias(name))
    change = new.groupBy("page").agg(F.count(F.lit(1)).alias("edits_"), F.max("seq").alias("seq_"), F.max_by("applied_at", "seq").alias("at_"))
    change = change.join(number(issues, "issues_"), "page", "left").join(number(lines, "lines_"), "page", "left")
    both = kept.stats.join(change, "page", "full")
    plus = lambda a, b: (F.coalesce(a, F.lit(0)) + F.coalesce(b, F.lit(0))).alias(a)
    later = F.col("last_seq").isNull() | (F.col("seq_") > F.col("last_seq"))
    stats = both.select(
        "page", *(plus(a, b) for a, b in zip(COUNTS, ("issues_", "edits_", "lines_"), strict=True)),
        F.greatest("last_seq", "seq_").alias("last_seq"), F.when(later, F.col("at_")).otherwise(F.col("last_applied")).alias("last_applied"),
    )
    return Kept(stats, kept.issues.unionByName(issues), kept.lines.unionByName(lines))


def differences(kept: Kept, log: DataFrame) -> DataFrame:
    """Pages whose kept numbers are not those of the log (V50): none if they are right."""
    true = aggregated(log).stats
    known = kept.stats.select(F.col("page").alias("p"), F.struct(*(c for c in true.columns if c != "page")).alias("kept"))
    both = true.select("page", F.struct(*(c for c in true.columns if c != "page")).alias("true")).join(known, F.col("page").eqNullSafe(F.col("p")), "full")
    return both.where(~F.col("kept").eqNullSafe(F.col("true"))).select(F.coalesce("page", "p").alias("page"), "kept", "true")
