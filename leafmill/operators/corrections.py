"""Corrections: payloads, rewriting lines in their style, history, decisions, and edits in a browser's workspace."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as D

from leafmill.functions import content as C
from leafmill.functions import text as T
from leafmill.functions.matching import matching_blocks

STYLE = ("typeface", "placement", "layout", "line_span", "span_id")
FIELDS = ("typeface", "text", "placement", "layout", "line_span", "span_id")


PART = D.StructType().add("own", "integer").add("face", "string").add("text", "string")


def kept_styles(old: str, new: str, styles: np.ndarray) -> np.ndarray:
    """The style number of each letter of ``new``, from those of the letters of ``old``; -1 where there is none to go by."""
    out = np.full(len(new), -1)
    i = j = 0
    for x, y, n in matching_blocks(old, new):
        gap = styles[i:x]
        if len(gap) == y - j:
            out[j:y] = gap  # letter for letter
        elif y > j:
            if len(gap):  # the commonest, of equals the first seen
                values, first, counts = np.unique(gap, return_index=True, return_counts=True)
                style = values[np.lexsort((first, -counts))[0]]
            else:
                style = styles[i - 1] if i else styles[i] if i < len(styles) else -1
            out[j:y] = style
        out[y : y + n] = styles[x : x + n]
        i, j = x + n, y + n
    return out


def new_parts(texts: list[str], faces: list[str], rests: list[str], new: str, roman: list[tuple], italic: list[tuple]) -> list[tuple] | None:
    """(own, face, text) of the runs of a new text: the run whose style each has (or -1), and the typeface forced upon it."""
    if any(not 0 <= s < e <= len(new) for s, e in (*roman, *italic)):
        return None
    known: dict[tuple, int] = {}
    first = np.array([known.setdefault(style, i) for i, style in enumerate(zip(faces, rests, strict=True))], int)
    own = kept_styles("".join(texts), new, np.repeat(first, np.array([len(t) for t in texts], int)))
    forced = np.zeros(len(new), int)
    for kind, ranges in ((1, roman), (2, italic)):
        for s, e in ranges:
            forced[s:e] = kind
    forms: dict[tuple, int] = {}

    def form(i: int, kind: int) -> int:
        face, rest = (faces[i], rests[i]) if i >= 0 else ("roman", "{}")
        return forms.setdefault(((face, "roman", "italic")[kind], rest), len(forms))

    pairs, which = np.unique(own * 3 + forced, return_inverse=True)
    looks = np.array([form(p // 3, p % 3) for p in pairs.tolist()], int)[which]
    starts = np.flatnonzero(np.diff(looks, prepend=-1)).tolist() + [len(new)]
    return [(int(own[s]), (None, "roman", "italic")[forced[s]], new[s:e]) for s, e in zip(starts, starts[1:], strict=False)]


SLICE = 128  # rows that are Python objects at a time
PARTS = pa.list_(pa.struct({"own": pa.int32(), "face": pa.string(), "text": pa.string()}))


@F.arrow_udf(D.ArrayType(PART))
def parts_of(
    texts: pa.Array, faces: pa.Array, rests: pa.Array, new: pa.Array, rs: pa.Array, re: pa.Array, is_: pa.Array, ie: pa.Array
) -> pa.Array:
    """``new_parts`` by rows; null where anything is."""

    def one(t, f, r, n, a, b, c, d) -> list[tuple] | None:  # noqa: ANN001
        if any(x is None for x in (t, n, a, b, c, d)):
            return None
        return new_parts([x or "" for x in t], f, r, n, list(zip(a, b, strict=True)), list(zip(c, d, strict=True)))

    def piece(i: int) -> pa.Array:
        own = (x.slice(i, SLICE).to_pylist() for x in (texts, faces, rests, new, rs, re, is_, ie))
        return pa.array([one(*row) for row in zip(*own, strict=True)], PARTS)

    return pa.concat_arrays([piece(i) for i in range(0, len(texts), SLICE)] or [pa.array([], PARTS)])


# its own step, as an expression with a lambda cannot hold it
parts_of = parts_of.asNondeterministic()


def rewrite_runs(lines: DataFrame, runs: str, target: str, roman: str, italic: str, into: str) -> DataFrame:
    """``lines`` with the runs of the new text, each character in the style it had; null where a forced range is outside it (F16).

    What the texts have in common keeps its style, and so does what is replaced letter for
    letter.  Other new text takes the commonest style of what it replaces (the first seen of
    equals), or else that of its neighbour, or else roman; forced ranges (s, e) set the
    typeface, italic before roman.  Time is near-linear in the length of the texts and the number of ranges.
    """
    old = F.col(runs)
    of = lambda ranges, f: F.transform(ranges, lambda r: r[f])
    rest = F.transform(old, lambda r: F.to_json(F.struct(*(r[f].alias(f) for f in STYLE[1:]))))
    found = parts_of(
        of(old, "text"), of(old, "typeface"), rest, F.col(target), of(F.col(roman), "s"), of(F.col(roman), "e"), of(F.col(italic), "s"), of(F.col(italic), "e")
    )
    steps = lines.withColumn("_parts", found)

    def run(p: Column) -> Column:
        own = F.when(p["own"] >= 0, F.get(old, p["own"]))
        style = {"typeface": F.coalesce(p["face"], own["typeface"], F.lit("roman")), "text": p["text"]}
        return F.struct(*((style[f] if f in style else own[f]).alias(f) for f in FIELDS))

    return steps.withColumn(into, F.transform("_parts", run)).drop("_parts")


def resolved(changes: DataFrame, after: str = "after") -> DataFrame:
    """``changes`` with target, roman, italic and error."""
    read = changes.withColumn("_m", T.resolve_markers(F.col(after))).withColumn("_p", T.parse_notation(F.col("_m.value")))
    out = read.select(
        *changes.columns,
        F.col("_p.text").alias("target"), F.col("_p.roman").alias("roman"), F.col("_p.italic").alias("italic"),
        F.coalesce("_m.error", "_p.error").alias("error"),
    )
    return T.composed(out, "target")


def applied(lines: DataFrame, changes: DataFrame) -> DataFrame:
    """The outcome and the new runs of each change (line_ref, before, after, comment, second_opinion).

    ``applied``, ``already`` (the line is as asked), ``held`` (a second opinion is asked for),
    ``mismatch``, ``unknown_line`` or ``invalid``.
    """
    now = resolved(changes).join(lines.select("line_ref", "runs"), "line_ref", "left")
    text = C.line_text(F.col("runs"))
    held = F.coalesce("second_opinion", F.length(F.coalesce("comment", F.lit(""))) > 0)
    outcome = (
        F.when(F.col("error").isNotNull(), "invalid")
        .when(F.col("runs").isNull(), "unknown_line")
        .when(text == F.col("target"), "already")
        .when(text != F.col("before"), "mismatch")
        .when(held, "held")
        .otherwise("applied")
    )
    known = now.withColumn("outcome", outcome)
    known = known.withColumn("_target", F.when(F.col("outcome") == "applied", F.col("target")))
    new = rewrite_runs(known, "runs", "_target", "roman", "italic", "new_runs")
    return new.withColumn("new_runs", F.when(F.col("outcome") == "applied", F.col("new_runs")).otherwise(F.col("runs"))).drop("_target")


def idempotent(log: DataFrame, page: str = "page_id", issue: str = "issue_no") -> tuple[DataFrame, DataFrame]:
    """(one record for each page and issue, the earliest; issues that came again with other lines)."""
    lines = F.array_sort("lines")
    marked = log.withColumn("_l", lines)
    w = Window.partitionBy(page, issue).orderBy("seq")
    seen = marked.withColumn("_first", F.first("_l").over(w)).withColumn("_n", F.row_number().over(w))
    conflicts = seen.where(F.col("_l") != F.col("_first")).select(page, issue).distinct()
    return seen.where("_n = 1").drop("_l", "_first", "_n"), conflicts


def report_state(failed: Column, flagged: Column, pending: Column, final: Column) -> Column:
    """Where a correction stands."""
    return (
        F.when(final, "locally_finalized")
        .when(failed, "validation_failed")
        .when((flagged > 0) & (pending > 0), "awaiting_second_opinion")
        .otherwise("ready_to_finalize")
    )


def recovered(state: Column, line_is_target: Column) -> Column:
    """A rerun after a failed validation finds its edit in place (trap 11)."""
    return F.when((state == "validation_failed") & line_is_target, "recovered").otherwise(state)


def decision_violations(decisions: DataFrame) -> DataFrame:
    """Rules of decisions (V47) over (line_ref, decision, before, qualified, now)."""
    bad = (
        F.when(~F.col("decision").isin("reject", "qualify", "accept"), "pending or unknown")
        .when((F.col("decision") == "reject") & (F.col("now") != F.col("before")), "rejected line changed")
        .when((F.col("decision") == "qualify") & (F.coalesce("qualified", F.lit("")) == ""), "no qualified value")
    )
    return decisions.withColumn("detail", bad).where("detail IS NOT NULL").select(F.lit("V47").alias("rule"), F.col("line_ref").alias("key"), "detail")


def proposal_matches(runs: Column, target: Column, roman: Column, italic: Column) -> Column:
    """Whether a line has the proposed text and each forced range its typeface."""
    faces = F.flatten(F.transform(runs, lambda r: F.array_repeat(r["typeface"], F.length(r["text"]))))
    whole = lambda ranges, face: F.forall(
        F.coalesce(ranges, F.array().cast("array<struct<s:int,e:int>>")),
        lambda x: F.forall(F.slice(faces, x["s"] + 1, x["e"] - x["s"]), lambda f: f == face),
    )
    return (C.line_text(runs) == target) & whole(roman, "roman") & whole(italic, "italic")


def reconciled_edits(edits: DataFrame, lines: DataFrame) -> DataFrame:
    """Edits of a workspace against the lines as they are.

    ``edits``: line_ref, before, after, comment, base_line_version; ``lines``: line_ref, runs,
    version.  ``action`` is orphan, keep, drop, comment_only or rebase.
    """
    now = resolved(edits).join(lines.select("line_ref", "runs", "version"), "line_ref", "left")
    text = C.line_text(F.col("runs"))
    changed = F.when(F.col("base_line_version").isNotNull(), F.col("base_line_version") != F.col("version")).otherwise(F.col("before") != text)
    unforced = (F.size("roman") == 0) & (F.size("italic") == 0)
    done = F.coalesce(proposal_matches(F.col("runs"), F.col("target"), F.col("roman"), F.col("italic")), F.lit(False))
    idle = done | F.coalesce(F.col("error").isNull() & (F.col("before") == F.col("target")) & unforced, F.lit(False))
    said = F.length(F.coalesce("comment", F.lit(""))) > 0
    action = (
        F.when(F.col("runs").isNull(), "orphan").when(~changed, "keep").when(idle & said, "comment_only").when(idle, "drop").otherwise("rebase")
    )
    moved = F.col("action").isin("comment_only", "rebase")
    return now.withColumn("action", action).select(
        "line_ref",
        "action",
        F.when(moved, text).otherwise(F.col("before")).alias("before"),
        F.when(F.col("action") == "comment_only", text).otherwise(F.col("after")).alias("after"),
        "comment",
        F.when(F.col("action") == "orphan", F.col("base_line_version")).otherwise(F.col("version")).alias("base_line_version"),
        moved.alias("base_changed"),
        (moved & said).alias("comment_review_needed"),
    )


def wants_second_opinion(flag: Column, comment: Column) -> Column:
    """An explicit flag, or else whether there is a comment."""
    return F.coalesce(flag, F.length(F.coalesce(comment, F.lit(""))) > 0)


def saved(workspace: DataFrame, edits: DataFrame) -> DataFrame:
    """A workspace after edits: upserts, and deletes of those that change nothing and say nothing."""
    noop = (F.col("before") == F.col("after")) & (F.coalesce("comment", F.lit("")) == "") & ~F.coalesce("second_opinion", F.lit(False))
    kept = workspace.join(edits.select("line_ref"), "line_ref", "left_anti")
    return kept.unionByName(edits.where(~noop), allowMissingColumns=True)


def submitted(workspace: DataFrame) -> DataFrame:
    """Payloads of schema 2 by page (page, base_commit, version, line, before, after, comment, second_opinion)."""
    change = F.struct(
        "line", "before", "after", F.nullif("comment", F.lit("")).alias("comment"),
        F.when(wants_second_opinion(F.col("second_opinion"), F.col("comment")), F.lit(True)).alias("second_opinion"),
    )
    grouped = workspace.groupBy("page", "base_commit", "version").agg(F.array_sort(F.collect_list(change)).alias("changes"))
    body = F.struct(F.lit(2).alias("schema"), "page", "base_commit", F.col("version").alias("base_transcription_version"), "changes")
    return grouped.select("page", F.to_json(body).alias("payload"))


def edit_counters(edits: DataFrame) -> DataFrame:
    """(A14)"""
    return edits.agg(F.count_if("base_changed").alias("changed_bases"), F.count_if("comment_review_needed").alias("comments_to_review"))


def common_ends(before: Column, after: Column) -> Column:
    """struct(prefix, removed, inserted, suffix): the change between a common beginning and end."""
    a, b = T.characters(before), T.characters(after)
    n = F.least(F.size(a), F.size(b))
    run = lambda x, y, most: F.aggregate(
        F.slice(F.zip_with(x, y, lambda p, q: p.eqNullSafe(q)), F.lit(1), most),
        F.struct(F.lit(0).alias("k"), F.lit(True).alias("on")),
        lambda acc, same: F.struct((acc["k"] + (acc["on"] & same).cast("int")).alias("k"), (acc["on"] & same).alias("on")),
        lambda acc: acc["k"],
    )
    head = run(a, b, n)
    tail = run(F.reverse(a), F.reverse(b), n - head)
    part = lambda x, s, k: F.array_join(F.slice(x, s, k), "")
    return F.struct(
        part(a, F.lit(1), head).alias("prefix"),
        part(a, head + 1, F.size(a) - head - tail).alias("removed"),
        part(b, head + 1, F.size(b) - head - tail).alias("inserted"),
        part(a, F.size(a) - tail + 1, tail).alias("suffix"),
    )

