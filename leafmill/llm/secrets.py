r"""Secret scan with an incremental blob ledger, in DataFrame operations only.

Every version of a text is addressed by its SHA-256.  The ledger, a table that each scan
appends to, holds for each blob the rule versions it was scanned by and the spans each of
them found; a scan asks it by the blobs' digests first, and only texts with (blob, rule version)
pairs that it lacks are dealt out and read, for these pairs alone.  The
findings of the rule versions asked for are joined back from it to every path that has the
blob.  A text with thousands of copies is scanned once.

Spans need no Python: cutting the text at the matches (``split``) and collecting the
matches (``regexp_extract_all``) with the same pattern give pieces and matches in turn,
whose lengths add up to positions in code points, ``CHUNK`` matches at a time.  The cut runs
only where there is a match.

Base rules, leftmost and non-overlapping, failing matches dropped: ``assign`` (a keyword,
``:`` or ``=``, a value of at least 8 characters), ``access`` (``AKIA`` and at least 12
more), ``hex`` (a run of at least 32).  A run that is too short cannot hold a longer one,
so the length is part of the pattern for ``access`` and ``hex``; for ``assign`` it is
tested afterwards, for a dropped match uses up its text.  The method adds ``pem`` (private
key headers) and ``ghtoken`` (``ghp_...`` tokens).

Defined results: a null text is the empty text and has no spans; equal texts have equal
findings; repeated rows stay repeated; extra columns pass through (one named ``_found`` gets
``_in`` after its name); spans of rules or versions that are not asked for stay in the
ledger and out of the result; an empty table gives no rows.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import column, free, own_names, shared_dir, table

# Kind, version, pattern, group whose length counts, least length.  The first three are the base.
RULES = [
    ("assign", 1, r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", 1, r"AKIA[A-Z0-9]{12,}", 0, 16),
    ("hex", 1, r"[0-9a-f]{32,}", 0, 32),
    ("pem", 1, r"-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----", 0, 0),
    ("ghtoken", 1, r"gh[pousr]_[A-Za-z0-9]{36,}", 0, 40),
]
BASE = ("assign", "access", "hex")
CHUNK = 256
SPANS = "array<struct<start:bigint,kind:string,end:bigint,rule:string>>"
LEDGER = f"blob string, scanned array<string>, found {SPANS}"


def rule_id(rule: tuple) -> str:
    return f"{rule[0]}@{rule[1]}"


def spans_of(text: Column, matches: Column, rule: tuple) -> Column:
    """Spans of the matches of one rule, from the pieces between them."""
    kind, _, pattern, group, least = rule
    pieces = F.split(text, pattern, -1)
    counted = F.regexp_extract_all(text, F.lit(pattern), F.lit(group)) if group else matches
    none = F.from_json(F.lit("[]"), SPANS)

    def step(acc: Column, x: Column) -> Column:
        begin = acc["at"] + F.length(x["p"])
        end = begin + F.length(x["m"])
        span = F.struct(begin.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), F.lit(rule_id(rule)).alias("rule"))
        out = F.when(F.length(x["c"]) >= least, F.concat(acc["out"], F.array(span))).otherwise(acc["out"])
        return F.struct(end.alias("at"), out.alias("out"))

    def chunk(done: Column, k: Column) -> Column:
        some = lambda a: F.slice(a, k, F.least(F.lit(CHUNK), F.size(matches) - k + 1))
        parts = F.arrays_zip(some(pieces).alias("p"), some(matches).alias("m"), some(counted).alias("c"))
        start = F.struct(F.element_at(done, -1)["at"].alias("at"), none.alias("out"))
        return F.concat(done, F.array(F.aggregate(parts, start, step)))

    begin = F.array(F.struct(F.lit(0).cast("long").alias("at"), none.alias("out")))
    at = F.sequence(F.lit(1), F.size(matches), F.lit(CHUNK))
    return F.aggregate(at, begin, chunk, lambda done: F.flatten(F.transform(done, lambda x: x["out"])))


def scan(blobs: DataFrame, rules: list[tuple]) -> DataFrame:
    """``blobs`` (blob, text, seen: rule versions in the ledger) -> blob, unseen rules, their findings."""
    out = blobs
    for i, rule in enumerate(rules):
        unseen = ~F.array_contains("seen", rule_id(rule))
        out = out.withColumn(
            f"m{i}", F.when(unseen, F.regexp_extract_all("text", F.lit(rule[2]), F.lit(0)))
        )
    none = F.from_json(F.lit("[]"), SPANS)
    found = [
        F.when(F.size(f"m{i}") > 0, spans_of(F.col("text"), F.col(f"m{i}"), rule)).otherwise(none)
        for i, rule in enumerate(rules)
    ]
    wanted = F.array(*[F.lit(rule_id(r)) for r in rules])
    return out.select("blob", F.array_except(wanted, "seen").alias("scanned"), F.concat(*found).alias("found"))


def new_findings(versions: DataFrame, ledger: DataFrame | None = None, rules: list[tuple] = RULES) -> DataFrame:
    """Ledger rows to append: blob, rule versions scanned now, spans found.

    ``versions`` has blob and text; ``ledger`` is what earlier calls returned.
    """
    none = F.array().cast("array<string>")
    wanted = F.array(*[F.lit(rule_id(r)) for r in rules])
    once = lambda rows, *keys: rows.groupBy(*keys).agg(F.first("text").alias("text"))
    if ledger is None:
        return scan(once(versions, "blob").withColumn("seen", none), rules)
    seen = (
        ledger.select("blob", F.explode("scanned").alias("r"))
        .groupBy("blob")
        .agg(F.collect_set("r").alias("seen"))  # at most one entry for each rule version
    )
    todo = versions.select("blob").distinct().join(seen, "blob", "left").withColumn("seen", F.coalesce("seen", none))
    todo = todo.where(F.size(F.array_except(wanted, "seen")) > 0)
    return scan(once(versions.join(todo, "blob"), "blob", "seen"), rules)


def blob_of(text: Column) -> Column:
    return F.sha2(F.coalesce(text, F.lit("")), 256)


def ledger_rows(spark: SparkSession, path: str) -> DataFrame | None:
    """The ledger table at ``path``; None if there is none yet."""
    try:
        return spark.read.schema(LEDGER).parquet(path)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def appended(texts: DataFrame, ledger: str, rules: list[tuple] = RULES, text: str = "text") -> None:
    """Scans what the ledger lacks of ``texts`` and appends it."""
    versions = texts.select(blob_of(column(text)).alias("blob"), F.coalesce(column(text), F.lit("")).alias("text"))
    new_findings(versions, ledger_rows(texts.sparkSession, ledger), rules).write.mode("append").parquet(ledger)


def secret_scan(paths: DataFrame, ledger: str | None = None, rules: list[tuple] = RULES, text: str = "text") -> DataFrame:
    """``paths`` (a text and any other columns) without the text, and with ``_found``, the spans of each row.

    ``ledger`` is the folder of the ledger table, to which this scan appends; None starts a new
    one.  Rows of blobs without findings get an empty array.
    """
    spark = paths.sparkSession
    place = ledger or f"{shared_dir(spark)}/secret-ledger-{uuid.uuid4().hex}"
    names = own_names(paths, "_found")
    blob = free(paths, "_blob")
    known = paths.select(*(column(c).alias(n) for c, n in names.items()), blob_of(column(text)).alias(blob))
    appended(paths, place, rules, text)

    wanted = {rule_id(r): i for i, r in enumerate(rules)}
    asked = F.filter("found", lambda s: s["rule"].isin(*wanted))
    ranks = F.create_map(*(F.lit(x) for pair in wanted.items() for x in pair))
    ranked = lambda s: F.struct(s["start"].alias("start"), ranks[s["rule"]].alias("rank"), s["kind"].alias("kind"), s["end"].alias("end"))
    found = ledger_rows(spark, place).select(F.col("blob").alias(blob), F.transform(asked, ranked).alias("_found")).where(F.size("_found") > 0)
    # several ledger rows of a blob: one for each time that rules were added
    found = found.groupBy(blob).agg(F.array_distinct(F.flatten(F.collect_list("_found"))).alias("_found"))
    joined = known.select(*(column(n) for c, n in names.items() if c != text), blob).join(found, blob, "left")
    none = F.from_json(F.lit("[]"), "array<struct<start:bigint,rank:int,kind:string,end:bigint>>")
    return joined.withColumn("_found", F.coalesce("_found", none)).drop(blob)


def written(spans: Column) -> Column:
    """kind:start:end of the spans, by start and then kind, joined by commas."""
    said = F.transform(
        F.array_sort(spans),
        lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string")),
    )
    return F.array_join(said, ",")


def op5_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and digest of the base spans of every document, and all its spans.

    The ledger grows twice: by the blobs of the lower half of all digests, then by those of all documents that it lacks.
    """
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    ledger = f"{shared_dir(spark)}/secret-ledger-{uuid.uuid4().hex}"
    appended(docs.where(blob_of(F.col("text")) < "8"), ledger)
    found = secret_scan(docs, ledger)
    count = lambda k: F.size(F.filter("_found", lambda s: s["kind"] == k)).cast("long")
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in BASE],
        F.sha2(written(F.filter("_found", lambda s: s["rank"] < len(BASE))), 256).alias("base_sha256"),
        written(F.col("_found")).alias("spans"),
    )


def _spans_sql(kind: str, rank: int, pattern: str, group: int, least: int) -> str:
    """Spans of one rule in SQL: pieces and matches in turn, their lengths summed up."""
    quoted = pattern.replace("'", "''")
    return f"""SELECT doc_id, {rank} AS rank, '{kind}' AS kind,
    list_sum(list_transform(p[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(m[1:i - 1], lambda x: length(x))), 0) AS s, length(m[i]) AS n
  FROM (SELECT doc_id, string_split_regex(t, '{quoted}') AS p, regexp_extract_all(t, '{quoted}') AS m, regexp_extract_all(t, '{quoted}', {group}) AS g FROM d),
    unnest(range(1, len(m) + 1)) AS u(i)
  WHERE length(g[i]) >= {least}"""


def _oracle() -> str:
    parts = " UNION ALL ".join(_spans_sql(r[0], i, r[2], r[3], r[4]) for i, r in enumerate(RULES))
    said = "string_agg(kind || ':' || CAST(s AS BIGINT) || ':' || CAST(s + n AS BIGINT), ',' ORDER BY s, rank)"
    counts = ", ".join(f"count(*) FILTER (kind = '{k}') AS n_{k}" for k in BASE)
    columns = ", ".join(f"coalesce(n_{k}, 0) AS n_{k}" for k in BASE)
    return f"""WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents), f AS ({parts}),
a AS (SELECT doc_id, {counts}, {said} FILTER (rank < {len(BASE)}) AS base, {said} AS spans FROM f GROUP BY doc_id)
SELECT doc_id, {columns}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM d LEFT JOIN a USING (doc_id)"""


OP5_SQL = _oracle()
