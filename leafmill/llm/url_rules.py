"""URL filter: a sort-merge range join of URLs with prefix rules.

A rule is a host and a path prefix; it fits its host and every subdomain.  The host, with
its labels reversed and each closed by a dot (``m.example.org`` -> ``org.example.m.``),
turns "this host or below" into one interval of a sorted key, and two such intervals nest
or are disjoint.  Each partition sorts its own keys and sweeps them once against the
sorted rules with a stack of the rules whose interval is open; nothing is shuffled, so a
host that owns a third of all pages costs nothing extra.

Rules travel to the tasks in pieces of at most ``RULES_PER_PASS`` rules.  More rules than
that take further sweeps over the (narrow) keys, of which the longest match wins.

Defined results: a null URL, or one without ``://``, has empty host and path and fits no
rule; of rules with equal host and path the blocking one holds; of equally long ones that
fit, the one with the longer host, in however many sweeps; no rule leaves ``default``.
Equal URLs are judged alike, extra columns pass through (one named like an output gets
``_in`` after its name), an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scratch import column, free, own_names, table

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES_PER_PASS = 200_000
RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]


def after_scheme(url: Column) -> Column:
    at = F.locate("://", url)
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise(F.lit(""))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(after_scheme(url), r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(after_scheme(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    return F.concat(F.array_join(F.reverse(F.split(host, r"\.")), "."), F.lit("."))


def key_of(host: str) -> str:
    return ".".join(reversed(host.split("."))) + "."


class Level:
    """The rules of one host: path prefix -> (length of rule, length of host, whether it blocks, rule, action), the larger the stronger."""

    def __init__(self, key: str):
        self.key, self.paths, self.lengths = key, {}, []

    def add(self, host: str, path: str, action: str) -> None:
        hit = (len(host + path), len(host), action == "block", host + path, action)
        self.paths[path] = max(hit, self.paths.get(path, hit))

    def longest(self, path: str) -> tuple | None:
        for n in self.lengths:
            if n <= len(path) and (hit := self.paths.get(path[:n])):
                return hit
        return None


def levels(rules: list[tuple[str, str, str]]) -> list[Level]:
    """The rules by host, in the order of the sweep."""
    by: dict[str, Level] = {}
    for action, host, path in rules:
        key = key_of(host)
        by.setdefault(key, Level(key)).add(host, path, action)
    for level in by.values():
        level.lengths = sorted({len(p) for p in level.paths}, reverse=True)
    return [by[k] for k in sorted(by)]


class Sweep:
    """Merges keys that come in ascending order with the sorted rules."""

    def __init__(self, ordered: list[Level]):
        self.rules, self.next, self.open, self.key = ordered, 0, [], None

    def judge(self, key: str, path: str) -> tuple | None:
        if key != self.key:
            self.key = key
            while self.open and not key.startswith(self.open[-1].key):
                self.open.pop()
            while self.next < len(self.rules) and self.rules[self.next].key <= key:
                if key.startswith(self.rules[self.next].key):
                    self.open.append(self.rules[self.next])
                self.next += 1
        return max((hit for level in self.open if (hit := level.longest(path))), default=None)


BEST = (("length", "int"), ("host", "int"), ("blocks", "boolean"), ("rule", "string"), ("action", "string"))


def sweep_once(keys: DataFrame, key: str, path: str, best: list[str], rules: list[tuple[str, str, str]]) -> DataFrame:
    """``keys`` with the columns ``best`` of this set of rules where it is stronger than what they hold."""
    ordered = keys.sparkSession.sparkContext.broadcast(levels(rules))
    others = [c for c in keys.columns if c not in best]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sweep = Sweep(ordered.value)
        for batch in batches:
            found = []
            for k, p, *old in zip(batch[key].to_pylist(), batch[path].to_pylist(), *(batch[b].to_pylist() for b in best), strict=True):
                hit = sweep.judge(k, p)
                found.append(hit if hit and (old[0] is None or hit > tuple(old)) else old)
            columns = [pa.array([x[i] for x in found], batch[b].type) for i, b in enumerate(best)]
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in others), *columns], names=[*others, *best])

    ordered_keys = keys.select(*map(column, others), *best).sortWithinPartitions(key, path)
    return ordered_keys.mapInArrow(run, ordered_keys.schema)


def url_filter(
    pages: DataFrame,
    rules: list[tuple[str, str, str]],
    default: str = "allow",
    rules_per_pass: int = RULES_PER_PASS,
) -> DataFrame:
    """``pages`` (a ``url`` and any other columns) with host, path, rule and verdict."""
    names = own_names(pages, "host", "path", "rule", "verdict")
    out = pages.select(*(column(c).alias(n) for c, n in names.items()))
    host, path, key, *best = free(out, "_host", "_path", "_key", *(f"_best_{n}" for n, _ in BEST))
    out = out.withColumn(host, host_of(F.col("url"))).withColumn(path, path_of(F.col("url"))).withColumn(key, host_key(F.col(host)))
    out = out.select("*", *(F.lit(None).cast(kind).alias(b) for b, (_, kind) in zip(best, BEST, strict=True)))
    for i in range(0, len(rules), rules_per_pass):
        out = sweep_once(out, key, path, best, rules[i : i + rules_per_pass])
    return out.select(
        *map(column, names.values()),
        F.col(host).alias("host"),
        F.col(path).alias("path"),
        F.col(best[3]).alias("rule"),
        F.coalesce(best[4], F.lit(default)).alias("verdict"),
    )


def op4_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """page_id, host, path, rule and verdict of every page."""
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter(pages, RULES).drop("url")


OP4_SQL = r"""
WITH rest AS (
  SELECT page_id,
         CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r
  FROM pages
), parts AS (
  SELECT page_id,
         translate(regexp_extract(r, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path
  FROM rest
), judged AS (
  SELECT page_id, host, path,
         CASE WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
              WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
              WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
              WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule
  FROM parts
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM judged
"""
