"""Joins by stable id, named after what happens to keys that miss."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FEW = 10_000  # literal rows that may be broadcast


def with_defaults(left: DataFrame, right: DataFrame, on: str | list[str], defaults: dict[str, object]) -> DataFrame:
    """Left join; columns of ``right`` in ``defaults`` take that value where there is no match."""
    out = left.join(right, on, "left")
    return out.withColumns({c: F.coalesce(c, F.lit(v)) for c, v in defaults.items()})


def strict(left: DataFrame, right: DataFrame, on: str | list[str]) -> tuple[DataFrame, DataFrame]:
    """(matches, keys of ``left`` without a match); the second must be empty."""
    keys = [on] if isinstance(on, str) else on
    return left.join(right, on), left.join(right, on, "left_anti").select(*keys).distinct()


def reconciled(left: DataFrame, right: DataFrame, on: str) -> DataFrame:
    """Keys on one side only, tagged ``missing`` (from the right) or ``extra``."""
    a, b = left.select(on).distinct(), right.select(on).distinct()
    missing = a.join(b, on, "left_anti").withColumn("side", F.lit("missing"))
    return missing.unionByName(b.join(a, on, "left_anti").withColumn("side", F.lit("extra")))


def range_slice(rows: DataFrame, ranges: DataFrame, key: list[str], id_: str, pos: str) -> DataFrame:
    """The rows from ``first_id`` to ``last_id`` of each range, both included.

    The ids are resolved to positions by equi-joins, so the range is a residual of a join on ``key``.
    """
    place = lambda name: rows.select(*key, F.col(id_).alias(f"{name}_id"), F.col(pos).alias(f"{name}_pos"))
    found = ranges.join(place("first"), [*key, "first_id"]).join(place("last"), [*key, "last_id"])
    return rows.join(found, key).where(F.col(pos).between(F.col("first_pos"), F.col("last_pos")))


def residual(left: DataFrame, right: DataFrame, on: str | list[str], condition: Column) -> DataFrame:
    """Equi-join with a further condition."""
    return left.join(right, on).where(condition)


def upserted(old: DataFrame, new: DataFrame, on: str | list[str]) -> DataFrame:
    """Rows of ``new``, and those of ``old`` whose key is not in it."""
    return new.unionByName(old.join(new, on, "left_anti"), allowMissingColumns=True)


def stale(pinned: DataFrame, current: DataFrame, on: str | list[str], version: str) -> DataFrame:
    """Keys whose pinned version is not the current one, or gone."""
    now = current.select(*([on] if isinstance(on, str) else on), F.col(version).alias("current"))
    return pinned.join(now, on, "left").where(~F.col(version).eqNullSafe(F.col("current")))


def with_literals(rows: DataFrame, name: str, values: list) -> DataFrame:
    """Every row with every one of a few literal values."""
    return rows.withColumn(name, F.explode(F.array(*[F.lit(v) for v in values])))


def with_rules(rows: DataFrame, rules: list[tuple], columns: list[str], on: str) -> DataFrame:
    """Join with a literal table of rules (J7), broadcast if there are no more than ``FEW``."""
    literal = rows.sparkSession.createDataFrame(rules, columns)
    return rows.join(F.broadcast(literal) if len(rules) <= FEW else literal, on)


def masters_with_pages(masters: DataFrame, pages: DataFrame, reviews: DataFrame, on: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(masters with their pages where there are any, pages without a master, reviews without a page)."""
    return (
        masters.join(pages, on, "left"),
        pages.join(masters.select(on), on, "left_anti"),
        reviews.join(pages.select(on), on, "left_anti"),
    )
