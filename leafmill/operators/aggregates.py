"""Aggregations with a stated order for ties."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest_per_key(log: DataFrame, key: str, *order: str) -> DataFrame:
    """The last record of each key of an append log."""
    rest = [c for c in log.columns if c != key]
    last = F.max_by(F.struct(*rest), F.struct(*order))
    return log.groupBy(key).agg(last.alias("_x")).select(key, "_x.*")


def first_per_key(rows: DataFrame, key: str, value: str, *order: str, where: Column | None = None) -> DataFrame:
    """The first value of each key in order, among the rows that qualify."""
    rows = rows if where is None else rows.where(where)
    return rows.groupBy(key).agg(F.min_by(value, F.struct(*order)).alias(value))


def mode_first_seen(rows: DataFrame, key: str, value: str, *order: str) -> DataFrame:
    """The most common value of each key; of equally common ones that seen first."""
    counted = rows.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"), F.min(F.struct(*order)).alias("first"))
    return counted.groupBy(key).agg(
        F.min_by(F.struct(value, "n"), F.struct((-F.col("n")).alias("n"), "first")).alias("_x")
    ).select(key, "_x.*")


def occurrences(rows: DataFrame, text: str, pattern: str, by: list[str], unit: str) -> DataFrame:
    """Occurrences of a pattern, and the lines and units that have one."""
    n = F.regexp_count(text, F.lit(pattern))
    return rows.withColumn("_n", n).groupBy(*by).agg(
        F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("occurrences"),
        F.count_if(F.col("_n") > 0).alias("lines"),
        F.count_distinct(F.when(F.col("_n") > 0, F.col(unit))).alias("units"),
    )


def carriers(rows: DataFrame, text: str, pattern: str) -> DataFrame:
    """Counts of what a pattern matched."""
    return (
        rows.select(F.explode(F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).alias("carrier"))
        .groupBy("carrier")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def categories(rows: DataFrame, column: str, separator: str) -> DataFrame:
    """Counts by part of a separated field."""
    return (
        rows.select(F.explode(F.split(column, separator)).alias("category")).groupBy("category").agg(F.count(F.lit(1)).alias("n"))
    )


def crosstab(rows: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by two columns with both totals.

    ``totals`` is 2 where ``a`` stands for all, 1 where ``b`` does, 3 for both; a null beside it is a value.
    """
    return rows.cube(a, b).agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("int").alias("totals"))


def correction_stats(log: DataFrame, page: str, issue: str, line: str, applied_at: str, seq: str) -> DataFrame:
    """Per page: issues, edits, distinct lines, and the date of the record appended last."""
    return log.groupBy(page).agg(
        F.count_distinct(issue).alias("issues_applied"),
        F.count(line).alias("accepted_edits"),
        F.count_distinct(line).alias("distinct_lines"),
        F.max_by(applied_at, seq).alias("last_applied"),
    )


def file_summary(rows: DataFrame, id_: str, link: Column, number: Column, least: int) -> DataFrame:
    """Records, unique ids, links that are not empty, numbers from a threshold on (A4)."""
    return rows.agg(
        F.count(F.lit(1)).alias("records"),
        F.count_distinct(id_).alias("unique_ids"),
        F.count_if(F.coalesce(link, F.lit("")) != "").alias("links"),
        F.count_if(number >= least).alias("supplement"),
    )


def median_gap(rows: DataFrame, key: str, value: str, *order: str, alone: float = 62.0) -> DataFrame:
    """Median of the differences between neighbours; a fixed value for one alone."""
    w = Window.partitionBy(key).orderBy(*order)
    gaps = rows.withColumn("_g", F.col(value) - F.lag(value).over(w))
    return gaps.groupBy(key).agg(F.coalesce(F.median("_g"), F.lit(alone)).alias("median_gap"))


def review_state(checked: Column, total: int, needs: Column) -> Column:
    """One word for a page: any correction needed wins, then all checked, then some (A10)."""
    return F.when(needs > 0, "needs_correction").when(checked == total, "checked").when(checked > 0, "partial").otherwise("pending")


def confusion(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Counts by label and prediction."""
    return rows.groupBy(label, predicted).agg(F.count(F.lit(1)).alias("n"))


def balanced_accuracy(rows: DataFrame, label: str, predicted: str) -> DataFrame:
    """Mean over the labels of the share predicted right."""
    recall = rows.groupBy(label).agg(F.avg((F.col(label) == F.col(predicted)).cast("double")).alias("recall"))
    return recall.agg(F.avg("recall").alias("balanced_accuracy"))


def leave_one_out_mode(rows: DataFrame, fold: str, label: str) -> DataFrame:
    """Predicts for each fold the most common label of the others, the smaller of equals."""
    by_fold = rows.groupBy(fold, label).agg(F.count(F.lit(1)).alias("n"))
    total = rows.groupBy(label).agg(F.count(F.lit(1)).alias("all")).agg(F.collect_list(F.struct(label, "all"))).scalar()  # labels are few
    each = rows.select(fold).distinct().select(fold, F.inline(total))
    rest = each.join(by_fold, [fold, label], "left").withColumn("rest", F.col("all") - F.coalesce("n", F.lit(0)))
    return rest.groupBy(fold).agg(F.min_by(label, F.struct((-F.col("rest")).alias("r"), F.col(label))).alias("predicted"))


def nested_report(rows: DataFrame, key: str, *fields: str) -> DataFrame:
    """An ordered array of records for each key."""
    return rows.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*fields))).alias("records"))


def map_total(maps: Column) -> Column:
    """Entries of a map, to be summed."""
    return F.coalesce(F.size(maps), F.lit(0))


def global_counts(**tables: DataFrame) -> DataFrame:
    """(name, n): how many rows each of several tables has (A1)."""
    one = lambda name: tables[name].agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
    return reduce(DataFrame.unionByName, map(one, tables))


def dark_rows(pixels: DataFrame, row: str, value: str, below: float = 105) -> DataFrame:
    """(row, dark): the pixels of each row that are darker than ``below``."""
    return pixels.groupBy(row).agg(F.count_if(F.col(value) < below).alias("dark"))


def unlike_distribution(rows: DataFrame, column: str, expected: dict) -> DataFrame:
    """(value, n, expected): the values of a column whose counts are not those expected."""
    counts = rows.groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    kind = counts.schema["value"].dataType
    wanted = [F.struct(F.lit(v).cast(kind).alias("value"), F.lit(n).cast("long").alias("expected")) for v, n in expected.items()]
    known = rows.sparkSession.range(1).select(F.inline(F.array(*wanted)))  # a literal table
    both = counts.join(known, counts["value"].eqNullSafe(known["value"]), "full").select(
        F.coalesce(counts["value"], known["value"]).alias("value"), F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("expected", F.lit(0)).alias("expected")
    )
    return both.where("n <> expected")
