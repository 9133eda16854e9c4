"""Delimited, JSON and binary files beside the pages."""

from __future__ import annotations

import re
import uuid
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from leafmill import model
from leafmill.sources.page_source import store


def delimited(spark: SparkSession, path: str, columns: list[str], sep: str = "\t") -> DataFrame:
    """A file with a header that must be ``columns`` exactly (S4-S6); all columns are text.  A BOM is dropped."""
    options = {"sep": sep, "header": True, "quote": '"' if sep == "," else "", "escape": '"' if sep == "," else "", "enforceSchema": True}
    found = spark.read.options(**options).csv(path).columns
    if [c.lstrip("﻿") for c in found] != columns:
        raise ValueError(f"header of {path} is {found}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    return spark.read.options(**options).schema(schema).csv(path)


def corrections(spark: SparkSession, path: str) -> DataFrame:
    """The correction log."""
    return delimited(spark, path, model.CORRECTIONS)


def side_table(spark: SparkSession, path: str, schema: str, one_a_line: bool = False) -> DataFrame:
    """Rows of the ``pages`` array of JSON documents, one a file or one a line (S3)."""
    return spark.read.schema(f"pages array<struct<{schema}>>").option("multiLine", not one_a_line).json(path).select(F.inline("pages"))


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line_no, value): the lines of text files with their numbers from 1, also where a file is read in several pieces."""
    at = F.monotonically_increasing_id()  # rows of a piece follow one another
    raw = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("_block"), "value", at.alias("_at"))
    pieces = raw.groupBy("file", "_block").agg(F.min("_at").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy("file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = pieces.select("file", "_block", (F.coalesce(F.sum("_rows").over(before), F.lit(0)) + 1 - F.col("_first")).alias("_start"))
    return raw.join(starts, ["file", "_block"]).select("file", (F.col("_at") + F.col("_start")).alias("line_no"), "value")


def json_lines(spark: SparkSession, path: str, schema: str, strict: bool = False) -> tuple[DataFrame, DataFrame]:
    """(records, damaged): the lines of JSON files as records (S7, S12), and those that are none as (file, line_no, value).

    Records have ``file`` and ``line_no``; blank lines are skipped.  Damaged is what does not
    parse, or does not fit the schema; if it is ``strict``, reading records fails at such a line and names it.
    """
    whole = T.StructType.fromDDL(schema).add("_corrupt", T.StringType())
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    read = lines.withColumn("x", F.from_json("value", whole, options)).withColumn("fine", F.col("x").isNotNull() & F.col("x._corrupt").isNull())
    damaged = read.where(~F.col("fine")).select("file", "line_no", "value")
    if strict:
        where = F.concat(F.lit("no record: "), F.col("file"), F.lit(":"), F.col("line_no").cast("string"))
        read = read.withColumn("fine", F.when(F.col("fine"), True).otherwise(F.raise_error(where).cast("boolean")))
    return read.where("fine").select("file", "line_no", *(F.col(f"x.{c}").alias(c) for c in whole.names[:-1])), damaged


def manifest(spark: SparkSession, path: str, schema: str = model.MANIFEST) -> tuple[DataFrame, DataFrame]:
    """(records with an id and their order ``at``, lines that are no records) of a JSONL log.

    Order is by file and line; ``latest`` (``aggregates.latest_per_key``) makes the last one win.
    """
    records, damaged = json_lines(spark, path, schema)
    at = F.struct("file", "line_no").alias("at")
    return records.where("id IS NOT NULL").withColumn("at", at).drop("file", "line_no"), damaged.select("value", at)


def by_leaf(spark: SparkSession, path: str, pattern: str = r"f(\d{4,})\.jpg$") -> DataFrame:
    """(leaf, path, length) of files whose name matches (S11); leaves beyond 9999 have longer names."""
    files = spark.read.format("binaryFile").load(path).select("path", "length")
    leaf = F.regexp_extract("path", pattern, 1)
    return files.where(leaf != "").select(leaf.cast("int").alias("leaf"), "path", "length")


def fenced_json(bodies: DataFrame, text: str, schema: str) -> DataFrame:
    """``bodies`` with ``payload`` from its one fenced JSON block, and ``error`` where there is not exactly one."""
    blocks = F.regexp_extract_all(text, F.lit(r"(?s)```json\s*\n(.*?)\n\s*```"), F.lit(1))
    one = F.size(blocks) == 1
    payload = F.from_json(F.get(blocks, 0), schema)
    valid = F.try_parse_json(F.get(blocks, 0)).isNotNull()
    return bodies.withColumn("payload", F.when(one & valid, payload)).withColumn(
        "error", F.when(~one, "needs exactly one JSON block").when(~valid, "block is not JSON")
    )


def raw_lines(lines: DataFrame, text: str) -> DataFrame:
    """(line_id, text) of lines ``[id ...] text``."""
    head = r"^\[([^\]\s]+)[^\]]*\] ?(.*)$"
    return lines.where(F.col(text).rlike(head)).select(F.regexp_extract(text, head, 1).alias("line_id"), F.regexp_extract(text, head, 2).alias("raw"))


def leaves(spark: SparkSession, start: int = 1, end: int = 651, last: int = 651) -> DataFrame:
    """Leaves of an inclusive range inside the book."""
    if not 1 <= start <= end <= last:
        raise ValueError(f"range {start}..{end} is not inside 1..{last}")
    return spark.range(start, end + 1).select(F.col("id").cast("int").alias("leaf"))


# Fixed values of the JPEG format: codes of frame headers, and of markers that stand alone.
FRAME_CODES = frozenset(range(0xC0, 0xD0)) - {0xC4, 0xC8, 0xCC}
LONE_CODES = frozenset(range(0xD0, 0xDA))
MARKER = re.compile(rb"\xff+([^\xff])", re.S)


def jpeg_size(data: bytes) -> tuple[int | None, int | None, str | None]:
    """(width, height, error) from the frame header of a JPEG.

    Segments give their own length, so the search for the next marker starts behind each.
    """
    error, at = ("no frame", 2) if data.startswith(b"\xff\xd8") else ("no start marker", len(data))
    while found := MARKER.search(data, at):
        code, at = found[1][0], found.end()
        if code in LONE_CODES:
            continue
        length = int.from_bytes(data[at : at + 2], "big")
        if code in FRAME_CODES and length >= 7 and len(data) >= at + 7:
            height, width = (int.from_bytes(data[at + k : at + k + 2], "big") for k in (3, 5))
            if width and height:
                return width, height, None
            error, at = "size is not positive", len(data)
        elif length < 2 and len(data) >= at + 2:
            error, at = "segment too short", len(data)
        at += length
    return None, None, error


@F.pandas_udf(T.StructType().add("width", "integer").add("height", "integer").add("error", "string"))
def image_size(content: pd.Series) -> pd.DataFrame:
    """``jpeg_size`` over ``binaryFile`` contents."""
    return pd.DataFrame([jpeg_size(bytes(c)) for c in content], columns=["width", "height", "error"]).astype(
        {"width": "Int32", "height": "Int32"}
    )


def write_files(rows: DataFrame, folder: str) -> int:
    """A file in ``folder`` for each row (name, content), written aside by its task and then moved; how many there are."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = store(folder)
        where.create_dir(root, recursive=True)
        for batch in batches:
            for name, content in zip(batch["name"].to_pylist(), batch["content"].to_pylist(), strict=True):
                aside = f"{root}/_{uuid.uuid4().hex}"
                with where.open_output_stream(aside) as file:
                    file.write(content)
                where.move(aside, f"{root}/{name}")
            yield pa.RecordBatch.from_pydict({"n": pa.array([batch.num_rows], pa.int64())})

    return rows.select("name", "content").mapInArrow(run, "n long").agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]


def images(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes, sha256, size) of image files."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"), image_size("content").alias("size"))
