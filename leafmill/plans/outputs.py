"""Outputs that others rely on: files in total order, versions behind a pointer.

``write_sorted`` deals rows by sampled ranges of their key, so that no task has all of them, and
sorts each range: files in the order of their names are in total order.  A manifest beside
them says which keys each file has; reading a range of keys opens only the files that may have some.

``publish`` writes a version of a dataset in a folder of its own and then switches a
small document that names the current one.  A reader asks the document once and
reads that version to its end, whatever is published meanwhile; ``reclaim`` deletes versions
that have been replaced for longer than readers take.
"""

from __future__ import annotations

import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from leafmill.shared import Document

DATA, MANIFEST, POINTER = "data", "manifest", "current.json"
FILE_ROWS = 1 << 20  # rows of a file, about


def write_sorted(rows: DataFrame, path: str, *order: str, files: int | None = None) -> None:
    """``rows`` as files in total order by ``order`` (nulls first), with a manifest (file, rows, first, last, offset).

    ``files`` of them at least, more where one would have over ``FILE_ROWS``: no task sorts more than that, however many rows there are.
    """
    spark = rows.sparkSession
    files = max(files or 1, -(-rows.count() // FILE_ROWS))
    dealt = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    dealt.write.mode("overwrite").parquet(f"{path}/{DATA}")
    at, name = F.col("_metadata.row_index").alias("at"), F.col("_metadata.file_name").alias("file")
    written = spark.read.schema(rows.schema).parquet(f"{path}/{DATA}").select(name, at, F.struct(*order).alias("key"))
    sizes = written.groupBy("file").agg(F.count(F.lit(1)).alias("rows"))
    ends = written.join(F.broadcast(sizes), "file").where((F.col("at") == 0) | (F.col("at") == F.col("rows") - 1))  # two rows a file, whose keys alone are compared
    ranges = ends.groupBy("file").agg(F.first("rows").alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
    before = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # over files, not rows
    ranges.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0))).coalesce(1).write.mode("overwrite").parquet(f"{path}/{MANIFEST}")


def manifest_of(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{MANIFEST}")


def out_of_order(spark: SparkSession, path: str) -> DataFrame:
    """Files that begin before the one before them ends; none if the output is in total order."""
    by_name = Window.orderBy("file")  # over files, not rows
    return manifest_of(spark, path).withColumn("before", F.lag("last").over(by_name)).where("first < before")


def read_sorted(spark: SparkSession, path: str, low: tuple | None = None, high: tuple | None = None) -> DataFrame:
    """Rows whose key is within ``low`` and ``high`` (inclusive, prefixes of the key), with their ``place`` in the whole order."""
    known = manifest_of(spark, path)
    names = known.schema["first"].dataType.names
    data = spark.read.parquet(f"{path}/{DATA}")
    kinds = {n: data.schema[n].dataType for n in names}

    def prefix(value: Column, bound: tuple) -> tuple[Column, Column]:
        own = names[: len(bound)]
        return F.struct(*(value[n] for n in own)), F.struct(*(F.lit(v).cast(kinds[n]).alias(n) for n, v in zip(own, bound, strict=True)))

    def within(first: Column, last: Column) -> Column:
        fine = F.lit(True)
        if low is not None:
            a, b = prefix(last, low)
            fine = fine & (a >= b)
        if high is not None:
            a, b = prefix(first, high)
            fine = fine & (a <= b)
        return fine

    chosen = known.where(within(F.col("first"), F.col("last"))).select("file", "offset").collect()  # a row for each file
    if not chosen:
        return data.where("false").withColumn("place", F.lit(0).cast("long"))
    offsets = F.create_map(*(F.lit(x) for r in chosen for x in (r["file"], r["offset"])))
    found = spark.read.schema(data.schema).parquet(*(f"{path}/{DATA}/{r['file']}" for r in chosen))
    place = F.element_at(offsets, F.col("_metadata.file_name")) + F.col("_metadata.row_index")
    key = F.struct(*names)
    return found.withColumn("place", place).where(within(key, key))


class Published:
    """Versions of a dataset below one folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.pointer = spark, path, Document(spark, f"{path}/{POINTER}")

    def publish(self, rows: DataFrame, *partitions: str) -> str:
        """Writes a new version and switches to it; the name of the version."""
        now = self.pointer.read() or {"version": None, "replaced": []}
        name = f"v-{uuid.uuid4().hex}"
        rows.write.partitionBy(*partitions).parquet(f"{self.path}/{name}")
        replaced = [*now["replaced"], *([{"version": now["version"], "at": time.time()}] if now["version"] else [])]
        self.pointer.replace({"version": name, "replaced": replaced})
        return name

    def replace_parts(self, rows: DataFrame, *partitions: str) -> str:
        """A new version in which the partitions that ``rows`` has are replaced and the others stay."""
        own = rows.select(F.struct(*partitions).alias("_own")).distinct()
        kept = self.current().join(own, F.struct(*partitions) == F.col("_own"), "left_anti")  # structs, so that null is null
        return self.publish(kept.unionByName(rows), *partitions)

    def current(self) -> DataFrame:
        """The version that is current now."""
        now = self.pointer.read()
        if now is None:
            raise FileNotFoundError(f"nothing is published at {self.path}")
        return self.spark.read.parquet(f"{self.path}/{now['version']}")

    def reclaim(self, after: float) -> list[str]:
        """Deletes versions replaced more than ``after`` seconds ago; the names of those that went."""
        now = self.pointer.read() or {"version": None, "replaced": []}
        old = [r for r in now["replaced"] if r["at"] < time.time() - after]
        if old:
            self.pointer.replace(now | {"replaced": [r for r in now["replaced"] if r not in old]})
        for r in old:  # none is named any more
            at = self.pointer.hadoop.Path(f"{self.path}/{r['version']}")
            at.getFileSystem(self.pointer.conf).delete(at, True)
        return [r["version"] for r in old]
