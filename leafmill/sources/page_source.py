"""Page files as a Spark data source: ``spark.read.format("leafpages")`` and ``df.write.format("leafpages")``.

Reading gives a row for each physical line of each page file below ``path`` (S1, S13): files are
bundled to partitions by size, only the columns of the schema that is asked for are made
(``.schema("page_id string, line_id string")``), and filters on the fields of a page's header are
tested before its body is looked at.  Writing takes ``id`` and ``body`` (K2) and makes a file of each page, by a commit
protocol: tasks write aside, the driver moves what they report into place when all are
done, and a failed job leaves nothing.  A task holds one page and one Arrow batch of a few MB at a time, however
many or long its pages are.  Files are reached through ``pyarrow.fs``, so that executors see the
same store as the driver.
"""

from __future__ import annotations

import posixpath
import re
import uuid
from collections.abc import Iterable, Iterator, Sequence
from contextlib import contextmanager
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from leafmill.sources.pages import LINE, ZONE

LINES = (
    "page_id string, view string, scope string, status string, zone_pos int, zone_id string, zone_kind string, "
    "line_pos int, line_id string, flag string, initial string, content string"
)
HEADER = {"page_id": "id", "view": "view", "scope": "scope", "status": "status"}
BUNDLE = 32 << 20  # bytes of files in a partition
BATCH = 1 << 20  # characters of lines, or bytes of pages, in an Arrow batch; one of more is a batch by itself
SUFFIX = ".txt"
PUSHDOWN = "spark.sql.python.filterPushdown.enabled"
BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def store(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a path or address, and the path in it."""
    if "://" not in path and path.startswith("file:"):
        path = "file://" + path.removeprefix("file:")
    return fs.FileSystem.from_uri(path) if "://" in path else (fs.LocalFileSystem(), path)


def arrow_batches(rows: Iterable[tuple], schema: pa.Schema, most: int = BATCH) -> Iterator[pa.RecordBatch]:
    """Rows as Arrow batches that are full at ``most`` characters, a field counted as 8 more than it has."""
    made = lambda: pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*held, strict=True), schema, strict=True)], schema=schema)
    held, size = [], 0
    for row in rows:
        own = sum(8 + len(v) if isinstance(v, str) else 8 for v in row)
        if held and size + own > most:
            yield made()
            held, size = [], 0
        held.append(row)
        size += own
    if held:
        yield made()


@dataclass
class Files(InputPartition):
    paths: tuple[str, ...]


class PageReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict):
        self.names, self.path, self.schema = schema.names, options["path"], to_arrow_schema(schema)
        self.size = int(options.get("bundle", BUNDLE))
        self.wanted: dict[str, set] = {}  # values that a header field may have

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:  # noqa: N802
        for f in filters:
            field = f.attribute[0] if isinstance(f, EqualTo | In) and len(f.attribute) == 1 else None
            if field not in HEADER:
                yield f
                continue
            values = {f.value} if isinstance(f, EqualTo) else set(f.value)
            self.wanted[field] = self.wanted.get(field, values) & values

    def partitions(self) -> Sequence[InputPartition]:
        where, root = store(self.path)
        found = where.get_file_info(fs.FileSelector(root, recursive=True))
        own = sorted((x.path, x.size) for x in found if x.is_file and x.path.endswith(SUFFIX) and "/_" not in x.path.removeprefix(root))
        bundles: list[list[str]] = []
        room = 0
        for path, size in own:
            if not bundles or room < size:
                bundles.append([])
                room = self.size
            bundles[-1].append(path)
            room -= size
        return [Files(tuple(b)) for b in bundles] or [Files(())]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        where, _ = store(self.path)

        def text(path: str) -> str:
            with where.open_input_stream(path) as file:
                return file.read().decode()

        return arrow_batches((row for path in partition.paths for row in self.rows(path, text(path))), self.schema)

    def rows(self, path: str, text: str) -> Iterator[tuple]:
        lines = text.splitlines()
        fences = [i for i, line in enumerate(lines) if line == "---"][:2]
        if fences[:1] != [0] or len(fences) < 2:
            raise ValueError(f"{path} has no header")
        said: dict[str, str] = {}
        for line in lines[1 : fences[1]]:
            key, _, value = line.partition(": ")
            said.setdefault(key, value)
        row = {column: said.get(key) for column, key in HEADER.items()}
        if any(row[field] not in values for field, values in self.wanted.items()):
            return
        zone, position = -1, 0
        for n, line in enumerate(lines[fences[1] + 1 :], fences[1] + 2):
            if line in ("", "---") or line.startswith("> "):
                continue
            if m := re.match(ZONE, line):
                zone, position = zone + 1, 0
                row |= {"zone_pos": zone, "zone_id": m[1], "zone_kind": m[2]}
            elif (m := re.match(LINE, line)) and zone >= 0:
                row |= {"line_pos": position, "line_id": m[1], "flag": m[2] or "", "initial": m[3] or "", "content": m[4]}
                position += 1
                yield tuple(row[name] for name in self.names)
            else:
                raise ValueError(f"{path}:{n} is no line of a page")


@dataclass
class Written(WriterCommitMessage):
    folder: str
    names: tuple[str, ...]  # in the folder


class PageWriter(DataSourceArrowWriter):
    def __init__(self, schema: StructType, options: dict, overwrite: bool):
        if not {"id", "body"} <= set(schema.names):
            raise ValueError("pages have the columns id and body")
        self.path, self.overwrite = options["path"], overwrite
        self.aside = f"_aside-{uuid.uuid4().hex}"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        where, root = store(self.path)
        folder = posixpath.join(root, self.aside, uuid.uuid4().hex)  # of this attempt
        where.create_dir(folder, recursive=True)
        names = []
        for batch in iterator:
            for key, body in zip(batch["id"], batch["body"], strict=True):
                if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9._-]*", name := key.as_py() or ""):
                    raise ValueError(f"page id {key.as_py()!r} is no file name")
                if not body.is_valid:
                    raise ValueError(f"page {name} has no body")
                names.append(name + SUFFIX)
                with where.open_output_stream(posixpath.join(folder, names[-1])) as file:
                    file.write(body.as_buffer())  # the bytes of the batch, not a copy
        return Written(folder, tuple(names))

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        where, root = store(self.path)
        written = [m for m in messages if m is not None]
        new = {name for m in written for name in m.names}
        if len(new) < sum(len(m.names) for m in written):
            self.abort(messages)
            raise ValueError("a page id occurs more than once")
        if self.overwrite:
            for x in where.get_file_info(fs.FileSelector(root)):
                if x.is_file and x.path.endswith(SUFFIX) and x.base_name not in new:
                    where.delete_file(x.path)
        for m in written:
            for name in m.names:
                where.move(posixpath.join(m.folder, name), posixpath.join(root, name))
        where.delete_dir(posixpath.join(root, self.aside))
        with where.open_output_stream(posixpath.join(root, "_SUCCESS")):
            pass

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        where, root = store(self.path)
        where.delete_dir_contents(posixpath.join(root, self.aside), missing_dir_ok=True)


class PageSource(DataSource):
    """Page files, see the module."""

    @classmethod
    def name(cls) -> str:
        return "leafpages"

    def schema(self) -> str:
        return LINES

    def reader(self, schema: StructType) -> DataSourceReader:
        return PageReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return PageWriter(schema, self.options, overwrite)


def register(spark: SparkSession) -> None:
    """Makes the source known to a session."""
    spark.dataSource.register(PageSource)
    spark.conf.set(PUSHDOWN, "true")


def page_lines(spark: SparkSession, path: str, *columns: str, **options: str) -> DataFrame:
    """``columns`` (all if none are named) of the lines of page files."""
    register(spark)
    known = StructType.fromDDL(LINES)
    schema = StructType([known[c] for c in columns]) if columns else known
    return spark.read.format("leafpages").schema(schema).options(**options).load(path)


@contextmanager
def small_batches(spark: SparkSession, most: int = BATCH) -> Iterator[None]:
    """Spark hands Arrow batches to Python that are full at ``most`` bytes; its default is 10,000 rows or 64 MB."""
    before = spark.conf.get(BATCH_BYTES)
    spark.conf.set(BATCH_BYTES, str(most))
    try:
        yield
    finally:
        spark.conf.set(BATCH_BYTES, before)


def write_pages(pages: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A file for each row of ``pages`` (id, body)."""
    register(pages.sparkSession)
    with small_batches(pages.sparkSession):
        pages.select("id", "body").write.format("leafpages").mode(mode).save(path)
