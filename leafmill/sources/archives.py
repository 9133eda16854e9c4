"""ZIP archives member by member (S14, V52): the index by ranges, then a row for each member, checked where it is read.

Archives and members are reached through ``pyarrow.fs`` by position, so the index of an archive costs its
central directory and a member its own bytes; a member is read in pieces, so neither needs to fit in memory.
"""

from __future__ import annotations

import hashlib
import posixpath
import struct
import uuid
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from leafmill.sources.page_source import store

MEMBERS = "path string, name string, at long, packed long, size long, crc long, method int, error string"
PIECE = 1 << 20


def members(spark: SparkSession, path: str) -> DataFrame:
    """A row for each member of the archives at ``path`` (a glob), from their central directories; one with ``error`` for what is no archive."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for address in batch["path"].to_pylist():
                where, name = store(address)
                try:
                    with where.open_input_file(name) as file, zipfile.ZipFile(file) as z:
                        rows += [(address, x.filename, x.header_offset, x.compress_size, x.file_size, x.CRC, x.compress_type, None) for x in z.infolist() if not x.is_dir()]
                except (zipfile.BadZipFile, struct.error, ValueError) as e:
                    rows.append((address, *(None,) * 6, str(e)))
            kinds = (pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(zip(*rows, strict=True) if rows else [()] * 8, kinds, strict=True)],
                names=["path", "name", "at", "packed", "size", "crc", "method", "error"],
            )

    return spark.read.format("binaryFile").load(path).select("path").mapInArrow(run, MEMBERS)


def unpacked(file: pa.NativeFile, at: int, packed: int, method: int) -> Iterator[bytes]:
    """The contents of a member, in pieces, from the place of its own header."""
    file.seek(at)
    head = file.read(30)
    if len(head) < 30 or head[:4] != b"PK\3\4":
        raise ValueError("no header")
    file.seek(at + 30 + sum(struct.unpack("<HH", head[26:30])))
    if method not in (zipfile.ZIP_STORED, zipfile.ZIP_DEFLATED):
        raise ValueError(f"method {method}")
    inflate = zlib.decompressobj(-15) if method else None
    while packed:
        piece = file.read(min(PIECE, packed))
        if not piece:
            raise ValueError("cut off")
        packed -= len(piece)
        if inflate is None:
            yield piece
            continue
        while piece:  # a small piece may unpack to a large one
            yield inflate.decompress(piece, PIECE)
            piece = inflate.unconsumed_tail
    if inflate is not None:
        yield inflate.flush()


def checked(found: DataFrame) -> DataFrame:
    """``members`` with the ``sha256`` of their contents, and ``error`` where size or CRC is not that of the index."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            digests, errors = [], []
            for row in batch.to_pylist():
                digest, crc, size, error = hashlib.sha256(), 0, 0, row["error"]
                if error is None:
                    where, name = store(row["path"])
                    try:
                        with where.open_input_file(name) as file:
                            for piece in unpacked(file, row["at"], row["packed"], row["method"]):
                                digest.update(piece)
                                crc, size = zlib.crc32(piece, crc), size + len(piece)
                        error = "size" if size != row["size"] else "CRC" if crc != row["crc"] else None
                    except (ValueError, zlib.error, OSError) as e:
                        error = str(e)
                digests.append(None if error else digest.hexdigest())
                errors.append(error)
            columns = [batch[c] for c in batch.schema.names if c != "error"]
            names = [c for c in batch.schema.names if c != "error"]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(digests, pa.string()), pa.array(errors, pa.string())], names=[*names, "sha256", "error"])

    names = [f for f in MEMBERS.split(", ") if not f.startswith("error")]
    dealt = found.repartition("path", "name")  # members of one archive go to many tasks
    return dealt.mapInArrow(run, ", ".join([*names, "sha256 string", "error string"]))


def missing_members(found: DataFrame, expected: DataFrame) -> DataFrame:
    """(path, name, side): members that ``expected`` (path, name) has and the archives have not, and the other way round."""
    have = found.where("error IS NULL").select("path", "name")
    lost = expected.join(have, ["path", "name"], "left_anti").withColumn("side", F.lit("missing"))
    return lost.unionByName(have.join(expected, ["path", "name"], "left_anti").withColumn("side", F.lit("unexpected")))


def write_archives(rows: DataFrame, path: str) -> DataFrame:
    """Writes an archive for each value of ``archive`` in ``rows`` (archive, name, content), members by name; (archive, members).

    An archive is one file, written aside by one task and then moved, so a task that runs again replaces it whole.
    """
    dealt = rows.select("archive", "name", "content").repartition("archive").sortWithinPartitions("archive", "name")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = store(path)
        where.create_dir(root, recursive=True)
        now, out, archive, aside, count = None, None, None, None, 0

        def ended() -> pa.RecordBatch:
            archive.close()
            out.close()
            where.move(aside, posixpath.join(root, f"{now}.zip"))
            return pa.RecordBatch.from_pydict({"archive": pa.array([now], pa.string()), "members": pa.array([count], pa.int64())})

        for batch in batches:
            for name, member, content in zip(*(batch[c].to_pylist() for c in ("archive", "name", "content")), strict=True):
                if name != now:
                    if archive is not None:
                        yield ended()
                    now, aside, count = name, posixpath.join(root, f"_{uuid.uuid4().hex}"), 0
                    out = where.open_output_stream(aside)
                    archive = zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED)
                archive.writestr(zipfile.ZipInfo(member), content, zipfile.ZIP_DEFLATED)
                count += 1
        if archive is not None:
            yield ended()

    return dealt.mapInArrow(run, "archive string, members long")
