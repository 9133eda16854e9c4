"""Pixels of page images, and the centres of their lines.

Images are the struct of Spark's ``image`` source, which decodes JPEG, PNG and BMP files on the
executors; ``from_graymaps`` makes the same of graymap bytes in a column.  Of an image only the
profile of each column goes on, the number of dark pixels in each of its rows, counted where
the image is; smoothing, the search about each expected line and the guard are array
expressions over it.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StructType

from leafmill.functions import geometry as G
from leafmill.operators import ordered as W

IMAGE = (
    StructType().add("origin", "string").add("height", "integer").add("width", "integer").add("nChannels", "integer").add("mode", "integer").add("data", "binary")
)
GRAYMAP = re.compile(rb"P5\s+(?:#[^\n]*\n\s*)*(\d+)\s+(\d+)\s+(\d+)\s", re.S)
# Weights of red, green and blue in a grey, in 65536ths.
GREY = (19595, 38470, 7471)


def page_images(spark: SparkSession, path: str) -> DataFrame:
    """(image): decoded image files; one that is no image is left out, ``files.images`` says why."""
    return spark.read.format("image").option("dropInvalid", True).load(path)


def from_graymaps(rows: DataFrame, content: str, into: str = "image") -> DataFrame:
    """``rows`` with the images of binary graymaps (8 bit) in place of their bytes; null where the bytes are none, or too few."""
    names = [c for c in rows.columns if c != content]
    schema = StructType([rows.schema[c] for c in names]).add(into, IMAGE)
    kind = pa.struct([("origin", pa.string()), *((f, pa.int32()) for f in ("height", "width", "nChannels", "mode")), ("data", pa.binary())])

    def image(data: bytes | None) -> dict | None:
        m = GRAYMAP.match(data) if data is not None else None
        width, height, most = map(int, m.groups()) if m else (0, 0, 0)
        pixels = data[m.end() : m.end() + width * height] if m else b""
        if not (0 < most < 256 and len(pixels) == width * height > 0):
            return None
        return {"origin": None, "height": height, "width": width, "nChannels": 1, "mode": 0, "data": pixels}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = pa.array([image(x.as_py()) for x in batch[content]], kind)
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), found], names=[*names, into])

    return rows.mapInArrow(run, schema)


def greys(data: bytes, height: int, width: int, channels: int) -> np.ndarray:
    """The pixels of an image as greys, by row; of several channels the first three are blue, green and red."""
    x = np.frombuffer(data, np.uint8).reshape(height, width, channels)
    if channels < 3:
        return x[:, :, 0]
    b, g, r = (x[:, :, i].astype(np.uint32) for i in range(3))
    return ((r * GREY[0] + g * GREY[1] + b * GREY[2] + 0x8000) >> 16).astype(np.uint8)


def inset(left: int, right: int) -> int:
    """How far the edges of a column are left out of its profile."""
    return max(45, (right - left) // 14)


def row_profiles(columns: DataFrame, image: str, box: str, below: int = 105, margin: int | None = None, into: str = "profile") -> DataFrame:
    """``columns`` with the dark pixels of each row of ``box`` (l, t, r, b) in ``image``, without a margin on its left and right.

    The image does not go on.  The box is cut at the image's edges; the profile is empty where
    nothing is left of it, and null where image or box is.
    """
    names = [c for c in columns.columns if c != image]
    schema = StructType([columns.schema[c] for c in names]).add(into, ArrayType(IntegerType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, last, grey = [], None, None
            for picture, where in zip(batch[image], batch[box].to_pylist(), strict=True):
                if not picture.is_valid or where is None or not picture["data"].is_valid:
                    out.append(None)
                    continue
                data = picture["data"].as_buffer()
                if last is None or data.address != last:  # the columns of one image stand beside each other
                    last, grey = data.address, greys(data, *(picture[f].as_py() for f in ("height", "width", "nChannels")))
                off = inset(where["l"], where["r"]) if margin is None else margin
                part = grey[max(0, where["t"]) : max(0, where["b"]), max(0, where["l"] + off) : max(0, where["r"] - off)]
                out.append((part < below).sum(1).tolist())
            yield pa.RecordBatch.from_arrays([*(batch[c] for c in names), pa.array(out, pa.list_(pa.int32()))], schema=None, names=[*names, into])

    return columns.mapInArrow(run, schema)


def local_centres(
    profile: Column, top: Column, first: Column, last: Column, count: Column, radius: int = 24, least: float = 28, weights: list[float] | None = None
) -> Column:
    """Centres of ``count`` lines expected evenly from ``first`` to ``last``, each moved to the darkest row about it.

    Rows are those of the image, ``top`` being the profile's first; of equal rows the upper one
    is taken, after rounding to nine digits; a centre not beyond the one before by more than ``least`` is
    where it was expected.  Null without rows.
    """
    expected = F.transform(F.sequence(F.lit(0), count - 1), lambda i: W.evenly(first, last, i, count))
    smooth = F.transform(W.smoothed(profile.cast("array<double>"), weights or W.reflected_weights()), lambda x: F.round(x, 9))
    n = F.size(profile)

    def snapped(values: Column) -> Column:
        def at(value: Column) -> Column:
            start = F.greatest(F.lit(0), G.half_even(value - top - radius).cast("int"))
            stop = F.least(n, G.half_even(value - top + (radius + 1)).cast("int"))
            return top + W.first_maximum(values, start, stop)

        return F.transform(expected, at)

    held = F.transform(F.array(smooth), snapped)[0]  # smoothed once
    return F.when((n > 0) & (count > 0), F.transform(W.guarded(held, F.transform(expected, lambda v: G.half_even(v)), least), lambda x: x.cast("int")))
