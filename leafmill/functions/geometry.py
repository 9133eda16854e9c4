"""Geometry of columns, lines and tiles.  A rectangle is x, y, w, h; a box is l, t, r, b."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PADDING = 12


def half_even(x: Column, digits: int = 0) -> Column:
    """Rounding with halves to the even digit (G1)."""
    return F.bround(x, digits)


def floor_div(a: Column, b: Column) -> Column:
    """Division that rounds down."""
    return F.floor(a / b)


def clamp(x: Column, low: Column, high: Column) -> Column:
    """(G3)"""
    return F.least(F.greatest(x, low), high)


def along(x0: Column, x1: Column, y: Column, y0: Column, y1: Column) -> Column:
    """Where a rule from (x0, y0) to (x1, y1) is at y."""
    return x0 + (x1 - x0) * ((y - y0) / (y1 - y0))


def envelope(left: tuple[Column, Column], right: tuple[Column, Column], y: Column, h: Column, y0: Column, y1: Column) -> Column:
    """struct(x, w) from before the left rule to after the right one, over the height of a line."""
    at = lambda rule, edge: along(*rule, edge, y0, y1)
    x = F.floor(F.least(at(left, y), at(left, y + h))) - PADDING
    end = F.ceil(F.greatest(at(right, y), at(right, y + h))) + PADDING
    return F.struct(x.alias("x"), (end - x).alias("w"))


def contains(outer: Column, inner: Column) -> Column:
    """Whether a rectangle holds another, edges included."""
    inside = lambda at, size: (inner[at] >= outer[at]) & (inner[at] + inner[size] <= outer[at] + outer[size])
    return inside("x", "w") & inside("y", "h")


def in_page(rect: Column, width: Column, height: Column) -> Column:
    """(G7)"""
    page = F.struct(F.lit(0).alias("x"), F.lit(0).alias("y"), width.alias("w"), height.alias("h"))
    return contains(page, rect) & (rect["w"] >= 0) & (rect["h"] >= 0)


def box_is_valid(box: Column, width: Column, height: Column) -> Column:
    """(G8)"""
    across = (box["l"] >= 0) & (box["l"] < box["r"]) & (box["r"] <= width)
    down = (box["t"] >= 0) & (box["t"] < box["b"]) & (box["b"] <= height)
    return F.coalesce(across & down, F.lit(False))


def as_rect(box: Column) -> Column:
    """(G14)"""
    return F.struct(
        box["l"].alias("x"), box["t"].alias("y"), (box["r"] - box["l"]).alias("w"), (box["b"] - box["t"]).alias("h")
    )


def as_box(rect: Column) -> Column:
    """(G14)"""
    return F.struct(
        rect["x"].alias("l"), rect["y"].alias("t"), (rect["x"] + rect["w"]).alias("r"), (rect["y"] + rect["h"]).alias("b")
    )


def variant_size(width: Column, height: Column, most: Column) -> Column:
    """struct(width, height) of a copy at most ``most`` wide, never enlarged."""
    return F.when(width <= most, F.struct(width.cast("int").alias("width"), height.cast("int").alias("height"))).otherwise(
        F.struct(most.cast("int").alias("width"), F.bround(height * most / width).cast("int").alias("height"))
    )


def column_estimate(width: Column, height: Column) -> Column:
    """Boxes of the two columns of an unmeasured page, from fixed shares of its size."""
    share = lambda percent, of: F.bround(of * (percent / 100)).cast("int")
    left, right, overlap = share(6, width), share(94, width), share(2.5, width)
    middle = floor_div(left + right, F.lit(2)).cast("int")
    box = lambda l, r: F.struct(  # noqa: E731, E741
        l.alias("l"), share(7, height).alias("t"), r.alias("r"), share(92, height).alias("b")
    )
    return F.struct(box(left, middle + overlap).alias("first"), box(middle - overlap, right).alias("second"))


def column_bounds(width: Column, first: Column, second: Column, audited: dict[str, Column] | None = None) -> Column:
    """struct(first, second) of (l, r) about the divider between two columns; audited bounds win."""
    divider = floor_div(first["r"] + second["l"], F.lit(2)).cast("int")
    edge = width - F.when(width < 2700, 250).otherwise(70)
    pair = lambda left, right: F.struct(left.cast("int").alias("l"), right.cast("int").alias("r"))
    one, two = pair(F.greatest(F.lit(0), first["l"] - 40), divider + 30), pair(divider - 30, edge)
    audited = audited or {}
    pick = lambda k, other: F.coalesce(audited[k], other) if k in audited else other
    return F.struct(pick("first", one).alias("first"), pick("second", two).alias("second"))


def percent_place(rect: Column, width: Column, height: Column) -> Column:
    """Position and size in percent of the page."""
    return F.struct(
        (rect["x"] * 100.0 / width).alias("left"),
        (rect["y"] * 100.0 / height).alias("top"),
        (rect["w"] * 100.0 / width).alias("width"),
        (rect["h"] * 100.0 / height).alias("height"),
    )


def line_crop(index: Column, n: Column, box: Column, low: float = 5.8, high: float = 95.8) -> Column:
    """struct(crop, context) about the interpolated centre of 0-based line ``index`` of ``n``."""
    height = (box["b"] - box["t"]).cast("double")
    span = height * (high - low) / 100
    centre = F.when(n == 1, box["t"] + height / 2).otherwise(box["t"] + height * (low + index / (n - 1) * (high - low)) / 100)
    step = F.when(n == 1, height / 20).otherwise(span / (n - 1))

    def rect(above: float, below: float) -> Column:
        top = F.greatest(box["t"], F.bround(centre - step * above).cast("int"))
        bottom = F.least(box["b"], F.bround(centre + step * below).cast("int"))
        return F.struct(box["l"].alias("x"), top.alias("y"), (box["r"] - box["l"]).alias("w"), (bottom - top).alias("h"))

    return F.struct(rect(0.78, 0.70).alias("crop"), rect(2.6, 2.6).alias("context"))


def line_rectangles(centres: str, w, nominal: Column, box: Column, overlap: int = 18) -> Column:
    """struct(crop, context) of each line from its neighbours' centres."""
    c = F.col(centres)
    before, after = F.coalesce(F.lag(c).over(w), c - nominal), F.coalesce(F.lead(c).over(w), c + nominal)

    def rect(low: Column, high: Column) -> Column:
        top = F.greatest(box["t"], F.bround(low).cast("int"))
        bottom = F.least(box["b"], F.bround(high).cast("int"))
        return F.struct(box["l"].alias("x"), top.alias("y"), (box["r"] - box["l"]).alias("w"), (bottom - top).alias("h"))

    crop = rect((before + c) / 2 - overlap, (c + after) / 2 + overlap)
    return F.struct(crop.alias("crop"), rect(c - nominal * 2.7, c + nominal * 2.7).alias("context"))


def tiles(box: Column, n: Column, overlap: Column) -> Column:
    """``n`` boxes from top to bottom that overlap by exactly ``overlap`` (W16); null where V55 fails."""
    height = box["b"] - box["t"]
    above = floor_div(overlap, F.lit(2))
    edge = lambda i: box["t"] + F.floor(height * i / n)
    one = lambda i: F.struct(
        box["l"].alias("l"),
        F.when(i == 0, edge(i)).otherwise(edge(i) - above).cast("int").alias("t"),
        box["r"].alias("r"),
        F.when(i == n - 1, edge(i + 1)).otherwise(edge(i + 1) + overlap - above).cast("int").alias("b"),
    )
    return F.when(tiles_are_valid(box, n, overlap), F.transform(F.sequence(F.lit(0), n - 1), one))


def tiles_are_valid(box: Column, n: Column, overlap: Column) -> Column:
    """(V55)"""
    height = box["b"] - box["t"]
    return (n >= 1) & (overlap >= 0) & (n <= height) & ((n == 1) | (overlap < F.ceil(height / n)))


def back_off(attempt: Column) -> Column:
    """Seconds to wait before a further attempt, without its random part."""
    return F.least(F.lit(60.0), F.pow(F.lit(2.0), attempt - 1))
