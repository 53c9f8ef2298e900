"""Rectangles x0, y0, w, h as shapes: clips, buffers, descriptors and checks."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landseries.operators import spans
from landseries.operators import tables as tab


def difference(a: DataFrame, b: DataFrame) -> DataFrame:
    """(fid, x, y): the cells of a's rectangles that no rectangle of b covers."""
    return spans.cells(spans.minus(spans.rectangle_spans(a), spans.rectangle_spans(b))).select("fid", "x", "y")


def clipped(a: DataFrame, b: DataFrame) -> DataFrame:
    """The rectangles of a that overlap ones of b, cut to the common part; columns of b get the prefix o_."""
    met = tab.rectangle_join(a, b)
    low_x, low_y = F.greatest("x0", "o_x0"), F.greatest("y0", "o_y0")
    w = F.least(F.col("x0") + F.col("w"), F.col("o_x0") + F.col("o_w")) - low_x
    h = F.least(F.col("y0") + F.col("h"), F.col("o_y0") + F.col("o_h")) - low_y
    return met.withColumns({"x0": low_x, "y0": low_y, "w": w, "h": h})


def owned_cells(rects: DataFrame) -> DataFrame:
    """(fid, n): cells left to each rectangle when a shared cell goes to the least fid."""
    owner = spans.area(spans.owned(spans.rectangle_spans(rects)), "fid").withColumnRenamed("area", "n")
    return rects.select("fid").join(owner, "fid", "left").select("fid", F.coalesce("n", F.lit(0)).alias("n"))


def buffered(rects: DataFrame, by: int) -> DataFrame:
    """Rectangles grown by so much on every side, or shrunk if negative; those of which nothing is left go."""
    sides = {"x0": F.col("x0") - by, "y0": F.col("y0") - by, "w": F.col("w") + 2 * by, "h": F.col("h") + 2 * by}
    return rects.withColumns(sides).where("w > 0 and h > 0")


def descriptors(w: Column, h: Column) -> tuple[Column, Column]:
    """Compactness (4 pi area / perimeter squared) and elongation (longer by shorter side) of a rectangle."""
    return 4 * math.pi * w * h / (2 * (w + h)) ** 2, F.greatest(w, h) / F.least(w, h)


def ring(x: Column, y: Column, w: Column, h: Column) -> Column:
    """The corners of a rectangle as a closed ring."""
    point = lambda a, b: F.struct(a.alias("x"), b.alias("y"))
    return F.array(point(x, y), point(x + w, y), point(x + w, y + h), point(x, y + h), point(x, y))


def ring_problem(points: Column) -> Column:
    """empty, open or flat, or null for a sound ring. Flat: the enclosed area is zero."""
    terms = F.transform(
        F.arrays_zip(F.slice(points, 1, F.size(points) - 1).alias("a"), F.slice(points, 2, F.size(points) - 1).alias("b")),
        lambda p: p["a"]["x"] * p["b"]["y"] - p["b"]["x"] * p["a"]["y"],
    )
    twice = F.aggregate(terms, F.lit(0).cast("long"), lambda s, v: s + v)
    return F.when(F.size(points) < 4, "empty").when(F.element_at(points, 1) != F.element_at(points, -1), "open").when(twice == 0, "flat")


def jittered(value: Column, deviation: Column, factor: float, one: Column, two: Column) -> Column:
    """value with normal noise of deviation / factor, from two uniform numbers above 0."""
    return value + F.sqrt(-2 * F.log(one)) * F.cos(2 * math.pi * two) * deviation / factor


def multitemporal(values: DataFrame) -> DataFrame:
    """(pixel, band, date, value): the mean of the neighbourhood times the mean ratio of a value to it over all dates.

    A neighbourhood is the pixel and the ones before and after it.
    """
    near = values.withColumn("by", F.explode(F.array(*map(F.lit, (-1, 0, 1))))).select((F.col("pixel") + F.col("by")).alias("pixel"), "band", "date", F.col("value").alias("v"))
    local = near.groupBy("pixel", "band", "date").agg(F.avg("v").alias("local"))
    both = values.join(local, ["pixel", "band", "date"]).where("local != 0")
    ratio = both.groupBy("pixel", "band").agg(F.avg(F.col("value") / F.col("local")).alias("ratio"))
    return both.join(ratio, ["pixel", "band"]).select("pixel", "band", "date", (F.col("local") * F.col("ratio")).alias("value"))
