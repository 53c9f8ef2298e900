"""Regularisation of class maps: sieves inside top-level classes, their union, resampling and recoding by polygons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landseries.operators import patches, spans, tables
from landseries.sources.store import stored


def sieved_by_rule(cells: DataFrame, parent: Column, least: int) -> DataFrame:
    """cells (x, y, label) sieved inside each top-level class: eight neighbours, then four.

    A patch under `least` cells takes the label of the largest patch of its own top-level
    class that it touches, if there is one; a class with one label under it stays as it is.
    The classes' results don't overlap, so their sum is one table and all are sieved together.
    """
    for eight in (True, False):
        named = stored(patches.patches(cells, eight).withColumn("parent", parent))
        cells = stored(patches.sieved(named, least, eight, within="parent"))
    return cells


def resampled(cells: DataFrame, step: int) -> DataFrame:
    """(x, y, label) at a coarser step: the commonest label of each square, the least of several."""
    squares = cells.select(F.struct(F.floor(F.col("x") / step).alias("x"), F.floor(F.col("y") / step).alias("y")).alias("cell"), "label")
    return tables.majority(squares, "cell", "label").select("cell.x", "cell.y", F.col("majority").alias("label"))


def recoded(cells: DataFrame, mask: DataFrame, labels: Sequence[int], to: int, inside: bool) -> DataFrame:
    """cells of which those with one of the labels inside (or outside) the spans of a mask become `to`."""
    flat = spans.union(mask).withColumn("fid", F.lit(1))
    hit = spans.at_points(cells.where(F.col("label").isin(list(labels))).select("x", "y"), flat).select("x", "y", F.lit(True).alias("hit"))
    both = cells.join(hit, ["x", "y"], "left")
    change = F.col("label").isin(list(labels)) & (F.col("hit").isNotNull() if inside else F.col("hit").isNull())
    return both.select("x", "y", F.when(change, to).otherwise(F.col("label")).alias("label"))


def merged(rules: Sequence[DataFrame], least: int, step: int | None = None, water: DataFrame | None = None, water_label: int = 0, sea_label: int = 0) -> DataFrame:
    """One map of several rules' maps (x, y, label; 0 where a rule says nothing): summed, sieved twice, resampled, and water outside the polygons of inland water recoded."""
    every = rules[0]
    for more in rules[1:]:
        every = every.unionByName(more)
    cells = every.groupBy("x", "y").agg(F.sum("label").cast("int").alias("label"))
    cells = patches.sieve_once(patches.sieve_once(cells, least, True), least, False)
    if step:
        cells = resampled(cells, step)
    return cells if water is None else recoded(cells, water, [water_label], sea_label, inside=False)


def only_listed(cells: DataFrame, listed: DataFrame) -> DataFrame:
    """cells (x, y, label, patch) with label 0 but in the patches of a list (patch)."""
    marks = listed.select("patch", F.lit(True).alias("listed")).distinct()
    return cells.join(marks, "patch", "left").select("x", "y", F.when(F.col("listed"), F.col("label")).otherwise(0).alias("label"), "patch")
