"""Sample sets, feature names, fused vectors and zone joins as functions of DataFrames."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def summed(stats: DataFrame, keys: Sequence[str], values: Sequence[str]) -> DataFrame:
    """Statistics of several tiles put together: sums by key."""
    return stats.groupBy(*keys).agg(*(F.sum(v).alias(v) for v in values))


def fused_vector(fused: Column, first: Column, second: Column, p: Column, q: Column) -> Column:
    """The probabilities of the map that gave the fused label; of both, the strictly more confident; else zeros."""
    none = F.transform(p, lambda _: F.lit(0.0))
    more = F.when(F.array_max(p) > F.array_max(q), p).when(F.array_max(q) > F.array_max(p), q).otherwise(none)
    return F.when((fused == first) & (fused == second), more).when(fused == first, p).when(fused == second, q).otherwise(none)


def intersected(edge: Column, quality: Column, no_data: Column) -> Column:
    """1 where any mask rules a pixel out: edge mask 1, odd quality flag, even no-data flag."""
    return F.when((edge == 1) | (quality % 2 == 1) | (no_data % 2 == 0), 1).otherwise(0)


def filled_classes(own: DataFrame, other: DataFrame, label: str) -> DataFrame:
    """own with the samples of classes that it lacks, from other."""
    return own.unionByName(other.join(own.select(label).distinct(), label, "left_anti").select(*own.columns))


def parsed_names(names: DataFrame, column: str) -> DataFrame:
    """names with sensor, band and date, for names sensor_band_date; others are metadata and have nulls."""
    part = F.split(column, "_")
    able = F.col(column).rlike("^[^_]+_[^_]+_[^_]+$")
    return names.select(column, *(F.when(able, part[k]).alias(n) for k, n in enumerate(("sensor", "band", "date"))))


def near_points(points: DataFrame, cells: DataFrame, radius: int) -> DataFrame:
    """points (point, px, py) with the cells (x, y, ..) within radius: an equi-join on blocks of that size."""
    block = lambda c: F.floor(F.col(c) / radius)
    around = F.array(*map(F.lit, (-1, 0, 1)))
    spread = points.withColumn("i", F.explode(around)).withColumn("j", F.explode(around)).select("point", "px", "py", (block("px") + F.col("i")).alias("bx"), (block("py") + F.col("j")).alias("by"))
    dx, dy = F.col("x") - F.col("px"), F.col("y") - F.col("py")
    return spread.join(cells.withColumns({"bx": block("x"), "by": block("y")}), ["bx", "by"]).where(dx * dx + dy * dy <= radius * radius).drop("bx", "by")


def hedge_or_forest(convexity: Column, compactness: Column, elongation: Column) -> Column:
    """Fixed thresholds: convexity 0.7, compactness 0.4, elongation 2.5."""
    return F.when((convexity >= 0.7) & ((compactness < 0.4) | (elongation > 2.5)), "hedge").when(convexity >= 0.7, "other").otherwise("forest")
