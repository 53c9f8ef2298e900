"""Masks over dates, regular date grids and gap filling."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def date_grid(bounds: DataFrame, step: int) -> DataFrame:
    """One row per date from `first` on, every `step` days up to `last`; other columns stay."""
    return bounds.withColumn("date", F.explode(F.sequence("first", "last", F.expr(f"interval {step} days")))).drop("first", "last")


def date_grid_closed(bounds: DataFrame, step: int) -> DataFrame:
    """As date_grid, but it always ends with `last`, and a date on the day before it is dropped."""
    inner = F.filter(F.sequence("first", "last", F.expr(f"interval {step} days")), lambda d: d < F.date_sub("last", 1))
    return bounds.withColumn("date", F.explode(F.array_distinct(F.concat(inner, F.array("last"))))).drop("first", "last")


def common_bounds(obs: DataFrame, by: str) -> DataFrame:
    """The latest first date and the earliest last date over the groups `by`."""
    each = obs.groupBy(by).agg(F.min("date").alias("lo"), F.max("date").alias("hi"))
    return each.agg(F.max("lo").alias("first"), F.min("hi").alias("last"))


def gap_fill(obs: DataFrame, grid: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Linear values of each series at the grid's dates (keys, date, value).

    obs: keys, date, value, mask (0: valid). grid: keys, date. Beyond the first and last
    valid date the nearest valid value holds; a series without one gives null. One window
    pass over the union of observations and grid dates, shuffled once by the keys.
    """
    known = obs.where("mask = 0").select(*keys, "date", F.col("value").cast("double").alias("value"), F.lit(False).alias("asked"))
    both = known.unionByName(grid.select(*keys, "date", F.lit(None).cast("double").alias("value"), F.lit(True).alias("asked")))
    w = Window.partitionBy(*keys).orderBy("date", "asked")
    here = F.when(F.col("value").isNotNull(), F.struct("date", "value"))
    back = F.last(here, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    ahead = F.first(here, ignorenulls=True).over(w.rowsBetween(0, Window.unboundedFollowing))
    p, n = F.col("p"), F.col("n")
    span = F.datediff(n["date"], p["date"])
    linear = p["value"] + (n["value"] - p["value"]) * F.datediff("date", p["date"]) / span
    value = F.when(p.isNull(), n["value"]).when(n.isNull() | (span == 0), p["value"]).otherwise(linear)
    return both.withColumns({"p": back, "n": ahead}).where("asked").select(*keys, "date", value.alias("value"))


def seasonal_summary(series: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Cumulative, least and relative variation of a series' values."""
    return series.groupBy(*keys).agg(
        F.sum("value").alias("cumulative"), F.min("value").alias("minimum"), (F.stddev_pop("value") / (F.avg("value") + 1e-6)).alias("variation")
    )


def sorted_days(obs: DataFrame, keys: Sequence[str], k: int) -> DataFrame:
    """The day numbers of a pixel's valid dates by descending value (then date), the first k, zero padded."""
    origin = obs.agg(F.trunc(F.min("date"), "year").alias("origin"))
    day = obs.crossJoin(F.broadcast(origin)).where("mask = 0").withColumn("day", F.datediff("date", "origin") + 1)
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("value")).alias("v"), "day")))
    days = day.groupBy(*keys).agg(F.transform(ranked, lambda s: s["day"]).alias("days"))
    return days.select(*keys, F.slice(F.concat("days", F.array_repeat(F.lit(0), k)), 1, k).alias("days"))


def mask_from_layers(*layers: Column) -> Column:
    """0 where all layers are 0, else 1."""
    return F.when(sum(layers[1:], layers[0]) == 0, 0).otherwise(1)


def mask_from_values(value: Column, bad: Sequence[int]) -> Column:
    return F.when(value.isin(*bad), 1).otherwise(0)


def mask_from_flags(odd: Column, *others: Column) -> Column:
    """1 where the first layer is odd or any other is not zero."""
    test = odd % 2 == 1
    for o in others:
        test = test | (o != 0)
    return F.when(test, 1).otherwise(0)


def valid_views(obs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """How many observations of each key are not masked."""
    return obs.groupBy(*keys).agg((F.count("*") - F.sum("mask")).alias("n_views"))


def footprint(obs: DataFrame, keys: Sequence[str]) -> DataFrame:
    """1 where any observation is valid, else 0."""
    return obs.groupBy(*keys).agg(F.max(1 - F.col("mask")).alias("footprint"))


def common_footprint(footprints: DataFrame, keys: Sequence[str], sensors: int) -> DataFrame:
    """1 where the footprints of all sensors are 1."""
    return footprints.groupBy(*keys).agg(F.when(F.sum("footprint") == sensors, 1).otherwise(0).alias("common"))
