"""Joins, aggregates, windows, sets, splits and zone statistics on tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landseries.operators.ranks import ranked
from landseries.sources.store import stored

def draw_order(key: Column, seed: Column | int = 0) -> Column:
    """A repeatable order of integer keys (under 2**31) that looks random; break ties by the key."""
    s = seed if isinstance(seed, Column) else F.lit(seed)
    return (key * F.lit(2654435761) + s.cast("long") * 40503) % F.lit(4294967296)


def stratified_split(rows: DataFrame, key: str, strata: Sequence[str], ratio: float, seeds: int = 1) -> DataFrame:
    """rows for each seed with `set`: learning or validation.

    Of a stratum's n rows max(1, round-half-even(n * ratio)) are drawn for learning; a lone
    row goes to both sets.
    """
    drawn = rows.withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(seeds - 1))))
    placed = ranked(drawn, [draw_order(F.col(key), F.col("seed")), key], [*strata, "seed"], rank="_rank", size="_n")
    sets = F.when(F.col("_n") == 1, F.array(F.lit("learning"), F.lit("validation"))).otherwise(
        F.array(F.when(F.col("_rank") <= F.greatest(F.lit(1), F.bround(F.col("_n") * ratio)), "learning").otherwise("validation"))
    )
    return placed.withColumn("set", F.explode(sets)).drop("_n", "_rank")


def folds(rows: DataFrame, key: str, strata: Sequence[str], k: int, order: Column) -> DataFrame:
    """rows with `fold` 0..k-1: blocks of k in this order are dealt out, in each stratum."""
    placed = ranked(rows, [order, key], strata, rank="fold")
    return placed.withColumn("fold", ((F.col("fold") - 1) % k).cast("int"))


def first_k(rows: DataFrame, by: Sequence[str], order: Sequence[Column], k: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*order))
    return rows.withColumn("rank", rank).where(F.col("rank") <= k)


def class_rates(pixels: DataFrame, zone: str, value: str, no_data: int | None = None) -> DataFrame:
    """(zone, value, n, rate): the share of each value in its zone."""
    kept = pixels if no_data is None else pixels.where(F.col(value) != no_data)
    counts = kept.groupBy(zone, value).agg(F.count("*").alias("n"))
    return counts.withColumn("rate", F.col("n") / F.sum("n").over(Window.partitionBy(zone)))


def majority(pixels: DataFrame, zone: str, value: str) -> DataFrame:
    """(zone, majority): a zone's commonest value, the least of several."""
    counts = pixels.groupBy(zone, value).agg(F.count("*").alias("n"))
    return counts.groupBy(zone).agg(F.max_by(value, F.struct("n", -F.col(value))).alias("majority"))


def zone_statistics(pixels: DataFrame, zone: str, bands: Sequence[str], digits: int = 2) -> DataFrame:
    """Mean, population deviation, greatest and least of each band in each zone."""
    stats = (("mean", F.avg), ("std", F.stddev_pop), ("max", F.max), ("min", F.min))
    return pixels.groupBy(zone).agg(*(F.round(f(b), digits).alias(f"{b}_{n}") for b in bands for n, f in stats))


def pivot_shares(tall: DataFrame, zone: str, key: str, value: str, keys: Sequence, prefix: str) -> DataFrame:
    """One row per zone with a column per key, 0 where absent."""
    wide = tall.groupBy(zone).pivot(key, list(keys)).agg(F.first(value))
    return wide.select(zone, *(F.coalesce(F.round(F.col(f"`{k}`"), 2), F.lit(0.0)).alias(f"{prefix}{k}") for k in keys))


def covered_cells(rects: DataFrame, size: int = 8) -> DataFrame:
    """rects with (cx, cy): the coarse cells that the rectangle x0, y0, w, h meets."""
    span = lambda a, b: F.sequence(F.floor(F.col(a) / size), F.floor((F.col(a) + F.col(b)) / size))
    return rects.withColumn("cx", F.explode(span("x0", "w"))).withColumn("cy", F.explode(span("y0", "h")))


def rectangle_join(a: DataFrame, b: DataFrame, size: int = 8) -> DataFrame:
    """Pairs of rectangles that overlap with positive area; columns of b get the prefix o_.

    An equi-join on coarse cells; a pair is kept only in the cell that holds the lower left
    corner of its overlap, so it comes out once without a distinct.
    """
    left = covered_cells(a, size)
    right = covered_cells(b, size)
    right = right.select("cx", "cy", *(F.col(c).alias(f"o_{c}") for c in b.columns))
    low_x, low_y = F.greatest("x0", "o_x0"), F.greatest("y0", "o_y0")
    met = left.join(right, ["cx", "cy"]).where(
        (low_x < F.least(F.col("x0") + F.col("w"), F.col("o_x0") + F.col("o_w"))) & (low_y < F.least(F.col("y0") + F.col("h"), F.col("o_y0") + F.col("o_h")))
    )
    return met.where((F.floor(low_x / size) == F.col("cx")) & (F.floor(low_y / size) == F.col("cy"))).drop("cx", "cy")


def rectangle_filter(a: DataFrame, b: DataFrame, key: str = "fid", size: int = 8) -> DataFrame:
    """The rectangles of a, told apart by key, that overlap any of b with positive area.

    A semi-join in each coarse cell against b's different rectangles: pairs are never made.
    """
    left = covered_cells(a.select(key, "x0", "y0", "w", "h"), size)
    right = covered_cells(b.select("x0", "y0", "w", "h").distinct(), size).toDF(*(f"o_{c}" for c in ("x0", "y0", "w", "h", "cx", "cy")))
    same = (F.col("cx") == F.col("o_cx")) & (F.col("cy") == F.col("o_cy"))
    low_x, low_y = F.greatest("x0", "o_x0"), F.greatest("y0", "o_y0")
    high = {c: F.least(F.col(f"{c}0") + F.col(n), F.col(f"o_{c}0") + F.col(f"o_{n}")) for c, n in (("x", "w"), ("y", "h"))}
    found = left.join(right, same & (low_x < high["x"]) & (low_y < high["y"]), "left_semi").select(key).distinct()
    return a.join(found, key, "left_semi")


def overlap_area() -> Column:
    dx = F.least(F.col("x0") + F.col("w"), F.col("o_x0") + F.col("o_w")) - F.greatest("x0", "o_x0")
    dy = F.least(F.col("y0") + F.col("h"), F.col("o_y0") + F.col("o_h")) - F.greatest("y0", "o_y0")
    return dx * dy


def priority_union(first: DataFrame, second: DataFrame, on: Sequence[str]) -> DataFrame:
    """All of first, and the rows of second whose key first lacks."""
    return first.unionByName(second.join(first.select(*on).distinct(), list(on), "left_anti"))


def to_add(counts: DataFrame, mode: str, least: int | None = None, wanted: DataFrame | None = None) -> DataFrame:
    """(class, add): samples to make of each class; mode: minimum, balance or by_class."""
    if mode == "minimum":
        target = counts.withColumn("add", F.lit(least) - F.col("n"))
    elif mode == "balance":
        target = counts.crossJoin(F.broadcast(counts.agg(F.max("n").alias("top")))).withColumn("add", F.col("top") - F.col("n"))
    else:
        target = counts.join(wanted, "class").withColumn("add", F.col("wanted") - F.col("n"))
    return target.where("add > 0").select("class", "add")


def replicate(samples: DataFrame, add: DataFrame, key: str) -> DataFrame:
    """The copies that replication adds: each class's samples in turn until `add` are made."""
    placed = ranked(samples, [key], ["class"], rank="_rank", size="_n").join(F.broadcast(add), "class")
    times = F.floor(F.col("add") / F.col("_n")) + (F.col("_rank") - 1 < F.col("add") % F.col("_n")).cast("long")
    return placed.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), times))).drop("_n", "_rank", "add")


def copy_by_rules(samples: DataFrame, rules: Sequence[tuple[int, int, int, int]], key: str) -> DataFrame:
    """samples (key, class, model) with a column `path`, and the copies that the rules add.

    rules: (source model, target model, class, number; -1 is all), in order: later rules see
    the copies of earlier ones. A rule takes the least keys, and all there are if those are
    too few. path is empty for a sample itself; a copy's names the rules (from 1) that made
    it, so key and path are its fresh identity and nothing is numbered in one task. A rule's
    copies are stored, so each rule reads the samples once.
    """
    whole = samples.withColumn("path", F.lit(""))
    copies = []
    for k, (source, target, kind, number) in enumerate(rules, 1):
        of = (F.col("model") == source) & (F.col("class") == kind)
        taken = whole.where(of)
        for m, c, made in copies:
            if (m, c) == (source, kind):
                taken = taken.unionByName(made)
        if number >= 0:
            taken = taken.orderBy(key, "path").limit(number)
        made = taken.withColumns({"model": F.lit(target).cast(samples.schema["model"].dataType), "path": F.concat("path", F.lit(f"/{k}"))})
        copies.append((target, kind, stored(made)))
    out = whole
    for _, _, made in copies:
        out = out.unionByName(made)
    return out
