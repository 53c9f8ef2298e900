"""Connected patches of equal label on a grid, their sizes, neighbours and clean-up."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators.components import components
from landseries.sources.store import stored

FOUR = ((0, -1), (-1, 0), (1, 0), (0, 1))
EIGHT = (*FOUR, (-1, -1), (1, -1), (-1, 1), (1, 1))


def least_of_runs(number: np.ndarray, label: np.ndarray) -> np.ndarray:
    """Each cell's least number within its run of equal labels along a row."""
    flat, same = number.ravel().copy(), np.zeros(label.shape, bool)
    same[:, 1:] = label[:, 1:] == label[:, :-1]
    starts = np.nonzero(~same.ravel())[0]
    return np.repeat(np.minimum.reduceat(flat, starts), np.diff(np.append(starts, flat.size))).reshape(number.shape)


def settled(label: np.ndarray, number: np.ndarray, eight: bool) -> np.ndarray:
    """Each cell's least number within its connected patch of equal label in a block."""
    while True:
        new = least_of_runs(number, label)
        new = least_of_runs(new.T, label.T).T.copy()
        if eight:
            for one, two in (((slice(1, None),) * 2, (slice(None, -1),) * 2), ((slice(1, None), slice(None, -1)), (slice(None, -1), slice(1, None)))):
                low = np.where(label[one] == label[two], np.minimum(new[one], new[two]), new[one])
                new[two] = np.where(label[one] == label[two], np.minimum(new[two], low), new[two])
                new[one] = np.where(label[one] == label[two], np.minimum(new[one], new[two]), new[one])
        if (new == number).all():
            return new
        number = new


def patches(cells: DataFrame, eight: bool = True, block: int = 128) -> DataFrame:
    """cells (x, y, label) with `patch`: the least y * 2**31 + x of the connected patch of equal label.

    Patches are settled inside blocks of cells first. Only contacts across the borders of
    blocks enter the search for components, so its links grow with the borders. Cells must
    be unique and labels whole numbers; an empty table stays empty.
    """

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        x, y = pdf["x"].to_numpy(), pdf["y"].to_numpy()
        at = (y - y.min(), x - x.min())
        labels, code = np.unique(pdf["label"].to_numpy(), return_inverse=True)
        label = np.full((at[0].max() + 1, at[1].max() + 1), -1)
        label[at] = code
        number = np.full(label.shape, np.iinfo(np.int64).max)
        number[at] = y * (1 << 31) + x
        return pd.DataFrame({"x": x, "y": y, "label": pdf["label"], "local": settled(label, number, eight)[at]})

    kind = cells.schema["label"].dataType.simpleString()
    placed = cells.select(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), "label", F.floor(F.col("x") / block).alias("bx"), F.floor(F.col("y") / block).alias("by"))
    local = stored(placed.groupBy("bx", "by").applyInPandas(run, f"x long, y long, label {kind}, local long"))
    edge = F.pmod("x", F.lit(block)).isin(0, block - 1) | F.pmod("y", F.lit(block)).isin(0, block - 1)
    border = local.where(edge)
    steps = ((1, 0), (0, 1), (1, 1), (1, -1)) if eight else ((1, 0), (0, 1))
    moved = border.withColumn("d", F.explode(F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in steps))))
    moved = moved.select((F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), "label", F.col("local").alias("other"))
    touching = border.join(moved, ["x", "y", "label"]).where("local != other").select("local", "other").distinct()
    low = components(touching)
    return local.join(low, F.col("local") == F.col("node"), "left").select("x", "y", "label", F.coalesce("component", "local").alias("patch"))


def neighbours(cells: DataFrame, offsets: tuple = FOUR) -> DataFrame:
    """cells with the columns of each neighbour (n_...): an equi-join on shifted coordinates."""
    shifts = F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in offsets))
    moved = cells.withColumn("d", F.explode(shifts))
    moved = moved.select((F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), *(F.col(c).alias(f"n_{c}") for c in cells.columns if c not in ("x", "y")))
    return cells.join(moved, ["x", "y"])


def sieved(named: DataFrame, least: int, eight: bool = True, within: str | None = None) -> DataFrame:
    """cells (x, y, label, patch), patches under `least` cells with the label of the largest patch that they touch (ties: least label).

    within: a column in which both patches must agree. Only the cells of small patches look around them.
    """
    also = [within] if within else []
    sizes = stored(named.groupBy("patch").agg(F.count("*").alias("size")))
    small = named.join(sizes.where(F.col("size") < least).select("patch"), "patch", "left_semi")
    steps = F.explode(F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in (EIGHT if eight else FOUR))))
    asked = small.withColumn("d", steps).select((F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), "patch", *also).distinct()
    met = asked.join(named.select("x", "y", *(F.col(c).alias(f"n_{c}") for c in ("label", "patch", *also))), ["x", "y"]).where("patch != n_patch")
    if within:
        met = met.where(F.col(within) == F.col(f"n_{within}"))
    touching = met.select("patch", "n_patch", "n_label").distinct().join(sizes.select(F.col("patch").alias("n_patch"), F.col("size").alias("n_size")), "n_patch")
    new = touching.groupBy("patch").agg(F.max_by("n_label", F.struct("n_size", -F.col("n_label"))).alias("new"))
    return named.join(new, "patch", "left").select("x", "y", F.coalesce("new", "label").alias("label"))


def sieve_once(cells: DataFrame, least: int, eight: bool = True) -> DataFrame:
    """Patches under `least` cells take the label of the largest patch that they touch (ties: least label)."""
    return sieved(stored(patches(cells, eight)), least, eight)


def local_majority(cells: DataFrame) -> DataFrame:
    """Each cell's commonest label among itself and its eight neighbours; ties keep the least label."""
    around = F.array(*(F.struct(F.lit(a).alias("dx"), F.lit(b).alias("dy")) for a, b in (*EIGHT, (0, 0))))
    votes = cells.withColumn("d", F.explode(around)).select((F.col("x") + F.col("d.dx")).alias("x"), (F.col("y") + F.col("d.dy")).alias("y"), "label")
    counts = votes.groupBy("x", "y", "label").agg(F.count("*").alias("n"))
    best = counts.groupBy("x", "y").agg(F.max_by("label", F.struct("n", -F.col("label"))).alias("label"))
    return best.join(cells.select("x", "y"), ["x", "y"], "left_semi")


def morphology(cells: DataFrame, dilate: bool, radius: int = 1) -> DataFrame:
    """Dilation or erosion of `v` (0/1) by the square of this radius around each cell, inside the grid.

    Along x, then along y; the places off the grid that the first pass fills take part in the second.
    """
    out = cells.select("x", "y", "v")
    for axis in ("x", "y"):
        moved = out.withColumn("d", F.explode(F.sequence(F.lit(-radius), F.lit(radius)))).withColumn(axis, F.col(axis) + F.col("d"))
        out = moved.groupBy("x", "y").agg((F.max("v") if dilate else F.min("v")).alias("v"))
    return out.join(cells.select("x", "y"), ["x", "y"], "left_semi")
