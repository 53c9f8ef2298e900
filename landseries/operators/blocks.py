"""User functions over blocks of cells with a rim of their neighbours, and over the series of a pixel."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Block:
    """What a user function sees: 2-D arrays by band name, rim included, NaN where there is no cell."""

    bands: dict[str, np.ndarray]
    rim: int
    given: list[str] = field(default_factory=list)

    def get(self, name: str) -> np.ndarray:
        return self.bands[name]

    def series(self, prefix: str) -> np.ndarray:
        """The bands whose name is prefix_..., by name, as one array (rows, columns, bands): the dates of `sensor_band`."""
        return np.stack([self.bands[b] for b in sorted(self.bands) if b.startswith(f"{prefix}_")], axis=2)

    def inner(self, a: np.ndarray) -> np.ndarray:
        return a[self.rim : a.shape[0] - self.rim, self.rim : a.shape[1] - self.rim]

    def around(self, name: str, reach: int = 1) -> np.ndarray:
        """(rows, columns, places): each cell's surroundings, NaN beyond the array."""
        a = np.pad(self.bands[name], reach, constant_values=np.nan)
        views = np.lib.stride_tricks.sliding_window_view(a, (2 * reach + 1, 2 * reach + 1))
        return views.reshape(*views.shape[:2], -1)


UserFunction = Callable[[Block], tuple[np.ndarray, list[str]]]


def run_functions(block: Block, functions: Sequence[UserFunction], there: np.ndarray) -> tuple[list[str], list[np.ndarray]]:
    """Labels and inner arrays of all functions in turn; later ones see what earlier ones gave, rim included.

    there: which inner cells exist. A function gives rows x columns (x bands), with the rim
    or without; other shapes, NaN and infinities at existing cells are refused. Where the
    labels don't match the bands, function i's band j is named custFeat_i_bj.
    """
    rows, columns = there.shape
    full = (rows + 2 * block.rim, columns + 2 * block.rim)
    names, arrays = [], []
    for i, function in enumerate(functions, 1):
        out, labels = function(block)
        out = np.asarray(out, np.float64)
        if out.ndim == 2:
            out = out[:, :, None]
        if out.ndim != 3 or out.shape[:2] not in (full, (rows, columns)):
            raise ValueError(f"function {i}: expected {rows} x {columns} cells, with or without a rim of {block.rim}, got {out.shape}")
        if len(labels) != out.shape[2]:
            labels = [f"custFeat_{i}_b{j}" for j in range(1, out.shape[2] + 1)]
        inner = block.inner(out) if out.shape[:2] == full else out
        if not np.isfinite(inner[there]).all():
            raise ValueError(f"function {i}: NaN or infinite values, is there a division by zero?")
        if out.shape[:2] != full:
            out = np.pad(out, ((block.rim,) * 2,) * 2 + ((0, 0),), constant_values=np.nan)
        for j, label in enumerate(labels):
            block.bands[label] = out[:, :, j]
            names.append(label)
            arrays.append(inner[:, :, j])
    return names, arrays


def fixed(width: int, height: int) -> Callable[[DataFrame], tuple[int, int, int, int]]:
    """Blocks of so many cells, counted from 0, 0."""
    return lambda cells: (width, height, 0, 0)


def strips(n: int, cells: int = 1 << 18) -> Callable[[DataFrame], tuple[int, int, int, int]]:
    """n strips of rows over the whole width, or as many more as keep each under so many cells (or one row): a strip is computed in one task."""

    def size(table: DataFrame) -> tuple[int, int, int, int]:
        x0, x1, y0, y1 = table.agg(F.min("x"), F.max("x"), F.min("y"), F.max("y")).first()
        if x0 is None:
            return 1, 1, 0, 0
        return x1 - x0 + 1, max(1, min(-(-(y1 - y0 + 1) // n), cells // (x1 - x0 + 1))), x0, y0

    return size


def user_features(
    cells: DataFrame, bands: Sequence[str], functions: Sequence[UserFunction], blocks: Callable = fixed(64, 64), rim: int = 0, mask: str | None = None, only: tuple[int, int] | None = None
) -> DataFrame:
    """x, y and bands of cells with a column for each band that the functions add.

    Cells go to their block, and those within `rim` of a border to the neighbouring blocks
    too, so that a block is computed in one task without the others. Functions that look at
    their neighbours' outputs need a rim of the sum of their reaches. mask: a column that is
    0 where values don't count: blocks of nothing but such cells aren't computed and become
    0, and in others all bands of such cells become 0. only: compute just this block.

    The labels are those that the first block in order which isn't masked gives; a block
    that gives others is an error. Cells must be unique; rows without x or y are left out;
    null bands are NaN for functions and null in the result; an empty table gives no rows
    and no labels.
    """
    width, height, x0, y0 = blocks(cells)
    on = F.lit(1) if mask is None else F.when(F.col(mask) == 0, 0).otherwise(1)
    kept = cells.where(F.col("x").isNotNull() & F.col("y").isNotNull()).select(F.col("x").cast("long").alias("x"), F.col("y").cast("long").alias("y"), *(F.col(b).cast("double").alias(b) for b in bands), on.alias("_on"))
    reach = lambda c, o, n: F.sequence(F.floor((F.col(c) - o - rim) / n), F.floor((F.col(c) - o + rim) / n))
    dealt = kept.withColumn("_bx", F.explode(reach("x", x0, width))).withColumn("_by", F.explode(reach("y", y0, height)))
    if only:
        dealt = dealt.where((F.col("_bx") == only[0]) & (F.col("_by") == only[1]))
    own = (F.floor((F.col("x") - x0) / width) == F.col("_bx")) & (F.floor((F.col("y") - y0) / height) == F.col("_by"))
    dealt = dealt.withColumn("_own", own)

    def computed(pdf: pd.DataFrame) -> tuple[pd.DataFrame, list[str], list[np.ndarray]] | None:
        mine = pdf[pdf["_own"]]
        if not len(mine):
            return None
        left, low = x0 + int(pdf["_bx"].iloc[0]) * width, y0 + int(pdf["_by"].iloc[0]) * height
        shape = (height + 2 * rim, width + 2 * rim)
        at = (pdf["y"].to_numpy() - low + rim, pdf["x"].to_numpy() - left + rim)
        arrays = {}
        for b in bands:
            a = np.full(shape, np.nan)
            a[at] = pdf[b].to_numpy(np.float64)
            arrays[b] = a
        place = (mine["y"].to_numpy() - low, mine["x"].to_numpy() - left)
        if not mine["_on"].any():
            return mine, [], []
        there = np.zeros((height, width), bool)
        there[place] = True
        names, outs = run_functions(Block(arrays, rim, list(bands)), functions, there)
        return mine, names, [o[place] for o in outs]

    groups = dealt.groupBy("_bx", "_by")
    active = dealt.where("_own and _on = 1").select("_by", "_bx").orderBy("_by", "_bx").limit(1).collect()
    names: list[str] = []
    if active:
        first = dealt.where((F.col("_bx") == active[0]["_bx"]) & (F.col("_by") == active[0]["_by"]))
        told = first.groupBy("_bx", "_by").applyInPandas(lambda pdf: pd.DataFrame({"labels": [list(computed(pdf)[1])]}), "labels array<string>")
        names = list(told.first().labels)

    def apply(pdf: pd.DataFrame) -> pd.DataFrame:
        done = computed(pdf)
        if done is None:
            return pd.DataFrame({c: [] for c in ("x", "y", *bands, *names)})
        mine, labels, outs = done
        on = mine["_on"].to_numpy() == 1
        if not labels:
            outs = [np.zeros(len(mine))] * len(names)
        elif labels != names:
            raise ValueError(f"labels {labels} differ from {names}")
        out = {"x": mine["x"].to_numpy(), "y": mine["y"].to_numpy()}
        for b in bands:
            out[b] = np.where(on, mine[b].to_numpy(np.float64), 0.0)
        for name, values in zip(names, outs, strict=True):
            out[name] = np.where(on, values, 0.0)
        return pd.DataFrame(out)

    schema = "x long, y long, " + ", ".join(f"`{c}` double" for c in (*bands, *names))
    out = groups.applyInPandas(apply, schema)
    return out.select("x", "y", *(F.when(~F.isnan(b), F.col(b)).alias(b) for b in bands), *(F.col(f"`{n}`") for n in names))


def series_features(obs: DataFrame, functions: dict[str, Callable[[np.ndarray, np.ndarray], float]], by: Sequence[str] = ("pixel", "band")) -> DataFrame:
    """(by, a column for each function): user aggregates over the dates of a series.

    A function gets the days (whole numbers, in order) and values of a series, masked and
    null values left out; a series without any gives null. A series is gathered by its key, which holds
    its dates only, and functions run on batches of series.
    """
    valid = F.when((F.col("mask") == 0) & F.col("value").isNotNull(), F.struct(F.unix_date("date").alias("day"), F.col("value").alias("value")))
    series = obs.groupBy(*by).agg(F.array_sort(F.collect_list(valid)).alias("s")).select(*by, F.transform("s", lambda p: p["day"]).alias("days"), F.transform("s", lambda p: p["value"]).alias("values"))
    names = list(functions)

    def run(batches):
        for batch in batches:
            out = batch[list(by)].copy()
            for name in names:
                out[name] = [float(functions[name](np.asarray(d), np.asarray(v, float))) if len(d) else None for d, v in zip(batch["days"], batch["values"], strict=True)]
            yield out

    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in series.select(*by).schema)
    return series.mapInPandas(run, f"{kinds}, " + ", ".join(f"`{n}` double" for n in names))
