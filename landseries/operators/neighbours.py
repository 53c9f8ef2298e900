"""Nearest samples inside a class, and samples made between neighbours."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType

from landseries.operators.forest import mixed
from landseries.operators.ranks import ranked
from landseries.sources.store import stored


def closest(a: np.ndarray, b: np.ndarray, of_a: np.ndarray, of_b: np.ndarray, k: int, step: int = 64) -> pd.DataFrame:
    """(key, other, d2): the k rows of b nearest to each row of a, a key never its own; ties go to the lesser key."""
    parts = []
    order = np.argsort(of_b, kind="stable")
    b, of_b = b[order], of_b[order]
    for at in range(0, len(a), step):
        d2 = np.zeros((len(a[at : at + step]), len(b)))
        for j in range(a.shape[1]):  # feature by feature: no error of cancelling products, and no cube of differences
            d2 += (a[at : at + step, j, None] - b[None, :, j]) ** 2
        d2[of_a[at : at + step, None] == of_b[None, :]] = np.inf
        top = np.argsort(d2, axis=1, kind="stable")[:, :k]
        rows = np.repeat(np.arange(len(top)), top.shape[1])
        cols = top.ravel()
        ok = np.isfinite(d2[rows, cols])
        parts.append(pd.DataFrame({"key": of_a[at + rows[ok]], "other": of_b[cols[ok]], "d2": d2[rows[ok], cols[ok]]}))
    return pd.concat(parts, ignore_index=True)


def nearest_in_class(samples: DataFrame, k: int, tile: int = 2048) -> DataFrame:
    """(class, key, rank, other, d2): the k nearest other samples of a class by squared distance, exactly.

    samples: key (unique whole number), class, x. A class is dealt by hash into tiles of about
    `tile` samples; a task compares two tiles and returns k rows a sample, which are merged
    by rank. The work grows with the square of a class, its output with its size. Rows with
    null key, class, x or components take no part.
    """
    known = samples.select("key", "class", F.col("x").cast("array<double>").alias("x")).where(F.col("key").isNotNull() & F.col("class").isNotNull() & F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v)))
    sizes = known.groupBy("class").agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    placed = stored(known.join(F.broadcast(sizes), "class").withColumn("own", F.pmod(F.xxhash64("key"), F.col("tiles")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    left = placed.select("class", F.col("own").alias("ti"), every.alias("tj"), F.lit(True).alias("asks"), "key", "x")
    right = placed.select("class", every.alias("ti"), F.col("own").alias("tj"), F.lit(False).alias("asks"), "key", "x")
    kinds = {f.name: f.dataType.simpleString() for f in known.schema}

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        asks = pdf["asks"].to_numpy()
        a, b = pdf[asks], pdf[~asks]
        if not len(a) or not len(b):
            return pd.DataFrame({"class": [], "key": [], "other": [], "d2": []})
        out = closest(np.stack(a["x"].to_numpy()), np.stack(b["x"].to_numpy()), a["key"].to_numpy(), b["key"].to_numpy(), k)
        out.insert(0, "class", pdf["class"].iloc[0])
        return out

    found = left.unionByName(right).groupBy("class", "ti", "tj").applyInPandas(run, f"class {kinds['class']}, key {kinds['key']}, other {kinds['key']}, d2 double")
    order = Window.partitionBy("class", "key").orderBy("d2", "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def share(key: Column, copy: Column, salt: int) -> Column:
    """A number in [0, 1) that a key and a copy's number fix."""
    return mixed(key, copy * 4 + salt) / (1 << 32)


def between(samples: DataFrame, add: DataFrame, k: int, tile: int = 2048) -> DataFrame:
    """(key, copy, class, other, u, x): new samples on the line from a sample to one of its k nearest of the class.

    add: (class, add), how many to make; a class's samples take turns in the order of their
    keys. Neighbour and place u on the line follow from key and copy. A class with one
    sample has no neighbours and makes none.
    """
    near = nearest_in_class(samples, k, tile).groupBy("class", "key").agg(F.array_sort(F.collect_list(F.struct("rank", "other"))).alias("near"))
    able = samples.select("key", "class", F.col("x").cast("array<double>").alias("x")).join(near, ["class", "key"])
    turns = ranked(able, ["key"], ["class"], rank="turn", size="n").join(F.broadcast(add), "class")
    times = (F.floor(F.col("add") / F.col("n")) + (F.col("turn") - 1 < F.col("add") % F.col("n")).cast("long")).cast("int")
    made = turns.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
    pick = F.floor(share(F.col("key"), F.col("copy"), 1) * F.size("near")).cast("int")
    made = made.select("class", "key", "copy", "x", F.get("near", pick)["other"].alias("other"), share(F.col("key"), F.col("copy"), 2).alias("u"))
    there = samples.select("class", F.col("key").alias("other"), F.col("x").cast("array<double>").alias("to"))
    return made.join(there, ["class", "other"]).select("key", "copy", "class", "other", "u", F.zip_with("x", "to", lambda a, b: a + F.col("u") * (b - a)).alias("x"))


def augmented(samples: DataFrame, key: str, klass: str, add: DataFrame, method: str = "smote", model: str | None = None, models: Sequence | None = None, factor: float = 10.0, k: int = 5) -> DataFrame:
    """samples and the synthetic ones of the target models, with `copy` (0 for a sample itself).

    method: `replicate`, `jitter` (normal noise of a feature's deviation in its class over
    factor) or `smote` (a point between two neighbours). Features are the columns of floating
    point; whole numbers, texts and dates are those of the sample that a copy is made from,
    so codes and flags stay valid. model, models: only samples of these models are read; the
    number to make counts over them.
    """
    features = [f.name for f in samples.schema if isinstance(f.dataType, (DoubleType, FloatType)) and f.name not in (key, klass, model)]
    source = samples if models is None else samples.where(F.col(model).isin(list(models)))
    flat = source.select(F.col(key).alias("key"), F.col(klass).alias("class"), F.array(*(F.col(f).cast("double") for f in features)).alias("x"))
    asked = add.select(F.col(klass).alias("class"), "add")
    if method == "smote":
        made = between(flat, asked, k).select("key", "copy", "x")
    else:
        turns = ranked(flat, ["key"], ["class"], rank="turn", size="n").join(F.broadcast(asked), "class")
        times = (F.floor(F.col("add") / F.col("n")) + (F.col("turn") - 1 < F.col("add") % F.col("n")).cast("long")).cast("int")
        made = turns.where(times > 0).withColumn("copy", F.explode(F.sequence(F.lit(1), times)))
        if method == "jitter":
            spread = flat.groupBy("class").agg(F.array(*(F.stddev_pop(F.col("x")[j]) for j in range(len(features)))).alias("std"))
            noise = lambda j: F.sqrt(-2 * F.log(1 - share(F.col("key"), F.col("copy") * 64 + j, 1))) * F.cos(6.283185307179586 * share(F.col("key"), F.col("copy") * 64 + j, 2))
            moved = F.array(*(F.col("x")[j] + noise(j) * F.col("std")[j] / factor for j in range(len(features))))
            made = made.join(F.broadcast(spread), "class").withColumn("x", moved)
        made = made.select("key", "copy", "x")
    taken = samples.join(made.withColumnRenamed("key", "_key").withColumnRenamed("copy", "_copy").withColumnRenamed("x", "_x"), F.col(key) == F.col("_key"))
    kinds = {f.name: f.dataType for f in samples.schema}
    new = taken.select(*(F.col("_x")[features.index(c)].cast(kinds[c]).alias(c) if c in features else F.col(c) for c in samples.columns), F.col("_copy").alias("copy"))
    return samples.withColumn("copy", F.lit(0)).unionByName(new)
