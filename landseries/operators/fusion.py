"""Fusion of several labels of a pixel, and mosaics of tiles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def majority_vote(labels: DataFrame, keys: Sequence[str], undecided: int = 0, no_data: int = 0) -> DataFrame:
    """(keys, label): the commonest label, no-data not counted; ties are undecided."""
    counts = labels.where(F.col("label") != no_data).groupBy(*keys, "label").agg(F.count("*").alias("n"))
    best = counts.groupBy(*keys).agg(F.max(F.struct("n", "label")).alias("top"), F.max("n").alias("most"), F.min(F.struct(-F.col("n"), "label")).alias("low"))
    same = F.col("top.label") == F.col("low.label")  # the greatest and the least of the commonest
    voted = best.select(*keys, F.when(same, F.col("top.label")).otherwise(undecided).alias("label"))
    everyone = labels.select(*keys).distinct()
    return everyone.join(voted, list(keys), "left").select(*keys, F.coalesce("label", F.lit(undecided)).alias("label"))


def dempster_shafer(sources: DataFrame, keys: Sequence[str], undecided: int = 0) -> DataFrame:
    """(keys, label) with the largest combined belief of simple support functions (keys, label, mass).

    A source gives its mass to its label and the rest to ignorance. Up to one common factor,
    the combined mass of a label is 1/prod(1 - m) - 1 over its supporters. Ties are undecided.
    """
    weight = F.exp(-F.sum(F.log(F.greatest(1 - F.col("mass"), F.lit(1e-12))))) - 1
    belief = sources.groupBy(*keys, "label").agg(F.round(weight, 9).alias("belief"))
    best = belief.groupBy(*keys).agg(F.max(F.struct("belief", "label")).alias("top"), F.min(F.struct(-F.col("belief"), "label")).alias("low"))
    return best.select(*keys, F.when(F.col("top.label") == F.col("low.label"), F.col("top.label")).otherwise(undecided).alias("label"))


def fusion_choice(fused: Column, first: Column, second: Column) -> Column:
    """1: both agree with the fused label, 2: the first alone, 3: the second alone, 0: none."""
    return F.when((fused == first) & (fused == second), 1).when(fused == first, 2).when(fused == second, 3).otherwise(0)


def fused_confidence(choice: Column, first: Column, second: Column) -> Column:
    return F.when(choice == 1, F.greatest(first, second)).when(choice == 2, first).when(choice == 3, second).otherwise(0.0)


def most_confident(labels: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, label) of the strictly most confident source; without one, of the first source (column `source`)."""
    agg = labels.groupBy(*keys).agg(
        F.max(F.struct("conf", "label")).alias("top"), F.min_by("label", "source").alias("first"), F.sort_array(F.collect_list("conf"), False).alias("confs")
    )
    strict = (F.size("confs") == 1) | (F.col("confs")[0] > F.col("confs")[1])
    return agg.select(*keys, F.when(strict, F.col("top.label")).otherwise(F.col("first")).alias("label"))


def argmax(proba: Column) -> Column:
    """The position, from 0, of the first greatest probability."""
    return (F.array_position(proba, F.array_max(proba)) - 1).cast("int")


def mosaic(rows: DataFrame, keys: Sequence[str], order: str, no_data: int = 0) -> DataFrame:
    """(keys, label): the last tile in order that has data, else no-data."""
    return rows.groupBy(*keys).agg(F.coalesce(F.max_by("label", F.when(F.col("label") != no_data, F.col(order))), F.lit(no_data)).alias("label"))
