"""Confusion tables and the coefficients drawn from them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def confusion(pairs: DataFrame, by: Sequence[str] = (), no_data: int | None = None) -> DataFrame:
    """(by, ref, prod, n): how often each produced label meets each reference label."""
    kept = pairs if no_data is None else pairs.where((F.col("ref") != no_data) & (F.col("prod") != no_data))
    return kept.groupBy(*by, "ref", "prod").agg(F.count("*").alias("n"))


def zero_filled(matrix: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """matrix with a row for every pair of its labels; labels are as many as there are classes."""
    labels = matrix.select(F.explode(F.array("ref", "prod")).alias("label")).distinct()
    pairs = labels.withColumnRenamed("label", "ref").crossJoin(F.broadcast(labels.withColumnRenamed("label", "prod")))
    if by:
        pairs = matrix.select(*by).distinct().crossJoin(F.broadcast(pairs))
    return pairs.join(matrix, [*by, "ref", "prod"], "left").select(*by, "ref", "prod", F.coalesce("n", F.lit(0)).alias("n"))


def merged_labels(matrix: DataFrame, rules: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """matrix with labels replaced by rules (label, new); others stay."""
    rules = F.broadcast(rules)
    out = matrix
    for side in ("ref", "prod"):
        out = out.join(rules.withColumnRenamed("label", side), side, "left").withColumn(side, F.coalesce("new", side)).drop("new")
    return out.groupBy(*by, "ref", "prod").agg(F.sum("n").alias("n"))


def or_else(c: Column, undefined: float | None) -> Column:
    return c if undefined is None else F.coalesce(c, F.lit(float(undefined)))


def class_scores(matrix: DataFrame, by: Sequence[str] = (), undefined: float | None = None) -> DataFrame:
    """(by, label, precision, recall, fscore) of every label; undefined replaces 0/0, else null."""
    cells = F.array(F.struct(F.col("ref").alias("label"), F.lit("r").alias("side")), F.struct(F.col("prod").alias("label"), F.lit("p").alias("side")))
    sides = matrix.withColumn("e", F.explode(cells)).select(*by, "e.label", "e.side", "n", (F.col("ref") == F.col("prod")).alias("right"))
    total = lambda side: F.sum(F.when(F.col("side") == side, F.col("n")).otherwise(0))
    sums = sides.groupBy(*by, "label").agg(total("r").alias("r"), total("p").alias("p"), (F.sum(F.when(F.col("right"), F.col("n")).otherwise(0)) / 2).alias("hit"))
    ratio = lambda a, b: F.when(b != 0, a / b)
    precision, recall = ratio(F.col("hit"), F.col("p")), ratio(F.col("hit"), F.col("r"))
    scored = sums.select(*by, "label", precision.alias("precision"), recall.alias("recall"))
    f = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return scored.select(*by, "label", *(or_else(c, undefined).alias(n) for n, c in (("precision", F.col("precision")), ("recall", F.col("recall")), ("fscore", f))))


def global_scores(matrix: DataFrame, by: Sequence[str] = (), undefined: float | None = None) -> DataFrame:
    """(by, kappa, accuracy): chance agreement is the sum over labels of row total times column total."""
    sums = matrix.groupBy(*by).agg(F.sum("n").alias("n"), F.sum(F.when(F.col("ref") == F.col("prod"), F.col("n")).otherwise(0)).alias("hit"))
    rows = matrix.groupBy(*by, F.col("ref").alias("label")).agg(F.sum("n").alias("r"))
    cols = matrix.groupBy(*by, F.col("prod").alias("label")).agg(F.sum("n").alias("c"))
    chance = rows.join(cols, [*by, "label"]).groupBy(*by).agg(F.sum(F.col("r") * F.col("c")).alias("chance"))
    both = sums.join(chance, list(by), "left") if by else sums.crossJoin(chance)
    n = F.col("n").cast("double")
    expected, accuracy = F.coalesce("chance", F.lit(0)) / (n * n), F.col("hit") / n
    kappa = F.when(expected != 1, (accuracy - expected) / (1 - expected))
    return both.select(*by, or_else(kappa, undefined).alias("kappa"), or_else(accuracy, undefined).alias("accuracy"))


def normalised(matrix: DataFrame, side: str, by: Sequence[str] = ()) -> DataFrame:
    """matrix with `share` of each side's total, -1 where that is 0."""
    total = F.sum("n").over(Window.partitionBy(*by, side))
    return matrix.withColumn("share", F.when(total == 0, F.lit(-1.0)).otherwise(F.col("n") / total))


def most_confused(matrix: DataFrame, k: int = 3, by: Sequence[str] = ()) -> DataFrame:
    """The k labels that each reference label is most often given, largest first, then by descending label."""
    rank = F.row_number().over(Window.partitionBy(*by, "ref").orderBy(F.desc("n"), F.desc("prod")))
    return matrix.withColumn("rank", rank).where(F.col("rank") <= k)


#: Two-sided 95 % quantiles of Student's t by degrees of freedom.
T95 = {1: 12.7062, 2: 4.3027, 3: 3.1824, 4: 2.7764, 5: 2.5706, 6: 2.4469, 7: 2.3646, 8: 2.3060, 9: 2.2622, 10: 2.2281}


def quantile95(degrees: int) -> float:
    """Student's two-sided 95 % quantile: from the table, beyond it by its expansion around the normal one."""
    if degrees in T95:
        return T95[degrees]
    z = 1.959964
    return z + (z**3 + z) / (4 * degrees) + (5 * z**5 + 16 * z**3 + 3 * z) / (96 * degrees**2) + (3 * z**7 + 19 * z**5 + 17 * z**3 - 15 * z) / (384 * degrees**3)


def interval(scores: DataFrame, column: str, degrees: int, by: Sequence[str] = ()) -> DataFrame:
    """Mean over runs and half width of its 95 % interval."""
    half = F.stddev_samp(column) / F.sqrt(F.count("*")) * quantile95(degrees)
    return scores.groupBy(*by).agg(F.avg(column).alias("mean"), half.alias("half_width"))
