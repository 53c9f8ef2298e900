"""Queries that run user functions over blocks of cells and over series."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import blocks as op
from landseries.plans.registry import query
from landseries.sources.views import Tables


def mean_around(block: op.Block):
    """The mean of a cell and its neighbours."""
    near = block.around("conf")
    n = np.isfinite(near).sum(axis=2)
    return np.nan_to_num(near).sum(axis=2) / np.maximum(n, 1), ["local"]


def contrast(block: op.Block):
    """What a cell has over its surroundings, and twice that; the labels don't fit on purpose."""
    d = np.nan_to_num(block.get("conf")) - block.get("local")
    return np.stack([d, 2 * d], axis=2), ["contrast"]


NEAR = "near AS (SELECT a.x, a.y, a.conf, a.label, avg(b.conf) AS local FROM grid a JOIN grid b ON abs(a.x - b.x) <= 1 AND abs(a.y - b.y) <= 1 GROUP BY ALL)"
FEATURES = "round(conf, 9) AS conf, round(local, 9) AS local, round(conf - local, 9) AS \"custFeat_2_b1\", round(2 * (conf - local), 9) AS \"custFeat_2_b2\""


def rounded(features: DataFrame) -> DataFrame:
    return features.select("x", "y", *(F.round(c, 9).alias(c) for c in features.columns[2:]))


@query("u1_user_features", f"SELECT x, y, {FEATURES} FROM near", NEAR)
def user_features(t: Tables) -> DataFrame:
    return rounded(op.user_features(t.grid, ["conf"], [mean_around, contrast], op.fixed(32, 16), rim=1))


HELD = "x // 20 + 8 * (y // 20) IN (SELECT n_nationkey FROM nation WHERE n_regionkey IN (1, 2))"


@query(
    "u2_masked_blocks",
    f"SELECT x, y, CASE WHEN held THEN 0 ELSE round(conf, 9) END AS conf, CASE WHEN held THEN 0 ELSE round(local, 9) END AS local FROM (SELECT *, {HELD} AS held FROM near)",
    NEAR,
)
def masked(t: Tables) -> DataFrame:
    """Zones of 20 cells a side that belong to nations of two regions are masked."""
    zone = F.floor(F.col("x") / 20) + 8 * F.floor(F.col("y") / 20)
    held = t.nation.where("n_regionkey in (1, 2)").select(F.col("n_nationkey").alias("zone"), F.lit(0).alias("on"))
    cells = t.grid.withColumn("zone", zone).join(F.broadcast(held), "zone", "left").withColumn("on", F.coalesce("on", F.lit(1)))
    return rounded(op.user_features(cells, ["conf"], [mean_around], op.fixed(20, 20), rim=1, mask="on"))


@query("u3_strips", f"SELECT x, y, {FEATURES} FROM near", NEAR)
def strips(t: Tables) -> DataFrame:
    return rounded(op.user_features(t.grid, ["conf"], [mean_around, contrast], op.strips(5), rim=1))


def growth(days: np.ndarray, values: np.ndarray) -> float:
    return float(np.maximum(np.diff(values), 0).sum())


def slope(days: np.ndarray, values: np.ndarray) -> float:
    """Values a day by least squares, 0 for a lone date."""
    d = days - days.mean()
    return float((d * values).sum() / (d * d).sum()) if (d * d).sum() else 0.0


@query("u4_user_aggregates", """SELECT pixel, band, round(sum(greatest(coalesce(value - before, 0), 0)), 4) AS growth, round(CASE WHEN min(day) < max(day) THEN regr_slope(value, day) ELSE 0 END + 1e-7, 3) AS slope FROM (
  SELECT pixel, band, value, date - DATE '1970-01-01' AS day, lag(value) OVER (PARTITION BY pixel, band ORDER BY date) AS before FROM obs WHERE mask = 0) GROUP BY 1, 2
  UNION ALL SELECT pixel, band, NULL, NULL FROM obs GROUP BY 1, 2 HAVING min(mask) = 1""")
def user_aggregates(t: Tables) -> DataFrame:
    out = op.series_features(t.obs, {"growth": growth, "slope": slope})
    return out.select("pixel", "band", F.round("growth", 4).alias("growth"), F.round(F.col("slope") + 1e-7, 3).alias("slope"))
