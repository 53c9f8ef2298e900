"""Queries on super-pixels."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import superpixels as op
from landseries.operators.forest import Settings
from landseries.plans.registry import query
from landseries.sources.store import stored
from landseries.sources.views import Tables

STEP, WEIGHT, ROUNDS = 10, 0.5, 2


def slic_sql(rounds: int) -> str:
    """The same clusters in SQL: nine seeds a cell, means a round."""
    mean = lambda c: f"round(avg({c}), {op.DIGITS})"
    parts = [
        f"sp AS (SELECT x, y, conf, x // {STEP} AS gx, y // {STEP} AS gy FROM grid)",
        f"centre0 AS (SELECT gx AS sx, gy AS sy, {mean('x')} AS cx, {mean('y')} AS cy, {mean('conf')} AS cc FROM sp GROUP BY 1, 2)",
    ]
    for k in range(rounds + 1):
        w = WEIGHT / STEP**2
        d = f"(x - cx) * (x - cx) * {w} + (y - cy) * (y - cy) * {w} + (conf - cc) * (conf - cc)"
        parts.append(f"""told{k} AS (SELECT x, y, any_value(conf) AS conf, arg_min((sx, sy), ({d}, sx, sy)) AS seed FROM sp JOIN centre{k} ON sx BETWEEN gx - 1 AND gx + 1 AND sy BETWEEN gy - 1 AND gy + 1 GROUP BY 1, 2)""")
        parts.append(f"""centre{k + 1} AS (SELECT sx, sy, coalesce(m.cx, c.cx) AS cx, coalesce(m.cy, c.cy) AS cy, coalesce(m.cc, c.cc) AS cc FROM centre{k} c LEFT JOIN (
          SELECT seed[1] AS sx, seed[2] AS sy, {mean('x')} AS cx, {mean('y')} AS cy, {mean('conf')} AS cc FROM told{k} GROUP BY 1, 2) m USING (sx, sy))""")
    near = "abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.x BETWEEN a.x - 1 AND a.x + 1"
    parts.append(f"""sp_reach(x, y, tx, ty) AS (SELECT x, y, x, y FROM told{rounds} UNION SELECT r.x, r.y, b.x, b.y FROM sp_reach r JOIN told{rounds} a ON a.x = r.tx AND a.y = r.ty JOIN told{rounds} b ON b.seed = a.seed AND {near})""")
    parts.append("segments AS (SELECT tx AS x, ty AS y, min(y * 2147483648 + x) AS segment FROM sp_reach GROUP BY 1, 2)")
    return ", ".join(parts)


SLIC = slic_sql(ROUNDS)


def segments(t: Tables) -> DataFrame:
    return op.superpixels(t.grid, ["conf"], STEP, WEIGHT, ROUNDS)


@query("rg11_superpixels", "SELECT x, y, segment FROM segments", SLIC)
def superpixels(t: Tables) -> DataFrame:
    return segments(t).select("x", "y", "segment")


POINTS = "points AS (SELECT x, y, min(c_custkey) AS ref, min(c_nationkey) AS class FROM (SELECT *, c_custkey * 7 % 150 AS x, c_custkey % 97 AS y FROM customer) GROUP BY 1, 2)"


@query("jn17_touched_superpixels", """SELECT x, y, segment, ref IS NULL AS is_super_pix, ref, class FROM segments LEFT JOIN points USING (x, y)
  WHERE segment IN (SELECT segment FROM segments JOIN points USING (x, y))""", f"{SLIC}, {POINTS}")
def touched(t: Tables) -> DataFrame:
    """Customers stand as reference points on the grid, with their nation as class."""
    key = F.col("c_custkey")
    points = t.customer.groupBy((key * 7 % 150).alias("x"), (key % 97).alias("y")).agg(F.min("c_custkey").alias("ref"), F.min("c_nationkey").alias("class"))
    return op.touched(segments(t), points).select("x", "y", "segment", "is_super_pix", "ref", "class")


@query("ml9_class_shares", "SELECT segment, round(count(*) FILTER (label = 1) / count(*), 9) AS one, round(count(*) FILTER (label = 3) / count(*), 9) AS three, count(*) AS n FROM segments JOIN grid USING (x, y) GROUP BY 1", SLIC)
def class_shares(t: Tables) -> DataFrame:
    s = op.class_shares(segments(t), [1, 2, 3, 4, 5], size="n")
    return s.select("segment", F.round(F.col("shares")[0], 9).alias("one"), F.round(F.col("shares")[2], 9).alias("three"), "n")


@query("ml9_auto_context")
def auto_context(t: Tables) -> DataFrame:
    """Labels of all cells after one round with the class shares of their super-pixel; the cells of touched ones are the samples."""
    cells = segments(t).select((F.col("y") * 150 + F.col("x")).alias("key"), F.lit("all").alias("model"), "label", F.array("conf").alias("x"), "segment").transform(stored)
    samples = cells.where("key % 3 = 0")
    told = op.auto_context(samples, cells.drop("label"), [1, 2, 3, 4, 5], Settings("bagging", trees=2, depth=3, bins=16), 1)
    return told.select("key", "segment", "label", F.round("conf", 9).alias("conf"))
