"""Queries on patches of a class map."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import outlines
from landseries.operators import patches as op
from landseries.plans.registry import query
from landseries.sources.store import stored
from landseries.sources.views import Tables


@query("rg1_patches", """SELECT x, y, label, m AS patch FROM (SELECT x, y, label, min(fy * 2147483648 + fx) AS m FROM (
  SELECT b.x, b.y, b.label, r.x AS fx, r.y AS fy FROM reach r JOIN blocky b ON b.x = r.tx AND b.y = r.ty) GROUP BY 1, 2, 3)""",
       """reach(x, y, tx, ty) AS (SELECT x, y, x, y FROM blocky UNION SELECT r.x, r.y, c.x, c.y FROM reach r JOIN blocky s ON s.x = r.tx AND s.y = r.ty
  JOIN blocky c ON c.label = s.label AND abs(c.x - s.x) <= 1 AND abs(c.y - s.y) <= 1)""")
def patches(t: Tables) -> DataFrame:
    return op.patches(t.blocky)


FOUR = """reach(x, y, tx, ty) AS (SELECT x, y, x, y FROM blocky UNION SELECT r.x, r.y, c.x, c.y FROM reach r JOIN blocky s ON s.x = r.tx AND s.y = r.ty
  JOIN blocky c ON c.label = s.label AND abs(c.x - s.x) + abs(c.y - s.y) = 1 AND c.x BETWEEN s.x - 1 AND s.x + 1),
patch AS (SELECT x, y, label, m AS patch FROM (SELECT x, y, label, min(fy * 2147483648 + fx) AS m FROM (
  SELECT b.x, b.y, b.label, r.x AS fx, r.y AS fy FROM reach r JOIN blocky b ON b.x = r.tx AND b.y = r.ty) GROUP BY 1, 2, 3))"""


@query("rg1_patch_sizes", "SELECT patch, label, count(*) AS n FROM patch GROUP BY 1, 2", FOUR)
def patch_sizes(t: Tables) -> DataFrame:
    return op.patches(t.blocky, eight=False).groupBy("patch", "label").agg(F.count("*").alias("n"))


def sieved(source: str, name: str, near: str, least: int) -> str:
    """SQL of one sieve: patches of a table under `least` cells take the label of the largest patch that they touch."""
    touch = near.format(a="a", b="b")
    return f"""{name}_reach(x, y, tx, ty) AS (SELECT x, y, x, y FROM {source} UNION SELECT r.x, r.y, b.x, b.y FROM {name}_reach r JOIN {source} a ON a.x = r.tx AND a.y = r.ty JOIN {source} b ON b.label = a.label AND {touch}),
{name}_patch AS (SELECT b.x, b.y, b.label, min(r.y * 2147483648 + r.x) AS patch FROM {name}_reach r JOIN {source} b ON b.x = r.tx AND b.y = r.ty GROUP BY 1, 2, 3),
{name}_sized AS (SELECT *, count(*) OVER (PARTITION BY patch) AS size FROM {name}_patch),
{name}_new AS (SELECT a.patch, arg_max(b.label, (b.size, -b.label)) AS new FROM {name}_sized a JOIN {name}_sized b ON {touch} AND a.patch <> b.patch WHERE a.size < {least} GROUP BY 1),
{name} AS (SELECT x, y, coalesce(new, label) AS label FROM {name}_patch LEFT JOIN {name}_new USING (patch))"""


CORNERS = "b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1"
CROSS = "abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.x BETWEEN a.x - 1 AND a.x + 1"


@query("rg2_sieve", "SELECT x, y, label FROM twice", f"{sieved('blocky', 'once', CORNERS, 4)}, {sieved('once', 'twice', CROSS, 4)}")
def sieve(t: Tables) -> DataFrame:
    return op.sieve_once(op.sieve_once(t.blocky, 4, True), 4, False)


@query("rg7_local_majority", """SELECT x, y, label FROM (SELECT a.x, a.y, b.label, row_number() OVER (PARTITION BY a.x, a.y ORDER BY count(*) DESC, b.label) AS k
  FROM blocky a JOIN blocky b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY a.x, a.y, b.label) WHERE k = 1""")
def local_majority(t: Tables) -> DataFrame:
    return op.local_majority(t.blocky)


@query("rg8_opening", """SELECT a.x, a.y, max(e.v) AS v FROM blocky a JOIN e ON e.x BETWEEN a.x - 1 AND a.x + 1 AND e.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY 1, 2""",
       """e AS (SELECT a.x, a.y, min(CASE WHEN b.label = 2 THEN 1 ELSE 0 END) AS v FROM blocky a JOIN blocky b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY 1, 2)""")
def opening(t: Tables) -> DataFrame:
    v = t.blocky.select("x", "y", (F.col("label") == 2).cast("int").alias("v"))
    return op.morphology(op.morphology(v, dilate=False), dilate=True)


@query("rg9_label_contacts", "SELECT a.label, b.label AS n_label, count(*) AS n FROM blocky a JOIN blocky b ON abs(a.x - b.x) + abs(a.y - b.y) = 1 AND a.x BETWEEN b.x - 1 AND b.x + 1 AND a.y BETWEEN b.y - 1 AND b.y + 1 WHERE a.label <> b.label GROUP BY 1, 2")
def contacts(t: Tables) -> DataFrame:
    return op.neighbours(t.blocky).where("label != n_label").groupBy("label", "n_label").agg(F.count("*").alias("n"))


@query("vt10_boundary_edges", "SELECT label, CAST(sum(4 - n) AS BIGINT) AS edges FROM (SELECT a.x, a.y, a.label, count(b.x) AS n FROM blocky a LEFT JOIN blocky b ON b.label = a.label AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY 1, 2, 3) GROUP BY 1")
def boundary(t: Tables) -> DataFrame:
    inside = op.neighbours(t.blocky).where("label = n_label").groupBy("x", "y").agg(F.count("*").alias("n"))
    return t.blocky.join(inside, ["x", "y"], "left").groupBy("label").agg(F.sum(4 - F.coalesce("n", F.lit(0))).alias("edges"))


@query("pf18_focal_mean", "SELECT a.x, a.y, round(avg(b.conf), 6) AS mean FROM grid a JOIN grid b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 GROUP BY 1, 2")
def focal_mean(t: Tables) -> DataFrame:
    n = op.neighbours(t.grid.select("x", "y", "conf"), (*op.EIGHT, (0, 0)))
    return n.groupBy("x", "y").agg(F.round(F.avg("n_conf"), 6).alias("mean"))


OUTLINE = """inner_sides AS (SELECT a.patch, count(*) AS n FROM patch a JOIN patch b ON a.patch = b.patch AND abs(a.x - b.x) + abs(a.y - b.y) = 1 AND b.x BETWEEN a.x - 1 AND a.x + 1 GROUP BY 1),
sized AS (SELECT patch, count(*) AS n FROM patch GROUP BY 1)"""


@query("vt10_rings", "SELECT patch, CAST(sized.n AS DOUBLE) AS area, CAST(4 * sized.n - coalesce(inner_sides.n, 0) AS BIGINT) AS perimeter FROM sized LEFT JOIN inner_sides USING (patch)", f"{FOUR}, {OUTLINE}")
def rings(t: Tables) -> DataFrame:
    """Area and perimeter of each patch from the corners of its rings."""
    corners = outlines.rings(op.patches(t.blocky, eight=False)).transform(stored)
    area = outlines.ring_sizes(corners).groupBy("patch").agg(F.sum("area").alias("area"))
    return area.join(outlines.ring_lengths(corners).groupBy("patch").agg(F.sum("length").alias("perimeter")), "patch")


@query("vt10_arcs", "SELECT patch, CAST(count(*) AS DOUBLE) AS area FROM patch GROUP BY 1", FOUR)
def arcs(t: Tables) -> DataFrame:
    """Area of each patch from the borders that it shares with others, each of which is kept once."""
    return outlines.patch_areas(outlines.arcs(op.patches(t.blocky, eight=False)))


@query("vt6_simplified")
def simplified(t: Tables) -> DataFrame:
    """Area of each patch after its borders are simplified by a tolerance of one cell."""
    return outlines.patch_areas(outlines.simplified(outlines.arcs(op.patches(t.blocky, eight=False)), 1.0))
