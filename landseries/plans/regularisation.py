"""Queries on the regularisation of class maps and on masks of tiles."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import patches, spans
from landseries.operators import regularisation as op
from landseries.plans.patches import CORNERS, CROSS, FOUR, sieved
from landseries.plans.registry import query
from landseries.plans.spans import COVER
from landseries.sources.views import Tables

MODE = "mode AS (SELECT x, y, label FROM (SELECT x // 2 AS x, y // 2 AS y, label, row_number() OVER (PARTITION BY x // 2, y // 2 ORDER BY count(*) DESC, label) AS k FROM twice GROUP BY x // 2, y // 2, label) WHERE k = 1)"
WATER = "water AS (SELECT DISTINCT x, y FROM cell WHERE code = 1)"


@query(
    "rg4_merged_rules", "SELECT m.x, m.y, CASE WHEN m.label = 2 AND w.x IS NULL THEN 9 ELSE m.label END AS label FROM mode m LEFT JOIN water w ON w.x = m.x AND w.y = m.y",
    f"{sieved('blocky', 'once', CORNERS, 4)}, {sieved('once', 'twice', CROSS, 4)}, {MODE}, {COVER}, {WATER}",
)
def merged_rules(t: Tables) -> DataFrame:
    """Rules of odd and even classes summed, sieved, halved, and class 2 outside the shapes of code 1 made 9."""
    rule = lambda odd: t.blocky.select("x", "y", F.when(F.col("label") % 2 == odd, F.col("label")).otherwise(0).alias("label"))
    water = spans.shape_spans(t.shapes.where("code = 1"))
    return op.merged([rule(0), rule(1)], 4, 2, water, 2, 9)


def within(source: str, name: str, near: str) -> str:
    """SQL of one sieve inside the top-level classes label // 2."""
    return sieved(source, name, near, 4).replace("AND a.patch <> b.patch", "AND a.patch <> b.patch AND a.label // 2 = b.label // 2")


@query("rg3_sieved_rules", "SELECT x, y, label FROM second", f"{within('blocky', 'one', CORNERS)}, {within('one', 'second', CROSS)}")
def sieved_rules(t: Tables) -> DataFrame:
    return op.sieved_by_rule(t.blocky, F.floor(F.col("label") / 2), 4)


@query("rg6_recoded_outside", "SELECT b.x, b.y, CASE WHEN label IN (1, 2) AND c.x IS NULL THEN 0 ELSE label END AS label FROM blocky b LEFT JOIN (SELECT DISTINCT x, y FROM cell WHERE region = 2) c ON c.x = b.x AND c.y = b.y", COVER)
def recoded_outside(t: Tables) -> DataFrame:
    return op.recoded(t.blocky, spans.shape_spans(t.shapes.where("region = 2")), [1, 2], 0, inside=False)


POINTS = "listed AS (SELECT DISTINCT patch FROM patch JOIN supplier ON x = s_suppkey * 3 % 150 AND y = s_suppkey % 97)"


@query("rg10_listed_patches", "SELECT x, y, CASE WHEN l.patch IS NULL THEN 0 ELSE label END AS label FROM patch p LEFT JOIN listed l ON l.patch = p.patch", f"{FOUR}, {POINTS}")
def listed_patches(t: Tables) -> DataFrame:
    """Labels of the patches in which a supplier stands."""
    named = patches.patches(t.blocky, eight=False).cache()
    key = F.col("s_suppkey")
    at = t.supplier.select((key * 3 % 150).alias("x"), (key % 97).alias("y"))
    return op.only_listed(named, named.join(at, ["x", "y"]).select("patch")).select("x", "y", "label")


@query("pf28_common_mask", "SELECT patch, count(*) AS n, min(x) AS x0, max(x) + 1 AS x1 FROM mk_patch WHERE label = 1 GROUP BY 1", f"""mask AS (SELECT x, y, CAST(CASE WHEN label <> 3 AND conf >= 0.2 THEN 1 ELSE 0 END AS INTEGER) AS label FROM grid),
{sieved('mask', 'mk', CROSS, 0)}""")
def common_mask(t: Tables) -> DataFrame:
    """Connected parts of what two sensors both see."""
    mask = t.grid.select("x", "y", ((F.col("label") != 3) & (F.col("conf") >= 0.2)).cast("int").alias("label"))
    parts = patches.patches(mask, eight=False).where("label = 1")
    return parts.groupBy("patch").agg(F.count("*").alias("n"), F.min("x").alias("x0"), (F.max("x") + 1).alias("x1"))


@query("vt11_copied_if_new", """SELECT fid, x0, y0, w, h FROM polygons UNION ALL SELECT 1000000 + s_suppkey, s_suppkey % 97, s_suppkey % 89, 1 + s_suppkey % 4, 1 + s_suppkey % 3 FROM supplier
  WHERE (s_suppkey % 97, s_suppkey % 89, 1 + s_suppkey % 4, 1 + s_suppkey % 3) NOT IN (SELECT (x0, y0, w, h) FROM polygons)""")
def copied_if_new(t: Tables) -> DataFrame:
    """Polygons and those of another file whose shape isn't there yet."""
    key, shape = F.col("s_suppkey"), ["x0", "y0", "w", "h"]
    other = t.supplier.select((1000000 + key).alias("fid"), (key % 97).alias("x0"), (key % 89).alias("y0"), (1 + key % 4).alias("w"), (1 + key % 3).alias("h"))
    own = t.polygons.select("fid", *shape)
    return own.unionByName(other.join(own.select(*shape), shape, "left_anti"))
