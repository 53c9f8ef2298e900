"""Queries on polygons of any form: joins, differences, unions, overlaps, rasters and buffers over row spans."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import samples
from landseries.operators import spans as op
from landseries.operators.ranks import ranked
from landseries.plans.registry import query
from landseries.plans.shapes import SQUARES, squares
from landseries.sources.views import Tables

SIDES = """points AS (SELECT fid, r, unnest(rings[r]) AS p, unnest(range(1, len(rings[r]) + 1)) AS i, len(rings[r]) AS n FROM (SELECT fid, rings, unnest(range(1, len(rings) + 1)) AS r FROM shapes)),
sides AS (SELECT p.fid, p.p[1] AS x1, p.p[2] AS y1, q.p[1] AS x2, q.p[2] AS y2 FROM points p JOIN points q ON q.fid = p.fid AND q.r = p.r AND q.i = p.i % p.n + 1)"""
COVER = f"""{SIDES}, boxes AS (SELECT fid, CAST(floor(min(x1)) AS BIGINT) AS xa, CAST(ceil(max(x1)) AS BIGINT) AS xb, CAST(floor(min(y1)) AS BIGINT) AS ya, CAST(ceil(max(y1)) AS BIGINT) AS yb FROM sides GROUP BY 1),
near AS (SELECT fid, x, y FROM boxes, unnest(range(xa, xb)) s(x), unnest(range(ya, yb)) u(y)),
inside AS (SELECT fid, x, y FROM near JOIN sides USING (fid) WHERE (y1 <= y + 0.5) <> (y2 <= y + 0.5) AND x1 + (y + 0.5 - y1) * (x2 - x1) / (y2 - y1) <= x + 0.5 GROUP BY ALL HAVING count(*) % 2 = 1),
cell AS (SELECT fid, code, region, tile, x, y FROM inside JOIN shapes USING (fid))"""
ZONES = f"{COVER}, {SQUARES}, zone_cell AS (SELECT zone, kind, CAST(4 * zx + a AS BIGINT) AS x, CAST(4 * zy + b AS BIGINT) AS y FROM squares, unnest(range(0, 80)) s(a), unnest(range(0, 80)) u(b))"


def layer(t: Tables, *codes: int) -> DataFrame:
    return op.shape_spans(t.shapes.where(F.col("code").isin(*codes)))


def zones(t: Tables) -> DataFrame:
    """The squares of nations, four times as large, as spans."""
    four = squares(t).withColumns({c: F.col(c) * 4 for c in ("x0", "y0", "w", "h")})
    return op.rectangle_spans(four.withColumnRenamed("zone", "fid"), ("fid", "kind"))


@query("jn1_shape_intersection", """SELECT a.fid, b.fid AS o_fid, any_value(a.region) AS region, any_value(b.tile) AS o_tile, count(*) AS area
  FROM cell a JOIN cell b USING (x, y) WHERE a.code = 1 AND b.code = 2 GROUP BY 1, 2""", COVER)
def intersection(t: Tables) -> DataFrame:
    """Area of each intersection, with chosen fields of both layers."""
    of = lambda code, field: op.shape_spans(t.shapes.where(F.col("code") == code), ("fid", field))
    return op.common_area(of(1, "region"), of(2, "tile"), ("fid", "region"), ("fid", "tile"))


@query("jn2_shape_difference", "SELECT fid, count(*) AS area FROM cell WHERE code = 1 AND (x, y) NOT IN (SELECT (x, y) FROM cell WHERE code = 2) GROUP BY 1", COVER)
def difference(t: Tables) -> DataFrame:
    return op.area(op.minus(layer(t, 1), layer(t, 2)), "fid")


@query("jn2_shape_union", "SELECT y, count(DISTINCT x) AS area FROM cell WHERE code IN (1, 2) GROUP BY 1", COVER)
def union(t: Tables) -> DataFrame:
    return op.area(op.union(layer(t, 1), layer(t, 2)), "y")


@query("jn3_shape_common_spans", """SELECT fid, o_fid, y, min(x) AS a, max(x) + 1 AS b FROM (SELECT a.fid, b.fid AS o_fid, x, y, x - row_number() OVER (PARTITION BY a.fid, b.fid, y ORDER BY x) AS g
  FROM cell a JOIN cell b USING (x, y) WHERE a.code = 3 AND b.code = 4) GROUP BY fid, o_fid, y, g""", COVER)
def common_spans(t: Tables) -> DataFrame:
    """The shapes of all intersections: spans that don't touch, as those of each layer are made not to."""
    return op.common(op.joined(layer(t, 3)), op.joined(layer(t, 4)))


@query("jn4_shapes_meeting_zones", "SELECT DISTINCT fid, zone FROM cell JOIN zone_cell USING (x, y) WHERE kind = 1", ZONES)
def meeting(t: Tables) -> DataFrame:
    met = op.common(op.shape_spans(t.shapes), zones(t).where("kind = 1").drop("kind"))
    return met.select("fid", F.col("o_fid").alias("zone")).distinct()


@query("jn5_shape_clip", "SELECT fid, x, y FROM cell SEMI JOIN (SELECT x, y FROM zone_cell WHERE kind = 2) USING (x, y) WHERE code = 5", ZONES)
def clip(t: Tables) -> DataFrame:
    inside = op.common(layer(t, 5), op.union(zones(t).where("kind = 2")).withColumn("fid", F.lit(0)))
    return op.cells(inside.select("fid", "y", "a", "b")).select("fid", "x", "y")


@query("jn6_tiles_meeting_zones", "SELECT DISTINCT tile, zone FROM cell JOIN zone_cell USING (x, y)", ZONES)
def tiles_meeting(t: Tables) -> DataFrame:
    whole = op.joined(op.shape_spans(t.shapes, ("fid", "tile")), "tile").withColumnRenamed("tile", "fid")
    return op.common(whole, zones(t).drop("kind")).select(F.col("fid").alias("tile"), F.col("o_fid").alias("zone")).distinct()


@query("jn8_shape_share", "SELECT zone, count(*) AS n_cells, count(DISTINCT fid) AS n_shapes, round(100.0 * count(DISTINCT (x, y)) / 6400, 6) AS percent FROM cell JOIN zone_cell USING (x, y) GROUP BY 1", ZONES)
def share(t: Tables) -> DataFrame:
    """Shapes of a zone, their cells, and the percentage of the zone that any covers."""
    of = zones(t).drop("kind")
    met = op.common(of, op.shape_spans(t.shapes)).groupBy(F.col("fid").alias("zone")).agg(F.sum(F.col("b") - F.col("a")).alias("n_cells"), F.countDistinct("o_fid").alias("n_shapes"))
    covered = op.area(op.common(of, op.union(op.shape_spans(t.shapes)).withColumn("fid", F.lit(0))), "fid")
    return met.join(covered.withColumnRenamed("fid", "zone"), "zone").select("zone", "n_cells", "n_shapes", F.round(100.0 * F.col("area") / 6400, 6).alias("percent"))


@query("jn13_shapes_at_points", "SELECT vec_id, fid FROM (SELECT vec_id, CAST(floor((embedding[1]::DOUBLE + 1) * 200) AS BIGINT) AS x, CAST(floor((embedding[2]::DOUBLE + 1) * 200) AS BIGINT) AS y FROM embeddings) JOIN cell USING (x, y)", COVER)
def at_points(t: Tables) -> DataFrame:
    e = F.col("embedding")
    points = t.embeddings.select("vec_id", ((e[0].cast("double") + 1) * 200).alias("x"), ((e[1].cast("double") + 1) * 200).alias("y"))
    return op.at_points(points, op.shape_spans(t.shapes)).select("vec_id", "fid")


@query("jn14_rasterised_shapes", "SELECT x, y, CAST(max(code) AS INTEGER) AS code FROM cell GROUP BY 1, 2", COVER)
def rasterised(t: Tables) -> DataFrame:
    """The greatest code of the shapes on each cell."""
    spans = op.shape_spans(t.shapes, ("fid", "code")).withColumn("key", -F.col("code")).select("key", "y", "a", "b")
    return op.cells(op.owned(spans, "key")).select("x", "y", (-F.col("key")).cast("int").alias("code"))


@query("jn15_shape_overlap", """SELECT code, fid, count(*) AS own, count(*) FILTER (first = fid) AS kept, count(*) FILTER (n > 1) AS shared FROM (
  SELECT code, fid, min(fid) OVER (PARTITION BY code, x, y) AS first, count(*) OVER (PARTITION BY code, x, y) AS n FROM cell WHERE code = 5) GROUP BY 1, 2""", COVER)
def overlap(t: Tables) -> DataFrame:
    """Cells of each shape, those left when common parts go to the least id, and those that others hold too."""
    spans = layer(t, 5)
    kept = op.area(op.owned(spans), "fid").withColumnRenamed("area", "kept")
    more = op.depths(n=spans).where("n > 1").select("y", "a", "b").withColumn("fid", F.lit(0))
    shared = op.area(op.common(spans, more), "fid").withColumnRenamed("area", "shared")
    out = op.area(spans, "fid").withColumnRenamed("area", "own").join(kept, "fid", "left").join(shared, "fid", "left")
    return out.select(F.lit(5).alias("code"), "fid", "own", F.coalesce("kept", F.lit(0)).alias("kept"), F.coalesce("shared", F.lit(0)).alias("shared"))


@query("jn15_corrected_shapes", "SELECT min(fid) AS fid, x, y FROM cell WHERE code = 4 GROUP BY x, y", COVER)
def corrected(t: Tables) -> DataFrame:
    return op.cells(op.owned(layer(t, 4))).select("fid", "x", "y")


@query("ag11_dissolved_shapes", """SELECT tile, y, min(x) AS a, max(x) + 1 AS b FROM (SELECT tile, y, x, x - row_number() OVER (PARTITION BY tile, y ORDER BY x) AS g
  FROM (SELECT DISTINCT tile, x, y FROM cell)) GROUP BY tile, y, g""", COVER)
def dissolved(t: Tables) -> DataFrame:
    return op.joined(op.shape_spans(t.shapes, ("fid", "tile")), "tile")


def ball(radius: int) -> str:
    return ", ".join(f"({a}, {b})" for a in range(-radius, radius + 1) for b in range(-radius, radius + 1) if a * a + b * b <= radius * radius)


@query("vt5_dilated_shapes", f"SELECT fid, count(DISTINCT (x + a, y + b)) AS area FROM cell, (VALUES {ball(2)}) v(a, b) GROUP BY 1", COVER)
def dilated(t: Tables) -> DataFrame:
    return op.area(op.dilated(op.shape_spans(t.shapes), 2), "fid")


@query("vt5_eroded_shapes", f"SELECT fid, count(*) AS area FROM (SELECT c.fid, c.x, c.y FROM cell c, (VALUES {ball(2)}) v(a, b) JOIN cell o ON o.fid = c.fid AND o.x = c.x + a AND o.y = c.y + b GROUP BY ALL HAVING count(*) = {len(ball(2).split('), ('))}) GROUP BY 1", COVER)
def eroded(t: Tables) -> DataFrame:
    return op.area(op.eroded(op.shape_spans(t.shapes), 2), "fid")


@query("vt1_shape_areas", """SELECT fid, round(abs(sum(x1 * y2 - x2 * y1)) / 2, 6) AS area, round(sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)), 6) AS perimeter FROM sides GROUP BY 1""", SIDES)
def areas(t: Tables) -> DataFrame:
    length = op.edges(t.shapes).groupBy("fid").agg(F.round(F.sum(F.sqrt((F.col("x2") - F.col("x1")) ** 2 + (F.col("y2") - F.col("y1")) ** 2)), 6).alias("perimeter"))
    return t.shapes.select("fid", F.round(F.abs(op.ring_area(F.col("rings"))), 6).alias("area")).join(length, "fid")


MEASURES = f"""{SIDES}, boxed AS (SELECT fid, 16.0 * w * h AS box, 4.0 * w AS w, 4.0 * h AS h FROM polygons),
measured AS (SELECT fid, abs(sum(x1 * y2 - x2 * y1)) / 2 AS area, sum(sqrt((x2 - x1) ** 2 + (y2 - y1) ** 2)) AS perimeter FROM sides GROUP BY 1),
described AS (SELECT fid, area / (box * CASE fid % 4 WHEN 0 THEN 1 WHEN 1 THEN 0.875 WHEN 2 THEN 0.5 ELSE 0.75 END) AS convexity, 4 * pi() * area / (perimeter * perimeter) AS compactness,
  CASE WHEN fid % 4 = 0 THEN greatest(w, h) / least(w, h) END AS elongation FROM measured JOIN boxed USING (fid))"""


@query("vt2_shape_descriptors", "SELECT fid, round(convexity, 6) AS convexity, round(compactness, 6) AS compactness, round(elongation, 6) AS elongation FROM described", MEASURES)
def described(t: Tables) -> DataFrame:
    """Elongation is compared for boxes only, whose smallest rectangle has a closed form."""
    d = op.descriptors(t.shapes)
    return d.select("fid", F.round("convexity", 6).alias("convexity"), F.round("compactness", 6).alias("compactness"), F.when(F.col("fid") % 4 == 0, F.round("elongation", 6)).alias("elongation"))


@query("vt3_kinds_of_boxes", "SELECT fid, CASE WHEN convexity >= 0.7 AND (compactness < 0.4 OR elongation > 2.5) THEN 'hedge' WHEN convexity >= 0.7 THEN 'other' ELSE 'forest' END AS kind FROM described WHERE fid % 4 = 0", MEASURES)
def kinds(t: Tables) -> DataFrame:
    d = op.descriptors(t.shapes.where("fid % 4 = 0"))
    return d.select("fid", samples.hedge_or_forest(F.col("convexity"), F.col("compactness"), F.col("elongation")).alias("kind"))


ZONED = "zoned AS (SELECT code AS zone, fid, area, coalesce(sum(area) OVER (PARTITION BY code ORDER BY fid ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before, sum(area) OVER (PARTITION BY code) AS total, row_number() OVER (PARTITION BY code ORDER BY fid) AS k FROM polygons)"


@query("zs11_chunks_of_equal_area", "SELECT fid, CAST(floor(before * 4 / total) AS BIGINT) AS chunk FROM zoned", ZONED)
def equal_area(t: Tables) -> DataFrame:
    """Zones of a layer in four chunks of nearly equal area, by running sums."""
    total = t.polygons.groupBy("code").agg(F.sum("area").alias("total"))
    placed = ranked(t.polygons.select("code", "fid", "area"), ["fid"], ["code"], sums={"area": "before"}).join(F.broadcast(total), "code")
    return placed.select("fid", F.floor(F.col("before") * 4 / F.col("total")).alias("chunk"))


@query("zs11_chunks_by_count", "SELECT fid, (k - 1) // 50 AS chunk FROM zoned", ZONED)
def by_count(t: Tables) -> DataFrame:
    return ranked(t.polygons.select("code", "fid"), ["fid"], ["code"]).select("fid", F.floor((F.col("rank") - 1) / 50).alias("chunk"))
