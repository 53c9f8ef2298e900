"""Queries on shapes, filters of series, and sets of samples made from maps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import patches, spans
from landseries.operators import shapes as op
from landseries.operators import tables as tab
from landseries.operators.ranks import ranked
from landseries.plans.registry import query
from landseries.sources.views import Tables

CELLS = "cells AS (SELECT fid, code, tile, region, x0 + a AS x, y0 + b AS y FROM polygons, unnest(range(0, w)) s(a), unnest(range(0, h)) u(b))"
SQUARES = "squares AS (SELECT n_nationkey AS zone, n_regionkey AS kind, n_nationkey % 5 * 20 AS zx, n_nationkey // 5 * 20 AS zy FROM nation)"
CUT = "greatest(x0, zx) AS x0, greatest(y0, zy) AS y0, least(x0 + w, zx + 20) - greatest(x0, zx) AS w, least(y0 + h, zy + 20) - greatest(y0, zy) AS h"
IN_SQUARE = "x0 < zx + 20 AND zx < x0 + w AND y0 < zy + 20 AND zy < y0 + h"
RECT = ("fid", "x0", "y0", "w", "h")


def squares(t: Tables) -> DataFrame:
    """Zones of 20 cells a side, one for each nation, with its region as their kind."""
    key = F.col("n_nationkey")
    return t.nation.select(key.alias("zone"), F.col("n_regionkey").alias("kind"), (key % 5 * 20).alias("x0"), (F.floor(key / 5) * 20).alias("y0"), F.lit(20).alias("w"), F.lit(20).alias("h"))


def layer(t: Tables, code: int) -> DataFrame:
    return t.polygons.where(F.col("code") == code)


@query("jn2_difference", "SELECT fid, x, y FROM cells WHERE code = 1 AND (x, y) NOT IN (SELECT (x, y) FROM cells WHERE code = 2)", CELLS)
def difference(t: Tables) -> DataFrame:
    return op.difference(layer(t, 1), layer(t, 2))


@query("jn3_common_parts", """SELECT a.fid, b.fid AS o_fid, greatest(a.x0, b.x0) AS x0, greatest(a.y0, b.y0) AS y0, least(a.x0 + a.w, b.x0 + b.w) - greatest(a.x0, b.x0) AS w,
  least(a.y0 + a.h, b.y0 + b.h) - greatest(a.y0, b.y0) AS h FROM polygons a JOIN polygons b ON a.code = 3 AND b.code = 4
  AND a.x0 < b.x0 + b.w AND b.x0 < a.x0 + a.w AND a.y0 < b.y0 + b.h AND b.y0 < a.y0 + a.h""")
def common_parts(t: Tables) -> DataFrame:
    return op.clipped(layer(t, 3).select(*RECT), layer(t, 4).select(*RECT)).select("fid", "o_fid", "x0", "y0", "w", "h")


@query("jn5_clipped_to_zone", f"SELECT fid, zone, {CUT} FROM polygons JOIN squares ON {IN_SQUARE} WHERE kind = 1", SQUARES)
def clipped(t: Tables) -> DataFrame:
    return op.clipped(t.polygons.select(*RECT), squares(t).where("kind = 1")).select("fid", F.col("o_zone").alias("zone"), "x0", "y0", "w", "h")


@query("jn15_self_overlap", "SELECT p.fid, count(o.fid) AS n FROM polygons p LEFT JOIN (SELECT x, y, min(fid) AS fid FROM cells WHERE code = 5 GROUP BY 1, 2) o ON o.fid = p.fid WHERE code = 5 GROUP BY 1", CELLS)
def self_overlap(t: Tables) -> DataFrame:
    return op.owned_cells(layer(t, 5))


@query("jn19_points_of_region", f"SELECT fid, x0 AS x, y0 AS y FROM polygons JOIN squares ON {IN_SQUARE} WHERE kind = 2 AND region = 2 GROUP BY ALL", SQUARES)
def points_of_region(t: Tables) -> DataFrame:
    inside = tab.rectangle_join(t.polygons.where("region = 2"), squares(t).where("kind = 2")).select("fid")
    return t.polygons.join(inside, "fid", "left_semi").select("fid", F.col("x0").alias("x"), F.col("y0").alias("y"))


@query("jn20_tile_footprint", "SELECT x // 40 AS tx, y // 40 AS ty, min(x) AS x0, min(y) AS y0, max(x) + 1 AS x1, max(y) + 1 AS y1 FROM grid WHERE label <> 3 GROUP BY 1, 2")
def tile_footprint(t: Tables) -> DataFrame:
    cells = t.grid.where("label != 3")
    return cells.groupBy(F.floor(F.col("x") / 40).alias("tx"), F.floor(F.col("y") / 40).alias("ty")).agg(
        F.min("x").alias("x0"), F.min("y").alias("y0"), (F.max("x") + 1).alias("x1"), (F.max("y") + 1).alias("y1")
    )


@query("ag11_dissolved", "SELECT DISTINCT code, x, y FROM cells", CELLS)
def dissolved(t: Tables) -> DataFrame:
    return spans.cells(spans.joined(spans.rectangle_spans(t.polygons, ("code",)), "code")).select("code", "x", "y")


@query("sp3_folds_by_class_and_region", "SELECT fid, CAST((row_number() OVER (PARTITION BY code, region ORDER BY area DESC, fid) - 1) % 5 AS INTEGER) AS fold FROM polygons")
def folds_by_region(t: Tables) -> DataFrame:
    return tab.folds(t.polygons, "fid", ["code", "region"], 5, F.desc("area")).select("fid", "fold")


@query("wn8_fold_totals", "SELECT code, fold, count(*) AS n, round(sum(area), 2) AS area FROM (SELECT code, area, CAST((row_number() OVER (PARTITION BY code ORDER BY area DESC, fid) - 1) % 5 AS INTEGER) AS fold FROM polygons) GROUP BY 1, 2")
def fold_totals(t: Tables) -> DataFrame:
    return tab.folds(t.polygons, "fid", ["code"], 5, F.desc("area")).groupBy("code", "fold").agg(F.count("*").alias("n"), F.round(F.sum("area"), 2).alias("area"))


@query("vt5_buffered", """SELECT fid, k AS by, x0 - k AS x0, y0 - k AS y0, w + 2 * k AS w, h + 2 * k AS h FROM polygons, (SELECT CAST(unnest([-1, 2]) AS INTEGER) AS k) WHERE w + 2 * k > 0 AND h + 2 * k > 0""")
def buffered(t: Tables) -> DataFrame:
    both = [op.buffered(t.polygons.select(*RECT), k).withColumn("by", F.lit(k)) for k in (-1, 2)]
    return both[0].unionByName(both[1])


@query("vt2_descriptors", "SELECT fid, round(4 * pi() * w * h / ((2 * (w + h)) * (2 * (w + h))), 9) AS compactness, round(greatest(w, h) / least(w, h), 9) AS elongation FROM polygons")
def descriptors(t: Tables) -> DataFrame:
    compactness, elongation = op.descriptors(F.col("w"), F.col("h"))
    return t.polygons.select("fid", F.round(compactness, 9).alias("compactness"), F.round(elongation, 9).alias("elongation"))


@query("vt4_exploded_parts", "SELECT code, tile, fid, row_number() OVER (PARTITION BY code, tile ORDER BY fid) AS part, count(*) OVER (PARTITION BY code, tile) > 1 AS multiple FROM polygons")
def exploded_parts(t: Tables) -> DataFrame:
    """A multipolygon per class and tile, its parts in the order of fid."""
    parts = ranked(t.polygons.select("code", "tile", "fid"), ["fid"], ["code", "tile"], rank="part", size="n")
    return parts.select("code", "tile", "fid", "part", (F.col("n") > 1).alias("multiple"))


PROBLEM = "CASE WHEN fid % 7 = 0 THEN 'empty' WHEN fid % 11 = 0 THEN 'open' WHEN fid % 13 = 0 THEN 'flat' END"


def spoiled(t: Tables) -> DataFrame:
    """Rings of which some have lost all points, their last point or their height."""
    fid = F.col("fid")
    whole = op.ring(F.col("x0"), F.col("y0"), F.col("w"), F.when((fid % 13 == 0) & (fid % 11 != 0), 0).otherwise(F.col("h")))
    points = F.when(fid % 7 == 0, F.slice(whole, 1, 0)).when(fid % 11 == 0, F.slice(whole, 1, 4)).otherwise(whole)
    return t.polygons.select("fid", "code", "region", "area", op.ring_problem(points).alias("problem"))


@query("ck3_geometry_problems", f"SELECT fid, {PROBLEM} AS problem FROM polygons WHERE {PROBLEM} IS NOT NULL")
def geometry_problems(t: Tables) -> DataFrame:
    return spoiled(t).where("problem is not null").select("fid", "problem")


@query("ck2_small_regions", "SELECT region, count(*) AS n, count(*) FILTER (area < 500) AS small FROM polygons GROUP BY 1")
def small_regions(t: Tables) -> DataFrame:
    return t.polygons.groupBy("region").agg(F.count("*").alias("n"), F.count(F.when(F.col("area") < 500, 1)).alias("small"))


@query("ck4_all_checks", f"""SELECT problem AS finding, count(*) AS n FROM (SELECT {PROBLEM} AS problem FROM polygons) WHERE problem IS NOT NULL GROUP BY 1
  UNION ALL SELECT 'small', count(*) FROM polygons WHERE area < 500 HAVING count(*) > 0""")
def all_checks(t: Tables) -> DataFrame:
    found = spoiled(t).withColumn("finding", F.explode(F.array_compact(F.array("problem", F.when(F.col("area") < 500, "small")))))
    return found.groupBy("finding").agg(F.count("*").alias("n"))


@query("ms4_region_shapes", "SELECT region, min(x0) AS x0, min(y0) AS y0, max(x0 + w) AS x1, max(y0 + h) AS y1, count(DISTINCT tile) AS tiles FROM polygons GROUP BY 1")
def region_shapes(t: Tables) -> DataFrame:
    far = {"x1": F.max(F.col("x0") + F.col("w")), "y1": F.max(F.col("y0") + F.col("h"))}
    return t.polygons.groupBy("region").agg(F.min("x0").alias("x0"), F.min("y0").alias("y0"), *(v.alias(k) for k, v in far.items()), F.countDistinct("tile").alias("tiles"))


@query("ms5_regions_by_tiles", f"SELECT region, zone AS tile, count(*) AS parts, CAST(sum(w * h) AS BIGINT) AS covered FROM (SELECT region, zone, {CUT} FROM polygons JOIN squares ON {IN_SQUARE}) GROUP BY 1, 2", SQUARES)
def regions_by_tiles(t: Tables) -> DataFrame:
    parts = op.clipped(t.polygons.select(*RECT, "region"), squares(t)).withColumn("covered", F.col("w") * F.col("h"))
    return parts.groupBy("region", F.col("o_zone").alias("tile")).agg(F.count("*").alias("parts"), F.sum("covered").alias("covered"))


@query("ms6_mosaic_in_shapes", "SELECT DISTINCT x, y, label FROM grid JOIN squares ON kind = 3 AND x BETWEEN zx AND zx + 19 AND y BETWEEN zy AND zy + 19", SQUARES)
def mosaic_in_shapes(t: Tables) -> DataFrame:
    zones = spans.rectangle_spans(squares(t).where("kind = 3").withColumnRenamed("zone", "fid"))
    return spans.at_points(t.grid, zones).select("x", "y", "label").distinct()


@query("ms9_grid_refit", "SELECT x // 40 AS in_x, y // 40 AS in_y, x // 25 AS out_x, y // 25 AS out_y, count(*) AS cells FROM grid GROUP BY 1, 2, 3, 4")
def grid_refit(t: Tables) -> DataFrame:
    cell = lambda c, size, name: F.floor(F.col(c) / size).alias(name)
    return t.grid.groupBy(cell("x", 40, "in_x"), cell("y", 40, "in_y"), cell("x", 25, "out_x"), cell("y", 25, "out_y")).agg(F.count("*").alias("cells"))


@query("ts11_mosaic_by_date", "SELECT pixel % 10 AS cell, band, date, round(arg_min(value, pixel) FILTER (mask = 0), 6) AS value FROM obs GROUP BY 1, 2, 3")
def mosaic_by_date(t: Tables) -> DataFrame:
    """Scenes of one date over a cell in the order of their pixel ids; the first clear one counts."""
    clear = F.col("mask") == 0
    return t.obs.groupBy((F.col("pixel") % 10).alias("cell"), "band", "date").agg(F.round(F.min_by(F.when(clear, F.col("value")), F.when(clear, F.col("pixel"))), 6).alias("value"))


@query("pf16_border_mask", "SELECT a.x, a.y, max(e.v) AS v FROM grid a JOIN e ON e.x BETWEEN a.x - 5 AND a.x + 5 AND e.y BETWEEN a.y - 5 AND a.y + 5 GROUP BY 1, 2",
       "e AS (SELECT a.x, a.y, min(CASE WHEN b.conf < 1 THEN 1 ELSE 0 END) AS v FROM grid a JOIN grid b ON b.x BETWEEN a.x - 5 AND a.x + 5 AND b.y BETWEEN a.y - 5 AND a.y + 5 GROUP BY 1, 2)")
def border_mask(t: Tables) -> DataFrame:
    low = t.grid.select("x", "y", (F.col("conf") < 1).cast("int").alias("v"))
    return patches.morphology(patches.morphology(low, dilate=False, radius=5), dilate=True, radius=5)


@query("pf19_multitemporal_filter", "SELECT pixel, band, date, round(near * avg(value / near) OVER (PARTITION BY pixel, band), 6) AS value FROM l WHERE near <> 0",
       "l AS (SELECT a.pixel, a.band, a.date, any_value(a.value) AS value, avg(b.value) AS near FROM obs a JOIN obs b ON b.pixel BETWEEN a.pixel - 1 AND a.pixel + 1 AND a.band = b.band AND a.date = b.date GROUP BY 1, 2, 3)")
def multitemporal(t: Tables) -> DataFrame:
    return op.multitemporal(t.obs.select("pixel", "band", "date", "value")).withColumn("value", F.round("value", 6))


@query("fx10_edge_statistics", """SELECT label, round(avg(g), 6) AS mean, round(stddev_pop(g), 6) AS std FROM (
  SELECT a.x, a.y, a.label, sum(abs(a.conf - b.conf)) AS g FROM grid a JOIN grid b ON b.x BETWEEN a.x - 1 AND a.x + 1 AND b.y BETWEEN a.y - 1 AND a.y + 1 AND abs(a.x - b.x) + abs(a.y - b.y) = 1 GROUP BY 1, 2, 3) GROUP BY 1""")
def edge_statistics(t: Tables) -> DataFrame:
    edges = patches.neighbours(t.grid.select("x", "y", "label", "conf")).groupBy("x", "y", "label").agg(F.sum(F.abs(F.col("conf") - F.col("n_conf"))).alias("g"))
    return edges.groupBy("label").agg(F.round(F.avg("g"), 6).alias("mean"), F.round(F.stddev_pop("g"), 6).alias("std"))


@query("fx8_features_of_all_sensors", """SELECT pixel, 'optical_' || band || '_' || date_idx AS name, v AS value FROM (SELECT pixel, date_idx, unnest(range(1, 9)) AS band, unnest(bands) AS v FROM stack)
  WHERE pixel IN (SELECT pixel FROM obs) UNION ALL SELECT pixel, 'events_' || band || '_' || strftime(date, '%Y%m%d'), round(value, 6) FROM obs WHERE pixel IN (SELECT vec_id FROM embeddings)""")
def features_of_all_sensors(t: Tables) -> DataFrame:
    """One array of named values per pixel that both sensors see, and its entries as rows."""
    entry = lambda name, value: F.struct(name.alias("name"), value.cast("double").alias("value"))
    optical = t.stack.select("pixel", "date_idx", F.posexplode("bands").alias("band", "v"))
    optical = optical.select("pixel", entry(F.concat_ws("_", F.lit("optical"), F.col("band") + 1, "date_idx"), F.col("v")).alias("e")).groupBy("pixel").agg(F.collect_list("e").alias("a"))
    events = t.obs.select("pixel", entry(F.concat_ws("_", F.lit("events"), "band", F.date_format("date", "yyyyMMdd")), F.round("value", 6)).alias("e")).groupBy("pixel").agg(F.collect_list("e").alias("b"))
    return optical.join(events, "pixel").select("pixel", F.inline(F.concat("a", "b")))


UNIFORM = "(((vec_id * 64 + k) * 2654435761 + {} * 40503) % 4294967296 + 1) / 4294967297.0"


@query("au3_jitter", f"""SELECT vec_id, CAST(k AS INTEGER) AS k, round(v + sqrt(-2 * ln({UNIFORM.format(1)})) * cos(2 * pi() * {UNIFORM.format(2)}) * std / 10, 6) AS value
  FROM f JOIN (SELECT label, k, stddev_pop(v) AS std FROM f GROUP BY 1, 2) USING (label, k)""",
       "f AS (SELECT vec_id, label, unnest(range(0, 64)) AS k, unnest(embedding::DOUBLE[]) AS v FROM embeddings)")
def jitter(t: Tables) -> DataFrame:
    """New samples of each class: every feature with normal noise of a tenth of its deviation in the class."""
    f = t.embeddings.select("vec_id", "label", F.posexplode(F.col("embedding").cast("array<double>")).alias("k", "v"))
    std = f.groupBy("label", "k").agg(F.stddev_pop("v").alias("std"))  # a row per class and feature
    uniform = lambda seed: (tab.draw_order(F.col("vec_id") * 64 + F.col("k"), seed) + 1) / F.lit(4294967297.0)
    noisy = op.jittered(F.col("v"), F.col("std"), 10, uniform(1), uniform(2))
    return f.join(F.broadcast(std), ["label", "k"]).select("vec_id", "k", F.round(noisy, 6).alias("value"))


@query("rg3_rule_masks", "SELECT x, y, CAST(label // 2 AS INTEGER) AS parent, n > 1 AS sieved FROM grid JOIN (SELECT label // 2 AS parent, count(DISTINCT label) AS n FROM grid GROUP BY 1) p ON p.parent = label // 2")
def rule_masks(t: Tables) -> DataFrame:
    """Cells with their top-level class, which is sieved only if it has more than one class below it."""
    cells = t.grid.select("x", "y", "label", F.floor(F.col("label") / 2).cast("int").alias("parent"))
    rules = cells.select("parent", "label").distinct().groupBy("parent").agg((F.count("*") > 1).alias("sieved"))  # a row per top-level class
    return cells.join(F.broadcast(rules), "parent").select("x", "y", "parent", "sieved")


@query("vt8_prepared_samples", """SELECT min(fid) AS fid, code % 2 AS code, x0, y0, w, h, w * h AS size FROM (
  SELECT fid, code, x0 + 1 AS x0, y0 AS y0, w - 2 AS w, h AS h FROM polygons WHERE w > 2) GROUP BY code % 2, x0, y0, w, h HAVING w * h >= 2""")
def prepared_samples(t: Tables) -> DataFrame:
    """Recoded, shrunk on the left and right, without empty ones, duplicates and those under two cells."""
    shrunk = op.buffered(t.polygons.withColumns({"y0": F.col("y0") - 1, "h": F.col("h") + 2}), -1)
    once = shrunk.groupBy((F.col("code") % 2).alias("code"), "x0", "y0", "w", "h").agg(F.min("fid").alias("fid"))
    return once.withColumn("size", F.col("w") * F.col("h")).where("size >= 2")


@query("sp15_annual_points", """SELECT x, y, label FROM (SELECT x, y, label, row_number() OVER (PARTITION BY label ORDER BY ((y * 150 + x) * 2654435761 + 3 * 40503) % 4294967296, y, x) AS k
  FROM grid WHERE label IN (1, 4) AND conf > 0.5 AND x % 3 <> 0) WHERE k <= 40""")
def annual_points(t: Tables) -> DataFrame:
    """Forty points of each annual class where the earlier map is valid enough and inside the region."""
    able = t.grid.where("label in (1, 4) and conf > 0.5 and x % 3 != 0")
    return tab.first_k(able, ["label"], [tab.draw_order(F.col("y") * 150 + F.col("x"), 3), F.col("y"), F.col("x")], 40).select("x", "y", "label")


@query("sp16_mixed_years", "SELECT x, y, label, 'annual' AS origin FROM blocky WHERE label IN (1, 4) UNION ALL SELECT x, y, label, 'other' FROM grid WHERE label NOT IN (1, 4)")
def mixed_years(t: Tables) -> DataFrame:
    """Annual classes from one year's map, the others from another's."""
    annual = F.col("label").isin(1, 4)
    return t.blocky.where(annual).select("x", "y", "label", F.lit("annual").alias("origin")).unionByName(t.grid.where(~annual).select("x", "y", "label", F.lit("other").alias("origin")))


@query("zs13_statistics_in_one", "SELECT zone, " + ", ".join(f"round(count(*) FILTER (class = {k}) * 100.0 / count(*), 2) AS class_{k}" for k in range(2, 9))
       + ", round(avg(b1), 2) AS b1_mean, round(stddev_pop(b1), 2) AS b1_std, round(max(b1), 2) AS b1_max, round(min(b1), 2) AS b1_min FROM zones GROUP BY 1")
def statistics_in_one(t: Tables) -> DataFrame:
    rates = tab.class_rates(t.zones, "zone", "class").withColumn("rate", F.col("rate") * 100)
    return tab.pivot_shares(rates, "zone", "class", "rate", range(2, 9), "class_").join(tab.zone_statistics(t.zones, "zone", ["b1"]), "zone")


@query("sp7_formatted", f"""SELECT a.fid, zone, code, seed, set FROM (SELECT fid, zone, code FROM polygons JOIN squares ON {IN_SQUARE}) a JOIN split_rows s ON s.fid = a.fid""",
       SQUARES + """, ranked AS (SELECT fid, code, region, seed, count(*) OVER (PARTITION BY code, region, seed) AS n,
  row_number() OVER (PARTITION BY code, region, seed ORDER BY (fid * 2654435761 + seed * 40503) % 4294967296, fid) AS k FROM polygons, (SELECT unnest([0, 1]) AS seed)),
  split_rows AS (SELECT fid, seed, unnest(CASE WHEN n = 1 THEN ['learning', 'validation'] WHEN k <= greatest(1, round_even(n * 0.5, 0)) THEN ['learning'] ELSE ['validation'] END) AS set FROM ranked)""")
def formatted(t: Tables) -> DataFrame:
    """Ground truth cut by tiles, each part with the set that its polygon is drawn for."""
    sets = tab.stratified_split(t.polygons.select("fid", "code", "region"), "fid", ["code", "region"], 0.5, 2).select("fid", "seed", "set")
    parts = tab.rectangle_join(t.polygons.select(*RECT, "code"), squares(t)).select("fid", F.col("o_zone").alias("zone"), "code")
    return parts.join(sets, "fid")
