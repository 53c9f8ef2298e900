"""Queries on whole feature arrays, on masks and points that come from other tables, and on selections of samples."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import assembly as op
from landseries.operators import forest, spans
from landseries.operators.ranks import ranked
from landseries.plans.learning import mixed
from landseries.plans.registry import query
from landseries.plans.spans import COVER
from landseries.sources.views import Tables

OPTICAL = op.Sensor("opt", [f"b{k}" for k in range(1, 9)], 3, 4, 6, user={"sum": lambda b: F.aggregate(b, F.lit(0.0), lambda a, v: a + v)})
RELATIVE = op.Sensor("rel", [f"b{k}" for k in range(1, 9)], 3, 4, 6, reference=4, duplicates=False)

INDEX = "CASE WHEN abs({a} + {b}) < 1e-5 THEN 0 ELSE ({a} - {b}) / ({a} + {b}) END"


def index_sql(a: int, b: int) -> str:
    return INDEX.format(a=f"bands[{a}]", b=f"bands[{b}]")


def assembled_sql(sensor: op.Sensor) -> str:
    ref = sensor.reference
    own = [f"bands[{k}]" if ref in (None, k) else index_sql(k, ref) for k in range(1, 9)]
    rows = [f"SELECT pixel, date_idx * 8 + {k} AS place, {v} AS v FROM stack" for k, v in enumerate(own)]
    each = {"NDVI": f"1000 * ({index_sql(4, 3)})", "NDWI": f"1000 * ({index_sql(6, 4)})", "Brightness": "sqrt(list_sum([v * v for v in bands]))", "sum": "list_sum(bands)"}
    for n, name in enumerate((*sensor.indices(), *sensor.user)):
        rows.append(f"SELECT pixel, 64 + {8 * n} + date_idx AS place, {each[name]} AS v FROM stack")
    return f"SELECT pixel, CAST(place AS INTEGER) AS place, round(v, 4) AS v FROM ({' UNION ALL '.join(rows)})"


def long_form(features: DataFrame) -> DataFrame:
    return features.select("pixel", F.posexplode("features").alias("place", "v")).withColumn("v", F.round("v", 4))


@query("fx7_assembled_features", assembled_sql(OPTICAL))
def assembled(t: Tables) -> DataFrame:
    """Bands, three indices and a user index of all dates, by place."""
    return long_form(op.assembled(t.stack, OPTICAL))


@query("fx4_without_duplicates", assembled_sql(RELATIVE))
def without_duplicates(t: Tables) -> DataFrame:
    """Bands relative to the near infrared, so NDWI would repeat one of them."""
    return long_form(op.assembled(t.stack, RELATIVE))


@query("ml7_all_classes", "SELECT vec_id, c AS class, CASE WHEN c % 2 = 0 THEN round(proba[c // 2 + 1], 9) ELSE 0 END AS p FROM proba, range(20) r(c)")
def all_classes(t: Tables) -> DataFrame:
    """Probabilities of a model that knows the even classes, in the list of all twenty."""
    known = F.map_from_arrays(F.array(*(F.lit(2 * k) for k in range(10))), F.col("proba"))
    every = F.transform(F.sequence(F.lit(0), F.lit(19)), lambda c: F.round(F.coalesce(F.element_at(known, c), F.lit(0.0)), 9))
    return t.proba.select("vec_id", F.posexplode(every).alias("class", "p")).withColumn("class", F.col("class").cast("long"))


MASKED = "masked AS (SELECT g.x, g.y, g.label, g.conf, min(c.region) AS first FROM grid g LEFT JOIN cell c USING (x, y) GROUP BY 1, 2, 3, 4)"


def region_of_cells(t: Tables) -> DataFrame:
    """(x, y, first): the least region one of whose shapes covers a cell of the grid."""
    own = spans.owned(spans.shape_spans(t.shapes, ("fid", "region")).select(F.col("region").alias("key"), "y", "a", "b"), "key")
    return spans.at_points(t.grid.select("x", "y"), own, "key").withColumnRenamed("key", "first")


@query("pf26_masked_by_regions", "SELECT x, y, CASE WHEN first IS NULL THEN 0 ELSE label END AS label, CASE WHEN first IS NULL THEN 0 ELSE conf END AS conf, CASE WHEN first IS NULL THEN 0 ELSE conf END AS p_in, CASE WHEN first IS NULL THEN 0 ELSE round(1 - conf, 9) END AS p_out FROM masked", f"{COVER}, {MASKED}")
def masked_by_regions(t: Tables) -> DataFrame:
    """Label, confidence and probabilities of cells, 0 where no region's shape covers them."""
    both = t.grid.join(region_of_cells(t), ["x", "y"], "left")
    out = F.col("first").isNull()
    zero = lambda c, z: F.when(out, z).otherwise(c)
    return both.select("x", "y", zero(F.col("label"), F.lit(0)).alias("label"), zero(F.col("conf"), F.lit(0.0)).alias("conf"), zero(F.col("conf"), F.lit(0.0)).alias("p_in"), zero(F.round(1 - F.col("conf"), 9), F.lit(0.0)).alias("p_out"))


@query("fu7_filled_by_covering_region", "SELECT x, y, CAST(CASE WHEN conf >= 0.5 THEN label WHEN first IS NULL THEN 0 ELSE 1 + (label + first) % 5 END AS INTEGER) AS label FROM masked", f"{COVER}, {MASKED}")
def filled_by_region(t: Tables) -> DataFrame:
    """Undecided cells take the label of the model of the first region that covers them; models differ by a shift of classes."""
    both = t.grid.join(region_of_cells(t), ["x", "y"], "left")
    of_model = F.coalesce(1 + (F.col("label") + F.col("first")) % 5, F.lit(0))
    return both.select("x", "y", F.when(F.col("conf") >= 0.5, F.col("label")).otherwise(of_model).cast("int").alias("label"))


PLACED = "placed AS (SELECT c_custkey AS ref, c_custkey * 7 % 150 AS x, c_custkey % 97 AS y, CASE WHEN c_nationkey % 2 = 0 THEN 'learning' ELSE 'validation' END AS set FROM customer)"


@query("zs15_map_at_points", "SELECT set, label, count(*) AS n, round(avg(conf), 6) AS conf, round(avg(views), 6) AS views FROM placed JOIN (SELECT x, y, label, conf, o_custkey % 7 AS views FROM (SELECT o_orderkey % 150 AS x, o_orderkey // 150 AS y, o_custkey FROM orders) JOIN grid USING (x, y)) USING (x, y) GROUP BY 1, 2", PLACED)
def map_at_points(t: Tables) -> DataFrame:
    """Label, validity and confidence of the map at all customers, by set."""
    key = F.col("c_custkey")
    points = t.customer.select((key * 7 % 150).alias("x"), (key % 97).alias("y"), F.when(F.col("c_nationkey") % 2 == 0, "learning").otherwise("validation").alias("set"))
    views = t.orders.select((F.col("o_orderkey") % 150).alias("x"), F.floor(F.col("o_orderkey") / 150).alias("y"), (F.col("o_custkey") % 7).alias("views"))
    found = points.join(t.grid, ["x", "y"]).join(views, ["x", "y"])
    return found.groupBy("set", "label").agg(F.count("*").alias("n"), F.round(F.avg("conf"), 6).alias("conf"), F.round(F.avg("views"), 6).alias("views"))


@query("jn9_shapes_in_both_files", "SELECT c.fid, s_suppkey AS o_fid, x0, y0, w, h FROM polygons c JOIN supplier ON s_suppkey % 97 = x0 AND s_suppkey % 89 = y0 AND 1 + s_suppkey % 5 = w AND 1 + s_suppkey % 3 = h AND 1 + s_nationkey % 5 = code")
def in_both_files(t: Tables) -> DataFrame:
    """Customers and suppliers whose rectangles and codes are the same."""
    key = F.col("s_suppkey")
    other = t.supplier.select(key.alias("o_fid"), (key % 97).alias("x0"), (key % 89).alias("y0"), (1 + key % 5).alias("w"), (1 + key % 3).alias("h"), (1 + F.col("s_nationkey") % 5).cast("int").alias("code"))
    return t.polygons.join(other, ["x0", "y0", "w", "h", "code"]).select("fid", "o_fid", "x0", "y0", "w", "h")


PIXELS = f"pixels AS (SELECT fid, code, region, x, y, count(*) OVER (PARTITION BY code, region) AS n, row_number() OVER (PARTITION BY code, region ORDER BY fid, y, x) AS k, {mixed('fid * 1000003 + y * 1009 + x', '7')} AS h FROM cell)"
WANTED = "CASE region WHEN 1 THEN 40 WHEN 3 THEN n ELSE 100 END"


@query("sp10_jittered_pixels", f"SELECT fid, x, y FROM (SELECT *, greatest(1, n // 50) AS step, (k - 1) // greatest(1, n // 50) AS block FROM pixels) WHERE (k - 1) % step = {mixed('block', 'code * 8 + region')} % step", f"{COVER}, {PIXELS}")
def jittered(t: Tables) -> DataFrame:
    """One pixel in each block of a class and region, at a place that jitters."""
    placed = ranked(pixels(t), ["fid", "y", "x"], ["code", "region"], rank="k", size="n")
    step = F.greatest(F.lit(1), F.floor(F.col("n") / 50))
    block = F.floor((F.col("k") - 1) / step)
    return placed.where((F.col("k") - 1) % step == forest.mixed(block, F.col("code") * 8 + F.col("region")) % step).select("fid", "x", "y")


def pixels(t: Tables) -> DataFrame:
    return spans.cells(spans.shape_spans(t.shapes, ("fid", "code", "region")))


@query("sp11_selected_by_model", f"SELECT fid, x, y FROM (SELECT *, row_number() OVER (PARTITION BY code, region ORDER BY h, fid, y, x) AS drawn FROM pixels) WHERE drawn <= {WANTED}", f"{COVER}, {PIXELS}")
def selected(t: Tables) -> DataFrame:
    """A random choice of pixels of each class by its model's own strategy: 40, all, or 100 by default."""
    own = t.spark.createDataFrame([(1, 40), (3, -1)], "region int, most int")  # -1: all
    h = forest.mixed(F.col("fid") * 1000003 + F.col("y") * 1009 + F.col("x"), F.lit(7))
    drawn = ranked(pixels(t).withColumn("h", h), ["h", "fid", "y", "x"], ["code", "region"], rank="k").join(F.broadcast(own), "region", "left")
    most = F.coalesce("most", F.lit(100))
    return drawn.where((most < 0) | (F.col("k") <= most)).select("fid", "x", "y")
