"""Queries on attribute tables: joins, aggregates, windows, sets, splits, augmentation, zones, checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landseries.operators import tables as op
from landseries.operators.ranks import ranked
from landseries.plans.registry import query
from landseries.sources.views import Tables


@query("sc8_field_values", "SELECT c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 1")
def field_values(t: Tables) -> DataFrame:
    return t.customer.groupBy(F.col("c_mktsegment").alias("value")).agg(F.count("*").alias("n"))


@query("sc12_rows_by_partition", "SELECT region, tile, code, count(*) AS n FROM polygons GROUP BY 1, 2, 3")
def by_partition(t: Tables) -> DataFrame:
    return t.polygons.groupBy("region", "tile", "code").agg(F.count("*").alias("n"))


@query("pf21_fields", "SELECT fid AS ident, code, 'x' AS origin, row_number() OVER (ORDER BY fid) - 1 AS fresh FROM polygons WHERE region = 2")
def fields(t: Tables) -> DataFrame:
    """Keep, rename, add a constant, number the rest anew (the numbering is by a global order)."""
    kept = t.polygons.where("region = 2").select(F.col("fid").alias("ident"), "code", F.lit("x").alias("origin"))
    return ranked(kept, ["ident"], rank="fresh").withColumn("fresh", F.col("fresh") - 1)


@query("pf22_ids_in_list", "SELECT fid, code FROM polygons WHERE fid NOT IN (SELECT s_suppkey FROM supplier)")
def ids_in_list(t: Tables) -> DataFrame:
    return t.polygons.join(t.supplier, F.col("fid") == F.col("s_suppkey"), "left_anti").select("fid", "code")


@query("pf23_by_size", "SELECT fid, floor(area / 100) AS pixels FROM polygons WHERE area / 100 >= 50")
def by_size(t: Tables) -> DataFrame:
    return t.polygons.where(F.col("area") / 100 >= 50).select("fid", F.floor(F.col("area") / 100).cast("double").alias("pixels"))


@query("pf24_classes_of_interest", "SELECT code, count(*) AS n FROM polygons WHERE code IN (1, 3, 5) GROUP BY 1")
def of_interest(t: Tables) -> DataFrame:
    return t.polygons.where(F.col("code").isin(1, 3, 5)).groupBy("code").agg(F.count("*").alias("n"))


@query("jn6_tiles_of_zone", "SELECT DISTINCT tile FROM polygons WHERE x0 < 20 AND x0 + w > 10 AND y0 < 20 AND y0 + h > 10")
def tiles_of_zone(t: Tables) -> DataFrame:
    return t.polygons.where("x0 < 20 and x0 + w > 10 and y0 < 20 and y0 + h > 10").select("tile").distinct()


RECTS = """ra AS (SELECT * FROM polygons WHERE code = 1), rb AS (SELECT * FROM polygons WHERE code = 2),
met AS (SELECT ra.fid, rb.fid AS o_fid, (least(ra.x0 + ra.w, rb.x0 + rb.w) - greatest(ra.x0, rb.x0)) * (least(ra.y0 + ra.h, rb.y0 + rb.h) - greatest(ra.y0, rb.y0)) AS common, ra.w * ra.h AS own
  FROM ra JOIN rb ON ra.x0 < rb.x0 + rb.w AND rb.x0 < ra.x0 + ra.w AND ra.y0 < rb.y0 + rb.h AND rb.y0 < ra.y0 + ra.h)"""


def met(t: Tables) -> DataFrame:
    return op.rectangle_join(t.polygons.where("code = 1"), t.polygons.where("code = 2")).withColumn("common", op.overlap_area())


@query("jn1_intersection", "SELECT fid, o_fid, common FROM met", RECTS)
def intersection(t: Tables) -> DataFrame:
    return met(t).select("fid", "o_fid", "common")


@query("jn4_semi_join", "SELECT fid, code FROM ra WHERE fid IN (SELECT fid FROM met)", RECTS)
def spatial_filter(t: Tables) -> DataFrame:
    return op.rectangle_filter(t.polygons.where("code = 1"), t.polygons.where("code = 2")).select("fid", "code")


@query("jn7_count_in_polygon", "SELECT ra.fid, count(o_fid) AS n FROM ra LEFT JOIN met ON met.fid = ra.fid GROUP BY 1", RECTS)
def count_in(t: Tables) -> DataFrame:
    n = met(t).groupBy("fid").agg(F.count("*").alias("n"))
    return t.polygons.where("code = 1").select("fid").join(n, "fid", "left").select("fid", F.coalesce("n", F.lit(0)).alias("n"))


@query("jn8_area_percent", "SELECT fid, round(sum(common) * 100.0 / min(own), 4) AS percent FROM met GROUP BY 1", RECTS)
def area_percent(t: Tables) -> DataFrame:
    return met(t).groupBy("fid").agg(F.round(F.sum("common") * 100.0 / F.min(F.col("w") * F.col("h")), 4).alias("percent"))


SHAPES = "SELECT DISTINCT x0, y0, w, h FROM polygons WHERE tile {}"


@query("jn9_common_features", SHAPES.format("< 10") + " INTERSECT " + SHAPES.format(">= 10"))
def common_features(t: Tables) -> DataFrame:
    shape = ["x0", "y0", "w", "h"]
    return t.polygons.where("tile < 10").select(*shape).join(t.polygons.where("tile >= 10"), shape, "left_semi").distinct()


@query("jn10_priority_union", "SELECT fid, x0, y0, w, h FROM polygons p WHERE tile < 10 OR NOT EXISTS (SELECT 1 FROM polygons q WHERE q.tile < 10 AND (p.x0, p.y0, p.w, p.h) = (q.x0, q.y0, q.w, q.h))")
def priority_union(t: Tables) -> DataFrame:
    shape = ["x0", "y0", "w", "h"]
    p = t.polygons.select("tile", "fid", *shape)
    return op.priority_union(p.where("tile < 10").drop("tile"), p.where("tile >= 10").drop("tile"), shape)


@query("jn11_attribute_join", "SELECT s_suppkey, a.n AS n_1, b.n AS n_2 FROM supplier LEFT JOIN (SELECT l_suppkey k, count(*) n FROM lineitem GROUP BY 1) a ON a.k = s_suppkey LEFT JOIN (SELECT l_suppkey k, count(*) n FROM lineitem WHERE l_tax > 0.04 GROUP BY 1) b ON b.k = s_suppkey")
def attribute_join(t: Tables) -> DataFrame:
    out = t.supplier.select("s_suppkey")
    for k, part in enumerate((t.lineitem, t.lineitem.where("l_tax > 0.04")), 1):
        out = out.join(part.groupBy(F.col("l_suppkey").alias("s_suppkey")).agg(F.count("*").alias(f"n_{k}")), "s_suppkey", "left")
    return out


@query("jn13_value_at_points", "SELECT fid, label FROM polygons JOIN grid ON x = x0 AND y = y0")
def at_points(t: Tables) -> DataFrame:
    p = t.polygons
    return p.join(t.grid, (F.col("x") == F.col("x0")) & (F.col("y") == F.col("y0"))).select("fid", "label")


@query("jn14_rasterised", "SELECT fid, x0 + i AS x, y0 + j AS y FROM polygons, unnest(range(0, w)) a(i), unnest(range(0, h)) b(j)")
def rasterised(t: Tables) -> DataFrame:
    cells = t.polygons.withColumn("i", F.explode(F.expr("sequence(0L, w - 1)"))).withColumn("j", F.explode(F.expr("sequence(0L, h - 1)")))
    return cells.select("fid", (F.col("x0") + F.col("i")).alias("x"), (F.col("y0") + F.col("j")).alias("y"))


@query("jn16_tiles_without_data", "SELECT n_nationkey AS tile FROM nation WHERE n_nationkey NOT IN (SELECT tile FROM polygons WHERE area > 10900)")
def without_data(t: Tables) -> DataFrame:
    return t.nation.join(t.polygons.where("area > 10900"), F.col("n_nationkey") == F.col("tile"), "left_anti").select(F.col("n_nationkey").alias("tile"))


@query("jn18_pixel_coordinates", "SELECT fid, CAST(floor((x0 * 10.0 + 3) / 7) AS BIGINT) AS col, CAST(floor((1000 - y0 * 10.0) / 7) AS BIGINT) AS line FROM polygons")
def pixel_coordinates(t: Tables) -> DataFrame:
    return t.polygons.select("fid", F.floor((F.col("x0") * 10.0 + 3) / 7).alias("col"), F.floor((1000 - F.col("y0") * 10.0) / 7).alias("line"))


@query("ag1_sample_statistics", "SELECT coalesce(CAST(class AS VARCHAR), 'all') AS class, count(*) AS pixels, count(DISTINCT zone) AS polygons FROM zones GROUP BY GROUPING SETS ((class), ())")
def sample_statistics(t: Tables) -> DataFrame:
    each = t.zones.rollup("class").agg(F.count("*").alias("pixels"), F.count_distinct("zone").alias("polygons"))
    return each.withColumn("class", F.coalesce(F.col("class").cast("string"), F.lit("all")))


@query("ag3_share_by_attribute", "SELECT code, count(*) AS n, round(sum(area), 2) AS area, round(sum(area) * 100 / sum(sum(area)) OVER (), 6) AS percent FROM polygons GROUP BY 1")
def share(t: Tables) -> DataFrame:
    each = t.polygons.groupBy("code").agg(F.count("*").alias("n"), F.sum("area").alias("a"))
    total = F.sum("a").over(Window.partitionBy(F.lit(0)))  # over one row per class
    return each.select("code", "n", F.round("a", 2).alias("area"), F.round(F.col("a") * 100 / total, 6).alias("percent"))


@query("ag4_repartition", "SELECT label, tile, seed, count(*) AS n FROM (SELECT ref AS label, tile, seed FROM pred) GROUP BY ROLLUP (label, tile, seed)")
def repartition(t: Tables) -> DataFrame:
    return t.pred.withColumnRenamed("ref", "label").rollup("label", "tile", "seed").agg(F.count("*").alias("n"))


@query("ag6_region_area", "SELECT region, round(sum(area), 2) AS area, count(DISTINCT tile) AS tiles FROM polygons GROUP BY 1")
def region_area(t: Tables) -> DataFrame:
    return t.polygons.groupBy("region").agg(F.round(F.sum("area"), 2).alias("area"), F.count_distinct("tile").alias("tiles"))


@query("ag7_models", "SELECT region, seed, string_agg(CAST(tile AS VARCHAR), ',' ORDER BY tile) AS tiles FROM (SELECT DISTINCT region, tile FROM polygons), (SELECT unnest([0, 1]) AS seed) GROUP BY 1, 2")
def models(t: Tables) -> DataFrame:
    tiles = t.polygons.groupBy("region").agg(F.array_join(F.array_sort(F.collect_set("tile")).cast("array<string>"), ",").alias("tiles"))
    return tiles.withColumn("seed", F.explode(F.array(F.lit(0), F.lit(1))))


@query("ag9_total_area", "SELECT count(*) AS n, round(sum(area / 100), 2) AS pixels FROM polygons")
def total_area(t: Tables) -> DataFrame:
    return t.polygons.agg(F.count("*").alias("n"), F.round(F.sum(F.col("area") / 100), 2).alias("pixels"))


@query("ag10_expected_samples", "SELECT code, CAST(floor(0.3 * sum(area) / 400) AS BIGINT) AS n FROM polygons GROUP BY 1")
def expected(t: Tables) -> DataFrame:
    return t.polygons.groupBy("code").agg(F.floor(0.3 * F.sum("area") / 400).alias("n"))


@query("ag12_classes_by_model", "SELECT tile AS model, seed, string_agg(CAST(ref AS VARCHAR), ',' ORDER BY ref) AS classes FROM (SELECT DISTINCT tile, seed, ref FROM pred) GROUP BY 1, 2")
def classes_by_model(t: Tables) -> DataFrame:
    return t.pred.groupBy(F.col("tile").alias("model"), "seed").agg(F.array_join(F.array_sort(F.collect_set("ref")).cast("array<string>"), ",").alias("classes"))


@query("ag13_extent", "SELECT tile, min(x0) AS xmin, max(x0 + w) AS xmax, min(y0) AS ymin, max(y0 + h) AS ymax FROM polygons GROUP BY 1")
def extent(t: Tables) -> DataFrame:
    return t.polygons.groupBy("tile").agg(F.min("x0").alias("xmin"), F.max(F.expr("x0 + w")).alias("xmax"), F.min("y0").alias("ymin"), F.max(F.expr("y0 + h")).alias("ymax"))


@query("zs1_class_rates", "SELECT zone, class, count(*) AS n, round(count(*) * 1.0 / sum(count(*)) OVER (PARTITION BY zone), 9) AS rate FROM zones GROUP BY 1, 2")
def class_rates(t: Tables) -> DataFrame:
    return op.class_rates(t.zones, "zone", "class").withColumn("rate", F.round("rate", 9))


MAJORITY = "SELECT zone, class AS majority FROM (SELECT zone, class, row_number() OVER (PARTITION BY zone ORDER BY count(*) DESC, class) AS k FROM zones GROUP BY 1, 2) WHERE k = 1"


@query("zs2_majority", MAJORITY)
def majority(t: Tables) -> DataFrame:
    return op.majority(t.zones, "zone", "class")


STATS = ", ".join(f"round({f}({b}), 2) AS {b}_{n}" for b in ("b1", "b2") for n, f in (("mean", "avg"), ("std", "stddev_pop"), ("max", "max"), ("min", "min")))


@query("zs3_zone_statistics", f"SELECT zone, {STATS} FROM zones GROUP BY 1")
def zone_statistics(t: Tables) -> DataFrame:
    return op.zone_statistics(t.zones, "zone", ["b1", "b2"])


@query("zs4_majority_statistics", f"SELECT zone, {STATS} FROM zones JOIN maj USING (zone) WHERE class = majority GROUP BY 1", f"maj AS ({MAJORITY})")
def majority_statistics(t: Tables) -> DataFrame:
    chosen = t.zones.join(op.majority(t.zones, "zone", "class"), "zone").where("class = majority")
    return op.zone_statistics(chosen, "zone", ["b1", "b2"])


@query("zs5_class_statistics", f"SELECT zone, {STATS} FROM zones WHERE class = 3 GROUP BY 1")
def class_statistics(t: Tables) -> DataFrame:
    return op.zone_statistics(t.zones.where("class = 3"), "zone", ["b1", "b2"])


@query("zs10_product_layout", "SELECT zone, CAST(CAST(avg(b1) AS DECIMAL(6, 2)) AS DOUBLE) AS validity, CAST(CAST(sum(b1) AS DECIMAL(10, 2)) AS DOUBLE) AS area FROM zones GROUP BY 1")
def product_layout(t: Tables) -> DataFrame:
    return t.zones.groupBy("zone").agg(F.avg("b1").cast("decimal(6,2)").cast("double").alias("validity"), F.sum("b1").cast("decimal(10,2)").cast("double").alias("area"))


@query("zs12_pivoted_shares", "SELECT zone, " + ", ".join(f"round(count(*) FILTER (class = {k}) * 100.0 / count(*), 2) AS class_{k}" for k in range(2, 9)) + " FROM zones GROUP BY 1")
def pivoted(t: Tables) -> DataFrame:
    rates = op.class_rates(t.zones, "zone", "class").withColumn("rate", F.col("rate") * 100)
    return op.pivot_shares(rates, "zone", "class", "rate", range(2, 9), "class_")


@query("wn1_numbering", "SELECT fid, row_number() OVER (PARTITION BY region ORDER BY fid) AS id FROM polygons")
def numbering(t: Tables) -> DataFrame:
    return ranked(t.polygons.select("fid", "region"), ["fid"], ["region"], rank="id").select("fid", "id")


@query("wn2_area_folds", "SELECT fid, CAST((row_number() OVER (PARTITION BY code ORDER BY area DESC, fid) - 1) % 5 AS INTEGER) AS fold FROM polygons")
def area_folds(t: Tables) -> DataFrame:
    return op.folds(t.polygons, "fid", ["code"], 5, F.desc("area")).select("fid", "fold")


HASH = "(fid * 2654435761 + {} * 40503) % 4294967296"


@query("wn4_random_k_of_class", f"SELECT fid, code FROM (SELECT fid, code, row_number() OVER (PARTITION BY code ORDER BY {HASH.format(1)}, fid) AS k FROM polygons) WHERE k <= 20")
def random_k(t: Tables) -> DataFrame:
    return op.first_k(t.polygons.select("fid", "code"), ["code"], [op.draw_order(F.col("fid"), 1), F.col("fid")], 20).drop("rank")


@query("wn5_tile_priority", "SELECT tile, row_number() OVER (ORDER BY ymax DESC, xmin, tile) AS priority FROM (SELECT tile, max(y0 + h) AS ymax, min(x0) AS xmin FROM polygons GROUP BY 1)")
def tile_priority(t: Tables) -> DataFrame:
    e = t.polygons.groupBy("tile").agg(F.max(F.expr("y0 + h")).alias("ymax"), F.min("x0").alias("xmin"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("ymax"), "xmin", "tile")  # one row per tile
    return e.select("tile", F.row_number().over(order).cast("long").alias("priority"))


@query("wn6_biggest_part", "SELECT region, code, fid FROM (SELECT region, code, fid, row_number() OVER (PARTITION BY region, code ORDER BY area DESC, fid) AS k FROM polygons) WHERE k = 1")
def biggest(t: Tables) -> DataFrame:
    return op.first_k(t.polygons.select("region", "code", "fid", "area"), ["region", "code"], [F.desc("area"), F.col("fid")], 1).select("region", "code", "fid")


@query("wn7_draw_to_area", f"SELECT fid, code FROM (SELECT fid, code, sum(area) OVER (PARTITION BY code ORDER BY {HASH.format(0)}, fid ROWS UNBOUNDED PRECEDING) - area AS before FROM polygons) WHERE before < 50000")
def draw_to_area(t: Tables) -> DataFrame:
    drawn = ranked(t.polygons, [op.draw_order(F.col("fid")), "fid"], ["code"], sums={"area": "before"})
    return drawn.where("before < 50000").select("fid", "code")


@query("st1_append", "SELECT fid, code FROM polygons WHERE tile = 1 UNION ALL SELECT fid, code FROM polygons WHERE tile IN (1, 2)")
def append(t: Tables) -> DataFrame:
    p = t.polygons.select("tile", "fid", "code")
    return p.where("tile = 1").unionByName(p.where("tile in (1, 2)"), allowMissingColumns=True).drop("tile")


@query("st3_distinct_shapes", "SELECT min(fid) AS fid, x0, y0, w, h FROM polygons GROUP BY x0, y0, w, h")
def distinct_shapes(t: Tables) -> DataFrame:
    return t.polygons.groupBy("x0", "y0", "w", "h").agg(F.min("fid").alias("fid"))


@query("st5_difference", "SELECT pixel FROM (SELECT DISTINCT pixel FROM obs) WHERE pixel NOT IN (SELECT pixel FROM obs WHERE mask = 1 AND band = 'view')")
def difference(t: Tables) -> DataFrame:
    return t.obs.select("pixel").distinct().join(t.obs.where("mask = 1 and band = 'view'"), "pixel", "left_anti")


@query("st6_intersection", " INTERSECT ".join(f"SELECT pixel, date FROM obs WHERE band = '{b}' AND mask = 0" for b in ("view", "click")))
def set_intersection(t: Tables) -> DataFrame:
    valid = t.obs.where("mask = 0")
    return valid.where("band = 'view'").select("pixel", "date").intersect(valid.where("band = 'click'").select("pixel", "date"))


SPLIT = """n_of AS (SELECT fid, code, region, seed, count(*) OVER (PARTITION BY code, region, seed) AS n,
  row_number() OVER (PARTITION BY code, region, seed ORDER BY (fid * 2654435761 + seed * 40503) % 4294967296, fid) AS k FROM polygons, (SELECT unnest([0, 1, 2]) AS seed)),
split_rows AS (SELECT fid, seed, CASE WHEN k <= greatest(1, round_even(n * 0.3, 0)) THEN 'learning' ELSE 'validation' END AS set FROM n_of
  UNION ALL SELECT fid, seed, 'validation' FROM n_of WHERE n = 1)"""


@query("sp1_stratified_split", "SELECT fid, set FROM split_rows WHERE seed = 0", SPLIT)
def split(t: Tables) -> DataFrame:
    return op.stratified_split(t.polygons, "fid", ["code", "region"], 0.3).select("fid", "set")


@query("sp2_repeated_splits", "SELECT fid, seed, set FROM split_rows", SPLIT)
def splits(t: Tables) -> DataFrame:
    return op.stratified_split(t.polygons, "fid", ["code", "region"], 0.3, 3).select("fid", "seed", "set")


@query("sp4_cross_validation", "SELECT fid, seed, CASE WHEN fold = seed THEN 'learn' WHEN fold = 4 THEN 'validation' ELSE 'unused' END AS set FROM (SELECT fid, CAST((row_number() OVER (PARTITION BY code, region ORDER BY area DESC, fid) - 1) % 5 AS INTEGER) AS fold FROM polygons), (SELECT unnest([0, 1, 2, 3]) AS seed)")
def cross_validation(t: Tables) -> DataFrame:
    f = op.folds(t.polygons, "fid", ["code", "region"], 5, F.desc("area")).withColumn("seed", F.explode(F.sequence(F.lit(0), F.lit(3))))
    return f.select("fid", "seed", F.when(F.col("fold") == F.col("seed"), "learn").when(F.col("fold") == 4, "validation").otherwise("unused").alias("set"))


@query("sp6_hold_out", "SELECT fid, code FROM polygons WHERE fid NOT IN (SELECT fid FROM split_rows WHERE seed = 0 AND set = 'learning')", SPLIT)
def hold_out(t: Tables) -> DataFrame:
    held = op.stratified_split(t.polygons, "fid", ["code", "region"], 0.3).where("set = 'learning'")
    return t.polygons.join(held, "fid", "left_anti").select("fid", "code")


@query("sp8_region_folds", "SELECT region, CAST(ceil(sum(area) / 2e5) AS BIGINT) AS folds FROM polygons GROUP BY 1 HAVING ceil(sum(area) / 2e5) > 1")
def region_folds(t: Tables) -> DataFrame:
    return t.polygons.groupBy("region").agg(F.ceil(F.sum("area") / 2e5).alias("folds")).where("folds > 1")


@query("sp9_split_models", f"SELECT fid, region || 'f' || ntile(3) OVER (PARTITION BY region, code ORDER BY {HASH.format(0)}, fid) AS model FROM polygons")
def split_models(t: Tables) -> DataFrame:
    placed = ranked(t.polygons, [op.draw_order(F.col("fid")), "fid"], ["region", "code"], size="n")
    least, more = F.floor(F.col("n") / 3), F.col("n") % 3  # the first folds have one row more
    wide = more * (least + 1)
    fold = F.when(F.col("rank") <= wide, F.ceil(F.col("rank") / (least + 1))).otherwise(more + F.ceil((F.col("rank") - wide) / F.greatest(least, F.lit(1))))
    return placed.select("fid", F.concat_ws("f", "region", fold).alias("model"))


@query("sp10_periodic_selection", "SELECT fid, code FROM (SELECT fid, code, row_number() OVER (PARTITION BY code ORDER BY fid) AS k, count(*) OVER (PARTITION BY code) AS n FROM polygons) WHERE (k - 1) % greatest(1, n // 25) = 0")
def periodic(t: Tables) -> DataFrame:
    placed = ranked(t.polygons, ["fid"], ["code"], rank="k", size="n")
    return placed.where((F.col("k") - 1) % F.greatest(F.lit(1), F.floor(F.col("n") / 25)) == 0).select("fid", "code")


@query("sp12_flags", "SELECT fid, CASE WHEN seed = 1 THEN set ELSE 'XXXX' END AS flag, seed FROM split_rows", SPLIT)
def flags(t: Tables) -> DataFrame:
    s = op.stratified_split(t.polygons, "fid", ["code", "region"], 0.3, 3)
    return s.select("fid", "seed", F.when(F.col("seed") == 1, F.col("set")).otherwise("XXXX").alias("flag"))


@query("sp13_percent_of_class", f"SELECT fid, code FROM (SELECT fid, code, row_number() OVER (PARTITION BY code ORDER BY {HASH.format(0)}, fid) AS k, count(*) OVER (PARTITION BY code) AS n FROM polygons) WHERE k <= floor(n * 0.1)")
def percent(t: Tables) -> DataFrame:
    placed = ranked(t.polygons, [op.draw_order(F.col("fid")), "fid"], ["code"], rank="k", size="n")
    return placed.where(F.col("k") <= F.floor(F.col("n") * 0.1)).select("fid", "code")


def counts(t: Tables) -> DataFrame:
    return t.embeddings.groupBy(F.col("label").alias("class")).agg(F.count("*").alias("n"))


@query("au1_balance", "SELECT label AS class, max(count(*)) OVER () - count(*) AS add FROM embeddings GROUP BY 1 QUALIFY add > 0")
def balance(t: Tables) -> DataFrame:
    return op.to_add(counts(t), "balance")


@query("au1_minimum", "SELECT label AS class, 60 - count(*) AS add FROM embeddings GROUP BY 1 HAVING count(*) < 60")
def minimum(t: Tables) -> DataFrame:
    return op.to_add(counts(t), "minimum", 60).withColumn("add", F.col("add").cast("long"))


@query("au2_replicate", """SELECT vec_id, class, unnest(range(1, times + 1)) AS copy FROM (SELECT vec_id, s.class, a.add // n + CASE WHEN k < a.add % n THEN 1 ELSE 0 END AS times FROM (
  SELECT vec_id, label AS class, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS k FROM embeddings) s
  JOIN (SELECT label AS class, 60 - count(*) AS add FROM embeddings GROUP BY 1 HAVING count(*) < 60) a ON a.class = s.class)""")
def replicate(t: Tables) -> DataFrame:
    samples = t.embeddings.select("vec_id", F.col("label").alias("class"))
    return op.replicate(samples, op.to_add(counts(t), "minimum", 60), "vec_id")


@query("au6_copy_by_rules", """WITH s AS (SELECT vec_id, label AS class, vec_id % 3 AS model, '' AS path FROM embeddings),
  a AS (FROM s UNION ALL SELECT vec_id, class, 1, path || '/1' FROM s WHERE model = 0 AND class = 2),
  b AS (FROM a UNION ALL FROM (SELECT vec_id, class, 2, path || '/2' FROM a WHERE model = 1 AND class = 2 ORDER BY vec_id, path LIMIT 5))
  FROM b UNION ALL FROM (SELECT vec_id, class, 2, path || '/3' FROM b WHERE model = 0 AND class = 4 ORDER BY vec_id, path LIMIT 7)""")
def copy_by_rules(t: Tables) -> DataFrame:
    samples = t.embeddings.select("vec_id", F.col("label").alias("class"), (F.col("vec_id") % 3).alias("model"))
    return op.copy_by_rules(samples, [(0, 1, 2, -1), (1, 2, 2, 5), (0, 2, 4, 7)], "vec_id")


@query("vt1_area_perimeter", "SELECT fid, w * h AS area, 2 * (w + h) AS perimeter FROM polygons")
def area_perimeter(t: Tables) -> DataFrame:
    """Shoelace sums over the rings of the rectangles."""
    p = t.polygons
    corner = lambda dx, dy: F.struct((F.col("x0") + dx).alias("x"), (F.col("y0") + dy).alias("y"))
    zero = F.lit(0)
    ring = F.array(corner(zero, zero), corner(F.col("w"), zero), corner(F.col("w"), F.col("h")), corner(zero, F.col("h")), corner(zero, zero))
    edges = F.zip_with(F.slice("ring", 1, 4), F.slice("ring", 2, 4), lambda a, b: F.struct((a.x * b.y - b.x * a.y).alias("cross"), (F.abs(a.x - b.x) + F.abs(a.y - b.y)).alias("length")))
    total = lambda name: F.aggregate("edges", F.lit(0).cast("long"), lambda s, e: s + e[name])
    return p.withColumn("ring", ring).withColumn("edges", edges).select("fid", F.floor(F.abs(total("cross")) / 2).alias("area"), total("length").alias("perimeter"))


@query("vt7_recode", "SELECT fid, CASE code WHEN 1 THEN 10 WHEN 2 THEN 10 WHEN 3 THEN 20 END AS code FROM polygons WHERE code IN (1, 2, 3)")
def recode(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([(1, 10), (2, 10), (3, 20)], "code int, new int")
    return t.polygons.join(F.broadcast(rules), "code").select("fid", F.col("new").alias("code"))


@query("ck1_ground_truth_check", "SELECT count(*) FILTER (code IS NULL) AS no_code, count(*) FILTER (w <= 0 OR h <= 0) AS empty, count(*) - count(DISTINCT (x0, y0, w, h)) AS duplicates, count(*) FILTER (area < 10) AS small FROM polygons")
def ground_truth_check(t: Tables) -> DataFrame:
    """All violations in one pass; duplicates are counted after grouping by shape."""
    shapes = t.polygons.groupBy("x0", "y0", "w", "h").agg(
        F.count_if(F.col("code").isNull()).alias("no_code"), F.count("*").alias("n"), F.count_if(F.col("area") < 10).alias("small")
    )
    empty = F.sum(F.when((F.col("w") <= 0) | (F.col("h") <= 0), F.col("n")).otherwise(0))
    return shapes.agg(F.sum("no_code").alias("no_code"), empty.alias("empty"), F.sum(F.col("n") - 1).alias("duplicates"), F.sum("small").alias("small"))


@query("ck5_tables_differ", "SELECT fid, code FROM (SELECT fid, code FROM polygons WHERE tile <> 3 EXCEPT ALL SELECT fid, code FROM polygons WHERE tile <> 4)")
def differ(t: Tables) -> DataFrame:
    p = t.polygons.select("tile", "fid", "code")
    return p.where("tile != 3").drop("tile").exceptAll(p.where("tile != 4").drop("tile"))


@query("ck6_grids_differ", "SELECT round(avg(abs(g.label - b.label)), 6) AS mean, max(abs(g.label - b.label)) AS top FROM grid g JOIN blocky b USING (x, y)")
def grids_differ(t: Tables) -> DataFrame:
    g, b = t.grid.select("x", "y", F.col("label").alias("p")), t.blocky.select("x", "y", F.col("label").alias("q"))
    d = F.abs(F.col("p") - F.col("q"))
    return g.join(b, ["x", "y"], "full").agg(F.round(F.avg(d), 6).alias("mean"), F.max(d).alias("top"))
