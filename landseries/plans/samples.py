"""Queries on sample sets, feature names, fused vectors and zone joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import accuracy, fusion
from landseries.operators import samples as op
from landseries.operators import tables as tab
from landseries.plans.classes import CM, GLOBAL
from landseries.plans.registry import query
from landseries.sources.views import Tables


@query("ag2_merged_statistics", "SELECT code, region, count(*) AS polygons, CAST(sum(w * h) AS BIGINT) AS pixels FROM polygons GROUP BY 1, 2")
def merged_statistics(t: Tables) -> DataFrame:
    by_tile = t.polygons.groupBy("tile", "code", "region").agg(F.count("*").alias("polygons"), F.sum(F.col("w") * F.col("h")).alias("pixels"))
    return op.summed(by_tile, ["code", "region"], ["polygons", "pixels"])


@query("ag5_class_count", "SELECT seed, count(*) AS n FROM pred WHERE ref = 3 GROUP BY 1")
def class_count(t: Tables) -> DataFrame:
    return t.pred.where("ref = 3").groupBy("seed").agg(F.count("*").alias("n"))


@query("ag8_grouped_pairs", "SELECT region, list_aggregate(list_sort(list(DISTINCT tile)), 'string_agg', ',') AS tiles FROM polygons GROUP BY 1")
def grouped_pairs(t: Tables) -> DataFrame:
    return t.polygons.groupBy("region").agg(F.array_join(F.array_sort(F.collect_set("tile")), ",").alias("tiles"))


@query("ag14_sample_groups", "SELECT seed, ref % 3 AS region, band = 'view' AS sar, count(*) AS n FROM pred JOIN (SELECT DISTINCT pixel, band FROM obs) o ON o.pixel = vec_id GROUP BY ALL")
def sample_groups(t: Tables) -> DataFrame:
    bands = t.obs.select(F.col("pixel").alias("vec_id"), "band").distinct()
    return t.pred.join(bands, "vec_id").groupBy("seed", (F.col("ref") % 3).alias("region"), (F.col("band") == "view").alias("sar")).agg(F.count("*").alias("n"))


@query("ag15_model_folds", "SELECT model, max(fold) AS folds FROM (SELECT region AS model, tile % 4 + 1 AS fold FROM polygons) GROUP BY 1")
def model_folds(t: Tables) -> DataFrame:
    """Names of split models are <model>f<fold>; the number of folds of each model is read from them."""
    names = t.polygons.select(F.concat(F.col("region"), F.lit("f"), F.col("tile") % 4 + 1).alias("name")).distinct()
    part = F.split("name", "f")
    return names.groupBy(part[0].cast("long").alias("model")).agg(F.max(part[1].cast("long")).alias("folds"))


@query("fu5_fused_vector", """SELECT a.vec_id, class, round(CASE WHEN fused = p AND fused = q THEN CASE WHEN list_max(x) > list_max(y) THEN x[class + 1] WHEN list_max(y) > list_max(x) THEN y[class + 1] ELSE 0 END
  WHEN fused = p THEN x[class + 1] WHEN fused = q THEN y[class + 1] ELSE 0 END, 9) AS p FROM two_maps a, (SELECT CAST(unnest(range(0, 10)) AS INTEGER) AS class)""",
       """two_maps AS (SELECT b.vec_id, p, q, CASE WHEN b.vec_id % 5 = 0 THEN -1 ELSE p END AS fused, proba AS x, list_reverse(proba) AS y FROM (
         SELECT vec_id, min(prod) FILTER (seed = 0) AS p, min(prod) FILTER (seed = 1) AS q FROM pred GROUP BY 1) b JOIN proba ON proba.vec_id = b.vec_id)""")
def fused_vector(t: Tables) -> DataFrame:
    maps = t.pred.groupBy("vec_id").agg(F.min(F.when(F.col("seed") == 0, F.col("prod"))).alias("p"), F.min(F.when(F.col("seed") == 1, F.col("prod"))).alias("q"))
    fused = F.when(F.col("vec_id") % 5 == 0, -1).otherwise(F.col("p"))
    vector = op.fused_vector(fused, F.col("p"), F.col("q"), F.col("proba"), F.reverse("proba"))
    return maps.join(t.proba, "vec_id").select("vec_id", F.posexplode(vector).alias("class", "v")).select("vec_id", "class", F.round("v", 9).alias("p"))


VOTE = """v AS (SELECT vec_id, CASE WHEN count(*) FILTER (k = 1) = 1 THEN min(prod) FILTER (k = 1) ELSE 0 END AS label FROM (
  SELECT vec_id, prod, rank() OVER (PARTITION BY vec_id ORDER BY count(*) DESC) AS k FROM pred WHERE prod <> 0 GROUP BY 1, 2) RIGHT JOIN (SELECT DISTINCT vec_id FROM pred) USING (vec_id) GROUP BY 1)"""


def voted(t: Tables) -> DataFrame:
    return fusion.majority_vote(t.pred.select("vec_id", F.col("prod").alias("label")), ["vec_id"])


@query("fu8_scores_of_fused_runs", "SELECT label, round(hit / nullif(p, 0), 9) AS precision, round(hit / nullif(r, 0), 9) AS recall FROM (SELECT l.label, count(*) FILTER (ref = l.label) * 1.0 AS r, count(*) FILTER (v.label = l.label) * 1.0 AS p, count(*) FILTER (ref = l.label AND v.label = l.label) * 1.0 AS hit FROM (SELECT DISTINCT vec_id, ref FROM pred) s JOIN v USING (vec_id), (SELECT ref AS label FROM pred UNION SELECT label FROM v) l GROUP BY 1)", VOTE)
def scores_of_fused(t: Tables) -> DataFrame:
    pairs = t.pred.select("vec_id", "ref").distinct().join(voted(t).withColumnRenamed("label", "prod"), "vec_id")
    return accuracy.class_scores(accuracy.confusion(pairs)).select("label", F.round("precision", 9).alias("precision"), F.round("recall", 9).alias("recall"))


@query("fu12_global_confidence", "SELECT vec_id, tile, CAST(floor(sum(CASE WHEN seed = 0 THEN 100 * conf ELSE 0 END + CASE WHEN seed = 1 AND vec_id % 2 = 0 THEN floor(conf * 100) ELSE 0 END) + 1e-9) AS BIGINT) AS conf FROM pred GROUP BY 1, 2")
def global_confidence(t: Tables) -> DataFrame:
    """Split models give whole per cents already, unsplit ones shares; regions don't overlap, so maps are added."""
    whole, split = F.col("seed") == 0, (F.col("seed") == 1) & (F.col("vec_id") % 2 == 0)
    part = F.when(whole, 100 * F.col("conf")).otherwise(0.0) + F.when(split, F.floor(F.col("conf") * 100)).otherwise(0)
    return t.pred.groupBy("vec_id", "tile").agg(F.floor(F.sum(part) + 1e-9).alias("conf"))


@query("fu9_mean_probabilities", "SELECT vec_id, CAST((i + s) % 10 AS INTEGER) AS class, round(avg(proba[CAST(i + 1 AS INTEGER)]), 9) AS p FROM proba, (SELECT unnest(range(0, 10)) AS i), (SELECT unnest([0, 1, 2]) AS s) GROUP BY 1, 2")
def mean_probabilities(t: Tables) -> DataFrame:
    """Mean over three models of each pixel's vector; model s numbers its classes from s on."""
    long = t.proba.select("vec_id", F.posexplode("proba").alias("i", "p")).withColumn("s", F.explode(F.array(*map(F.lit, range(3)))))
    return long.groupBy("vec_id", ((F.col("i") + F.col("s")) % 10).alias("class")).agg(F.round(F.avg("p"), 9).alias("p"))


@query("fu11_confidence_of_vote", "SELECT vec_id, CAST(floor(avg(CASE WHEN prod = 0 THEN 0 WHEN prod = label THEN conf ELSE 1 - conf END) * 100 + 1e-9) AS INTEGER) AS conf FROM pred JOIN v USING (vec_id) GROUP BY 1", VOTE)
def vote_confidence(t: Tables) -> DataFrame:
    part = F.when(F.col("prod") == 0, 0.0).when(F.col("prod") == F.col("label"), F.col("conf")).otherwise(1 - F.col("conf"))
    return t.pred.join(voted(t), "vec_id").groupBy("vec_id").agg(F.floor(F.avg(part) * 100 + 1e-9).cast("int").alias("conf"))


@query("ms1_region_sum", "SELECT x, y, label FROM grid")
def region_sum(t: Tables) -> DataFrame:
    """Each region's map has labels inside its mask and 0 elsewhere; masks are disjoint, so a tile's map is their sum."""
    maps = t.grid.withColumn("region", F.explode(F.array(*map(F.lit, range(3)))))
    own = maps.select("x", "y", F.when(F.pmod(F.col("x") + F.col("y"), F.lit(3)) == F.col("region"), F.col("label")).otherwise(0).alias("label"))
    return op.summed(own, ["x", "y"], ["label"])


@query("va9_report", f"""SELECT g.seed, round(kappa, 9) AS kappa, round(accuracy, 9) AS accuracy, s.label, round(hit / p, 9) AS precision, round(hit / r, 9) AS recall, round(2 * hit / (p + r), 9) AS fscore, c.prods AS confused
  FROM gs g JOIN (SELECT seed, label, sum(n) FILTER (ref = label) AS r, sum(n) FILTER (prod = label) AS p, sum(n) FILTER (ref = label AND prod = label) AS hit FROM cm, (SELECT DISTINCT ref AS label FROM cm) GROUP BY 1, 2) s USING (seed)
  LEFT JOIN (SELECT seed, ref AS label, string_agg(prod, ',' ORDER BY k) AS prods FROM (SELECT *, row_number() OVER (PARTITION BY seed, ref ORDER BY n DESC, prod DESC) AS k FROM cm) WHERE k <= 3 GROUP BY 1, 2) c ON c.seed = g.seed AND c.label = s.label""", f"{CM}, {GLOBAL}")
def report(t: Tables) -> DataFrame:
    """A row for each run and class: global and class coefficients and the three commonest labels given."""
    m = accuracy.confusion(t.pred, ["seed"])
    whole, own = accuracy.global_scores(m, ["seed"]), accuracy.class_scores(m, ["seed"])
    top = accuracy.most_confused(m, 3, ["seed"]).groupBy("seed", F.col("ref").alias("label")).agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "prod"))), lambda s: s["prod"]), ",").alias("confused"))
    joined = own.join(F.broadcast(whole), "seed").join(top, ["seed", "label"], "left")  # one row per run, one per run and class
    return joined.select("seed", *(F.round(c, 9).alias(c) for c in ("kappa", "accuracy")), "label", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "fscore")), "confused")


@query("ck5_difference", """SELECT side, fid FROM (SELECT 'first' AS side, fid FROM a WHERE (fid, x0, y0, code) NOT IN (SELECT (fid, x0, y0, code) FROM b) UNION ALL SELECT 'second', fid FROM b WHERE (fid, x0, y0, code) NOT IN (SELECT (fid, x0, y0, code) FROM a))""",
       "a AS (SELECT fid, x0, y0, code FROM polygons WHERE fid % 3 <> 0), b AS (SELECT fid, CASE WHEN fid % 11 = 0 THEN x0 + 1 ELSE x0 END AS x0, y0, code FROM polygons WHERE fid % 4 <> 0)")
def difference(t: Tables) -> DataFrame:
    keys = ["fid", "x0", "y0", "code"]
    a = t.polygons.where("fid % 3 != 0").select(*keys)
    b = t.polygons.where("fid % 4 != 0").withColumn("x0", F.when(F.col("fid") % 11 == 0, F.col("x0") + 1).otherwise(F.col("x0"))).select(*keys)
    one = lambda x, y, side: x.join(y, keys, "left_anti").select(F.lit(side).alias("side"), "fid")
    return one(a, b, "first").unionByName(one(b, a, "second"))


@query("pf6_masks_intersection", "SELECT o_orderkey AS pixel, CASE WHEN o_custkey % 2 = 1 AND o_custkey % 3 = 0 OR o_custkey % 7 % 2 = 1 OR o_custkey % 5 % 2 = 0 THEN 1 ELSE 0 END AS mask FROM orders")
def masks_intersection(t: Tables) -> DataFrame:
    c = F.col("o_custkey")
    edge = F.when((c % 2 == 1) & (c % 3 == 0), 1).otherwise(0)
    return t.orders.select(F.col("o_orderkey").alias("pixel"), op.intersected(edge, c % 7, c % 5).alias("mask"))


@query("pf14_sar_index", "SELECT pixel, 'sentinel1_asc_userfeature1_' || strftime(date, '%Y%m%d') AS name, round((vv - vh) / (vv + vh), 6) AS value FROM (SELECT pixel, date, max(value) FILTER (band = 'view') AS vv, max(value) FILTER (band = 'click') AS vh FROM obs GROUP BY 1, 2) WHERE vv + vh <> 0")
def sar_index(t: Tables) -> DataFrame:
    wide = t.obs.groupBy("pixel", "date").pivot("band", ["view", "click"]).agg(F.max("value"))
    total = F.col("view") + F.col("click")
    return wide.where(total != 0).select("pixel", F.concat(F.lit("sentinel1_asc_userfeature1_"), F.date_format("date", "yyyyMMdd")).alias("name"), F.round((F.col("view") - F.col("click")) / total, 6).alias("value"))


@query("pf25_polygons_of_set", "SELECT fid FROM polygons WHERE region = 2 AND fid % 2 = 1")
def polygons_of_set(t: Tables) -> DataFrame:
    sets = t.polygons.select("fid", F.when(F.col("fid") % 2 == 1, "learning").otherwise("validation").alias("set"))
    return t.polygons.where("region = 2").join(sets.where("set = 'learning'"), "fid").select("fid")


@query("pf27_region_ids", "SELECT DISTINCT o_orderkey % 1000 AS id FROM orders WHERE o_custkey % 300 > 1 AND o_custkey % 300 < 250")
def region_ids(t: Tables) -> DataFrame:
    label = F.col("o_custkey") % 300
    return t.orders.where((label > 1) & (label < 250)).select((F.col("o_orderkey") % 1000).alias("id")).distinct()


@query("ts7_input_dates", "SELECT pixel, band, date, round(value, 6) AS value FROM obs WHERE mask = 0")
def input_dates(t: Tables) -> DataFrame:
    return t.obs.where("mask = 0").select("pixel", "band", "date", F.round("value", 6).alias("value"))


@query("fx6_feature_names", "SELECT row_number() OVER (ORDER BY date, band) AS place, 'sensor_' || band || '_' || strftime(date, '%Y%m%d') AS name FROM (SELECT DISTINCT band, date FROM obs)")
def feature_names(t: Tables) -> DataFrame:
    """Names in the order of dates, then bands; there is one for each band and date, however many pixels."""
    name = F.concat(F.lit("sensor_"), "band", F.lit("_"), F.date_format("date", "yyyyMMdd"))
    names = t.obs.select("date", "band", name.alias("name")).distinct().agg(F.array_sort(F.collect_list(F.struct("date", "band", "name"))).alias("all"))
    return names.select(F.posexplode("all").alias("place", "e")).select((F.col("place") + 1).alias("place"), "e.name")


@query("jn12_zones_with_shares", "SELECT s_suppkey AS zone, s_nationkey AS nation, " + ", ".join(f"coalesce(count(class) FILTER (class = {k}), 0) AS c{k}" for k in range(2, 9)) + " FROM supplier LEFT JOIN zones ON zone = s_suppkey GROUP BY 1, 2")
def zones_with_shares(t: Tables) -> DataFrame:
    wide = t.zones.groupBy("zone").pivot("class", list(range(2, 9))).count()
    zones = t.supplier.select(F.col("s_suppkey").alias("zone"), F.col("s_nationkey").alias("nation"))
    return zones.join(wide, "zone", "left").select("zone", "nation", *(F.coalesce(F.col(str(k)), F.lit(0)).alias(f"c{k}") for k in range(2, 9)))


@query("zs6_value_at_points", "SELECT fid, label FROM polygons JOIN grid ON x0 = x AND y0 = y")
def value_at_points(t: Tables) -> DataFrame:
    points = t.polygons.select("fid", F.col("x0").alias("x"), F.col("y0").alias("y"))
    return points.join(t.grid, ["x", "y"]).select("fid", "label")


@query("zs7_buffered_points", "SELECT fid, count(*) AS n, CAST(sum(label) AS BIGINT) AS total FROM polygons JOIN grid ON (x - x0) * (x - x0) + (y - y0) * (y - y0) <= 9 GROUP BY 1")
def buffered_points(t: Tables) -> DataFrame:
    points = t.polygons.select(F.col("fid").alias("point"), F.col("x0").alias("px"), F.col("y0").alias("py"))
    return op.near_points(points, t.grid, 3).groupBy(F.col("point").alias("fid")).agg(F.count("*").alias("n"), F.sum("label").alias("total"))


@query("zs9_alias_columns", "SELECT zone, " + ", ".join(f"count(*) FILTER (class = {k}) AS {a}" for k, a in ((2, "crop"), (3, "forest"), (4, "water"))) + " FROM zones GROUP BY 1")
def alias_columns(t: Tables) -> DataFrame:
    alias = t.spark.createDataFrame([(2, "crop"), (3, "forest"), (4, "water")], "class int, name string")
    named = t.zones.join(F.broadcast(alias), "class", "left")  # one row per class
    return named.groupBy("zone").pivot("name", ["crop", "forest", "water"]).count().na.fill(0)


@query("zs14_zone_counts", "SELECT zone, min(class) AS least, max(class) AS most, round(avg(class), 9) AS mean, count(*) AS n FROM zones GROUP BY 1")
def zone_counts(t: Tables) -> DataFrame:
    return t.zones.groupBy("zone").agg(F.min("class").alias("least"), F.max("class").alias("most"), F.round(F.avg("class"), 9).alias("mean"), F.count("*").alias("n"))


@query("st2_merged_selections", "SELECT fid, region AS model FROM polygons WHERE tile = 3 UNION ALL SELECT fid, region + 10 FROM polygons WHERE tile = 3 AND area > 3000")
def merged_selections(t: Tables) -> DataFrame:
    tile = t.polygons.where("tile = 3")
    return tile.select("fid", F.col("region").alias("model")).unionByName(tile.where("area > 3000").select("fid", (F.col("region") + 10).alias("model")))


@query("st4_without_duplicates", "SELECT x0, y0, min(fid) AS fid FROM polygons GROUP BY 1, 2")
def without_duplicates(t: Tables) -> DataFrame:
    return tab.first_k(t.polygons.select("x0", "y0", "fid"), ["x0", "y0"], [F.col("fid")], 1).drop("rank")


@query("sp5_no_split", "SELECT fid, code, 'learning' AS set FROM polygons UNION ALL SELECT fid, code, 'validation' FROM polygons")
def no_split(t: Tables) -> DataFrame:
    return t.polygons.select("fid", "code", F.explode(F.array(F.lit("learning"), F.lit("validation"))).alias("set"))


@query("sp11_strategy_of_model", "SELECT code, region, CASE WHEN region = 1 THEN least(n, 5) WHEN region = 3 THEN n ELSE least(n, 20) END AS samples FROM (SELECT code, region, count(*) AS n FROM polygons GROUP BY 1, 2)")
def strategy_of_model(t: Tables) -> DataFrame:
    """How many samples each class and model gives: the model's own strategy, or the common one."""
    own = t.spark.createDataFrame([(1, 5), (3, -1)], "region int, most int")  # -1: all
    n = t.polygons.groupBy("code", "region").agg(F.count("*").alias("n")).join(F.broadcast(own), "region", "left")
    most = F.coalesce("most", F.lit(20))
    return n.select("code", "region", F.when(most < 0, F.col("n")).otherwise(F.least("n", most)).alias("samples"))


@query("sp14_filled_classes", "SELECT fid, code FROM polygons WHERE region = 0 AND code <> 2 UNION ALL SELECT fid, code FROM polygons WHERE region = 1 AND code NOT IN (SELECT code FROM polygons WHERE region = 0 AND code <> 2)")
def filled_classes(t: Tables) -> DataFrame:
    side = lambda r: t.polygons.where(F.col("region") == r).select("fid", "code")
    return op.filled_classes(side(0).where("code != 2"), side(1), "code")


@query("au1_by_class", "SELECT code AS class, CAST(wanted - n AS BIGINT) AS add FROM (SELECT code, count(*) AS n, 100 * code AS wanted FROM polygons GROUP BY 1) WHERE wanted > n")
def by_class(t: Tables) -> DataFrame:
    counts = t.polygons.groupBy(F.col("code").alias("class")).agg(F.count("*").alias("n"))
    wanted = t.spark.createDataFrame([(k, 100 * k) for k in range(1, 6)], "class int, wanted int")
    return tab.to_add(counts, "by_class", wanted=F.broadcast(wanted))


NAMES = "names AS (SELECT DISTINCT 'sentinel2_' || band || '_' || strftime(date, '%Y%m%d') AS name FROM obs UNION ALL SELECT 'originfid' UNION ALL SELECT 'code')"


def names(t: Tables) -> DataFrame:
    made = t.obs.select(F.concat(F.lit("sentinel2_"), "band", F.lit("_"), F.date_format("date", "yyyyMMdd")).alias("name")).distinct()
    return made.unionByName(t.spark.createDataFrame([("originfid",), ("code",)], "name string"))


@query("dr1_parsed_names", "SELECT name, split_part(name, '_', 1) AS sensor, split_part(name, '_', 2) AS band, split_part(name, '_', 3) AS date FROM names WHERE name LIKE '%\\_%\\_%' ESCAPE '\\'", NAMES)
def parsed(t: Tables) -> DataFrame:
    return op.parsed_names(names(t), "name").where("sensor is not null")


@query("dr2_feature_groups", "SELECT 'band' AS mode, split_part(name, '_', 2) AS grp, count(*) AS n FROM names WHERE contains(name, '_') GROUP BY 2 UNION ALL SELECT 'date', split_part(name, '_', 3), count(*) FROM names WHERE contains(name, '_') GROUP BY 2 UNION ALL SELECT 'global', 'all', count(*) FROM names WHERE contains(name, '_')", NAMES)
def feature_groups(t: Tables) -> DataFrame:
    made = op.parsed_names(names(t), "name").where("sensor is not null")
    keys = F.explode(F.map_from_arrays(F.array(*map(F.lit, ("band", "date", "global"))), F.array("band", "date", F.lit("all")))).alias("mode", "grp")
    return made.select(keys).groupBy("mode", "grp").agg(F.count("*").alias("n"))


@query("dr5_metadata_names", "SELECT name FROM names WHERE NOT contains(name, '_')", NAMES)
def metadata_names(t: Tables) -> DataFrame:
    return op.parsed_names(names(t), "name").where("sensor is null").select("name")


@query("ml4_normalisation_statistics", "SELECT class, round(avg(b1), 6) AS mean, round(stddev_samp(b1), 6) AS std FROM zones GROUP BY 1")
def normalisation_statistics(t: Tables) -> DataFrame:
    return t.zones.groupBy("class").agg(F.round(F.avg("b1"), 6).alias("mean"), F.round(F.stddev_samp("b1"), 6).alias("std"))


@query("vt3_hedge_or_forest", "SELECT fid, CASE WHEN convex >= 0.7 AND (compact < 0.4 OR long > 2.5) THEN 'hedge' WHEN convex >= 0.7 THEN 'other' ELSE 'forest' END AS kind FROM (SELECT fid, (fid % 10) / 10.0 AS convex, 4 * pi() * w * h / ((2 * (w + h)) * (2 * (w + h))) AS compact, greatest(w, h) * 1.0 / least(w, h) AS long FROM polygons)")
def hedge_or_forest(t: Tables) -> DataFrame:
    w, h = F.col("w").cast("double"), F.col("h").cast("double")
    perimeter = 2 * (w + h)
    kind = op.hedge_or_forest((F.col("fid") % 10) / 10.0, 4 * F.pi() * w * h / (perimeter * perimeter), F.greatest(w, h) / F.least(w, h))
    return t.polygons.select("fid", kind.alias("kind"))


@query("ck7_names", "SELECT s_name AS name, regexp_matches(s_name, '^[A-Za-z]') AS ok FROM supplier UNION ALL SELECT CAST(s_suppkey AS VARCHAR), false FROM supplier")
def checked_names(t: Tables) -> DataFrame:
    both = t.supplier.select(F.explode(F.array("s_name", F.col("s_suppkey").cast("string"))).alias("name"))
    return both.select("name", F.col("name").rlike("^[A-Za-z]").alias("ok"))


@query("sc18_user_files", "SELECT c_nationkey AS tile, c_name AS name FROM customer WHERE contains(c_name, '7') OR contains(c_name, '42')")
def user_files(t: Tables) -> DataFrame:
    patterns = t.spark.createDataFrame([("7",), ("42",)], "pattern string")
    files = t.customer.select(F.col("c_nationkey").alias("tile"), F.col("c_name").alias("name"))
    return files.join(F.broadcast(patterns), F.col("name").contains(F.col("pattern")), "left_semi")
