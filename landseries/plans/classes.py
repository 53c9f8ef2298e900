"""Queries on labels: prediction, fusion, mosaics, accuracy, nomenclature."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import accuracy, fusion
from landseries.operators import tables as op
from landseries.plans.registry import query
from landseries.sources.views import Tables

ML5 = "SELECT vec_id, CAST(list_position(proba, list_max(proba)) - 1 AS INTEGER) AS label, round(list_max(proba), 9) AS conf FROM proba"


@query("ml5_label_of_probabilities", ML5)
def label_of(t: Tables) -> DataFrame:
    return t.proba.select("vec_id", fusion.argmax(F.col("proba")).alias("label"), F.round(F.array_max("proba"), 9).alias("conf"))


@query("ml7_reordered_probabilities", "SELECT vec_id, " + ", ".join(f"round({'proba[' + str(k // 2 + 1) + ']' if k % 2 == 0 else '0.0::DOUBLE'}, 9) AS p{k}" for k in range(6)) + " FROM proba")
def reordered(t: Tables) -> DataFrame:
    """Probabilities of the model's classes 0, 2, 4, .. put into the list of all classes, 0 where the model lacks one."""
    known = F.map_from_arrays(F.array(*(F.lit(2 * k) for k in range(10))), F.col("proba"))
    return t.proba.select("vec_id", known.alias("m")).select("vec_id", *(F.round(F.coalesce(F.col("m")[k], F.lit(0.0)), 9).alias(f"p{k}") for k in range(6)))


@query("fu1_majority_vote", """SELECT vec_id, CASE WHEN count(*) FILTER (k = 1) = 1 THEN min(prod) FILTER (k = 1) ELSE 0 END AS label FROM (
  SELECT vec_id, prod, rank() OVER (PARTITION BY vec_id ORDER BY count(*) DESC) AS k FROM pred WHERE prod <> 0 GROUP BY 1, 2) RIGHT JOIN (SELECT DISTINCT vec_id FROM pred) USING (vec_id) GROUP BY 1""")
def vote(t: Tables) -> DataFrame:
    return fusion.majority_vote(t.pred.select("vec_id", F.col("prod").alias("label")), ["vec_id"])


MASS = """mass AS (SELECT seed, prod AS label, count(*) FILTER (ref = prod) * 1.0 / count(*) AS mass FROM pred GROUP BY 1, 2),
belief AS (SELECT vec_id, prod AS label, round(exp(-sum(ln(greatest(1 - mass, 1e-12)))) - 1, 9) AS b FROM pred JOIN mass ON mass.seed = pred.seed AND mass.label = pred.prod GROUP BY 1, 2),
ds AS (SELECT vec_id, CASE WHEN count(*) = 1 THEN min(label) ELSE 0 END AS label FROM (SELECT vec_id, label, rank() OVER (PARTITION BY vec_id ORDER BY b DESC) AS k FROM belief) WHERE k = 1 GROUP BY 1)"""


def shafer(t: Tables) -> DataFrame:
    matrix = accuracy.confusion(t.pred, ["seed"])
    precision = accuracy.class_scores(matrix, ["seed"]).select("seed", F.col("label").alias("prod"), F.col("precision").alias("mass"))
    sources = t.pred.join(F.broadcast(precision), ["seed", "prod"])
    return fusion.dempster_shafer(sources.select("vec_id", F.col("prod").alias("label"), "mass"), ["vec_id"])


@query("fu2_dempster_shafer", "SELECT vec_id, label FROM ds", MASS)
def dempster(t: Tables) -> DataFrame:
    return shafer(t)


TWO = "two AS (SELECT a.vec_id, a.prod AS p, b.prod AS q, a.conf AS cp, b.conf AS cq, ds.label FROM pred a JOIN pred b ON a.vec_id = b.vec_id AND a.seed = 0 AND b.seed = 1 JOIN ds ON ds.vec_id = a.vec_id)"
CHOICE = "CASE WHEN label = p AND label = q THEN 1 WHEN label = p THEN 2 WHEN label = q THEN 3 ELSE 0 END"


def two(t: Tables) -> DataFrame:
    side = lambda s, a, b: t.pred.where(F.col("seed") == s).select("vec_id", F.col("prod").alias(a), F.col("conf").alias(b))
    return side(0, "p", "cp").join(side(1, "q", "cq"), "vec_id").join(shafer(t), "vec_id").withColumn("choice", fusion.fusion_choice(F.col("label"), F.col("p"), F.col("q")))


@query("fu3_fusion_choice", f"SELECT vec_id, {CHOICE} AS choice FROM two", f"{MASS}, {TWO}")
def choice(t: Tables) -> DataFrame:
    return two(t).select("vec_id", "choice")


@query("fu4_fused_confidence", f"SELECT vec_id, CASE {CHOICE} WHEN 1 THEN greatest(cp, cq) WHEN 2 THEN cp WHEN 3 THEN cq ELSE 0 END AS conf FROM two", f"{MASS}, {TWO}")
def confidence(t: Tables) -> DataFrame:
    return two(t).select("vec_id", fusion.fused_confidence(F.col("choice"), F.col("cp"), F.col("cq")).alias("conf"))


@query("fu6_most_confident", """SELECT vec_id, CASE WHEN c[1] > c[2] THEN l[1] ELSE first END AS label FROM (
  SELECT vec_id, list(conf ORDER BY conf DESC) AS c, list(prod ORDER BY conf DESC) AS l, min(prod) FILTER (seed = 0) AS first FROM pred GROUP BY 1)""")
def confident(t: Tables) -> DataFrame:
    return fusion.most_confident(t.pred.select("vec_id", F.col("prod").alias("label"), "conf", F.col("seed").alias("source")), ["vec_id"])


@query("fu7_first_covering_region", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN p0 WHEN vec_id % 2 = 0 THEN p1 ELSE 0 END AS label FROM (SELECT vec_id, min(prod) FILTER (seed = 0) AS p0, min(prod) FILTER (seed = 1) AS p1 FROM pred GROUP BY 1)")
def covering(t: Tables) -> DataFrame:
    wide = t.pred.groupBy("vec_id").pivot("seed", [0, 1]).agg(F.first("prod"))
    return wide.select("vec_id", F.coalesce(F.when(F.col("vec_id") % 3 == 0, F.col("0")), F.when(F.col("vec_id") % 2 == 0, F.col("1")), F.lit(0)).alias("label"))


@query("fu10_votes", "SELECT vec_id, count(*) FILTER (prod <> 0) AS votes FROM pred GROUP BY 1")
def votes(t: Tables) -> DataFrame:
    return t.pred.groupBy("vec_id").agg(F.count_if(F.col("prod") != 0).alias("votes"))


@query("ms2_mosaic", "SELECT x, y, coalesce(arg_max(label, k) FILTER (label <> 0), 0) AS label FROM (SELECT x % 50 AS x, y, CASE WHEN label = 3 THEN 0 ELSE label END AS label, x AS k FROM grid) GROUP BY 1, 2")
def mosaic(t: Tables) -> DataFrame:
    rows = t.grid.select((F.col("x") % 50).alias("x"), "y", F.when(F.col("label") == 3, 0).otherwise(F.col("label")).alias("label"), F.col("x").alias("k"))
    return fusion.mosaic(rows, ["x", "y"], "k")


@query("ms3_tile_priority_cells", "SELECT x, y, tile FROM (SELECT x, y, tile, row_number() OVER (PARTITION BY x, y ORDER BY tile) AS k FROM (SELECT x, y, x // 40 AS tile FROM grid UNION ALL SELECT x, y, x // 40 - 1 FROM grid WHERE x >= 40 AND x % 40 < 5)) WHERE k = 1")
def tile_cells(t: Tables) -> DataFrame:
    own = F.floor(F.col("x") / 40)
    tiles = F.when((F.col("x") >= 40) & (F.col("x") % 40 < 5), F.array(own, own - 1)).otherwise(F.array(own))
    return op.first_k(t.grid.select("x", "y", F.explode(tiles).alias("tile")), ["x", "y"], [F.col("tile")], 1).drop("rank")


@query("ms7_square_grid", "SELECT a * 25 AS x0, b * 25 AS y0, a * 25 + 25 AS x1, b * 25 + 25 AS y1 FROM (SELECT max(x) // 25 AS mx, max(y) // 25 AS my FROM grid), unnest(range(0, mx + 1)) s(a), unnest(range(0, my + 1)) u(b)")
def square_grid(t: Tables) -> DataFrame:
    e = t.grid.agg(F.floor(F.max("x") / 25).alias("mx"), F.floor(F.max("y") / 25).alias("my"))
    cells = e.withColumn("a", F.explode(F.expr("sequence(0L, mx)"))).withColumn("b", F.explode(F.expr("sequence(0L, my)")))
    return cells.selectExpr("a * 25 as x0", "b * 25 as y0", "a * 25 + 25 as x1", "b * 25 + 25 as y1")


@query("ms8_mode_resample", "SELECT x, y, label FROM (SELECT x // 3 AS x, y // 3 AS y, label, row_number() OVER (PARTITION BY x // 3, y // 3 ORDER BY count(*) DESC, label) AS k FROM grid GROUP BY 1, 2, label) WHERE k = 1".replace("GROUP BY 1, 2, label", "GROUP BY x // 3, y // 3, label"))
def mode_resample(t: Tables) -> DataFrame:
    cells = t.grid.select(F.struct(F.floor(F.col("x") / 3).alias("x"), F.floor(F.col("y") / 3).alias("y")).alias("cell"), "label")
    return op.majority(cells, "cell", "label").select("cell.x", "cell.y", F.col("majority").alias("label"))


CM = "cm AS (SELECT seed, ref, prod, count(*) AS n FROM pred GROUP BY 1, 2, 3)"


def matrix(t: Tables) -> DataFrame:
    return accuracy.confusion(t.pred, ["seed"])


@query("va1_confusion", "SELECT tile, seed, ref, prod, count(*) AS n FROM pred WHERE ref <> 0 AND prod <> 0 GROUP BY ALL")
def confusion(t: Tables) -> DataFrame:
    return accuracy.confusion(t.pred, ["tile", "seed"], 0)


@query("va2_confusion_of_regions", "SELECT ref, prod, count(*) AS n FROM pred WHERE tile IN (1, 3) GROUP BY ALL")
def of_regions(t: Tables) -> DataFrame:
    return accuracy.confusion(t.pred.where("tile in (1, 3)"))


@query("va3_zero_filled", "SELECT s.seed, a.l AS ref, b.l AS prod, coalesce(n, 0) AS n FROM (SELECT DISTINCT seed FROM cm) s, lab a, lab b LEFT JOIN cm ON cm.seed = s.seed AND cm.ref = a.l AND cm.prod = b.l", CM + ", lab AS (SELECT DISTINCT ref AS l FROM cm UNION SELECT DISTINCT prod FROM cm)")
def zero_filled(t: Tables) -> DataFrame:
    return accuracy.zero_filled(matrix(t), ["seed"])


@query("va4_merged_classes", "SELECT seed, CASE WHEN ref IN (1, 2) THEN 0 ELSE ref END AS ref, CASE WHEN prod IN (1, 2) THEN 0 ELSE prod END AS prod, CAST(sum(n) AS BIGINT) AS n FROM cm GROUP BY ALL", CM)
def merged(t: Tables) -> DataFrame:
    rules = t.spark.createDataFrame([(1, 0), (2, 0)], "label int, new int")
    return accuracy.merged_labels(matrix(t), rules, ["seed"])


@query("va5_without_undecided", "SELECT * FROM cm WHERE ref <> 0 AND prod <> 0", CM)
def without_undecided(t: Tables) -> DataFrame:
    return matrix(t).where("ref != 0 and prod != 0")


@query("va6_class_scores", """SELECT seed, label, round(hit / p, 9) AS precision, round(hit / r, 9) AS recall, round(2 * (hit / p) * (hit / r) / (hit / p + hit / r), 9) AS fscore FROM (
  SELECT seed, label, sum(n) FILTER (ref = label) AS r, sum(n) FILTER (prod = label) AS p, sum(n) FILTER (ref = label AND prod = label) AS hit FROM cm, (SELECT DISTINCT ref AS label FROM cm) GROUP BY 1, 2)""", CM)
def class_scores(t: Tables) -> DataFrame:
    return accuracy.class_scores(matrix(t), ["seed"]).select("seed", "label", *(F.round(c, 9).alias(c) for c in ("precision", "recall", "fscore")))


GLOBAL = """gs AS (SELECT seed, hit / n AS accuracy, (hit / n - e) / (1 - e) AS kappa FROM (SELECT seed, sum(n) * 1.0 AS n, sum(n) FILTER (ref = prod) * 1.0 AS hit FROM cm GROUP BY 1) JOIN (
  SELECT seed, sum(r * c) / (sum(r) * sum(r)) AS e FROM (SELECT seed, ref AS label, sum(n) AS r FROM cm GROUP BY 1, 2) JOIN (SELECT seed, prod AS label, sum(n) AS c FROM cm GROUP BY 1, 2) USING (seed, label) GROUP BY 1) USING (seed))"""


@query("va6_global_scores", "SELECT seed, round(kappa, 9) AS kappa, round(accuracy, 9) AS accuracy FROM gs", f"{CM}, {GLOBAL}")
def global_scores(t: Tables) -> DataFrame:
    return accuracy.global_scores(matrix(t), ["seed"]).select("seed", F.round("kappa", 9).alias("kappa"), F.round("accuracy", 9).alias("accuracy"))


@query("va7_normalised", "SELECT seed, ref, prod, n, round(n * 1.0 / sum(n) OVER (PARTITION BY seed, ref), 9) AS share FROM cm", CM)
def normalised(t: Tables) -> DataFrame:
    return accuracy.normalised(matrix(t), "ref", ["seed"]).withColumn("share", F.round("share", 9))


@query("va8_mean_matrix", "SELECT ref, prod, round(sum(n) / 3.0, 6) AS n FROM cm GROUP BY 1, 2", CM)
def mean_matrix(t: Tables) -> DataFrame:
    return matrix(t).groupBy("ref", "prod").agg(F.round(F.sum("n") / 3.0, 6).alias("n"))


@query("va8_interval", "SELECT round(avg(kappa), 9) AS mean, round(stddev_samp(kappa) / sqrt(count(*)) * 2.2622, 9) AS half_width FROM gs", f"{CM}, {GLOBAL}")
def interval(t: Tables) -> DataFrame:
    i = accuracy.interval(accuracy.global_scores(matrix(t), ["seed"]), "kappa", 9)
    return i.select(F.round("mean", 9).alias("mean"), F.round("half_width", 9).alias("half_width"))


@query("wn3_most_confused", "SELECT seed, ref, prod, n, CAST(k AS INTEGER) AS rank FROM (SELECT *, row_number() OVER (PARTITION BY seed, ref ORDER BY n DESC, prod DESC) AS k FROM cm) WHERE k <= 3", CM)
def most_confused(t: Tables) -> DataFrame:
    return accuracy.most_confused(matrix(t), 3, ["seed"])


@query("va10_compare_map", "SELECT vec_id, CASE WHEN vec_id % 3 = 0 THEN 0 WHEN vec_id % 3 = 1 THEN CASE WHEN ref = prod THEN 2 ELSE 1 END ELSE CASE WHEN ref = prod THEN 4 ELSE 3 END END AS code FROM pred WHERE seed = 0")
def compare_map(t: Tables) -> DataFrame:
    """0: no reference, 1 and 2: validation wrong and right, 3 and 4: learning wrong and right."""
    p = t.pred.where("seed = 0")
    sets = p.select("vec_id", F.when(F.col("vec_id") % 3 == 1, "validation").when(F.col("vec_id") % 3 == 2, "learning").alias("set")).where("set is not null")
    right = (F.col("ref") == F.col("prod")).cast("int")
    return p.join(sets, "vec_id", "left").select("vec_id", F.when(F.col("set") == "validation", 1 + right).when(F.col("set") == "learning", 3 + right).otherwise(0).alias("code"))


@query("va11_confidence_histogram", "SELECT right_, bin, coalesce(n, 0) AS n FROM (SELECT right_, bin FROM (SELECT unnest([false, true]) AS right_), (SELECT CAST(unnest(range(0, 101)) AS INTEGER) AS bin)) LEFT JOIN (SELECT ref = prod AS right_, CAST(round(conf * 100) AS INTEGER) AS bin, count(*) AS n FROM pred GROUP BY 1, 2) USING (right_, bin)")
def histogram(t: Tables) -> DataFrame:
    n = t.pred.groupBy((F.col("ref") == F.col("prod")).alias("right_"), F.round(F.col("conf") * 100).cast("int").alias("bin")).agg(F.count("*").alias("n"))
    bins = t.spark.range(101).select(F.col("id").cast("int").alias("bin"), F.explode(F.array(F.lit(False), F.lit(True))).alias("right_"))
    return bins.join(n, ["right_", "bin"], "left").select("right_", "bin", F.coalesce("n", F.lit(0)).alias("n"))


@query("va12_histogram_moments", "SELECT seed, round(sum(b * n) / sum(n), 6) AS mean, round(sqrt(sum(b * b * n) / sum(n) - (sum(b * n) / sum(n)) ** 2), 6) AS std FROM (SELECT seed, CAST(round(conf * 100) AS DOUBLE) AS b, count(*) AS n FROM pred GROUP BY 1, 2) GROUP BY 1")
def moments(t: Tables) -> DataFrame:
    h = t.pred.groupBy("seed", F.round(F.col("conf") * 100).alias("b")).agg(F.count("*").alias("n"))
    mean = F.sum(F.col("b") * F.col("n")) / F.sum("n")
    square = F.sum(F.col("b") * F.col("b") * F.col("n")) / F.sum("n")
    return h.groupBy("seed").agg(F.round(mean, 6).alias("mean"), F.round(F.sqrt(square - mean * mean), 6).alias("std"))


@query("va13_correlation", "SELECT round(corr(l_quantity, l_extendedprice), 9) AS r, count(*) AS n FROM lineitem")
def correlation(t: Tables) -> DataFrame:
    return t.lineitem.agg(F.round(F.corr("l_quantity", "l_extendedprice"), 9).alias("r"), F.count("*").alias("n"))


NAMES = "nomen AS (SELECT DISTINCT label AS code, label // 3 AS parent, 'class ' || label AS name, printf('#%02X%02X%02X', label * 20, 255 - label * 20, 128) AS colour FROM embeddings)"


def nomenclature(t: Tables) -> DataFrame:
    code = F.col("code")
    hex2 = lambda c: F.lpad(F.hex(c), 2, "0")
    return t.embeddings.select(F.col("label").alias("code")).distinct().select(
        "code", F.floor(code / 3).cast("int").alias("parent"), F.concat(F.lit("class "), code).alias("name"), F.concat(F.lit("#"), hex2(code * 20), hex2(255 - code * 20), hex2(F.lit(128))).alias("colour")
    )


@query("nm1_level_table", "SELECT 1 AS level, parent AS code, count(*) AS children FROM nomen GROUP BY 2 UNION ALL SELECT 2, code, 0 FROM nomen", NAMES)
def level_table(t: Tables) -> DataFrame:
    n = nomenclature(t)
    top = n.groupBy(F.col("parent").alias("code")).agg(F.count("*").alias("children")).select(F.lit(1).alias("level"), "code", "children")
    return top.unionByName(n.select(F.lit(2).alias("level"), "code", F.lit(0).cast("long").alias("children")))


@query("nm2_colours", "SELECT code, name, colour, label * 20 AS r, 255 - label * 20 AS g, 128 AS b FROM nomen JOIN (SELECT DISTINCT label FROM embeddings) ON label = code", NAMES)
def colours(t: Tables) -> DataFrame:
    part = lambda at: F.conv(F.substring("colour", at, 2), 16, 10).cast("int")
    return nomenclature(t).select("code", "name", "colour", part(2).alias("r"), part(4).alias("g"), part(6).alias("b"))


@query("nm3_confusion_by_level", "SELECT 1 AS level, a.parent AS ref, b.parent AS prod, CAST(sum(n) AS BIGINT) AS n FROM cm JOIN nomen a ON a.code = ref JOIN nomen b ON b.code = prod GROUP BY 2, 3 UNION ALL SELECT 2, ref, prod, CAST(sum(n) AS BIGINT) FROM cm GROUP BY 2, 3", f"{CM}, {NAMES}")
def by_level(t: Tables) -> DataFrame:
    m, n = matrix(t).drop("seed"), nomenclature(t)
    up = accuracy.merged_labels(m, n.select(F.col("code").alias("label"), F.col("parent").alias("new")))
    level = lambda k, x: x.select(F.lit(k).alias("level"), "ref", "prod", "n")
    return level(1, up).unionByName(level(2, m.groupBy("ref", "prod").agg(F.sum("n").alias("n"))))


@query("nm4_colour_table", "SELECT colour, count(*) AS n FROM grid JOIN nomen ON code = label GROUP BY 1", NAMES)
def colour_table(t: Tables) -> DataFrame:
    return t.grid.join(F.broadcast(nomenclature(t)), F.col("label") == F.col("code")).groupBy("colour").agg(F.count("*").alias("n"))


@query("pf26_masked_labels", "SELECT vec_id, CASE WHEN vec_id % 4 >= 1 THEN prod ELSE 0 END AS label, CASE WHEN vec_id % 4 >= 1 THEN conf ELSE 0 END AS conf FROM pred WHERE seed = 0")
def masked(t: Tables) -> DataFrame:
    inside = F.col("vec_id") % 4 >= 1
    return t.pred.where("seed = 0").select("vec_id", F.when(inside, F.col("prod")).otherwise(0).alias("label"), F.when(inside, F.col("conf")).otherwise(0.0).alias("conf"))


@query("zs15_labels_at_points", "SELECT seed, ref, round(avg(conf), 9) AS conf, count(*) AS n FROM pred WHERE vec_id % 5 = 0 GROUP BY 1, 2")
def at_points(t: Tables) -> DataFrame:
    points = t.embeddings.where("vec_id % 5 = 0").select("vec_id")
    return t.pred.join(points, "vec_id", "left_semi").groupBy("seed", "ref").agg(F.round(F.avg("conf"), 9).alias("conf"), F.count("*").alias("n"))


@query("st7_split_rows", "SELECT vec_id % 7 = 0 AS super, count(*) AS n FROM embeddings GROUP BY 1")
def split_rows(t: Tables) -> DataFrame:
    return t.embeddings.groupBy((F.col("vec_id") % 7 == 0).alias("super")).agg(F.count("*").alias("n"))


