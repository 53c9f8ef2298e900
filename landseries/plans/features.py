"""Queries on synthetic samples, reduced features and the files of the chain."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import accuracy, neighbours, reduction
from landseries.plans.learning import mixed
from landseries.plans.registry import query
from landseries.sources import files
from landseries.sources.store import shared_folder
from landseries.sources.views import Tables

NEAR = """near AS (SELECT a.label AS class, a.vec_id AS key, b.vec_id AS other, d2, row_number() OVER (PARTITION BY a.vec_id ORDER BY d2, b.vec_id) AS rank FROM (
  SELECT a.vec_id, a.label, b.vec_id AS bid, list_sum(list_transform(list_zip(a.x, b.x), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d2
  FROM sites a JOIN sites b ON a.label = b.label AND a.vec_id <> b.vec_id) p JOIN sites a ON a.vec_id = p.vec_id JOIN sites b ON b.vec_id = p.bid QUALIFY rank <= 3)"""
ADD = "(SELECT label AS class, 60 - count(*) AS add FROM sites GROUP BY 1 HAVING count(*) < 60)"


def samples(t: Tables) -> DataFrame:
    return t.sites.select(F.col("vec_id").alias("key"), F.col("label").alias("class"), "x")


@query("au4_neighbours", "SELECT key, CAST(rank AS INTEGER) AS rank, other, round(d2, 6) AS d2 FROM near", NEAR)
def nearest(t: Tables) -> DataFrame:
    return neighbours.nearest_in_class(samples(t), 3).select("key", "rank", "other", F.round("d2", 6).alias("d2"))


@query("au4_between_neighbours", f"""SELECT m.key, CAST(copy AS INTEGER) AS copy, n.other, round(u, 9) AS u, round(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] + u * (p[2] - p[1]))), 6) AS total FROM (
  SELECT key, class, copy, {mixed('key', 'copy * 4 + 1')} / 4294967296.0 AS v, {mixed('key', 'copy * 4 + 2')} / 4294967296.0 AS u FROM (
    SELECT key, class, unnest(range(1, times + 1)) AS copy FROM (SELECT key, s.class, add // n + CASE WHEN k < add % n THEN 1 ELSE 0 END AS times FROM (
      SELECT vec_id AS key, label AS class, count(*) OVER (PARTITION BY label) AS n, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS k FROM sites) s JOIN {ADD} a ON a.class = s.class))) m
  JOIN near n ON n.key = m.key AND n.rank = 1 + CAST(floor(v * 3) AS BIGINT) JOIN sites a ON a.vec_id = m.key JOIN sites b ON b.vec_id = n.other""", NEAR)
def between(t: Tables) -> DataFrame:
    """Samples made for classes of under 60 at that, with the sum of their features."""
    add = samples(t).groupBy("class").agg((60 - F.count("*")).alias("add")).where("add > 0")
    made = neighbours.between(samples(t), add, 3)
    return made.select("key", "copy", "other", F.round("u", 9).alias("u"), F.round(F.aggregate("x", F.lit(0.0), lambda a, v: a + v), 6).alias("total"))


@query("au5_target_models", """SELECT key, class, CAST(customer AS BIGINT) AS customer, CAST(copy AS INTEGER) AS copy, round(price, 6) AS price FROM (
  SELECT o_orderkey AS key, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS class, o_custkey AS customer, o_totalprice::DOUBLE AS price, unnest(CASE WHEN o_orderstatus = 'F' AND class = 2 THEN [0, 1] ELSE [0] END) AS copy FROM orders)""")
def target_models(t: Tables) -> DataFrame:
    """A copy of each sample of class 2 of one model (the orders of a status); whole numbers stay as they are."""
    kind = F.substring("o_orderpriority", 1, 1).cast("int").alias("class")
    rows = t.orders.select(F.col("o_orderkey").alias("key"), kind, F.col("o_orderstatus").alias("model"), F.col("o_custkey").cast("long").alias("customer"), F.col("o_totalprice").cast("double").alias("price"))
    add = rows.where("model = 'F' and class = 2").groupBy("class").agg(F.count("*").alias("add"))
    out = neighbours.augmented(rows, "key", "class", add, "replicate", "model", ["F"])
    return out.select("key", "class", "customer", "copy", F.round("price", 6).alias("price"))


GROUPS = {"low": list(range(6)), "high": list(range(6, 16))}


@query("dr3_correlations", " UNION ALL ".join(
    f"SELECT '{g}' AS grp, i, j, round(corr(x[i + {k[0]} + 1], x[j + {k[0]} + 1]), 6) AS r FROM sites, range({len(k)}) a(i), range({len(k)}) b(j) GROUP BY i, j" for g, k in GROUPS.items()))
def correlations(t: Tables) -> DataFrame:
    return reduction.correlations(t.sites, GROUPS).select("grp", "i", "j", F.round("r", 6).alias("r"))


@query("dr3_components")
def components(t: Tables) -> DataFrame:
    c = reduction.fit_components(t.sites, GROUPS, 3)
    return c.select("grp", "component", F.round("variance", 6).alias("variance"), F.posexplode("loadings").alias("place", "loading")).withColumn("loading", F.round("loading", 6))


#: Components have mean 0, are not correlated inside a group, and all of a group's variances add up to its features.
@query("dr4_reduced_features", "SELECT 6.0 AS low, 10.0 AS high, 0.0 AS mean, 0.0 AS common")
def reduced(t: Tables) -> DataFrame:
    both = reduction.reduced(t.sites, reduction.fit_components(t.sites, GROUPS, 16))
    r = reduction.spread(both.select("vec_id", "reduced"), 16)  # groups by name: high, then low
    var = lambda a, b: sum((F.var_pop(f"reduced_{k}") for k in range(a, b)), F.lit(0.0))
    pairs = [F.abs(F.covar_pop(f"reduced_{a}", f"reduced_{b}")) for lo, hi in ((1, 11), (11, 17)) for a in range(lo, hi) for b in range(a + 1, hi)]
    mean = F.greatest(*(F.abs(F.avg(f"reduced_{k}")) for k in range(1, 17)))
    return r.agg(F.round(var(11, 17), 6).alias("low"), F.round(var(1, 11), 6).alias("high"), F.round(mean, 6).alias("mean"), F.round(F.greatest(*pairs), 6).alias("common"))


def fresh_path(t: Tables, name: str) -> str:
    return f"{shared_folder(t.spark)}/{name}-{uuid.uuid4().hex}"


@query("sc9_matrix_files", "SELECT tile, seed, ref, prod, CAST(count(p.vec_id) AS DOUBLE) AS n FROM (SELECT DISTINCT tile, seed, ref FROM pred WHERE ref <> 0 AND prod <> 0) JOIN (SELECT DISTINCT tile, seed, prod FROM pred WHERE ref <> 0 AND prod <> 0) USING (tile, seed) LEFT JOIN pred p USING (tile, seed, ref, prod) GROUP BY ALL")
def matrix_files(t: Tables) -> DataFrame:
    """Matrices by tile and draw, written as files and read back; cells that were missing come back as 0."""
    path = fresh_path(t, "matrices")
    files.write_matrices(accuracy.confusion(t.pred, ["tile", "seed"], 0), path, ["tile", "seed"])
    back = files.read_matrices(t.spark, path)
    return back.select(F.col("tile").cast("long").alias("tile"), "seed", "ref", "prod", "n")


@query("sc12_split_files", "SELECT region, tile, code, fid, area FROM polygons")
def split_files(t: Tables) -> DataFrame:
    """Polygons in a folder for each region, tile and class, read back."""
    path = fresh_path(t, "split")
    files.write_split(t.polygons, path, ["region", "tile", "code"])
    return t.spark.read.parquet(path).select("region", "tile", "code", "fid", "area")


@query("sc13_statistics_files", "SELECT zone, class, count(*) AS n, round(avg(b1), 6) AS mean FROM zones GROUP BY 1, 2")
def statistics_files(t: Tables) -> DataFrame:
    """Tall statistics as CSV files with alias names, read back with a schema."""
    path = fresh_path(t, "statistics")
    tall = t.zones.groupBy("zone", "class").agg(F.count("*").alias("n"), F.round(F.avg("b1"), 6).alias("mean"))
    files.write_statistics(tall, path, {"n": "pixels", "mean": "first_band_mean"})
    back = files.read_statistics(t.spark, path, "zone long, class long, pixels long, first_band_mean double")
    return back.withColumnsRenamed({"pixels": "n", "first_band_mean": "mean"})
