"""Queries on classifiers: training for all regions and draws at once, search of settings, classification."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.operators import forest as op
from landseries.operators.forest import Settings
from landseries.plans.registry import query
from landseries.sources.views import Tables

CLASSES = tuple(range(10))
WIDTH = 64
GROWN = Settings("forest", trees=3, depth=3, bins=16)


def mixed(key: str, by: str) -> str:
    return f"((({key}) % 2147483648 * 2654435761 % 4294967296) * (2 * ({by}) + 1) % 4294967296)"


DRAWN = f"drawn AS (SELECT vec_id AS key, region || '_' || seed AS model, seed, label, x, {mixed('vec_id', 'seed + 50')} < 2147483648 AS learn FROM sites, (SELECT unnest([0, 1]) AS seed))"


def drawn(t: Tables) -> DataFrame:
    """All pixels for each of two draws with the model of their region, and whether the draw takes them for learning."""
    seeds = t.sites.withColumn("seed", F.explode(F.array(F.lit(0), F.lit(1))))
    learn = op.mixed(F.col("vec_id"), F.col("seed") + 50) < 1 << 31
    return seeds.select(F.col("vec_id").alias("key"), F.concat_ws("_", "region", "seed").alias("model"), "seed", "label", "x", "polygon", learn.alias("learn"))


def forest_ctes(s: Settings = GROWN) -> str:
    """The same trees in SQL: a count, a choice and a move a level."""
    top = 1 << s.depth
    poisson = " + ".join(f"CASE WHEN h >= {c} THEN 1 ELSE 0 END" for c in op.POISSON)
    parts = [
        DRAWN,
        f"ends AS (SELECT f, min(x[f + 1]) AS a, max(x[f + 1]) AS b FROM drawn, range({WIDTH}) r(f) WHERE learn GROUP BY f)",
        f"""binned AS (SELECT key, model, seed, f, CASE WHEN b > a THEN least(greatest(floor((x[f + 1] - a) / (b - a) * {s.bins}), 0), {s.bins - 1}) ELSE 0 END AS bin
          FROM drawn, ends)""",
        f"grown AS (SELECT key, model, seed, label, learn, tree, {poisson} AS w FROM (SELECT *, {mixed('key', 'tree')} AS h FROM drawn, range({s.trees}) r(tree)))",
        "at0 AS (SELECT key, model, tree, 1 AS node FROM grown)",
    ]
    for level in range(s.depth):
        order = mixed("f + 1", f"tree * {top} + node")
        parts += [
            f"""tried{level} AS (SELECT tree, node, f FROM (SELECT tree, node, f, row_number() OVER (PARTITION BY tree, node ORDER BY {order}, f) AS k
              FROM range({s.trees}) r(tree), range({1 << level}, {2 << level}) n(node), range({WIDTH}) u(f)) WHERE k <= {s.tried(WIDTH)})""",
            f"""cells{level} AS (SELECT model, tree, node, f, bin, label, sum(w) AS n FROM grown JOIN at{level} USING (key, model, tree) JOIN tried{level} USING (tree, node)
              JOIN binned USING (key, model, f) WHERE learn AND w > 0 GROUP BY ALL)""",
            f"""cuts{level} AS (SELECT model, tree, node, f, bin FROM (SELECT DISTINCT model, tree, node, f, bin FROM cells{level}))""",
            f"""sides{level} AS (SELECT u.model, u.tree, u.node, u.f, u.bin, label, coalesce(sum(n) FILTER (c.bin <= u.bin), 0)::DOUBLE AS l, sum(n)::DOUBLE AS t
              FROM cuts{level} u JOIN cells{level} c USING (model, tree, node, f) GROUP BY ALL)""",
            f"""score{level} AS (SELECT model, tree, node, f, bin, sum(l * l) / sum(l) + sum((t - l) * (t - l)) / sum(t - l) AS score, sum(t * t) / sum(t) AS own
              FROM sides{level} GROUP BY ALL HAVING sum(l) >= {s.least} AND sum(t - l) >= {s.least})""",
            f"""split{level} AS (SELECT model, tree, node, f AS feature, CAST(bin AS INTEGER) AS bin FROM score{level} WHERE score > own
              QUALIFY row_number() OVER (PARTITION BY model, tree, node ORDER BY score DESC, f, bin) = 1)""",
            f"""at{level + 1} AS (SELECT a.key, a.model, a.tree, CASE WHEN s.node IS NULL THEN a.node ELSE 2 * a.node + CASE WHEN b.bin > s.bin THEN 1 ELSE 0 END END AS node
              FROM at{level} a LEFT JOIN split{level} s USING (model, tree, node) LEFT JOIN binned b ON b.key = a.key AND b.model = a.model AND b.f = s.feature)""",
        ]
    return ", ".join(parts)


SPLITS = " UNION ALL ".join(f"FROM split{k}" for k in range(GROWN.depth))
LABELLED = f"""leaf AS (SELECT model, tree, node, label, n / sum(n) OVER (PARTITION BY model, tree, node) AS p FROM (
  SELECT model, tree, node, label, sum(w) AS n FROM grown JOIN at{GROWN.depth} USING (key, model, tree) WHERE learn AND w > 0 GROUP BY ALL)),
share AS (SELECT key, seed, c, list_reduce(list(coalesce(p, 0.0) ORDER BY g.tree), lambda u, v: u + v) / count(*) AS p FROM grown g JOIN at{GROWN.depth} a USING (key, model, tree)
  JOIN (SELECT DISTINCT model, tree, node FROM leaf) USING (model, tree, node) CROSS JOIN range(10) r(c) LEFT JOIN leaf l ON l.model = g.model AND l.tree = g.tree AND l.node = a.node AND l.label = c GROUP BY key, seed, c)"""


def grown(t: Tables) -> op.Forest:
    return op.fit(drawn(t).where("learn"), CLASSES, GROWN)


@query("ml1_splits_of_all_models", f"SELECT model, CAST(tree AS INTEGER) AS tree, CAST(node AS INTEGER) AS node, CAST(feature AS INTEGER) AS feature, bin FROM ({SPLITS})", forest_ctes())
def splits(t: Tables) -> DataFrame:
    return grown(t).splits


@query(
    "ml6_classification",
    "SELECT key AS vec_id, seed, CAST(arg_max(c, (p, -c)) AS INTEGER) AS label, round(max(p), 9) AS conf FROM share GROUP BY 1, 2",
    f"{forest_ctes()}, {LABELLED}",
)
def classification(t: Tables) -> DataFrame:
    told = op.classify(grown(t), drawn(t).drop("label"))
    return told.select(F.col("key").alias("vec_id"), "seed", "label", F.round("conf", 9).alias("conf"))


@query("ml3_standardised", f"""SELECT vec_id, f, round((x[f + 1] - m) / CASE WHEN d > 0 THEN d ELSE 1 END, 6) AS v FROM sites JOIN (SELECT region, f, avg(x[f + 1]) AS m, stddev_pop(x[f + 1]) AS d
  FROM sites, range({WIDTH}) r(f) GROUP BY 1, 2) USING (region)""")
def standardised(t: Tables) -> DataFrame:
    scaled = op.standardised(t.sites, ["region"]).select("vec_id", F.posexplode("x").alias("f", "v"))
    return scaled.select("vec_id", F.col("f").cast("long").alias("f"), F.round("v", 6).alias("v"))


@query("ml3_search_by_polygon")
def searched(t: Tables) -> DataFrame:
    """Accuracy of settings over folds of whole polygons."""
    grid = [Settings("forest", trees=5, depth=d, bins=16) for d in (1, 3)]
    rows = t.sites.select(F.col("vec_id").alias("key"), F.col("region").cast("string").alias("model"), "label", "x", "polygon")
    return op.search(rows, CLASSES, grid, 3, "polygon")


@query("ml2_classifiers")
def classifiers(t: Tables) -> DataFrame:
    """Labels of each kind of classifier, and of the vote of all."""
    rows = t.sites.select(F.col("vec_id").alias("key"), F.col("region").cast("string").alias("model"), "label", "x")
    kinds = ("forest", "extra", "bagging", "tree")
    fits = [op.fit(rows, CLASSES, Settings(k, trees=1 if k == "tree" else 3, depth=3, bins=16)) for k in kinds]
    bare = rows.drop("label")
    told = [op.classify(f, bare).select("key", F.lit(k).alias("kind"), "label") for f, k in zip(fits, kinds, strict=True)]
    told.append(op.voted(fits, bare).select("key", F.lit("vote").alias("kind"), "label"))
    told.append(op.boosted_label(op.boosted(rows, CLASSES, Settings("tree", trees=1, depth=2, bins=16), 2), bare).select("key", F.lit("boosted").alias("kind"), "label"))
    out = told[0]
    for more in told[1:]:
        out = out.unionByName(more)
    return out.withColumnRenamed("key", "vec_id")
