"""Tables of a data folder and the layouts that the operators read, derived from them.

obs: dated observations of a pixel and band with a validity mask. stack: eight bands at
eight dates of a pixel. grid: cells with a class label and a confidence. zones: pixels of
zones with a class and three bands. polygons: rectangles with class, region and tile. shapes: polygons
with holes, corners, slants and parts.
sites: pixels with features, a label, a region and a polygon. pred: reference and produced labels of three runs. proba: class probabilities.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Tables:
    """The tables of a folder as attributes, read from Parquet on first use."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder
        if spark.conf.get("spark.sql.session.timeZone") != "UTC":
            spark.conf.set("spark.sql.session.timeZone", "UTC")  # days are UTC days

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    @cached_property
    def obs(self) -> DataFrame:
        date = F.to_date("ts")
        return self.events.groupBy(F.col("user_id").alias("pixel"), F.col("event_type").alias("band"), date.alias("date")).agg(
            F.avg("value").alias("value"), F.max(F.when(F.col("event_id") % 4 == 0, 1).otherwise(0)).alias("mask")
        )

    @cached_property
    def stack(self) -> DataFrame:
        day = F.explode(F.sequence(F.lit(0), F.lit(7)))
        bands = F.transform(F.slice("embedding", F.col("date_idx") * 8 + 1, 8), lambda v: F.round(v.cast("double") * 1000, 3))
        return self.embeddings.select(F.col("vec_id").alias("pixel"), "label", "embedding", day.alias("date_idx")).select("pixel", "date_idx", bands.alias("bands"), "label")

    @cached_property
    def grid(self) -> DataFrame:
        key = F.col("o_orderkey")
        return self.orders.select(
            (key % 150).alias("x"), F.floor(key / 150).alias("y"), F.substring("o_orderpriority", 1, 1).cast("int").alias("label"), ((F.col("o_custkey") % 101) / 100.0).alias("conf")
        )

    @cached_property
    def blocky(self) -> DataFrame:
        """The grid with labels in blocks and a few single cells."""
        key, cust = F.col("o_orderkey"), F.col("o_custkey")
        x, y = key % 150, F.floor(key / 150)
        label = F.when(cust % 13 == 0, 1 + cust % 5).otherwise(1 + (F.floor(x / 7) + 2 * F.floor(y / 5)) % 5)
        return self.orders.select(x.alias("x"), y.alias("y"), label.cast("int").alias("label"))

    @cached_property
    def zones(self) -> DataFrame:
        return self.lineitem.select(
            F.col("l_suppkey").alias("zone"), (F.col("l_linenumber") + 1).alias("class"), F.col("l_quantity").alias("b1"), F.col("l_discount").alias("b2"), F.col("l_tax").alias("b3")
        )

    @cached_property
    def polygons(self) -> DataFrame:
        key = F.col("c_custkey")
        code = F.array_position(F.array(*map(F.lit, SEGMENTS)), F.col("c_mktsegment")).cast("int")
        nation = self.nation.select("n_nationkey", "n_regionkey")
        return self.customer.join(F.broadcast(nation), F.col("c_nationkey") == F.col("n_nationkey")).select(
            key.alias("fid"), code.alias("code"), F.col("n_regionkey").alias("region"), F.col("c_nationkey").alias("tile"),
            (1 + F.abs("c_acctbal")).alias("area"), (key % 97).alias("x0"), (key % 89).alias("y0"), (1 + key % 5).alias("w"), (1 + key % 3).alias("h"),
        )

    @cached_property
    def shapes(self) -> DataFrame:
        """Polygons four times as large and of four forms: with a hole, an L, a triangle, two parts."""
        p = self.polygons
        x, y, w, h = (F.col(c) * 4 for c in ("x0", "y0", "w", "h"))
        point = lambda a, b: F.struct(a.cast("double").alias("x"), b.cast("double").alias("y"))
        box = lambda a, b, c, d: F.array(point(a, b), point(c, b), point(c, d), point(a, d))
        half_w, half_h = w / 2, h / 2
        ell = F.array(point(x, y), point(x + w, y), point(x + w, y + half_h), point(x + half_w, y + half_h), point(x + half_w, y + h), point(x, y + h))
        forms = {
            0: F.array(box(x, y, x + w, y + h), F.reverse(box(x + 1, y + 1, x + w - 1, y + h - 1))),
            1: F.array(ell),
            2: F.array(F.array(point(x, y), point(x + w, y), point(x, y + h))),
            3: F.array(box(x, y, x + half_w, y + half_h), box(x + half_w, y + half_h, x + w, y + h)),
        }
        form = F.col("fid") % 4
        rings = F.when(form == 0, forms[0]).when(form == 1, forms[1]).when(form == 2, forms[2]).otherwise(forms[3])
        return p.select("fid", "code", "region", "tile", rings.alias("rings"))

    @cached_property
    def pred(self) -> DataFrame:
        v, s = F.col("vec_id"), F.col("seed")
        return self.embeddings.select("vec_id", "label", F.explode(F.sequence(F.lit(0), F.lit(2))).alias("seed")).select(
            "vec_id", (v % 4).alias("tile"), "seed", F.col("label").alias("ref"),
            F.when((v * 7 + s) % 3 == 0, (F.col("label") + 1 + s) % 10).otherwise(F.col("label")).alias("prod"), ((v * 31 + s * 17) % 101 / 100.0).alias("conf"),
        )

    @cached_property
    def sites(self) -> DataFrame:
        """Pixels with features, a label, and the region and polygon of the customer of the same number (0 if there is none)."""
        of = self.customer.join(F.broadcast(self.nation), F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_regionkey", "c_nationkey")
        both = self.embeddings.join(of, F.col("vec_id") == F.col("c_custkey"), "left")
        place = [F.coalesce(c, F.lit(0)).cast("int").alias(n) for c, n in (("n_regionkey", "region"), ("c_nationkey", "polygon"))]
        return both.select("vec_id", "label", F.col("embedding").cast("array<double>").alias("x"), *place)

    @cached_property
    def proba(self) -> DataFrame:
        ten = F.transform(F.slice("embedding", 1, 10), lambda v: v.cast("double"))
        low = self.embeddings.select("vec_id", "label", ten.alias("e")).withColumn("e", F.transform("e", lambda v: v - F.array_min("e")))
        total = F.aggregate("e", F.lit(0.0), lambda a, v: a + v)
        return low.select("vec_id", "label", F.transform("e", lambda v: v / total).alias("proba"))


SEGMENTS = ("AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY")

#: The same layouts in the SQL of the oracle.
SQL = {
    "obs": """SELECT user_id AS pixel, event_type AS band, CAST(ts AS DATE) AS date, avg(value) AS value,
        max(CASE WHEN event_id % 4 = 0 THEN 1 ELSE 0 END) AS mask FROM events GROUP BY 1, 2, 3""",
    "stack": """SELECT vec_id AS pixel, CAST(d AS INTEGER) AS date_idx, [round(1000 * embedding[d * 8 + i]::DOUBLE, 3) for i in range(1, 9)] AS bands, label
        FROM embeddings, (SELECT unnest(range(0, 8)) AS d)""",
    "grid": """SELECT o_orderkey % 150 AS x, CAST(floor(o_orderkey / 150) AS BIGINT) AS y, CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS label,
        (o_custkey % 101) / 100.0 AS conf FROM orders""",
    "blocky": """SELECT x, y, CAST(CASE WHEN c % 13 = 0 THEN 1 + c % 5 ELSE 1 + (x // 7 + 2 * (y // 5)) % 5 END AS INTEGER) AS label
        FROM (SELECT o_orderkey % 150 AS x, o_orderkey // 150 AS y, o_custkey AS c FROM orders)""",
    "zones": "SELECT l_suppkey AS zone, l_linenumber + 1 AS class, l_quantity AS b1, l_discount AS b2, l_tax AS b3 FROM lineitem",
    "polygons": """SELECT c_custkey AS fid, CAST(list_position(['AUTOMOBILE', 'BUILDING', 'FURNITURE', 'HOUSEHOLD', 'MACHINERY'], c_mktsegment) AS INTEGER) AS code,
        n_regionkey AS region, c_nationkey AS tile, 1 + abs(c_acctbal) AS area, c_custkey % 97 AS x0, c_custkey % 89 AS y0, 1 + c_custkey % 5 AS w, 1 + c_custkey % 3 AS h
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "shapes": """SELECT fid, code, region, tile, CASE fid % 4
        WHEN 0 THEN [[[x, y], [x + w, y], [x + w, y + h], [x, y + h]], [[x + 1, y + h - 1], [x + w - 1, y + h - 1], [x + w - 1, y + 1], [x + 1, y + 1]]]
        WHEN 1 THEN [[[x, y], [x + w, y], [x + w, y + h / 2], [x + w / 2, y + h / 2], [x + w / 2, y + h], [x, y + h]]]
        WHEN 2 THEN [[[x, y], [x + w, y], [x, y + h]]]
        ELSE [[[x, y], [x + w / 2, y], [x + w / 2, y + h / 2], [x, y + h / 2]], [[x + w / 2, y + h / 2], [x + w, y + h / 2], [x + w, y + h], [x + w / 2, y + h]]] END AS rings
        FROM (SELECT fid, code, region, tile, 4.0::DOUBLE * x0 AS x, 4.0::DOUBLE * y0 AS y, 4.0::DOUBLE * w AS w, 4.0::DOUBLE * h AS h FROM polygons)""",
    "pred": """SELECT vec_id, vec_id % 4 AS tile, seed, label AS ref, CASE WHEN (vec_id * 7 + seed) % 3 = 0 THEN (label + 1 + seed) % 10 ELSE label END AS prod,
        ((vec_id * 31 + seed * 17) % 101) / 100.0 AS conf FROM embeddings, (SELECT unnest([0, 1, 2]) AS seed)""",
    "sites": """SELECT vec_id, label, embedding::DOUBLE[] AS x, CAST(coalesce(n_regionkey, 0) AS INTEGER) AS region, CAST(coalesce(c_nationkey, 0) AS INTEGER) AS polygon
        FROM embeddings LEFT JOIN customer ON c_custkey = vec_id LEFT JOIN nation ON n_nationkey = c_nationkey""",
    "proba": """SELECT vec_id, label, [v / list_sum(e) for v in e] AS proba FROM (
        SELECT vec_id, label, [v - list_min(f) for v in f] AS e FROM (SELECT vec_id, label, embedding[1:10]::DOUBLE[] AS f FROM embeddings))""",
}
