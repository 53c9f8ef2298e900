"""Connected components of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.sources.store import stored


def handed_minimum(links: DataFrame, salts: int) -> DataFrame:
    """links (u, v) with m, the least v of each u. The join is salted, so a u with very many links is spread over tasks."""
    least = links.groupBy("u").agg(F.min("v").alias("m")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return links.withColumn("salt", F.pmod(F.hash("v"), F.lit(salts))).join(least, ["u", "salt"]).drop("salt")


def components(links: DataFrame, salts: int = 8, most: int = 60) -> DataFrame:
    """(node, component) for links (a, b) of numbers: the least node of each one's component, left out where it is itself.

    Large-star and small-star rounds in turn (Kiveris et al. 2014): every node's greater
    neighbours, then all its lesser ones, are tied to its least one, until links are stars.
    """
    a, b = (F.col(c) for c in links.columns)
    now = stored(links.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct())
    before = None
    for _ in range(most):
        state = now.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()
        if state == before or not state[0]:
            return now.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = state
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = handed_minimum(both, salts).where("v > u").select(F.col("v").alias("u"), F.least("u", "m").alias("v")).distinct()
        tied = F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e")
        now = stored(handed_minimum(large, salts).select(tied).select("e.*").where("u != v").distinct())
    raise RuntimeError("components did not settle")
