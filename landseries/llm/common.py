"""Helpers shared by the operators: staged tables and connected components."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


#: Stands for a null id inside Python tasks, where nulls would turn a batch's ids into floats.
NO_ID = -(2**63)


def known_id(column: str = "doc_id") -> Column:
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID)).alias("doc_id")


def with_null_ids(df: DataFrame) -> DataFrame:
    """df, of which doc_id came from known_id, with nulls again."""
    return df.withColumn("doc_id", F.nullif("doc_id", F.lit(NO_ID)))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that df doesn't have, in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share (spark.checkpoint.dir).

    Only a local session that names none, as in tests, gets a temporary one: on a cluster
    executors would write to their own disks.
    """
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not path:
        path = tempfile.mkdtemp(prefix="landseries-")
        spark.conf.set("spark.checkpoint.dir", path)
    return path.rstrip("/")


def long_texts(spark: SparkSession, rows: int = 2000) -> None:
    """Python tasks take at most this many rows at once, for tables of whole documents."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))


def staged(df: DataFrame) -> DataFrame:
    """Write df as Parquet into the shared folder and read it back.

    This cuts the lineage and survives lost executors; the work above it runs once.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/staged-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucketed(df: DataFrame, column: str) -> DataFrame:
    """Write df into the shared folder as a table in buckets of a column and read it back.

    Joins on the column take the buckets as they lie: only their other side is shuffled.
    There are as many buckets as shuffle partitions. The table stays in the session's catalog.
    """
    spark = df.sparkSession
    name = f"bucketed_{uuid.uuid4().hex}"
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    df.write.bucketBy(n, column).option("path", f"{shared_dir(spark)}/{name}").saveAsTable(name)
    return spark.table(name)


#: Keys are told apart by this many bits in `split_by_keys`, a table of fixed size.
KEY_BITS = 1 << 26


def split_by_keys(rows: DataFrame, keys: DataFrame, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """The rows that may have a partner among keys in these columns, and those that have none.

    All rows with a partner are among the first, with a few others, so a join of those gives
    the whole result, and the others, with their texts, aren't shuffled. The keys become a
    bitmap of hashes, 2048 pieces of 4 KB, which is broadcast. Both parts read `rows`.
    """
    bit = lambda df: F.pmod(F.xxhash64(*(df[c] for c in columns)), F.lit(KEY_BITS))
    piece, place, bits, at = (fresh(rows, x) for x in ("piece", "place", "bits", "at"))
    hashed = keys.select(bit(keys).alias(at))
    pieces = hashed.groupBy(F.shiftright(at, 15).alias(piece)).agg(F.bitmap_construct_agg(F.col(at) % 32768).alias(bits))
    pieces = F.broadcast(staged(pieces))
    found = rows.withColumn(at, bit(rows)).withColumn(piece, F.shiftright(at, 15)).withColumn(place, (F.col(at) % 32768).cast("int")).join(pieces, piece, "left")
    byte = F.conv(F.hex(F.substring(bits, (F.col(place) / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    hit = F.coalesce(F.call_function("shiftright", byte, F.col(place) % 8).bitwiseAND(1) == 1, F.lit(False))
    maybe, never = (found.where(c).drop(at, piece, place, bits) for c in (hit, ~hit))
    return maybe, never


def connected_components(edges: DataFrame, salts: int = 8, max_rounds: int = 60) -> DataFrame:
    """(node, component) of every node that has an edge and is not the least of its component.

    edges: two long columns, in any order and direction, repeats allowed. Alternating
    large-star and small-star rounds (Kiveris et al. 2014). Only minima per node are
    aggregated, never neighbour lists, and the join that hands a node's minimum to its
    neighbours is salted, so that a hub with a third of all edges is spread over tasks.
    No edges give no rows; nulls and self links are ignored.
    """
    a, b = (F.col(c) for c in edges.columns[:2])
    e = staged(
        edges.where(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    )

    def with_min(pairs: DataFrame) -> DataFrame:
        least = pairs.groupBy("u").agg(F.min("v").alias("m"))
        spread = least.withColumn("salt", F.explode(F.array(*map(F.lit, range(salts)))))
        salted = pairs.withColumn("salt", F.pmod(F.xxhash64("v"), F.lit(salts)).cast("int"))
        return salted.join(spread, ["u", "salt"]).drop("salt")

    def state(pairs: DataFrame):
        return pairs.agg(F.count("*"), F.expr("bit_xor(xxhash64(u, v))")).first()

    before = state(e)
    for _ in range(max_rounds):
        if not before[0]:
            break
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = (
            with_min(both)
            .where("v > u")
            .select(F.col("v").alias("u"), F.least("u", "m").alias("v"))
            .distinct()
        )
        linked = with_min(large)
        small = linked.select(
            F.explode(F.array(F.struct(F.col("u"), F.col("m").alias("v")), F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("e")
        ).select("e.u", "e.v").where("u != v").distinct()
        e = staged(small)
        after = state(e)
        if after == before:
            break
        before = after
    else:
        raise RuntimeError("components did not settle")
    return e.select(F.col("u").alias("node"), F.col("v").alias("component"))


def largest(df: DataFrame, column: str, limit: int) -> DataFrame:
    """The rows with the largest positive values of a column, at most `limit` of them.

    The cut is taken from a histogram of logarithms (eight bins a doubling), so that no
    more than the histogram reaches the driver and no task sorts the rows.
    """
    bin_ = F.floor(F.log2(F.col(column).cast("double")) * 8)
    sizes = sorted(df.groupBy(bin_.alias("bin")).count().collect(), reverse=True)
    total, cut = 0, None
    for b, n in sizes:
        total += n
        if total > limit:
            break
        cut = b
    return df.where(bin_ >= F.lit(cut if cut is not None else 1 << 30))
