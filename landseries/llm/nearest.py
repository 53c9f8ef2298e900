"""Nearest vectors by inner product: multi-index hashing of learned binary codes, then exact scores."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache
from itertools import combinations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from landseries.llm.common import staged

BITS, PART = 256, 16
PARTS = BITS // PART


def lifted(x: np.ndarray, longest: float | None) -> np.ndarray:
    """Unit vectors whose cosines order as inner products do.

    Candidates (longest: the greatest norm of all) get a last component that fills their
    norm up; queries (longest: None) are scaled to one and get a zero.
    """
    with np.errstate(over="ignore"):
        peak = np.abs(x).max(axis=1, keepdims=True)
        norm = np.minimum(peak * np.linalg.norm(x / peak, axis=1, keepdims=True), np.finfo(float).max)
    y = x / (norm if longest is None else longest)
    rest = np.zeros(len(x)) if longest is None else np.sqrt(np.maximum(0, 1 - (y * y).sum(axis=1)))
    return np.column_stack([y, rest])


def learned_rotation(sample: np.ndarray, rounds: int = 15, seed: int = 7) -> np.ndarray:
    """Columns on which the signs of vectors are their codes (iterative quantisation).

    Each block of columns is a rotation fitted so that the sample's coordinates are near
    their signs: signs and the best rotation for them (a polar decomposition) are found in
    turn. Blocks start at different random rotations; vectors of more than BITS components
    are first reduced to the sample's leading directions.
    """
    rng = np.random.default_rng(seed)
    n = sample.shape[1]
    keep = np.linalg.eigh(sample.T @ sample)[1][:, ::-1][:, : min(n, BITS)]
    x, blocks = sample @ keep, []
    for _ in range(-(-BITS // keep.shape[1])):
        r = np.linalg.qr(rng.normal(size=(keep.shape[1],) * 2))[0]
        for _ in range(rounds):
            u, _, v = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
            r = u @ v
        blocks.append(keep @ r)
    return np.concatenate(blocks, axis=1)[:, :BITS]


def codes(x: np.ndarray, rotation: np.ndarray) -> np.ndarray:
    """The code of each vector as PARTS numbers of PART bits."""
    return np.packbits(x @ rotation > 0, axis=1, bitorder="little").view("<u2")


def distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits in which rows of codes differ."""
    return np.bitwise_count(np.ascontiguousarray(a).view("<u8") ^ np.ascontiguousarray(b).view("<u8")).sum(axis=1, dtype=np.int64)


@cache
def flips(radius: int) -> np.ndarray:
    """All numbers of PART bits with at most `radius` of them set."""
    return np.array([sum(1 << b for b in c) for r in range(radius + 1) for c in combinations(range(PART), r)], np.uint16)


def shares(radius: int) -> list[int]:
    """A radius for each part, -1 for none: codes within `radius` bits are within it in one part at least.

    Were every part one bit beyond its own radius, the whole would be radius + 1 bits apart.
    """
    each, more = divmod(radius + 1, PARTS)
    return [min(PART, each + (j < more) - 1) for j in range(PARTS)]


class MultiIndex:
    """Tables of each part's values over some codes."""

    def __init__(self, rows: np.ndarray):
        self.codes = rows
        self.tables = []
        for j in range(PARTS):
            values, inverse, size = np.unique(rows[:, j], return_inverse=True, return_counts=True)
            slot = np.full(1 << PART, -1, np.int32)
            slot[values] = np.arange(len(values))
            self.tables.append((values, slot, np.argsort(inverse, kind="stable"), np.cumsum(size) - size, size))

    def within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all rows within `radius` bits of a query, each pair once.

        A part's table is asked for every value within the part's radius, or, where fewer
        values occur than that, each of them is compared: the same values either way.
        """
        near = np.zeros((len(queries), len(self.codes)), bool)
        for j, (share, (values, slot, order, start, size)) in enumerate(zip(shares(radius), self.tables, strict=True)):
            if share < 0:
                continue
            own = queries[:, j]
            if len(flips(share)) < len(values):
                found = slot[own[:, None] ^ flips(share)]
                q, k = np.nonzero(found >= 0)
                value = found[q, k]
            else:
                q, value = np.nonzero(np.bitwise_count(own[:, None] ^ values) <= share)
            n = size[value]
            at = np.repeat(start[value] - (np.cumsum(n) - n), n) + np.arange(n.sum())
            near[np.repeat(q, n), order[at]] = True
        q, row = np.nonzero(near)
        ok = distances(queries[q], self.codes[row]) <= radius
        return q[ok], row[ok]


def best(q: np.ndarray, item: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores of each q, smaller items first among equal ones."""
    order = np.lexsort((item, -score, q))
    q = q[order]
    first = np.searchsorted(q, q)
    return order[np.arange(len(q)) - first < k]


def search_tile(x: np.ndarray, ids: list[np.ndarray], queries: np.ndarray, longest: float, rotation: np.ndarray, radius: int, k: int, step: int = 32) -> pd.DataFrame:
    """(q, vec_id, score): the k nearest of some vectors for each query, of those within the radius.

    ids: the least ids that share a vector, in order. Scores are sums over a pair's products
    in one fixed order, so that equal pairs have equal scores.
    """
    index = MultiIndex(codes(lifted(x, longest), rotation))
    asked = codes(lifted(queries, None), rotation)
    least = np.array([i[0] for i in ids])
    parts = []
    for at in range(0, len(queries), step):
        q, row = index.within(asked[at : at + step], radius)
        score = np.concatenate([(queries[at + q[b : b + 65536]] * x[row[b : b + 65536]]).sum(axis=1) for b in range(0, len(q), 65536)] or [np.zeros(0)])
        top = best(q, least[row], score, k)
        q, row, score = q[top], row[top], score[top]
        n = np.array([len(ids[r]) for r in row], np.int64)
        every = np.concatenate([ids[r] for r in row] or [np.zeros(0, np.int64)])
        q, score = np.repeat(q, n), np.repeat(score, n)
        top = best(q, every, score, k)
        parts.append(pd.DataFrame({"q": at + q[top], "vec_id": every[top], "score": score[top]}))
    return pd.concat(parts, ignore_index=True)


def as_matrix(vectors: pd.Series) -> np.ndarray:
    return np.stack(vectors.to_numpy()).astype(np.float64) if len(vectors) else np.zeros((0, 1))


def radius_for(classes: DataFrame, sample: list, longest: float, rotation: np.ndarray, k: int, share: float) -> int:
    """The least radius that holds this share of the sample queries' exact k nearest other vectors.

    The sample is compared with all vectors; a task returns k rows a query.
    """
    asked = np.array([r.x for r in sample])
    own = codes(lifted(asked, None), rotation)
    number = np.arange(len(asked))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            x, rep = as_matrix(batch["x"]), batch["rep"].to_numpy()
            there = codes(lifted(x, longest), rotation)
            score = asked @ x.T
            q, row = np.nonzero((own[:, None] == there[None]).all(axis=2))
            same = (asked[q] == x[row]).all(axis=1)
            score[q[same], row[same]] = -np.inf
            top = np.argpartition(-score, min(k, len(x)) - 1, axis=1)[:, :k]
            q = np.repeat(number, top.shape[1])
            row = top.ravel()
            yield pd.DataFrame({"q": q, "rep": rep[row], "score": score[q, row], "bits": distances(own[q], there[row])})

    rows = classes.select("rep", "x").mapInPandas(run, "q long, rep long, score double, bits long").where("score > double('-infinity')")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "rep")
    bits = rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).groupBy("bits").count().collect()  # at most BITS + 1 rows
    total, seen = sum(r["count"] for r in bits), 0
    for r in sorted(bits):
        seen += r["count"]
        if seen >= share * total:
            return r.bits
    return 0


def search(
    vectors: DataFrame, k: int = 20, every: int = 20, id_col: str = "vec_id", vector_col: str = "embedding",
    learn_rows: int = 4096, sample_queries: int = 256, share: float = 0.97, tile: int = 8192, block: int = 2048,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the k rows of largest inner product found for each query.

    Queries are the rows whose id is divisible by `every`; candidates are all rows of other
    ids. Every vector is indexed. Codes are the signs of learned rotations (fitted on the
    learn_rows vectors of least hash). For each query every code within a radius is
    retrieved from tables of the codes' parts and ranked by its exact score in double
    precision; ties go to the smaller id. The radius is the least one that holds `share` of
    the exact k nearest of sample_queries queries against all vectors, so it follows the
    data. A query that finds too few within it is asked again without a radius.

    Equal vectors are one candidate with its k + 1 least ids, and one query. The vectors are
    dealt by hash into tiles, each with its own tables, and a task asks a tile a block of
    queries; of a tile k + 1 rows a query go on.

    Null ids, null, empty and zero vectors, vectors with null or non-finite components and
    vectors of another length than most (ties: the greatest) take no part. With fewer
    candidates than k all are returned. Rows equal in id and vector count once. An empty
    table gives no rows; other columns are ignored.
    """
    usable = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x")).where(
        F.col("vec_id").isNotNull() & F.col("x").isNotNull() & F.exists("x", lambda c: c != 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    )
    lengths = usable.groupBy(F.size("x").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    spark = vectors.sparkSession
    if not lengths:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    rows = staged(usable.where(F.size("x") == lengths[0].n).distinct())
    least = Window.partitionBy("x").orderBy("vec_id")
    classes = rows.withColumn("nth", F.row_number().over(least)).where(F.col("nth") <= k + 1).groupBy("x").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = staged(classes.select(F.col("ids")[0].alias("rep"), "ids", "x"))
    asked_rows = rows.where(F.col("vec_id") % every == 0)
    asked = staged(asked_rows.groupBy("x").agg(F.min("vec_id").alias("q")))
    norm = F.sqrt(F.aggregate("x", F.lit(0.0), lambda a, c: a + c * c))
    size = classes.agg(F.count("*").alias("classes"), F.max(F.least(norm, F.lit(float(np.finfo(float).max)))).alias("longest")).first()
    total, n_asked = rows.count(), asked.count()
    by_hash = lambda df, c, n: df.orderBy(F.xxhash64(c), c).limit(n).collect()
    rotation = learned_rotation(lifted(np.array([r.x for r in by_hash(classes, "rep", learn_rows)]), size.longest))
    sample = by_hash(asked, "q", sample_queries)
    radius = radius_for(classes, sample, size.longest, rotation, k, share) if sample else 0
    longest, wanted = size.longest, min(k + 1, total)

    def asked_of_all(queries: DataFrame, n: int, bits: int) -> DataFrame:
        tiles, blocks = -(-size.classes // tile), max(1, -(-n // block))
        spread = lambda c, m: F.pmod(F.xxhash64(c), F.lit(m)).cast("int")
        deal = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
        there = classes.select(spread("rep", tiles).alias("tile"), deal(blocks).alias("block"), F.lit(None).cast("long").alias("q"), "ids", "x")
        here = queries.select(deal(tiles).alias("tile"), spread("q", blocks).alias("block"), "q", F.lit(None).cast("array<long>").alias("ids"), "x")

        def run(pdf: pd.DataFrame) -> pd.DataFrame:
            of_query = pdf["q"].notna().to_numpy()
            q, own = pdf["q"][of_query].astype("int64").to_numpy(), pdf[~of_query]
            if not len(q) or not len(own):
                return pd.DataFrame({"q": [], "vec_id": [], "score": []}).astype({"q": "int64", "vec_id": "int64"})
            ids = [np.asarray(i, np.int64) for i in own["ids"]]
            found = search_tile(as_matrix(own["x"]), ids, as_matrix(pdf["x"][of_query]), longest, rotation, bits, k + 1)
            found["q"] = q[found["q"].to_numpy()]
            return found

        # ids as text: a frame would turn a column of numbers and nulls into floats
        dealt = there.unionByName(here).withColumn("q", F.col("q").cast("string"))
        found = dealt.groupBy("tile", "block").applyInPandas(run, "q long, vec_id long, score double")
        order = Window.partitionBy("q").orderBy(F.desc("score"), "vec_id")
        near = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k + 1)
        return near.groupBy("q").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("hits"))

    found = staged(asked_of_all(asked, n_asked, radius))
    short = staged(asked.join(found.where(F.size("hits") >= wanted), "q", "left_anti"))
    n_short = short.count()
    if n_short:
        again = staged(asked_of_all(short, n_short, BITS))
        found = found.where(F.size("hits") >= wanted).unionByName(again)
    hits = staged(asked.join(found, "q").select("x", "hits"))
    mine = asked_rows.join(hits, "x").select(F.col("vec_id").alias("query_id"), F.slice(F.filter("hits", lambda h: h["vec_id"] != F.col("vec_id")), 1, k).alias("hits"))
    out = mine.select("query_id", F.posexplode("hits").alias("at", "hit"))
    return out.select("query_id", (F.col("at") + 1).alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.minus")).alias("score"))
