"""Embedding near-duplicates: int8 tile products with error bounds, exact recheck."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import connected_components, staged

#: Slack for the rounding of the double arithmetic in the bounds themselves.
ROUNDING = 1e-9


def quantise(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 codes, scales and Euclidean residual norms of unit rows x."""
    scale = np.abs(x).max(axis=1) / 127.0
    codes = np.rint(x / scale[:, None]).astype(np.int8)
    residual = np.linalg.norm(x - codes * scale[:, None], axis=1)
    return codes, scale, residual


def linked_pairs(a: np.ndarray, b: np.ndarray, threshold: float, same: bool, block: int = 512):
    """Index pairs (i, j) of rows of a and b with cosine >= threshold; same: b is a, i < j.

    |x.y - sx sy qx.qy| <= |sx qx| ey + ex |y| <= (1 + ex) ey + ex for unit x, y with
    residual norms ex, ey. Pairs that can't reach the threshold within this bound are
    dropped; for the rest the cosine is computed from the vectors in double precision.
    The int8 products run as float32 matrix products, which are exact below 2**24.
    """
    ua, ub = a / np.linalg.norm(a, axis=1)[:, None], b / np.linalg.norm(b, axis=1)[:, None]
    (qa, sa, ea), (qb, sb, eb) = quantise(ua), quantise(ub)
    kind = np.float32 if a.shape[1] * 127 * 127 < 2**24 else np.float64
    qb_t = qb.astype(kind).T
    for at in range(0, len(a), block):
        to = slice(at, at + block)
        product = (qa[to].astype(kind) @ qb_t).astype(np.float64) * sa[to, None] * sb[None, :]
        bound = (1 + ea[to, None]) * eb[None, :] + ea[to, None] + ROUNDING
        i, j = np.nonzero(product + bound >= threshold)
        i += at
        if same:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), 65536):
            p, q = i[k : k + 65536], j[k : k + 65536]
            ok = np.einsum("ij,ij->i", ua[p], ub[q]) >= threshold
            if ok.any():
                yield p[ok], q[ok]


def local_roots(n: int, pairs: list[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """The least index of each of n nodes' component."""
    root = np.arange(n)
    while True:
        new = root.copy()
        for i, j in pairs:
            low = np.minimum(new[i], new[j])
            np.minimum.at(new, i, low)
            np.minimum.at(new, j, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def near_duplicates(
    vectors: DataFrame, threshold: float = 0.93, tile: int = 2048, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label"
) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row.

    Vectors link when their labels are equal and not null and their cosine is at least the
    threshold. Null, empty, zero vectors, vectors with null or non-finite components and
    vectors of different length link with nothing (0 links, own component). Equal vectors
    are collapsed first and counted by multiplicity. The rest of a label is dealt by hash
    into tiles of about `tile` vectors; a task compares two tiles and returns link counts
    and a spanning forest, never the pairs. An empty table gives no rows; other columns are
    ignored. Ids should be unique: rows of one id are one node, which has the links of all of
    them; a row of null id links with nothing but its equals and has null for kept. The
    number of tile products grows with the square of a
    label's distinct vectors: exactness at any cosine threshold needs it.
    """
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("x"), F.col(label_col).alias("label"))
    usable = rows.where(
        F.col("label").isNotNull() & F.col("vec_id").isNotNull() & F.col("x").isNotNull()
        & F.exists("x", lambda c: c != 0)
        & F.forall("x", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    )
    # a null inside makes exists/forall null, which where() drops as well
    classes = staged(usable.groupBy("label", "x").agg(F.min("vec_id").alias("rep"), F.count("*").alias("copies")))
    sizes = classes.groupBy("label", F.size("x").alias("dim")).agg(F.ceil(F.count("*") / F.lit(tile)).cast("int").alias("tiles"))
    placed = (
        classes.withColumn("dim", F.size("x")).join(sizes, ["label", "dim"])
        .withColumn("own", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
        .withColumn("other", F.explode(F.expr("sequence(0, tiles - 1)")))
        .select("label", "dim", F.least("own", "other").alias("ti"), F.greatest("own", "other").alias("tj"), "own", "rep", "copies", "x")
    )

    def compare(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        ti, tj = int(key[2]), int(key[3])
        pdf = pdf.sort_values("rep", ignore_index=True)
        rep, copies, own = (pdf[c].to_numpy() for c in ("rep", "copies", "own"))
        x = np.stack(pdf["x"].to_numpy()).astype(np.float64)
        x /= np.abs(x).max(axis=1)[:, None]  # no overflow in the norms
        left, right = np.nonzero(own == ti)[0], np.nonzero(own == tj)[0]
        pairs = [(left[i], right[j]) for i, j in linked_pairs(x[left], x[right], threshold, ti == tj)] if len(left) and len(right) else []
        links = np.zeros(len(rep), np.int64)
        for i, j in pairs:
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
        root = local_roots(len(rep), pairs)
        has = links > 0
        return pd.DataFrame({"node": rep[has], "links": links[has], "root": rep[root[has]]})

    found = staged(placed.groupBy("label", "dim", "ti", "tj").applyInPandas(compare, "node long, links long, root long"))
    comp = connected_components(found.select("node", "root").where("node != root"))
    counts = found.groupBy("node").agg(F.sum("links").alias("links"))
    of_class = staged(
        classes.select("label", "x", "rep", "copies")
        .join(counts, F.col("rep") == F.col("node"), "left").drop("node")
        .join(comp, F.col("rep") == F.col("node"), "left")
        .select("label", "x", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("component", "rep").alias("component_id"))
    )
    return rows.join(of_class, ["label", "x"], "left").select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.coalesce("component_id", "vec_id").alias("component_id"),
    ).withColumn("kept", F.col("vec_id") == F.col("component_id"))
