"""SimHash near-duplicate grouping by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import connected_components, fresh, known_id, staged, with_null_ids


def fingerprint(text: str | None, width: int = 3, seed: int = 42) -> int:
    """64-bit SimHash of a text's word shingles as a signed integer; no words: 0."""
    # bytes.lower and bytes.split know ASCII only: A-Z, and \x20 \x09-\x0D
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    digest = xxhash.xxh64_intdigest
    if len(words) <= width:
        hashes = [digest(b" ".join(words), seed)]
    else:
        hashes = [digest(b" ".join(s), seed) for s in zip(*(words[i:] for i in range(width)), strict=False)]
    ones = np.zeros(64, np.int64)
    h = np.array(hashes, "<u8")
    for at in range(0, len(h), 65536):
        part = h[at : at + 65536]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(h), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fp) of every row; null and empty texts have fingerprint 0."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "fp": [fingerprint(t, width) for t in b["text"]]})

    return docs.select(known_id(id_col), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, fp long").transform(with_null_ids)


def ball_edges(prints: DataFrame) -> DataFrame:
    """Links (a, b) between the least documents of fingerprints that differ in 1 or 2 bits.

    prints: (fp, doc_id), one row per distinct fp. Every fingerprint goes to itself and the
    64 values one bit away: two fingerprints within two bits meet at a value between them.
    A value's ball holds at most 65 distinct fingerprints, so a group is bounded, and a
    star to its least document carries the same connectivity as all of its pairs.
    """
    flips = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda i: F.col("fp").bitwiseXOR(F.call_function("shiftleft", F.lit(1).cast("long"), i)))
    variants = prints.select("fp", "doc_id", F.explode(F.concat(F.array("fp"), flips)).alias("variant"))
    balls = (
        variants.groupBy("variant")
        .agg(F.collect_list(F.struct("doc_id", "fp")).alias("members"))
        .where(F.size("members") > 1)
        .select("members", F.array_min("members").alias("least"))
    )
    return (
        balls.select("least", F.explode("members").alias("m"))
        .where((F.col("m.doc_id") != F.col("least.doc_id")) & (F.bit_count(F.col("m.fp").bitwiseXOR(F.col("least.fp"))) <= 2))
        .select(F.col("m.doc_id").alias("a"), F.col("least.doc_id").alias("b"))
        .distinct()
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row of docs.

    fingerprint: 16 lower-case hex digits. component_id: the least id reachable over links
    of fingerprints that differ in at most two bits. Rows with equal fingerprints are one
    node, so copies are never paired. Null texts count as empty (fingerprint 0, linked like
    any other); a null id keeps its fingerprint and joins no group; repeated rows come out
    repeated; an empty table gives no rows; further columns of docs are ignored.
    """
    fps = staged(fingerprints(docs, id_col, text_col, width))
    prints = staged(fps.where("doc_id is not null").groupBy("fp").agg(F.min("doc_id").alias("doc_id")))
    comp = connected_components(ball_edges(prints))
    of_print = staged(
        prints.join(comp, prints.doc_id == comp.node, "left").select("fp", F.coalesce("component", "doc_id").alias("component_id"))
    )
    return fps.join(of_print, "fp", "left").select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"),
    )


def keep_one(docs: DataFrame, width: int = 3) -> DataFrame:
    """docs without the later members of each near-duplicate group; the least doc_id stays.

    All columns stay, whatever their names. Rows of a null id stay; of equal rows all stay or
    all go; null and empty texts are one group; an empty table stays empty.
    """
    groups = near_duplicates(docs.select("doc_id", "text"), width=width)
    later = groups.where("doc_id != component_id").select(F.col("doc_id").alias(fresh(docs, "later"))).distinct()
    later = staged(later)  # its size decides how it is joined
    return docs.join(later, docs["doc_id"] == later[later.columns[0]], "left_anti")
