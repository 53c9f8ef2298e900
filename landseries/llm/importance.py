"""Importance resampling towards a target collection, by bit-sliced sums over hashed word features."""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import NO_ID, fresh, known_id, staged, with_null_ids
from landseries.operators.ranks import ranked

BUCKETS = 10_000
#: Bytes of a plane: a bit a bucket, whole 64-bit words.
PLANE = -(-BUCKETS // 64) * 8

#: A-Z become a-z; ASCII other than letters and digits becomes white space.
WORD_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def buckets_of(text: str | None) -> tuple[int, np.ndarray]:
    """The number of words of a text, and the bucket of each run of one to three of them.

    A checksum goes on from that of the words before, so that no run is put together.
    """
    words = (text or "").encode("utf-8", "surrogatepass").translate(WORD_BYTES).split()
    ones = list(map(zlib.crc32, words))
    spaced = [b" " + w for w in words[1:]]
    twos = list(map(zlib.crc32, spaced, ones))
    threes = list(map(zlib.crc32, spaced[1:], twos))
    return len(words), np.array(ones + twos + threes, np.int64) % BUCKETS


def sliced(counts: np.ndarray) -> np.ndarray:
    """Counts by bucket as planes of bits: plane k holds bit k of each count."""
    levels = int(counts.max(initial=0)).bit_length()
    planes = np.zeros((levels, PLANE), np.uint8)
    for k in range(levels):
        planes[k, : BUCKETS // 8] = np.packbits((counts >> k & 1).astype(bool), bitorder="little")
    return planes


def feature_planes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_words, n_features, planes): the planes of a text's feature counts, one after the other."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch["text"]:
                n, found = buckets_of(text)
                rows.append((n, len(found), sliced(np.bincount(found, minlength=BUCKETS)).tobytes()))
            out = pd.DataFrame(rows, columns=["n_words", "n_features", "planes"])
            out.insert(0, "doc_id", batch["doc_id"].to_numpy())
            yield out

    return docs.select(known_id(id_col), F.col(text_col).alias("text")).mapInPandas(run, "doc_id long, n_words long, n_features long, planes binary")


def stacked(planes: pd.Series) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All planes of some rows as one matrix, with each plane's row and level."""
    levels = np.array([len(p) // PLANE for p in planes], np.int64)
    matrix = np.frombuffer(b"".join(planes), np.uint8).reshape(-1, PLANE)
    row = np.repeat(np.arange(len(levels)), levels)
    level = np.arange(len(row)) - np.repeat(np.cumsum(levels) - levels, levels)
    return matrix, row, level


def bucket_totals(sliced_rows: DataFrame) -> np.ndarray:
    """Counts by bucket over all rows: the planes of a level are added up bit by bit in tasks, then the tasks' sums."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            matrix, _, level = stacked(batch["planes"])
            for k in range(int(level.max(initial=-1)) + 1):
                own = matrix[level == k]
                for at in range(0, len(own), 512):
                    bits = np.unpackbits(own[at : at + 512, : BUCKETS // 8], axis=1, bitorder="little")
                    total += bits.sum(axis=0, dtype=np.int64) << k
        some = np.nonzero(total)[0]
        yield pd.DataFrame({"bucket": some, "n": total[some]})

    sums = sliced_rows.select("planes").mapInPandas(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    total = np.zeros(BUCKETS, np.int64)
    for r in sums.collect():  # a row per bucket
        total[r.bucket] = r.n
    return total


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of each bucket's smoothed shares in the target and in the corpus, rounded down."""
    s_all, t_all = float(corpus.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (s_all + BUCKETS) / ((s + 1.0) * (t_all + BUCKETS)))) for s, t in zip(corpus.tolist(), target.tolist(), strict=True)], np.int64)


def weights_of(matrix: np.ndarray, row: np.ndarray, level: np.ndarray, rows: int, gain: np.ndarray) -> np.ndarray:
    """The sum of gains over each row's features.

    A row's weight is the sum over its planes k, the bits m of a gain and both signs of
    (+ or -) 2**(k + m) times the buckets set in plane k and in the plane of bit m and sign.
    """
    words = matrix.view(np.uint64)
    weight = np.zeros(rows, np.int64)
    for sign in (1, -1):
        for m, plane in enumerate(sliced(np.maximum(sign * gain, 0)).view(np.uint64)):
            for at in range(0, len(words), 4096):
                to = slice(at, at + 4096)
                common = np.bitwise_count(words[to] & plane).sum(axis=1, dtype=np.int64)
                np.add.at(weight, row[to], sign * (common << (level[to] + m)))
    return weight


def noise(doc_id: int) -> int:
    """Thousandths of a Gumbel variate that an id fixes, rounded down; a null id is hashed as nothing."""
    h = int(hashlib.sha256(f"42:{'' if doc_id == NO_ID else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def resample(docs: DataFrame, target: DataFrame, percent: int = 5, least_words: int = 20, id_col: str = "doc_id", text_col: str = "text", target_text: str = "text") -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs, all long.

    weight: the sum over a document's features (runs of one to three words) of their
    bucket's gain towards the texts of target. score: weight plus noise that the id fixes.
    Of the N documents with at least least_words words the percent * N / 100 of the highest
    scores are drawn (ties: smaller id, nulls first) and ranked from 1; others have no rank.

    Counts cover all rows of both tables. Null texts have no words (weight 0); null ids
    stay null; repeated rows count and come out repeated, next to each other in rank; an
    empty target has gains from the corpus alone; an empty docs gives no rows; further
    columns are ignored.
    """
    of_docs = staged(feature_planes(docs, id_col, text_col))
    of_target = feature_planes(target.withColumn(fresh(target, "none"), F.lit(None).cast("long")), fresh(target, "none"), target_text)
    gain = gains(bucket_totals(of_docs), bucket_totals(of_target))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weight = weights_of(*stacked(batch["planes"]), len(batch), gain)
            out = batch[["doc_id", "n_words", "n_features"]].copy()
            out["weight"] = weight
            out["score"] = weight + np.array([noise(d) for d in batch["doc_id"].tolist()], np.int64)
            yield out

    scored = staged(with_null_ids(of_docs.mapInPandas(run, "doc_id long, n_words long, n_features long, weight long, score long")))
    able = scored.where(F.col("n_words") >= least_words)
    drawn = able.count() * percent // 100
    order = ranked(able, [F.desc("score"), "doc_id"])
    rest = scored.where(F.col("n_words") < least_words).withColumn("rank", F.lit(None).cast("long"))
    placed = order.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return placed.unionByName(rest).select("doc_id", "n_features", "weight", "score", "rank")
