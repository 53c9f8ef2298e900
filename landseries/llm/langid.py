"""Language identification by prediction by partial matching (PPM, method C with exclusion).

Each language gets a byte context tree of contexts up to three bytes. Its statistics are
frozen after training, so that the code length of a byte after a context is a fixed number:
a text's code length is a sum of table entries, computed with numpy in Spark tasks.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import fresh, staged

ORDER = 3
PAD = b"\n" * ORDER


def remainder(id_col: str, n: int) -> Column:
    """crc32 of the id as text, mod n; null for a null id."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % n


def encoded(text: str | None) -> bytes:
    return (text or "").lower().encode("utf-8", "surrogatepass")


def grams(raw: np.ndarray) -> np.ndarray:
    """The four-byte strings of a byte array as integers, the last byte lowest."""
    r = raw.astype(np.uint32)
    return (r[:-3] << 24) | (r[1:-2] << 16) | (r[2:-1] << 8) | r[3:]


class ContextTree:
    """Frozen PPM statistics of one language; contexts seen fewer than `least` times are pruned."""

    def __init__(self, gram: np.ndarray, count: np.ndarray, least: int):
        self.levels = []
        for k in range(ORDER, -1, -1):
            mask = np.uint32((1 << (8 * (k + 1))) - 1) if k < 3 else np.uint32(0xFFFFFFFF)
            keys, at = np.unique(gram & mask, return_inverse=True)
            c = np.bincount(at, weights=count, minlength=len(keys))
            ctx, inv = np.unique(keys >> np.uint32(8), return_inverse=True)
            n = np.bincount(inv, weights=c, minlength=len(ctx))
            keep = n >= (least if k else 1)
            rows = keep[inv]
            keys, c = keys[rows], c[rows]
            ctx, n = ctx[keep], n[keep]
            d = np.bincount(np.searchsorted(ctx, keys >> np.uint32(8)), minlength=len(ctx)).astype(float)
            self.levels.append({"k": k, "keys": keys, "c": c, "ctx": ctx, "n": n, "d": d})
        for low, high in zip(self.levels[1:], self.levels, strict=False):
            # what a context's symbols weigh one level below: they are excluded after an escape
            mask = np.uint32((1 << (8 * (low["k"] + 1))) - 1)
            below = low["c"][np.searchsorted(low["keys"], high["keys"] & mask)]
            high["out"] = np.bincount(np.searchsorted(high["ctx"], high["keys"] >> np.uint32(8)), weights=below, minlength=len(high["ctx"]))

    def bits(self, gram: np.ndarray) -> np.ndarray:
        """Code length of each gram's last byte after its first three."""
        total = np.zeros(len(gram))
        open_ = np.arange(len(gram))
        out, seen = np.zeros(len(gram)), np.zeros(len(gram))
        for level in self.levels:
            g = gram[open_]
            key = g & np.uint32((1 << (8 * (level["k"] + 1))) - 1) if level["k"] < 3 else g
            ctx = key >> np.uint32(8)
            if not len(level["ctx"]):
                continue
            at = np.minimum(np.searchsorted(level["ctx"], ctx), len(level["ctx"]) - 1)
            has = level["ctx"][at] == ctx
            n, d = level["n"][at] - out[open_], level["d"][at] - seen[open_]
            row = np.minimum(np.searchsorted(level["keys"], key), len(level["keys"]) - 1)
            hit = has & (level["keys"][row] == key)
            total[open_[hit]] -= np.log2(level["c"][row[hit]] / (n[hit] + d[hit]))
            miss = has & ~hit
            some = miss & (d > 0)
            total[open_[some]] -= np.log2(d[some] / (n[some] + d[some]))
            seen[open_[miss]] = level["d"][at[miss]]
            if level["k"]:
                out[open_[miss]] = level["out"][at[miss]]
            open_ = open_[~hit]
        total[open_] += np.log2(np.maximum(256 - seen[open_], 1))
        return total


class Model:
    """The trees of all languages, with the code lengths of all grams seen in training."""

    def __init__(self, counts: pd.DataFrame, least: int = 2, direct: int = 3000):
        self.langs = sorted(counts["lang"].unique())
        parts = [counts[counts["lang"] == x] for x in self.langs]
        self.trees = [ContextTree(p["gram"].to_numpy(np.uint32), p["n"].to_numpy(float), least) for p in parts]
        seen = np.unique(counts["gram"].to_numpy(np.uint32))
        pairs, weight = np.unique(seen >> np.uint32(16), return_counts=True)
        pairs = np.sort(pairs[np.argsort(-weight, kind="stable")[:direct]])
        self.pair = np.zeros(65536, np.int32)
        self.pair[pairs] = np.arange(1, len(pairs) + 1)
        self.side = len(pairs) + 1
        first, last = self.pair[seen >> np.uint32(16)], self.pair[seen & np.uint32(0xFFFF)]
        seen, first, last = (x[(first > 0) & (last > 0)] for x in (seen, first, last))
        #: Row of `table` by two pair numbers; 0: not there, the trees are asked.
        self.row = np.zeros(self.side * self.side, np.int32)
        self.row[first * self.side + last] = np.arange(1, len(seen) + 1)
        self.table = np.zeros((len(self.langs), len(seen) + 1), np.float32)
        for i, tree in enumerate(self.trees):
            self.table[i, 1:] = tree.bits(seen)

    def code_lengths(self, texts: list[bytes], block: int = 1 << 20) -> np.ndarray:
        """Bits of each text under each language."""
        sizes = np.array([len(t) + ORDER for t in texts])
        raw = np.frombuffer(b"".join(PAD + t for t in texts), np.uint8)
        starts = np.concatenate([[0], np.cumsum(sizes)])
        bits = np.zeros((len(texts), len(self.langs)))
        for at in range(0, len(raw) - ORDER, block):
            part = raw[at : at + block + ORDER]
            two = self.pair[(part[:-1].astype(np.int32) << 8) | part[1:]]
            row = self.row[two[:-2] * self.side + two[2:]]
            to = at + len(row)
            doc = np.searchsorted(starts, at, "right") - 1
            stop = np.searchsorted(starts, to, "left")
            edges = starts[doc + 1 : stop]  # texts that begin inside this block
            skip = np.zeros(len(row), bool)
            for back in range(1, ORDER + 1):  # grams that reach into the next text
                ends = starts[1:][(starts[1:] - back >= at) & (starts[1:] - back < to)] - back - at
                skip[ends] = True
            cuts = np.concatenate([[0], edges - at]).astype(np.int64)
            rare = np.nonzero((row == 0) & ~skip)[0]
            g = grams(part)[rare] if len(rare) else None
            group = np.searchsorted(cuts, rare, "right") - 1
            for i in range(len(self.langs)):
                cost = self.table[i][row]
                cost[skip] = 0
                sums = np.add.reduceat(cost, cuts, dtype=np.float64)
                if g is not None:
                    sums += np.bincount(group, weights=self.trees[i].bits(g), minlength=len(cuts))
                bits[doc : doc + len(cuts), i] += sums
        return bits


def train(labelled: DataFrame, docs_per_lang: int = 6000, least: int = 2) -> Model | None:
    """A model from rows (doc_id, text, lang) without null langs; None if there are none.

    A bounded sample: about docs_per_lang rows of each language, drawn by a hash of the id.
    """
    sizes = staged(labelled.groupBy("lang").count())  # stored, so that its size decides how it is joined
    drawn = labelled.join(sizes, "lang").where(
        F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < F.lit(float(docs_per_lang << 20)) / F.col("count")
    )

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for lang, part in b.groupby("lang"):
                found = [grams(np.frombuffer(PAD + t, np.uint8)) for t in map(encoded, part["text"]) if t]
                if found:
                    g, n = np.unique(np.concatenate(found), return_counts=True)
                    yield pd.DataFrame({"lang": lang, "gram": g.astype(np.int64), "n": n})

    counted = drawn.select("lang", "text").mapInPandas(count, "lang string, gram long, n long")
    counts = counted.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toPandas()
    return Model(counts, least) if len(counts) else None


def language(docs: DataFrame, model: Model | None) -> Column:
    """A struct (lang_pred, score, bits_per_byte) of the column text of docs.

    score: the best language's share of the posterior under equal priors. Ties go to the
    first language in order. Null texts, texts with no letter, and all texts of an
    untrained model: `und` with score 0 and null bits_per_byte.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    @F.pandas_udf("lang_pred string, score double, bits_per_byte double")
    def run(text: pd.Series, letters: pd.Series) -> pd.DataFrame:
        m = shared.value
        out = pd.DataFrame({"lang_pred": "und", "score": 0.0, "bits_per_byte": np.nan}, index=text.index)
        has = letters.to_numpy(bool) if m else np.zeros(len(text), bool)
        if has.any():
            texts = [encoded(t) for t in text[has]]
            bits = m.code_lengths(texts)
            low = bits.min(axis=1)
            out.loc[has, "lang_pred"] = [m.langs[i] for i in bits.argmin(axis=1)]
            out.loc[has, "score"] = 1 / np.exp2(np.maximum(low[:, None] - bits, -1000)).sum(axis=1)
            out.loc[has, "bits_per_byte"] = low / [len(t) for t in texts]
        return out

    return run("text", F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False)))


def trained(docs: DataFrame, docs_per_lang: int, folds: int = 3, held_out: int = 1) -> Model | None:
    fold = remainder("doc_id", folds)
    return train(docs.where((fold != held_out) & F.col("lang").isNotNull()).select("doc_id", "text", "lang"), docs_per_lang)


def identify(docs: DataFrame, docs_per_lang: int = 6000, folds: int = 3, held_out: int = 1) -> DataFrame:
    """Train on docs (doc_id, text, lang) outside the held-out fold and predict all rows.

    Returns doc_id, held_out, lang_pred, score, bits_per_byte. Rows of a null id aren't
    learned from and count as not held out. Further columns are ignored; repeated rows come
    out repeated; an empty table gives no rows.
    """
    fold = remainder("doc_id", folds)
    found = docs.select("doc_id", language(docs, trained(docs, docs_per_lang, folds, held_out)).alias("p"))
    return found.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "p.lang_pred", "p.score", "p.bits_per_byte")


def keep_identified(docs: DataFrame, docs_per_lang: int = 6000) -> DataFrame:
    """docs without those that no language explains.

    Rejected: `und`, and texts that the best language codes in 8 bits a byte or more, which
    is no better than bytes drawn evenly. Null and empty texts are `und` and go; rows of a null
    id are judged like others; equal rows stay or go together; an empty table stays empty. All columns stay, whatever their names, and nothing is shuffled but the training sample.
    """
    p = fresh(docs, "p")
    found = docs.withColumn(p, language(docs, trained(docs, docs_per_lang)))
    return found.where(f"{p}.lang_pred != 'und' and not coalesce({p}.bits_per_byte >= 8, false)").drop(p)
