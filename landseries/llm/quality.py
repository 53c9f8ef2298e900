"""Quality classifier: additive lookup tables with pairwise terms, fitted by cyclic boosting."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import combinations
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import known_id, staged, with_null_ids
from landseries.llm.langid import remainder

FEATURES = (
    "log_words", "word_length", "upper", "digits", "stops", "symbols", "high_bytes", "line_breaks", "distinct_words", "repeats",
    "top_word", "line_length", "repeated_lines", "short_words", "long_words", "distinct_bytes", "byte_entropy", "words_in_a_line",
)


def features(text: str | None) -> list[float]:
    """The features of a whole text; null counts as empty."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    n = max(len(raw), 1)
    h = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    words = raw.split()
    k = max(len(words), 1)
    lengths = np.fromiter(map(len, words), np.int32, len(words))
    lines = [x for x in raw.split(b"\n") if x]
    m = max(len(lines), 1)
    stops = int(h[[33, 44, 46, 58, 59, 63]].sum())
    alnum = int(h[48:58].sum() + h[65:91].sum() + h[97:123].sum())
    p = h[h > 0] / n
    count = Counter(words)
    return [
        np.log1p(len(words)), len(raw) / k, h[65:91].sum() / n, h[48:58].sum() / n, h[[44, 46]].sum() / n,
        (h[:128].sum() - alnum - stops - h[[9, 10, 13, 32]].sum() + h[33]) / n, h[128:].sum() / n, h[10] / n, len(count) / k,
        sum(map(eq, words, words[1:])) / k, max(count.values(), default=0) / k, np.log1p(len(raw) / m), 1 - len(set(lines)) / m,
        (lengths <= 3).sum() / k, (lengths >= 14).sum() / k, np.count_nonzero(h), -(p * np.log2(p)).sum(), np.log1p(k / m),
    ]


def feature_table(docs: DataFrame) -> DataFrame:
    """(doc_id, x) with the features of every row."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield pd.DataFrame({"doc_id": b["doc_id"], "x": [list(map(float, features(t))) for t in b["text"]]})

    return docs.select(known_id(), "text").mapInPandas(run, "doc_id long, x array<double>").transform(with_null_ids)


def shallow_tree(g: np.ndarray, h: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Leaf values by bin of a regression tree on one binned feature, split greedily."""
    cuts = [0, len(g)]
    G, H = np.concatenate([[0], np.cumsum(g)]), np.concatenate([[0], np.cumsum(h)])
    value = lambda a, b: (G[b] - G[a]) ** 2 / (H[b] - H[a] + ridge)
    while len(cuts) <= leaves:
        best = (1e-9, None)
        for a, b in zip(cuts, cuts[1:], strict=False):
            if b - a > 1:
                c = np.arange(a + 1, b)
                gain = value(a, c) + value(c, b) - value(a, b)
                i = int(gain.argmax())
                best = max(best, (float(gain[i]), int(c[i])), key=lambda x: x[0])
        if best[1] is None:
            break
        cuts = sorted([*cuts, best[1]])
    out = np.zeros(len(g))
    for a, b in zip(cuts, cuts[1:], strict=False):
        out[a:b] = (G[b] - G[a]) / (H[b] - H[a] + ridge)
    return out


def quadrants(g: np.ndarray, h: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values by bin pair of the best tree with one cut on each of two features."""
    G, H = (np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0))) for x in (g, h))
    i, j = np.meshgrid(np.arange(1, g.shape[0]), np.arange(1, g.shape[1]), indexing="ij")
    parts = []
    for T in (G, H):
        parts.append((T[i, j], T[i, -1] - T[i, j], T[-1, j] - T[i, j], T[-1, -1] - T[i, -1] - T[-1, j] + T[i, j]))
    score = sum(a * a / (b + ridge) for a, b in zip(*parts, strict=True))
    at = np.unravel_index(score.argmax(), score.shape)
    v = [a[at] / (b[at] + ridge) for a, b in zip(*parts, strict=True)]
    out = np.empty(g.shape)
    a, b = at[0] + 1, at[1] + 1
    out[:a, :b], out[:a, b:], out[a:, :b], out[a:, b:] = v
    return float(score[at] - g.sum() ** 2 / (h.sum() + ridge)), out


class AdditiveModel:
    """Intercept, a table per feature and tables for some pairs of features, over quantile bins."""

    def __init__(self, x: np.ndarray, y: np.ndarray, bins: int = 32, coarse: int = 8, rounds: int = 150, pairs: int = 8, rate: float = 0.1, leaves: int = 3, ridge: float = 5.0):
        self.edges = [np.unique(np.quantile(c, np.linspace(0, 1, bins + 1)[1:-1])) for c in x.T]
        self.coarse = [np.unique(np.quantile(c, np.linspace(0, 1, coarse + 1)[1:-1])) for c in x.T]
        b, q = self.binned(x, self.edges), self.binned(x, self.coarse)
        p = np.clip(y.mean(), 1e-3, 1 - 1e-3)
        self.base = float(np.log(p / (1 - p)))
        self.tables = [np.zeros(len(e) + 1) for e in self.edges]
        self.pairs: dict[tuple[int, int], np.ndarray] = {}
        score = np.full(len(y), self.base)

        def residual() -> tuple[np.ndarray, np.ndarray]:
            s = 1 / (1 + np.exp(-score))
            return y - s, s * (1 - s)

        for _ in range(rounds):
            for j, table in enumerate(self.tables):
                g, h = residual()
                step = rate * shallow_tree(np.bincount(b[j], g, len(table)), np.bincount(b[j], h, len(table)), leaves, ridge)
                table += step
                score += step[b[j]]
        shape = lambda i, j: (len(self.coarse[i]) + 1, len(self.coarse[j]) + 1)

        def fit(i: int, j: int) -> tuple[float, np.ndarray]:
            g, h = residual()
            (m, n) = shape(i, j)
            at = q[i] * n + q[j]
            return quadrants(*(np.bincount(at, w, m * n).reshape(m, n) for w in (g, h)), ridge)

        able = [(i, j) for i, j in combinations(range(x.shape[1]), 2) if min(shape(i, j)) > 1]
        chosen = sorted(able, key=lambda p: -fit(*p)[0])[:pairs]
        self.pairs = {p: np.zeros(shape(*p)) for p in chosen}
        for _ in range(rounds // 2):
            for (i, j), table in self.pairs.items():
                step = rate * fit(i, j)[1]
                table += step
                score += step[q[i], q[j]]

    @staticmethod
    def binned(x: np.ndarray, edges: list[np.ndarray]) -> list[np.ndarray]:
        return [np.searchsorted(e, c, "right") for e, c in zip(edges, x.T, strict=True)]

    def score(self, x: np.ndarray) -> np.ndarray:
        b, q = self.binned(x, self.edges), self.binned(x, self.coarse)
        total = self.base + sum(t[c] for t, c in zip(self.tables, b, strict=True)) + sum(t[q[i], q[j]] for (i, j), t in self.pairs.items())
        return 1 / (1 + np.exp(-total))


def classify(docs: DataFrame, labels: DataFrame, train_rows: int = 20_000, folds: int = 3, held_out: int = 1) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row of docs (doc_id, text).

    Labels (doc_id, quality) are learned from outside the held-out fold, on a bounded sample
    of about train_rows labelled rows drawn by a hash of the id; null labels are skipped, and
    an id with several labels counts once for each. Null texts count as empty and are scored.
    Without any label every score is 0.5. Null ids are scored and not learned from; repeated
    rows come out repeated; an empty table gives no rows; further columns are ignored.
    """
    spark = docs.sparkSession
    table = staged(feature_table(docs))
    fold = remainder("doc_id", folds)
    usable = labels.select("doc_id", F.col("quality").cast("double").alias("y")).where((fold != held_out) & F.col("y").isin(0.0, 1.0))
    share = min(1.0, train_rows / max(1, usable.count()))
    drawn = usable.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    sample = table.join(drawn, "doc_id").orderBy("doc_id", "y").toPandas()
    model = AdditiveModel(np.stack(sample["x"].to_numpy()), sample["y"].to_numpy(float)) if len(sample) else None
    shared = spark.sparkContext.broadcast(model)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        m = shared.value
        for b in batches:
            s = m.score(np.stack(b["x"].to_numpy())) if m and len(b) else np.full(len(b), 0.5)
            yield pd.DataFrame({"doc_id": b["doc_id"], "score": s, "predicted": (s >= 0.5).astype(np.int32)})

    scored = with_null_ids(table.select(known_id(), "x").mapInPandas(run, "doc_id long, score double, predicted int"))
    return scored.select("doc_id", F.coalesce(fold == held_out, F.lit(False)).alias("held_out"), "score", "predicted")
