"""Language-model scores from a probabilistic suffix tree over bytes, beside word counts.

A text is its lower-cased words joined by single spaces, then one end symbol. Contexts are
the last one to DEPTH bytes. Those of up to LOW bytes all stay in the tree; a longer one stays
if its next-byte distribution differs enough from its suffix's: n * KL(context || suffix)
bits, summed over the corpus, less what describing the distribution costs, is the divergence
test. Distributions are smoothed towards the suffix's, down to the uniform one. There is no
limit on states: all that share their last GROUP bytes are one row of a stored table.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import known_id, largest, staged, with_null_ids
from landseries.llm.langid import remainder
from landseries.llm.tokens import batches_of, words_of

DEPTH, LOW, GROUP = 5, 2, 3
#: White space never stands inside a normalised text but as single spaces.
START, END = b"\n" * DEPTH, b"\n"
#: The key of the end token among the word hashes.
END_KEY = -1


def normalised(text: str | None) -> bytes:
    return b" ".join((text or "").encode("utf-8", "surrogatepass").lower().split())


def framed(texts: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(START + t + END for t in texts), np.uint8)


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """The sums of several (keys, counts)."""
    keys = np.concatenate([k for k, _ in parts])
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], np.concatenate([c for _, c in parts])[order]
    first = np.nonzero(np.diff(keys, prepend=keys[:1] - 1))[0] if len(keys) else np.zeros(0, int)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def counted(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    v = np.sort(values)
    first = np.nonzero(np.concatenate([[True], v[1:] != v[:-1]]))[0] if len(v) else np.zeros(0, int)
    return v[first], np.diff(np.append(first, len(v)))


def count_keys(docs: DataFrame, of) -> DataFrame:
    """(key, n): how often each key that of(texts) gives occurs, over all rows; summed per task first."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for b in batches:
            texts = [normalised(t) for t in b["text"]]
            for i, j in batches_of(texts, 1 << 22):
                held.append(counted(of(texts[i:j])))
                size += len(held[-1][0])
                if size > 4_000_000:  # bounded memory, whatever the task reads
                    keys, n = merged(held)
                    held, size = [(keys, n)], len(keys)
                    if size > 2_000_000:
                        yield pd.DataFrame({"key": keys, "n": n})
                        held, size = [], 0
        if held:
            keys, n = merged(held)
            yield pd.DataFrame({"key": keys, "n": n})

    parts = docs.select("text").mapInPandas(run, "key long, n long")
    return parts.groupBy("key").agg(F.sum("n").alias("n"))


def word_keys(texts: list[bytes]) -> np.ndarray:
    return np.append(words_of(texts)[0].view(np.int64), np.full(len(texts), END_KEY, np.int64))


def gram_keys(texts: list[bytes]) -> np.ndarray:
    """Every byte of the texts and their ends with the DEPTH bytes before it, as one number each."""
    raw = framed(texts).astype(np.int64)
    n = len(raw) - DEPTH
    g = np.zeros(n, np.int64)
    for k in range(DEPTH + 1):
        g = (g << 8) | raw[k : k + n]
    sizes = np.array([len(t) + 1 for t in texts])
    keep = np.ones(len(g), bool)
    ends = np.cumsum(sizes + DEPTH)[:-1]
    for k in range(DEPTH):  # these end in the next text's start
        keep[ends - DEPTH + k] = False
    return g[keep]


class Model:
    """What scoring needs: the low levels whole, states of longer contexts by their last GROUP bytes.

    Every state adds, for the symbols seen after it, a log10 probability, and for all others a
    weight times the probability at its suffix. Contexts of up to LOW bytes are all states.
    """

    def __init__(self, trigrams: np.ndarray, counts: np.ndarray, cold: np.ndarray, packed: list[bytes]):
        self.cold = cold
        self.levels: dict[int, tuple[np.ndarray, ...]] = low_levels(trigrams, counts)
        parts = [unpack_states(x) for x in packed]
        for k in range(LOW + 1, DEPTH + 1):
            own = [p[k] for p in parts]
            state, weight, gram, log_p = (np.concatenate([x[i] for x in own]) if own else np.empty(0, kind) for i, kind in enumerate((np.int64, np.float32, np.int64, np.float32)))
            a, b = np.argsort(state, kind="stable"), np.argsort(gram, kind="stable")
            self.levels[k] = state[a], weight[a], gram[b], log_p[b]

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """log10 probability of each gram's last byte after the longest state among its suffixes."""
        out, open_ = np.zeros(len(grams)), np.arange(len(grams))
        for k in range(DEPTH, -1, -1):
            state, weight, gram, log_p = self.levels[k]
            key = grams[open_] % 256 ** (k + 1)
            if len(state):
                at = np.minimum(np.searchsorted(gram, key), len(gram) - 1)
                hit = gram[at] == key
                out[open_[hit]] += log_p[at[hit]]
                rest, key = open_[~hit], key[~hit] >> 8
                at = np.minimum(np.searchsorted(state, key), len(state) - 1)
                out[rest] += np.where(state[at] == key, weight[at], 0)
                open_ = rest
        out[open_] -= np.log10(256)
        return out


def smoothed(n: np.ndarray, total: np.ndarray, kinds: np.ndarray, below: np.ndarray) -> np.ndarray:
    """Counts n of contexts with these totals and numbers of different symbols, smoothed towards the suffix (Witten-Bell)."""
    return (n + kinds * below) / (total + kinds)


def level_of(gram: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Contexts with their totals and numbers of symbols, and each gram's place among them; grams are sorted."""
    context = gram >> 8
    first = np.nonzero(np.diff(context, prepend=-1))[0] if len(gram) else np.zeros(0, int)
    kinds = np.diff(np.append(first, len(gram)))
    total = np.add.reduceat(n, first) if len(first) else n
    return context[first], total, kinds, np.repeat(np.arange(len(first)), kinds)


def low_levels(trigrams: np.ndarray, counts: np.ndarray) -> dict[int, tuple[np.ndarray, ...]]:
    """Levels 0 to LOW from the counts of all contexts of LOW bytes with their next byte."""
    grams = {LOW: (trigrams, counts)}
    for k in range(LOW - 1, -1, -1):
        grams[k] = merged([(grams[k + 1][0] % 256 ** (k + 1), grams[k + 1][1])])
    levels, p = {}, None
    for k in range(LOW + 1):
        gram, n = grams[k]
        context, total, kinds, of = level_of(gram, n)
        below = np.full(len(gram), 1 / 256) if k == 0 else p[np.searchsorted(grams[k - 1][0], gram % 256**k)]
        p = smoothed(n, total[of], kinds[of], below) if len(gram) else np.zeros(0)
        levels[k] = context, np.log10(kinds / (total + kinds)).astype(np.float32), gram, np.log10(p).astype(np.float32)
    return levels


def states_of(key: np.ndarray, n: np.ndarray, low: dict[int, tuple[np.ndarray, ...]], min_gain: float) -> dict[int, tuple[np.ndarray, ...]]:
    """The states (context, log10 weight, gram, log10 p) of depths LOW + 1 to DEPTH, from all grams of their last GROUP bytes.

    A context is a state if coding its symbols by its own distribution instead of its
    suffix's saves min_gain bits beyond what describing the distribution costs, or if a
    longer context that ends in it is one.
    """
    grams = {DEPTH: (key, n)}
    for k in range(DEPTH - 1, LOW, -1):
        grams[k] = merged([(grams[k + 1][0] % 256 ** (k + 1), grams[k + 1][1])])
    levels = {k: level_of(*g) for k, g in grams.items()}
    out, p = {}, None
    kept = {k: np.zeros(len(x[0]), bool) for k, x in levels.items()}
    for k in range(LOW + 1, DEPTH + 1):
        gram, count = grams[k]
        context, total, kinds, of = levels[k]
        at = np.searchsorted(low[LOW][2] if k == LOW + 1 else grams[k - 1][0], gram % 256**k)
        below = 10.0 ** low[LOW][3][at] if k == LOW + 1 else p[at]
        p = smoothed(count, total[of], kinds[of], below)
        saved = np.bincount(of, count * np.log2(p / below), len(context))
        kept[k] = saved - 0.5 * kinds * np.log2(total + 1) >= min_gain
        out[k] = context, np.log10(kinds / (total + kinds)), gram, np.log10(p)
    for k in range(DEPTH, LOW + 1, -1):
        up = np.searchsorted(levels[k - 1][0], levels[k][0][kept[k]] % 256 ** (k - 1))
        kept[k - 1][up] = True
    return {k: (c[kept[k]], w[kept[k]], g[kept[k][levels[k][3]]], q[kept[k][levels[k][3]]]) for k, (c, w, g, q) in out.items()}


def pack_states(states: dict[int, tuple[np.ndarray, ...]]) -> bytes:
    sizes = np.array([len(x) for k in sorted(states) for x in (states[k][0], states[k][2])], "<i8")
    parts = [x.astype(t).tobytes() for k in sorted(states) for x, t in zip(states[k], ("<i8", "<f4", "<i8", "<f4"), strict=True)]
    return zlib.compress(sizes.tobytes() + b"".join(parts), 1)


def unpack_states(packed: bytes) -> dict[int, tuple[np.ndarray, ...]]:
    raw, levels, at = zlib.decompress(packed), range(LOW + 1, DEPTH + 1), 0
    sizes = np.frombuffer(raw, "<i8", 2 * len(levels))
    at, out = sizes.nbytes, {}
    for k, (states, grams) in zip(levels, sizes.reshape(-1, 2), strict=True):
        out[k] = ()
        for size, kind in ((states, "<i8"), (states, "<f4"), (grams, "<i8"), (grams, "<f4")):
            part = np.frombuffer(raw, kind, size, at)
            out[k] += (part,)
            at += part.nbytes
    return out


def grow(grams: DataFrame, min_gain: float) -> tuple[np.ndarray, np.ndarray, DataFrame]:
    """Counts of contexts of LOW bytes with their next byte (at most 2**24, in fact as many as the
    writing systems have), and the table (part, n, entries, states) of all longer states by their last
    GROUP bytes. Divergence tests, smoothing and states stay in Spark and grow with the corpus."""
    spark = grams.sparkSession
    low = grams.groupBy((F.col("key") % F.lit(256 ** (LOW + 1))).alias("gram")).agg(F.sum("n").alias("n")).toPandas().sort_values("gram")
    trigrams, counts = low["gram"].to_numpy(np.int64), low["n"].to_numpy(np.int64)
    shared = spark.sparkContext.broadcast((trigrams, counts))

    def build(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels = low_levels(*shared.value)
        held: list[tuple[np.ndarray, ...]] = []

        def done() -> Iterator[pd.DataFrame]:
            part, key, n = (np.concatenate(x) for x in zip(*held, strict=True))
            cuts = np.nonzero(np.diff(part, prepend=-1))[0]
            for i, j in zip(cuts, np.append(cuts[1:], len(part)), strict=True):
                order = np.argsort(key[i:j], kind="stable")
                states = states_of(key[i:j][order], n[i:j][order], levels, min_gain)
                size = sum(len(s[2]) for s in states.values())
                if size:
                    yield pd.DataFrame({"part": [part[i]], "n": [int(n[i:j].sum())], "entries": [size], "states": [pack_states(states)]})

        for b in batches:
            part, key, n = (b[c].to_numpy() for c in ("part", "key", "n"))
            cut = int(np.searchsorted(part, part[-1])) if len(part) else 0
            if cut:
                held.append((part[:cut], key[:cut], n[:cut]))
                yield from done()
                held = []
            if len(part):
                if held and held[0][0][0] != part[cut]:
                    yield from done()
                    held = []
                held.append((part[cut:], key[cut:], n[cut:]))
        if held:
            yield from done()

    part = F.expr(f"(key div 256) % {256**GROUP}")
    rows = grams.select(part.alias("part"), "key", "n").repartition("part").sortWithinPartitions("part")
    return trigrams, counts, staged(rows.mapInPandas(build, "part long, n long, entries long, states binary"))


def loaded(trigrams: np.ndarray, counts: np.ndarray, states: DataFrame, cached: int) -> Model:
    """A model with the states of the commonest last bytes, at most `cached` entries; the others are marked cold."""
    density = F.floor(F.log2(F.col("n") / F.col("entries")) * 8)
    sizes = sorted(((r[0], r[1]) for r in states.groupBy(density).agg(F.sum("entries")).collect()), reverse=True)
    total, least = 0, None
    for d, size in sizes:
        total += size
        if total > cached:
            break
        least = d
    hot = (density >= F.lit(least)) if least is not None else F.lit(False)
    cold = np.zeros(256**GROUP, bool)
    cold[states.where(~hot).select("part").toPandas()["part"].to_numpy(np.int64)] = True
    return Model(trigrams, counts, np.packbits(cold), [r[0] for r in states.where(hot).select("states").toLocalIterator()])


def score(docs: DataFrame, folds: int = 7, held_out: int = 2, frequent: int = 100_000, min_gain: float = 4.0, cached: int = 4_000_000) -> DataFrame:
    """Scores of every row of docs (doc_id, text), learned from the rows outside the held-out fold.

    Returns doc_id, held_out, n_tokens, n_known, train_tokens, base_score (word counts with
    add-one smoothing) and score (the suffix tree's log10 probability). Null texts count as
    empty: their only token is the end. Rows of a null id are learned from (their remainder
    isn't the held-out one) and count as not held out. Repeated rows come out repeated; an
    empty table gives no rows; further columns are ignored. Words are told apart by 64-bit hashes.

    Tasks hold the counts of the `frequent` commonest words and the tree's entries, up to
    `cached`, of the commonest last bytes. Other words and other bytes meet their counts and
    states in joins, so no part of the vocabulary or the tree is left out.
    """
    spark = docs.sparkSession
    fold = F.coalesce(remainder("doc_id", folds) == held_out, F.lit(False))
    training = docs.where(~fold).select("text")
    counts = staged(count_keys(training, word_keys))
    total, vocabulary = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    trigrams, numbers, states = grow(staged(count_keys(training, gram_keys)), min_gain)
    top = largest(counts, "n", frequent).toPandas().sort_values("key")
    known = spark.sparkContext.broadcast((top["key"].to_numpy(np.int64), top["n"].to_numpy(np.int64)))
    shared = spark.sparkContext.broadcast(loaded(trigrams, numbers, states, cached))
    size = np.log10(total + vocabulary + 1.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        keys, n = known.value
        keys, n = np.append(keys, np.iinfo(np.int64).max), np.append(n, 0)
        cold = np.unpackbits(model.cold)
        for b in batches:
            texts = [normalised(t) for t in b["text"]]
            rows = b["row"].to_numpy()
            for i, j in batches_of(texts, 1 << 20):
                hashes, sizes = words_of(texts[i:j])
                words = np.append(hashes.view(np.int64), np.full(j - i, END_KEY, np.int64))
                doc = np.append(np.repeat(np.arange(j - i), sizes), np.arange(j - i))
                at = np.searchsorted(keys, words)
                found = keys[at] == words
                c = n[at] * found
                here = doc[found]
                grams = gram_keys(texts[i:j])
                of = np.repeat(np.arange(j - i), [len(t) + 1 for t in texts[i:j]])
                away = cold[grams >> 8 & 256**GROUP - 1] > 0
                distinct, place = np.unique(grams[~away], return_inverse=True)
                logs = np.bincount(of[~away], model.log_p(distinct)[place], j - i)
                yield pd.DataFrame({
                    "row": rows[i:j], "doc_id": b["doc_id"].to_numpy()[i:j], "kind": 0, "key": pd.array([None] * (j - i), "Int64"), "n": sizes + 1,
                    "known": np.bincount(here, c[found] > 0, j - i).astype(np.int64),
                    "base": np.bincount(here, np.log10(c[found] + 1.0) - size, j - i), "score": logs,
                })
                for kind, w, d in ((1, words[~found], doc[~found]), (2, grams[away], of[away])):
                    if len(w):
                        order = np.lexsort((w, d))
                        w, d = w[order], d[order]
                        first = np.nonzero(np.concatenate([[True], (w[1:] != w[:-1]) | (d[1:] != d[:-1])]))[0]
                        yield pd.DataFrame({"row": rows[i:j][d[first]], "doc_id": 0, "kind": kind, "key": w[first], "n": np.diff(np.append(first, len(w))), "known": None, "base": None, "score": None})

    numbered = docs.select(known_id(), "text", F.monotonically_increasing_id().alias("row"))
    both = staged(numbered.mapInPandas(run, "row long, doc_id long, kind int, key long, n long, known long, base double, score double"))
    c = F.coalesce("c", F.lit(0))
    rest = (
        both.where("kind = 1").select("row", "key", "n")
        .join(counts.withColumnRenamed("n", "c"), "key", "left")
        .groupBy("row")
        .agg(F.sum(F.when(c > 0, F.col("n")).otherwise(0)).alias("more"), F.sum(F.col("n") * (F.log10(c + 1.0) - F.lit(float(size)))).alias("rest"))
    )
    sums = with_null_ids(both.where("kind = 0").select("row", "doc_id", "n", "known", "base", "score")).join(rest, "row", "left")
    sums = sums.join(cold_scores(both.where("kind = 2").select("row", "key", "n"), trigrams, numbers, states), "row", "left")
    return sums.select(
        "doc_id", fold.alias("held_out"), F.col("n").alias("n_tokens"),
        (F.col("known") + F.coalesce("more", F.lit(0))).alias("n_known"), F.lit(int(total)).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rest", F.lit(0.0))).alias("base_score"), (F.col("score") + F.coalesce("cold", F.lit(0.0))).alias("score"),
    )


def cold_scores(asked: DataFrame, trigrams: np.ndarray, counts: np.ndarray, states: DataFrame) -> DataFrame:
    """(row, cold): the summed log10 probabilities of asked (row, key, n), by the states of their last bytes."""
    shared = asked.sparkSession.sparkContext.broadcast((trigrams, counts))
    part = F.expr(f"(key div 256) % {256**GROUP}")

    def look(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left):
            return pd.DataFrame({"row": [], "cold": []})
        model = Model(*shared.value, np.zeros(0, np.uint8), list(right["states"]))
        return pd.DataFrame({"row": left["row"], "cold": model.log_p(left["key"].to_numpy()) * left["n"]})

    keyed = asked.withColumn("part", part).withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(1 << 10)))
    held = states.select("part", "states").withColumn("bucket", F.pmod(F.xxhash64("part"), F.lit(1 << 10)))
    needed = held.join(keyed.select("part").distinct(), "part", "left_semi")
    found = keyed.groupBy("bucket").cogroup(needed.groupBy("bucket")).applyInPandas(look, "row long, cold double")
    return found.groupBy("row").agg(F.sum("cold").alias("cold"))
