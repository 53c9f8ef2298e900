"""Runs of words that repeat with a period, by block convolution at dyadic scales."""

from __future__ import annotations

import hashlib
import zlib
from collections import defaultdict
from collections.abc import Iterator
from functools import cache
from itertools import chain, count

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.llm.common import NO_ID, known_id, with_null_ids

#: A prime with roots of unity of every order up to 2**20, and a generator of its group.
PRIME, GENERATOR = 7 * 2**20 + 1, 3
#: Matrix side of one step of a transform: SIDE * (PRIME / 2)**2 < 2**53, so double products are exact.
SIDE = 128
#: Longest block; longer lags are covered by several windows.
BLOCK = SIDE * SIDE // 2
#: Words transformed at once.
STEP = 1 << 16
#: A run has at least so many words, and so many periods.
LEAST, TIMES = 6, 4


def centred(x: np.ndarray) -> np.ndarray:
    """Whole numbers below 2**52 in size, modulo PRIME, near zero; in place."""
    x -= PRIME * np.rint(x * (1 / PRIME))
    return x


@cache
def powers(order: int, rows: int, columns: int, inverse: bool) -> np.ndarray:
    """w**(i * j) for a root of unity w of an order, or 1 / w."""
    w = pow(GENERATOR, (PRIME - 1) // order, PRIME)
    w = pow(w, PRIME - 2, PRIME) if inverse else w
    table = np.ones(order, np.int64)
    for k in range(1, order):
        table[k] = table[k - 1] * w % PRIME
    return centred(table[np.outer(np.arange(rows), np.arange(columns)) % order].astype(float))


def spectrum(x: np.ndarray, m: int, inverse: bool = False) -> np.ndarray:
    """The transforms of rows x, zero beyond their columns (all m, or the first half of them).

    Up to SIDE numbers by one matrix, more by the two matrices of a row-column split; the
    order of the results is left as it falls.
    """
    rows, n = x.shape
    if m <= SIDE:
        return centred(x @ powers(m, m, m, inverse)[:n])
    b = m // SIDE
    x = centred(np.matmul(powers(SIDE, SIDE, SIDE, inverse)[:, : n // b], x.reshape(rows, n // b, b)))
    x *= powers(m, SIDE, b, inverse)
    return centred(np.matmul(centred(x), powers(b, b, b, inverse)))


def first_half(y: np.ndarray, m: int) -> np.ndarray:
    """The first m / 2 numbers of the rows whose spectra are y."""
    scale = pow(m, PRIME - 2, PRIME)
    if m <= SIDE:
        y = centred(y @ powers(m, m, m, True)[:, : m // 2])
    else:
        b = m // SIDE
        y = centred(np.matmul(y, powers(b, b, b, True)))
        y *= powers(m, SIDE, b, True)
        y = centred(np.matmul(powers(SIDE, SIDE, SIDE, True)[: SIDE // 2], centred(y))).reshape(len(y), m // 2)
    y *= scale
    return centred(y)


def equal_lags(code: np.ndarray, n: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Starts a and lags d in [size, 2 size) at which a block recurs: sum of (code[a+i] - code[a+d+i])**2 is 0.

    Blocks start at multiples of 2 * size and hold min(size, BLOCK) words. The sums are found
    for all lags of a window at once; they stay below PRIME, so that they are exact.
    """
    block = min(size, BLOCK)
    m = 2 * block
    starts = np.arange(0, n, 2 * size)
    x = np.concatenate([code[:n], np.zeros(4 * size + m)])
    squares = np.concatenate([[0.0], np.cumsum(x * x)])
    own = squares[block:] - squares[:-block]
    blocks, windows = (np.lib.stride_tricks.sliding_window_view(x, k) for k in (block, m))
    sums = np.lib.stride_tricks.sliding_window_view(own, block)
    found = []
    for offset in range(size, 2 * size, block):
        for at in range(0, len(starts), max(1, STEP // m)):
            a = starts[at : at + max(1, STEP // m)]
            products = spectrum(np.ascontiguousarray(windows[a + offset]), m)
            products *= spectrum(np.ascontiguousarray(blocks[a]), m, inverse=True)
            rest = own[a][:, None] + sums[a + offset] - 2 * first_half(centred(products), m)
            i, e = np.nonzero(centred(rest) == 0)
            found.append((a[i], offset + e))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


class Prefixes:
    """Compares substrings of x by sums of powers modulo 2**31 - 1: equal ones always compare equal."""

    MOD = np.uint64(2**31 - 1)

    def __init__(self, x: np.ndarray, base: int):
        self.power = np.ones(len(x) + 1, np.uint64)
        done = 1
        while done < len(self.power):
            more = self.power[:done] * (self.power[done - 1] * np.uint64(base) % self.MOD) % self.MOD
            self.power[done : 2 * done] = more[: len(self.power) - done]
            done *= 2
        value = (x.astype(np.uint64) * np.uint64(1_000_003) + np.uint64(12_345)) % self.MOD
        self.sums = np.concatenate([[np.uint64(0)], np.cumsum(value * self.power[:-1] % self.MOD, dtype=np.uint64)])

    def equal(self, i: np.ndarray, lag: np.ndarray, length: np.ndarray) -> np.ndarray:
        """Whether x[i : i + length] == x[i + lag : i + lag + length]."""
        left = (self.sums[i + length] - self.sums[i]) % self.MOD
        right = (self.sums[i + lag + length] - self.sums[i + lag]) % self.MOD
        return left * self.power[lag] % self.MOD == right

    def reach(self, i: np.ndarray, lag: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
        """The greatest length, up to `most`, for which the words after (before) i and i + lag agree."""
        low, high = np.zeros_like(most), most.copy()
        while (low < high).any():
            middle = (low + high + 1) // 2
            ok = self.equal(i - middle if back else i, lag, middle)
            low, high = np.where(ok, middle, low), np.where(ok, high, middle - 1)
        return low


def explained(a: np.ndarray, to: np.ndarray, d: np.ndarray, runs: np.ndarray) -> np.ndarray:
    """Whether the words from a to `to` lie in a known run whose period divides d.

    Of the runs that start in time the one that ends last is asked; no other one can hold
    4 d words if all periods are below d.
    """
    if not len(runs):
        return np.zeros(len(a), bool)
    runs = runs[np.argsort(runs[:, 0], kind="stable")]
    last = np.maximum.accumulate(runs[:, 1])
    new = np.concatenate([[True], last[1:] > last[:-1]])
    best = np.maximum.accumulate(np.where(new, np.arange(len(runs)), 0))
    k = np.searchsorted(runs[:, 0], a, "right") - 1
    at = best[np.maximum(k, 0)]
    return (k >= 0) & (runs[at, 1] >= to) & (d % runs[at, 2] == 0)


def repetitions(ids: np.ndarray, ends: np.ndarray, base: int = 999_983) -> np.ndarray:
    """(start, end, period) of all runs in ids, by start.

    ids: several texts, longest first, each followed by a number of its own; ends: where
    they end, that number included. A run of period q in [size, 2 size) has 4 q words; a
    block among its first 2 * size words recurs q words later inside the run, so each run
    is met by an aligned block. Lags that a run of a shorter period explains are passed
    over; the others are extended both ways.
    """
    n_words = np.diff(ends, prepend=0) - 1
    prefixes = Prefixes(ids, base)
    found, size = np.zeros((0, 3), np.int64), 1
    while True:
        texts = np.searchsorted(-n_words, -max(LEAST, TIMES * size), "right")
        if not texts:
            break
        n = int(ends[texts - 1])
        block = min(size, BLOCK)
        codes = max(2, int((PRIME - 1) ** 0.5 / block**0.5))  # block * (codes - 1)**2 < PRIME
        code = (ids[:n] * 2654435761 % 2**32 // 64 % codes).astype(float)
        a, d = equal_lags(code - codes // 2, n, size)
        ok = a + 2 * d + 1 <= n
        a, d = a[ok], d[ok]
        ok = ~explained(a, a + d + block, d, found)
        a, d = a[ok], d[ok]
        ok = prefixes.equal(a, d, d + 1)  # a run goes on for more than a period after its block
        a, d = a[ok], d[ok]
        s = a - prefixes.reach(a, d, a.copy(), back=True)
        e = a + d + prefixes.reach(a, d, n - a - d, back=False)
        ok = (e - s >= np.maximum(LEAST, TIMES * d)) & ~explained(s, e, d, found)
        found = np.concatenate([found, np.unique(np.stack([s, e, d], 1)[ok], axis=0)])
        size *= 2
    if any((ids[s : e - q] != ids[s + q : e]).any() for s, e, q in found):
        return repetitions(ids, ends, base + 2)  # sums that agree by chance
    return found[np.lexsort((found[:, 2], found[:, 0]))]


def with_planted(words: list[bytes], doc_id: int) -> list[bytes]:
    """The words, of which one document in ten repeats a part from some word on."""
    h, n = zlib.crc32(str(doc_id).encode()), len(words)
    if doc_id == NO_ID or h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    part = words[a : a + p]
    return words[:a] + (part * (-(-(n - a) // p)))[: n - a]


def described(texts: list[list[bytes]]) -> Iterator[tuple]:
    """(n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of each list of words."""
    order = sorted(range(len(texts)), key=lambda k: -len(texts[k]))
    number = defaultdict(count().__next__)
    words = np.fromiter(map(number.__getitem__, chain.from_iterable((*texts[k], k) for k in order)), np.int64)
    ends = np.cumsum([len(texts[k]) + 1 for k in order])
    runs = repetitions(words, ends)
    place = np.searchsorted(ends, runs[:, 0], "right")
    cut = np.searchsorted(place, np.arange(len(order) + 1))
    rows = [()] * len(texts)
    for at, k in enumerate(order):
        mine = (runs[cut[at] : cut[at + 1]] - (ends[at] - len(texts[k]) - 1) * np.array([1, 1, 0])).tolist()
        best, kept = None, texts[k]
        for s, e, q in mine:
            if best is None or (e - s) * best[2] > best[1] * q:
                best = (s, e - s, q)
        if mine:
            edges = np.zeros(len(kept) + 1, np.int64)
            for s, e, q in mine:
                edges[s + q] += 1
                edges[e] -= 1
            kept = [kept[i] for i in np.nonzero(np.cumsum(edges[:-1]) == 0)[0]]
        lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in mine)
        rows[k] = (
            len(mine), *(best or (None,) * 3), 1000 * best[1] // best[2] if best else None,
            hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(b" ".join(kept)).hexdigest(),
        )
    return iter(rows)


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = True, words_at_once: int = 1 << 19) -> DataFrame:
    """(doc_id, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256) of every row.

    A run is a longest stretch of consecutive words of a smallest period q with at least
    max(6, 4 q) words; start, length, period and exponent_milli are those of the run of the
    greatest length / period (ties: smallest start, then period), null if there is none.
    Words are what stands between ASCII white space. planted: repeat a part of one document
    in ten first, chosen by its id. The collapsed text leaves out what a run holds after its
    first period.

    Documents are read in batches of about words_at_once words; a longer one is a batch.
    Null texts have no words; a null id stays null and its text as it is; repeated rows come
    out repeated; an empty table gives no rows; further columns are ignored.
    """
    names = ["n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]
    schema = "doc_id long, n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"

    def frame(ids: list[int], texts: list[list[bytes]]) -> pd.DataFrame:
        out = pd.DataFrame(list(described(texts)), columns=names)
        out = out.astype(dict.fromkeys(names[:5], "Int64"))
        out.insert(0, "doc_id", np.array(ids, np.int64))
        return out

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, texts, held = [], [], 0
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                words = (text or "").encode("utf-8", "surrogatepass").split()
                ids.append(doc_id)
                texts.append(with_planted(words, doc_id) if planted else words)
                held += len(words)
                if held >= words_at_once:
                    yield frame(ids, texts)
                    ids, texts, held = [], [], 0
        if ids:
            yield frame(ids, texts)

    return docs.select(known_id(id_col), F.col(text_col).alias("text")).mapInPandas(run, schema).transform(with_null_ids)
