"""Runs of repeated words against a search of all periods, over block sizes that make every path short."""

import hashlib
import zlib

import numpy as np
import pytest

from landseries.llm import periodic_runs as pr


def all_runs(w: list) -> list[tuple[int, int, int]]:
    """(start, end, period) of all runs by comparing all words at all distances."""
    found = []
    for q in range(1, len(w) // 4 + 1):
        same = [a == b for a, b in zip(w, w[q:])] + [False]
        begins = None
        for i, s in enumerate(same):
            if s and begins is None:
                begins = i
            if not s and begins is not None:
                run, begins = (begins, i + q), None
                shorter = any(q % p == 0 and a <= run[0] and run[1] <= b for a, b, p in found)
                if run[1] - run[0] >= max(6, 4 * q) and not shorter:
                    found.append((*run, q))
    return sorted(found, key=lambda r: (r[0], r[2]))


def expected(words: list[bytes]) -> tuple:
    runs = all_runs(words)
    cut = {i for s, e, q in runs for i in range(s + q, e)}
    best = min(runs, key=lambda r: (-(r[1] - r[0]) / r[2], r[0], r[2]), default=None)
    head = (best[0], best[1] - best[0], best[2], 1000 * (best[1] - best[0]) // best[2]) if best else (None,) * 4
    lines = "".join(f"{s},{e - s},{q}\n" for s, e, q in runs)
    kept = b" ".join(w for i, w in enumerate(words) if i not in cut)
    return (len(runs), *head, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(kept).hexdigest())


def repetitive(rng: np.random.Generator, n: int, letters: int) -> list[bytes]:
    w: list[int] = []
    while len(w) < n:
        kind = rng.integers(0, 4)
        if kind == 0:
            w += rng.integers(0, letters, rng.integers(1, 8)).tolist()
        elif kind == 1:
            part = rng.integers(0, letters, rng.integers(1, 12)).tolist() * int(rng.integers(2, 9))
            w += part[: len(part) - int(rng.integers(0, 4))]
        elif kind == 2 and w:
            w += w[-int(rng.integers(1, len(w) + 1)) :]
        else:
            w += [int(rng.integers(0, letters))] * int(rng.integers(1, 15))
    return [b"%d" % v for v in w[:n]]


@pytest.mark.parametrize("side, block", [(128, 8192), (128, 4), (4, 8), (2, 2), (8, 32)])
def test_equal_to_all_distances(monkeypatch, side, block):
    monkeypatch.setattr(pr, "SIDE", side)
    monkeypatch.setattr(pr, "BLOCK", block)
    rng = np.random.default_rng(side + block)
    for _ in range(25):
        texts = [repetitive(rng, int(rng.integers(0, 220)), int(rng.integers(1, 6))) for _ in range(5)]
        assert list(pr.described(texts)) == [expected(t) for t in texts]


def test_sums_are_exact():
    rng = np.random.default_rng(1)
    code = rng.integers(0, 3, 400).astype(float)
    for size in (1, 2, 8, 64):
        a, d = pr.equal_lags(code, 400, size)
        padded = np.concatenate([code, np.zeros(4 * size)])
        want = {(s, k) for s in range(0, 400, 2 * size) for k in range(size, 2 * size) if (padded[s : s + size] == padded[s + k : s + k + size]).all()}
        assert set(zip(a.tolist(), d.tolist())) == want


def test_long_periods():
    part = [b"w%d" % k for k in range(20_000)]
    got = next(pr.described([[b"x"] + part * 4 + part[:7] + [b"y"]]))
    assert got[:5] == (1, 1, 80_007, 20_000, 4000)
    assert next(pr.described([[b"a"] * 300_000]))[:4] == (1, 0, 300_000, 1)


def test_query_rows(spark):
    ids = [d for d in range(400) if zlib.crc32(str(d).encode()) % 10 == 0][:6]
    text = " ".join(f"w{k}" for k in range(57))
    rows = [(d, f"{text} {d}", "v") for d in ids] + [(ids[0], f"{text} {ids[0]}", "v"), (None, "a " * 9, "v"), (501, None, "v"), (502, "", "v"), (503, "x y\x1cz " * 6, "v")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_runs string")
    got = pr.periodic_runs(docs, words_at_once=100).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: tuple(r)[1:] for r in got}
    for d, t, _ in rows:
        words = (t or "").encode().split()
        if d in ids:
            g = zlib.crc32(str(d).encode()) // 10
            a, n = g % len(words), len(words)
            p = 1 + (n - a) // (3 + g % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
        assert by[d] == expected(words)
    assert by[None][0] == 1 and by[501][0] == 0 and by[503][:4] == (1, 0, 12, 2)
    assert pr.periodic_runs(docs.where("false")).count() == 0
