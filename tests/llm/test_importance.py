"""Importance resampling against sums over dictionaries."""

import hashlib
import math
import re
import zlib

import numpy as np

from landseries.llm import importance


def features(text: str | None) -> tuple[int, list[int]]:
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", lower)
    runs = [" ".join(words[i : i + k]) for k in (1, 2, 3) for i in range(len(words) - k + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10_000 for r in runs]


def plain(docs: list[tuple], target: list[str | None]) -> list[tuple]:
    s, t = {}, {}
    for texts, count in (([d[1] for d in docs], s), (target, t)):
        for text in texts:
            for b in features(text)[1]:
                count[b] = count.get(b, 0) + 1
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t.get(b, 0) + 1.0) * (s_all + 10_000.0) / ((s.get(b, 0) + 1.0) * (t_all + 10_000.0)))) for b in range(10_000)]
    rows, able = [], []
    for doc_id, text in docs:
        n, f = features(text)
        h = int(hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[b] for b in f)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([doc_id, len(f), weight, score, None])
        if n >= 20:
            able.append(rows[-1])
    able.sort(key=lambda r: (-r[3], r[0] is not None, r[0] or 0))
    for k, r in enumerate(able[: len(able) * 5 // 100], 1):
        r[4] = k
    return sorted(map(tuple, rows), key=str)


def test_equal_to_dictionaries(spark):
    rng = np.random.default_rng(3)
    words = [f"Wort{k}" for k in range(300)] + ["É", "x_y", "don't", "日本", "a\x00b"]
    docs = [(k, " ".join(rng.choice(words, rng.integers(0, 90)))) for k in range(240)]
    docs += [(None, None), (1000, ""), (1001, None), (1002, "the the " * 3000), (2**53 + 1, docs[7][1]), (7, docs[7][1]), (None, docs[8][1] + " und " * 30)]
    target = [" ".join(rng.choice(words[:40], 30)) for _ in range(15)] + [None, ""]
    d = spark.createDataFrame([(*r, "v", "w") for r in docs], "doc_id long, text string, planes string, rank string")
    b = spark.createDataFrame([(k, t, "v") for k, t in enumerate(target)], "item_id long, text string, none string")
    got = sorted(map(tuple, importance.resample(d, b).collect()), key=str)
    assert got == plain(docs, target) and sum(r[4] is not None for r in got) > 5
    assert importance.resample(d.where("false"), b).count() == 0
    assert sorted(map(tuple, importance.resample(d, b.where("false")).collect()), key=str) == plain(docs, [])


def test_planes_hold_the_counts():
    rng = np.random.default_rng(4)
    counts = rng.integers(0, 9, 10_000) * (rng.random(10_000) < 0.1)
    counts[5] = 70_000
    gain = rng.integers(-9000, 9000, 10_000)
    matrix = importance.sliced(counts)
    weight = importance.weights_of(matrix, np.zeros(len(matrix), np.int64), np.arange(len(matrix)), 1, gain)
    assert weight.tolist() == [int(counts @ gain)]
