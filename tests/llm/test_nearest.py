"""Nearest vectors against all inner products, and the parts of the index against plain loops."""

import numpy as np
import pytest

from landseries.llm import nearest

KIND = "vec_id long, embedding array<float>, label string, q string, rank int"


def brute(rows: list[tuple], k: int, every: int) -> dict[int, list[tuple]]:
    rows = [(i, np.array(v, np.float32).astype(float)) for i, v in rows]
    return {
        i: sorted(((float((q * x).sum()), -j) for j, x in rows if j != i), reverse=True)[:k]
        for i, q in rows if i % every == 0
    }


def recall(got: list, want: dict[int, list[tuple]], k: int) -> float:
    assert {r.query_id for r in got} == set(want)
    hit = total = 0
    for q, best in want.items():
        own = sorted((r for r in got if r.query_id == q), key=lambda r: r["rank"])
        assert [r["rank"] for r in own] == list(range(1, len(best) + 1)) and len({r.vec_id for r in own}) == len(own)
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own) and q not in {r.vec_id for r in own}
        hit += len({r.vec_id for r in own} & {-j for _, j in best})
        total += len(best)
    return hit / total


@pytest.mark.parametrize("kind", ["norms", "crowded"])
def test_recall(spark, kind):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(3000, 32))
    x *= rng.uniform(0.2, 3, (3000, 1)) if kind == "norms" else 1
    if kind == "crowded":
        x[::3] = x[0]
        x[1::3] = x[rng.integers(0, 20, 1000) * 3 + 1] + 0.05 * rng.normal(size=(1000, 32))
    rows = [(k, v.tolist()) for k, v in enumerate(x.astype(np.float32))]
    table = spark.createDataFrame([(*r, "v", "v", 1) for r in rows], KIND)
    got = nearest.search(table, tile=700, block=40).collect()
    want = brute(rows, 20, 20)
    assert recall(got, want, 20) >= 0.9
    exact = {(q, -j): s for q, best in want.items() for s, j in best}
    assert all(r.score == pytest.approx(exact[r.query_id, r.vec_id], rel=1e-12) for r in got if (r.query_id, r.vec_id) in exact)
    if kind == "crowded":  # ties go to the least ids
        own = sorted((r for r in got if r.query_id == 0), key=lambda r: r["rank"])
        assert [r.vec_id for r in own] == list(range(3, 63, 3))


def test_odd_rows(spark):
    odd = [(None, [1.0, 0.0]), (0, None), (20, [0.0, 0.0]), (40, [1.0, None]), (60, [float("nan"), 1.0]), (80, [float("inf"), 1.0]), (100, [1.0]), (120, [])]
    fine = [(140, [1.0, 2.0]), (140, [1.0, 2.0]), (1, [1.0, 2.0]), (2, [-1.0, 0.5]), (-20, [3.0, 0.0])]
    table = spark.createDataFrame([(*r, "v", "v", 1) for r in odd + fine], KIND)
    got = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in nearest.search(table, k=3).collect()}
    assert got == {(140, 1): (1, 5.0), (140, 2): (-20, 3.0), (140, 3): (2, 0.0), (-20, 1): (1, 3.0), (-20, 2): (140, 3.0), (-20, 3): (2, -3.0)}
    assert nearest.search(table.where("false")).count() == 0
    lone = nearest.search(table.where("vec_id = -20"))
    assert lone.count() == 0 and [f.name for f in lone.schema] == ["query_id", "rank", "vec_id", "score"]
    assert nearest.search(table.where("vec_id in (1, 2)")).count() == 0


@pytest.mark.parametrize("radius", [0, 3, 15, 16, 40, 100, 256])
def test_every_code_within_the_radius(radius):
    rng = np.random.default_rng(radius)
    base = rng.integers(0, 1 << 16, (40, nearest.PARTS)).astype("<u2")
    noise = np.packbits(rng.random((1500, 256)) < rng.uniform(0, 0.5, (1500, 1)), axis=1).view("<u2")
    rows = base[rng.integers(0, 40, 1500)] ^ noise
    q, row = nearest.MultiIndex(rows).within(base, radius)
    want = {(a, b) for a in range(40) for b in range(1500) if sum(int(v).bit_count() for v in base[a] ^ rows[b]) <= radius}
    assert set(zip(q.tolist(), row.tolist())) == want and len(q) == len(want)
    assert sum(s + 1 for s in nearest.shares(radius)) >= min(radius + 1, 17 * 16)


def test_queries_short_of_candidates_are_asked_again(spark, monkeypatch):
    monkeypatch.setattr(nearest, "radius_for", lambda *a: 0)
    rng = np.random.default_rng(6)
    rows = [(k, v.tolist()) for k, v in enumerate(rng.normal(size=(200, 16)).astype(np.float32))]
    table = spark.createDataFrame([(*r, "v", "v", 1) for r in rows], KIND)
    assert recall(nearest.search(table, tile=64, block=3).collect(), brute(rows, 20, 20), 20) == 1
