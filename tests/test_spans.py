"""Shapes of any form as spans: holes, slants, parts, tiles, and operations against sets of cells."""

import math

import numpy as np
import pytest

from landseries.operators import spans as op

SHAPE = "fid long, rings array<array<struct<x:double,y:double>>>"


def covered(rings: list, x: int, y: int) -> bool:
    n = 0
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1]):
            if (y1 <= y + 0.5) != (y2 <= y + 0.5):
                n += x1 + (y + 0.5 - y1) * (x2 - x1) / (y2 - y1) <= x + 0.5
    return n % 2 == 1


def sets(spans) -> dict[int, set]:
    out: dict[int, set] = {}
    for r in spans.collect():
        new = {(x, r.y) for x in range(r.a, r.b)}
        assert new and not new & out.get(r.fid, set())
        out.setdefault(r.fid, set()).update(new)
    return out


@pytest.fixture(scope="module")
def shapes(spark):
    rng = np.random.default_rng(2)
    rows = [
        (1, [[(-7, -3), (9, -3), (9, 8), (-7, 8)], [(-5, -1), (3, -1), (3, 4), (-5, 4)]]),
        (2, [[(0, 0), (12, 0), (12, 4), (4, 4), (4, 10), (0, 10), (0, 0)]]),
        (3, [[(0.2, 0.1), (11.7, 3.3), (2.5, 9.9)]]),
        (4, [[(10, 10), (10, 10)], [], [(5, 5)]]),
    ]
    for k in range(5, 15):
        a = np.sort(rng.uniform(0, 2 * math.pi, 9))
        r = rng.uniform(2, 12, 9)
        rows.append((k, [[(float(x), float(y)) for x, y in zip(r * np.cos(a), r * np.sin(a))]]))
    table = spark.createDataFrame([(f, [[(float(x), float(y)) for x, y in ring] for ring in rings]) for f, rings in rows] + [(99, None)], SHAPE)
    return table, {f: {(x, y) for x in range(-15, 16) for y in range(-15, 16) if covered(rings, x, y)} for f, rings in rows}


@pytest.mark.parametrize("tile", [256, 4])
def test_operations_are_those_of_cells(shapes, monkeypatch, tile):
    monkeypatch.setattr(op, "TILE", tile)
    table, cells = shapes
    spans = op.shape_spans(table).cache()
    assert sets(spans) == {f: c for f, c in cells.items() if c}
    a, b = spans.where("fid <= 6"), spans.where("fid > 6")
    both = {(r.fid, r.o_fid): r.area for r in op.area(op.common(a, b), "fid", "o_fid").collect()}
    assert both == {(f, g): len(cells[f] & cells[g]) for f in range(1, 7) for g in range(7, 15) if cells[f] & cells[g]}
    of_b = set().union(*(cells[g] for g in range(7, 15)))
    assert sets(op.minus(a, b)) == {f: cells[f] - of_b for f in range(1, 7) if cells[f] - of_b}
    union = {(x, r.y) for r in op.union(a, b).collect() for x in range(r.a, r.b)}
    assert union == set().union(*cells.values())
    owner = {c: min(f for f in cells if c in cells[f]) for c in union}
    assert sets(op.owned(spans)) == {f: {c for c in owner if owner[c] == f} for f in set(owner.values())}
    whole = sets(op.joined(spans))
    assert whole == {f: c for f, c in cells.items() if c}


@pytest.mark.parametrize("square", [True, False])
def test_buffers(shapes, square):
    table, cells = shapes
    near = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if square or a * a + b * b <= 4]
    spans = op.shape_spans(table)
    assert sets(op.dilated(spans, 2, square)) == {f: {(x + a, y + b) for x, y in c for a, b in near} for f, c in cells.items() if c}
    small = {f: {(x, y) for x, y in c if all((x + a, y + b) in c for a, b in near)} for f, c in cells.items()}
    assert sets(op.eroded(spans, 2, square)) == {f: c for f, c in small.items() if c}


def test_rows_grow_with_height_not_area(spark):
    wide = spark.createDataFrame([(1, [[(0.0, 0.0), (1e6, 0.0), (1e6, 3.0), (0.0, 3.0)]])], SHAPE)
    assert op.shape_spans(wide).count() == 3 and op.area(op.shape_spans(wide), "fid").first().area == 3_000_000


@pytest.mark.parametrize("side", [64, 4])
def test_common_areas_are_those_of_cells(shapes, monkeypatch, side):
    """Of shapes in one piece and in many; a pair comes out once, and of small shapes none is shuffled after the join."""
    monkeypatch.setattr(op, "SIDE", side)
    table, cells = shapes
    spans = op.shape_spans(table)
    a, b = spans.where("fid <= 8"), spans.where("fid > 2")
    rows = op.common_area(a, b).collect()
    expected = {(f, g): len(cells[f] & cells[g]) for f in range(1, 9) for g in range(3, 15) if cells[f] & cells[g]}
    assert len(rows) == len(expected) and {(r.fid, r.o_fid): r.area for r in rows} == expected


def test_common_spans_are_whole(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 4)
    a = spark.createDataFrame([(1, 0, -3, 21), (2, 1, 0, 5)], "fid long, y long, a long, b long")
    b = spark.createDataFrame([(7, 0, -9, 2), (7, 0, 3, 30), (8, 1, 5, 9)], "fid long, y long, a long, b long")
    assert sorted(map(tuple, op.common(a, b).collect())) == [(1, 7, 0, -3, 2), (1, 7, 0, 3, 21)]


@pytest.mark.parametrize("most", [512, 8])
def test_descriptors_of_a_batch_are_those_of_each_shape_and_move_nothing(spark, monkeypatch, most):
    monkeypatch.setattr(op, "MOST_CORNERS", most)
    rng = np.random.default_rng(5)
    sizes = rng.integers(0, 25, 60)
    points = [rng.normal(size=(n, 2)) if k % 2 else rng.integers(0, 5, (n, 2)).astype(float) for k, n in enumerate(sizes)]
    of = np.repeat(np.arange(60), sizes)
    got = op.all_hull_measures(of, *np.concatenate(points).T, 60)
    for p, row in zip(points, got, strict=True):
        area, long, short = op.hull_measures(p) if len(p) else (math.nan,) * 3
        assert np.allclose([area, long * short], [row[0], row[1] * row[2]], equal_nan=True)
    table = spark.createDataFrame([(1, [[(0.0, 0.0), (4.0, 0.0), (4.0, 2.0), (0.0, 2.0)], [(1.0, 1.0), (1.0, 1.5), (2.0, 1.5), (2.0, 1.0)]]), (2, []), (3, None), (4, [[(1.0, 1.0)]])], SHAPE)
    out = op.descriptors(table)
    assert "Exchange" not in out._jdf.queryExecution().executedPlan().toString()
    rows = {r.fid: r[1:] for r in out.collect()}
    assert rows[1] == pytest.approx((7.5, 15.0, 7.5 / 8, 4 * math.pi * 7.5 / 225, 2.0))
    assert rows[2] == (0.0, None, None, None, None) and rows[3] == (None,) * 5 and rows[4] == (0.0, None, None, None, None)


def test_buffers_are_whole_across_tiles_and_shuffle_spans_once(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE", 4)
    rows = [("a", y, -6, 7) for y in range(-7, 6)] + [("a", 0, 7, 11), ("a", 1, 3, 9), ("b", 2, 0, 3), (None, 1, 1, 5)]
    spans = spark.createDataFrame(rows, "name string, y long, a long, b long")
    cells = {n: {(x, y) for m, y, a, b in rows if m == n for x in range(a, b)} for n in ("a", "b", None)}
    near = [(a, b) for a in range(-2, 3) for b in range(-2, 3) if a * a + b * b <= 4]
    for made, want in (
        (op.dilated(spans, 2, key="name"), {n: {(x + a, y + b) for x, y in c for a, b in near} for n, c in cells.items()}),
        (op.eroded(spans, 2, key="name"), {n: {(x, y) for x, y in c if all((x + a, y + b) in c for a, b in near)} for n, c in cells.items()}),
    ):
        got = {n: [(x, r.y) for r in made.collect() if r.name == n for x in range(r.a, r.b)] for n in cells}
        assert {n: set(c) for n, c in got.items()} == want and all(len(c) == len(set(c)) for c in got.values())
    plan = op.eroded(spans, 2, key="name")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange ") == 1


def test_spans_of_shapes_are_not_shuffled(spark, monkeypatch):
    monkeypatch.setattr(op, "CROSSINGS", 16)
    table = spark.createDataFrame([(k, [[(0.0, 0.0), (5.0, 0.0), (5.0, 6.0), (0.0, 6.0)]]) for k in range(20)], SHAPE).coalesce(1)
    spans = op.shape_spans(table)
    assert "Exchange" not in spans._jdf.queryExecution().executedPlan().toString()
    assert sorted(map(tuple, spans.collect())) == [(k, y, 0, 5) for k in range(20) for y in range(6)]
