"""Rings, arcs and their simplification on small maps with holes, touching corners and nodes."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landseries.operators import outlines as op
from landseries.operators import patches

MAPS = [
    ["1111", "1221", "1211", "1111"],
    ["111111", "122221", "123321", "122221", "111111"],
    ["1.12", "111.", "..13"],
    ["1212", "2121", "1122"],
]


def cells_of(spark, rows):
    return spark.createDataFrame([(x, y, int(v)) for y, row in enumerate(rows) for x, v in enumerate(row) if v != "."], "x long, y long, label int")


@pytest.mark.parametrize("k", range(len(MAPS)))
def test_rings_enclose_their_patches(spark, k):
    named = patches.patches(cells_of(spark, MAPS[k]), eight=False).cache()
    own = {}
    for r in named.collect():
        own.setdefault(r.patch, set()).add((r.x, r.y))
    rings = {}
    for r in op.rings(named).collect():
        rings.setdefault((r.patch, r.ring), []).append((r.pos, r.x, r.y))
    area, inside = dict.fromkeys(own, 0), {p: {} for p in own}
    for (patch, _), corners in rings.items():
        corners.sort()
        assert [c[0] for c in corners] == list(range(len(corners)))
        points = [c[1:] for c in corners]
        for (x1, y1), (x2, y2) in zip(points, points[1:] + points[:1]):
            assert (x1 == x2) != (y1 == y2)
            area[patch] += x1 * y2 - x2 * y1
            for y in range(min(y1, y2), max(y1, y2)):  # crossings left of a cell turn it over
                for x in range(x1, 9):
                    inside[patch][x, y] = not inside[patch].get((x, y), False)
    assert {p: a / 2 for p, a in area.items()} == {p: len(c) for p, c in own.items()}
    assert {p: {c for c, v in i.items() if v} for p, i in inside.items()} == own
    assert {r.patch: r.area for r in op.patch_areas(op.arcs(named)).collect()} == {p: len(c) for p, c in own.items()}


def test_chains(spark):
    links = [(k, k + 1) for k in range(10, 90)] + [(90, None)] + [(k, 100 + (k - 99) % 37) for k in range(100, 137)] + [(5, None), (200, 200)]
    got = {r.id: (r.chain, r.pos) for r in op.chained(spark.createDataFrame(links, "id long, next long")).collect()}
    assert [got[k] for k in range(10, 91)] == [(90, k - 10) for k in range(10, 91)]
    assert [got[k] for k in range(100, 137)] == [(136, k - 100) for k in range(100, 137)]
    assert got[5] == (5, 0) and got[200] == (200, 0) and len(got) == len(links)
    assert op.chained(spark.createDataFrame([], "id long, next long")).count() == 0


def test_simplified_neighbours_still_fit(spark):
    rng = np.random.default_rng(4)
    tall = np.clip(np.cumsum(rng.integers(-1, 2, 40)) + 12, 3, 21)  # a ragged border
    rows = ["".join("1" if y < tall[x] else "2" for x in range(40)) for y in range(24)]
    named = patches.patches(cells_of(spark, rows), eight=False)
    arcs = op.arcs(named).cache()
    thin = op.simplified(arcs, 1.5).cache()
    assert thin.count() < arcs.count() / 2
    area = {r.patch: r.area for r in op.patch_areas(thin).collect()}
    assert sum(area.values()) == 40 * 24 and all(a > 0 for a in area.values())
    ends = lambda d: {(r.arc, r.x, r.y) for r in d.groupBy("arc").agg(F.min_by("x", "pos").alias("x"), F.min_by("y", "pos").alias("y")).collect()}
    assert ends(thin) == ends(arcs)
    assert {r.patch: r.area for r in op.patch_areas(op.simplified(arcs, 0.0)).collect()} == {r.patch: r.area for r in op.patch_areas(arcs).collect()}


def test_kept_corners():
    x, y = np.array([0, 1, 2, 3, 4, 5.0]), np.array([0, 0.4, 0, 3, 0, 0])
    assert op.kept_corners(x, y, 0.5).tolist() == [True, False, True, True, True, True]
    assert op.kept_corners(x, y, 5).tolist() == [True] + [False] * 4 + [True]


def test_chains_across_blocks(spark, monkeypatch):
    """Blocks of two cells a side give the same rings and arcs as one block, also where numbers have over 53 bits."""
    far = 1 << 23
    cells = cells_of(spark, MAPS[1]).select("x", (F.col("y") + far).alias("y"), "label")
    named = patches.patches(cells, eight=False).cache()

    def around(rows, key):
        out = {}
        for r in sorted(rows, key=lambda r: r.pos):
            out.setdefault(r[key], []).append((r.x, r.y - far))
        turned = [tuple(c[c.index(min(c)) :] + c[: c.index(min(c))]) if key == "ring" else tuple(c) for c in out.values()]
        return sorted(turned)

    whole = around(op.rings(named).collect(), "ring"), {r.patch: r.area for r in op.patch_areas(op.arcs(named)).collect()}
    monkeypatch.setattr(op, "SIDE", 2)
    assert (around(op.rings(named).collect(), "ring"), {r.patch: r.area for r in op.patch_areas(op.arcs(named)).collect()}) == whole
    assert len(whole[0]) == 5 and all(abs(whole[1][p]) == n for p, n in ((r.patch, r["count"]) for r in named.groupBy("patch").count().collect()))


def test_rounds_chain_blocks_only(spark, monkeypatch):
    """What is chained by rounds are links between blocks: none on a map within one."""
    asked, chained = [], op.chained
    monkeypatch.setattr(op, "chained", lambda links, *a: asked.append(links.count()) or chained(links, *a))
    named = patches.patches(cells_of(spark, MAPS[1]), eight=False)
    assert op.rings(named).count() and op.arcs(named).count() and asked == [0, 0]
