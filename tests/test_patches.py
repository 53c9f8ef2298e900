"""Patches over blocks of every size against a plain search; components of links."""

import numpy as np
import pytest

from landseries.operators import patches
from landseries.operators.components import components


def plain(cells: dict, eight: bool) -> dict:
    steps = patches.EIGHT if eight else patches.FOUR
    out: dict = {}
    for c in sorted(cells, key=lambda c: (c[1], c[0])):
        todo = [c] if c not in out else []
        while todo:
            x, y = todo.pop()
            if (x, y) not in out and cells.get((x, y)) == cells[c]:
                out[x, y] = c[1] * 2**31 + c[0]
                todo += [(x + a, y + b) for a, b in steps]
    return out


@pytest.mark.parametrize("eight", [True, False])
@pytest.mark.parametrize("block", [3, 128])
def test_blocks_do_not_show(spark, eight, block):
    rng = np.random.default_rng(block)
    cells = {(x, y): int(v) for (y, x), v in np.ndenumerate(rng.integers(1, 3, (14, 23))) if rng.random() < 0.95}
    cells |= {(30 + x, y): 7 for x in range(12) for y in range(12) if y % 4 == 0 or (y % 4 != 0 and x == (11 if y % 8 < 4 else 0))}  # a snake
    table = spark.createDataFrame([(x, y, v) for (x, y), v in cells.items()], "x int, y int, label int")
    got = {(r.x, r.y): r.patch for r in patches.patches(table, eight, block).collect()}
    assert got == plain(cells, eight)
    assert patches.patches(table.where("false"), eight).count() == 0


def test_components(spark):
    rng = np.random.default_rng(1)
    links = [(int(a), int(b)) for a, b in rng.integers(0, 300, (220, 2))] + [(1000, k) for k in range(1001, 1300)] + [(k, k + 1) for k in range(2000, 2100)]
    root = list(range(2101))
    for _ in range(120):
        for a, b in links:
            root[a] = root[b] = min(root[a], root[b])
    got = {r.node: r.component for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {k: r for k, r in enumerate(root) if r != k}


@pytest.mark.parametrize("eight", [True, False])
@pytest.mark.parametrize("within", [None, "parent"])
def test_small_patches_look_around(spark, eight, within):
    rng = np.random.default_rng(6)
    cells = [(int(x), int(y), int(rng.integers(1, 5))) for x in range(14) for y in range(11) if rng.random() < 0.95]
    named = patches.patches(spark.createDataFrame(cells, "x long, y long, label int"), eight).selectExpr("*", "label div 2 AS parent").cache()
    at = {(r.x, r.y): r for r in named.collect()}
    size: dict[int, int] = {}
    for r in at.values():
        size[r.patch] = size.get(r.patch, 0) + 1
    best: dict[int, tuple] = {}
    for (x, y), r in at.items():
        for a, b in patches.EIGHT if eight else patches.FOUR:
            n = at.get((x + a, y + b))
            if n and size[r.patch] < 4 and n.patch != r.patch and (within is None or n.parent == r.parent):
                best[r.patch] = max(best.get(r.patch, (0, 0)), (size[n.patch], -n.label))
    want = {(x, y): -best[r.patch][1] if r.patch in best else r.label for (x, y), r in at.items()}
    assert {(r.x, r.y): r.label for r in patches.sieved(named, 4, eight, within).collect()} == want
