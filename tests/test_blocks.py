"""User functions over blocks: borders, masks, names of labels, refusals; series."""

import datetime

import numpy as np
import pytest

from landseries.operators import blocks as op


@pytest.fixture(scope="module")
def cells(spark):
    rng = np.random.default_rng(1)
    rows = [(x, y, float(rng.integers(0, 50)), None if (x + y) % 11 == 0 else 1.0, int(x >= 8 or y % 3 == 0)) for x in range(-3, 21) for y in range(13) if (x, y) not in ((2, 2), (7, 8))]
    return spark.createDataFrame(rows, "x int, y int, s2_b1_0 double, s2_b1_1 double, on int")


def functions():
    """Functions inside a function travel to the workers whole."""

    def greatest(block):
        near = block.around("s2_b1_0")
        return np.where(np.isnan(near), -1, near).max(axis=2), ["top"]

    def smoothed(block):
        near = block.around("top")
        return np.where(np.isnan(near), -1, near).max(axis=2), ["top2"]

    return [greatest, smoothed]


@pytest.mark.parametrize("blocks", [op.fixed(5, 4), op.fixed(64, 64), op.strips(4)])
def test_blocks_do_not_show(cells, blocks):
    have = {(r.x, r.y): r.s2_b1_0 for r in cells.collect()}
    got = op.user_features(cells, ["s2_b1_0", "s2_b1_1"], functions(), blocks, rim=2).collect()
    near = lambda x, y, r: max(have.get((x + a, y + b), -1) for a in range(-r, r + 1) for b in range(-r, r + 1))
    assert len(got) == len(have) and all(r.top == near(r.x, r.y, 1) and r.top2 == near(r.x, r.y, 2) for r in got)
    assert all((r.s2_b1_1 is None) == ((r.x + r.y) % 11 == 0) for r in got)


def test_masked_cells(cells):
    called = lambda block: (block.get("s2_b1_0") * 0 + 1, [])
    got = op.user_features(cells, ["s2_b1_0"], [called], op.fixed(4, 1), mask="on").collect()
    on = {(r.x, r.y): (r.on, r.s2_b1_0) for r in cells.collect()}
    assert all((r.s2_b1_0, r.custFeat_1_b1) == ((on[r.x, r.y][1], 1) if on[r.x, r.y][0] else (0, 0)) for r in got) and len(got) == len(on)

    def refuses(block):
        assert np.nanmin(block.get("on2")) == 1  # a block of masked cells only never gets here
        return block.get("on2"), ["v"]

    whole = cells.selectExpr("x", "y", "cast(on as double) on2", "on")
    assert op.user_features(whole.where("x >= 0"), ["on2"], [refuses], op.fixed(8, 1), mask="on").count() == cells.where("x >= 0").count()


def test_refusals_and_names(cells, spark):
    with pytest.raises(Exception, match="division by zero"):
        op.user_features(cells, ["s2_b1_0"], [lambda b: (b.get("s2_b1_0") / 0, ["v"])]).collect()
    with pytest.raises(Exception, match="expected"):
        op.user_features(cells, ["s2_b1_0"], [lambda b: (np.zeros(3), ["v"])]).collect()
    stacked = lambda b: (np.nan_to_num(b.series("s2_b1")), ["only one"])
    out = op.user_features(cells, ["s2_b1_0", "s2_b1_1"], [stacked, lambda b: (np.nan_to_num(b.get("custFeat_1_b2")), ["again"])])
    assert out.columns[-3:] == ["custFeat_1_b1", "custFeat_1_b2", "again"] and out.where("again != custFeat_1_b2").count() == 0
    assert op.user_features(cells, ["s2_b1_0"], functions()[:1], op.fixed(5, 5), rim=1, only=(0, 1)).count() == 25
    none = op.user_features(cells.where("false"), ["s2_b1_0"], functions()[:1])
    assert none.count() == 0 and none.columns == ["x", "y", "s2_b1_0"]


def test_series(spark):
    day = datetime.date(2020, 1, 1)
    rows = [(1, day + datetime.timedelta(k), float(v), int(k == 2)) for k, v in enumerate((5, 3, 100, 4))] + [(2, day, 1.0, 1), (3, day, None, 0)]
    obs = spark.createDataFrame(rows, "pixel long, date date, value double, mask int")
    got = {r.pixel: (r.last, r.span) for r in op.series_features(obs, {"last": lambda d, v: v[-1], "span": lambda d, v: d[-1] - d[0]}, ["pixel"]).collect()}
    assert got == {1: (4, 3), 2: (None, None), 3: (None, None)}
