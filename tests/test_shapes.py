"""Shapes by hand: what is covered, what is left, what is wrong with a ring."""

from pyspark.sql import functions as F

from landseries.operators import patches, shapes


def rects(spark, *rows):
    return spark.createDataFrame(rows, "fid long, x0 long, y0 long, w long, h long")


def test_difference_and_owners(spark):
    a, b = rects(spark, (1, 0, 0, 2, 2), (2, 9, 9, 0, 3)), rects(spark, (5, 1, 0, 5, 1))
    assert sorted(map(tuple, shapes.difference(a, b).collect())) == [(1, 0, 0), (1, 0, 1), (1, 1, 1)]
    assert dict(map(tuple, shapes.owned_cells(a.unionByName(b)).collect())) == {1: 4, 2: 0, 5: 4}


def test_buffer_drops_what_vanishes(spark):
    assert [tuple(r) for r in shapes.buffered(rects(spark, (1, 0, 0, 3, 4), (2, 0, 0, 2, 9)), -1).collect()] == [(1, 1, 1, 1, 2)]


def test_ring_problems(spark):
    whole = shapes.ring(*map(F.col, ("x0", "y0", "w", "h")))
    out = rects(spark, (1, 0, 0, 2, 3), (2, 0, 0, 2, 0)).select(
        *(shapes.ring_problem(p).alias(n) for n, p in (("all", whole), ("cut", F.slice(whole, 1, 4)), ("none", F.slice(whole, 1, 0))))
    ).collect()
    assert [tuple(r) for r in out] == [(None, "open", "empty"), ("flat", "flat", "empty")]


def test_dilation_of_a_grid_with_holes(spark):
    cells = spark.createDataFrame([(0, 0, 1), (2, 2, 0), (3, 0, 0)], "x int, y int, v int")
    assert sorted(map(tuple, patches.morphology(cells, dilate=True, radius=2).collect())) == [(0, 0, 1), (2, 2, 1), (3, 0, 0)]
