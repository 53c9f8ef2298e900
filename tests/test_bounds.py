"""Work that must not grow with pairs or with the height of a map."""

from landseries.operators import blocks
from landseries.operators import tables as op


def test_rectangle_filter_makes_no_pairs(spark):
    schema = "fid long, x0 long, y0 long, w long, h long"
    a = spark.createDataFrame([(1, 0, 0, 2, 2), (2, 2, 0, 3, 1), (3, 7, 7, 20, 2), (4, 50, 50, 0, 4)], schema)
    b = spark.createDataFrame([(9, 1, 1, 1, 1), (8, 26, 8, 5, 5), (7, 50, 50, 9, 9), (6, 5, 0, 1, 1)] + [(k, 1, 1, 1, 1) for k in range(10, 40)], schema)
    found = op.rectangle_filter(a, b)
    assert sorted(r.fid for r in found.collect()) == [1, 3]
    assert found.columns == a.columns and "LeftSemi" in found._jdf.queryExecution().optimizedPlan().toString()


def test_strips_are_bounded(spark):
    cells = spark.sql("select id % 10 as x, id div 10 as y from range(1000)")
    assert blocks.strips(2)(cells) == (10, 50, 0, 0)
    assert blocks.strips(2, cells=70)(cells) == (10, 7, 0, 0)
    assert blocks.strips(2, cells=3)(cells) == (10, 1, 0, 0)
