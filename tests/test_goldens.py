"""Worked examples with known results."""

import pytest
from pyspark.sql import functions as F

from landseries.functions import spectral
from landseries.operators import accuracy, patches


def test_date_features(spark):
    row = spark.createDataFrame([([2.0, 3.0, 4.0, 5.0],), ([5.0, 4.0, 3.0, 2.0],), ([-10000.0, 3.0, 4.0, 5.0],)], "bands array<double>")
    got = row.select(spectral.date_features(F.col("bands"), 1, 2, 3, 1.0).alias("f")).select("f.*").collect()
    assert got[0].ndvi == pytest.approx(0.2) and got[0].brightness == pytest.approx(54**0.5)
    assert got[1].ndvi == pytest.approx((4 - 5) / 9)
    assert got[2].ndvi == got[2].brightness == -10000


def test_scores(spark):
    rows = [(r, p, n) for r, line in enumerate([[50, 78, 41], [20, 52, 31], [27, 72, 98]]) for p, n in enumerate(line)]
    m = spark.createDataFrame(rows, "ref int, prod int, n long")
    g = accuracy.global_scores(m).first()
    assert g.kappa == pytest.approx(0.15482474945066724) and g.accuracy == pytest.approx(0.42643923240938164)
    c = accuracy.class_scores(m).orderBy("label").collect()
    assert [x.precision for x in c] == pytest.approx([0.5154639, 0.2574257, 0.5764706], abs=1e-6)
    assert [x.recall for x in c] == pytest.approx([0.2958580, 0.5048544, 0.4974619], abs=1e-6)
    assert [x.fscore for x in c] == pytest.approx([0.3759398, 0.3409836, 0.5340600], abs=1e-6)


def test_merged_labels(spark):
    m = spark.createDataFrame([(i // 4 + 1, i % 4 + 1, i + 1) for i in range(16)], "ref int, prod int, n long")
    rules = spark.createDataFrame([(1, 0), (2, 0)], "label int, new int")
    got = {(r.ref, r["prod"]): r.n for r in accuracy.merged_labels(m, rules).collect()}
    assert [[got[a, b] for b in (0, 3, 4)] for a in (0, 3, 4)] == [[14, 10, 12], [19, 11, 12], [27, 15, 16]]


def test_patches_follow_a_snake(spark):
    snake = [(x, y) for y in range(0, 9, 2) for x in range(9)] + [(8 if y % 4 == 1 else 0, y) for y in range(1, 8, 2)]
    cells = [(x, y, 1 if (x, y) in snake else 2) for x in range(9) for y in range(9)]
    got = patches.patches(spark.createDataFrame(cells, "x long, y long, label int"), eight=False)
    assert got.where("label = 1").select("patch").distinct().count() == 1


def test_entry_without_the_subpackage(monkeypatch):
    import importlib
    import sys

    monkeypatch.setitem(sys.modules, "landseries.llm", None)
    monkeypatch.setitem(sys.modules, "landseries.llm.queries", None)
    monkeypatch.setitem(sys.modules, "corpus_pipeline", None)
    sys.modules.pop("__spark_entry__", None)
    entry = importlib.import_module("__spark_entry__")
    assert entry.llm is None and len(entry.queries()) > 100
    sys.modules.pop("__spark_entry__", None)


def test_quantiles_beyond_the_table():
    from landseries.operators.accuracy import quantile95

    assert abs(quantile95(11) - 2.2010) < 2e-3 and abs(quantile95(30) - 2.0423) < 2e-4
