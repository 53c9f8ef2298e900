"""Neighbours, synthetic samples, principal components, files and hulls against plain versions."""

import math

import numpy as np
import pytest

from landseries.operators import neighbours, reduction, spans
from landseries.sources import files


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(1)
    rows = [(k, k % 3, rng.integers(0, 6, 4).astype(float).tolist()) for k in range(200)] + [(500, 9, [0.0] * 4), (501, 2, None), (None, 2, [0.0] * 4), (502, None, [0.0] * 4)]
    return spark.createDataFrame(rows, "key long, class int, x array<double>")


@pytest.mark.parametrize("tile", [2048, 13])
def test_neighbours_are_exact(samples, tile):
    rows = {r.key: (r["class"], np.array(r.x)) for r in samples.collect() if r.key is not None and r.x and r["class"] is not None}
    want = {}
    for key, (c, x) in rows.items():
        near = sorted((float(((x - y) ** 2).sum()), k) for k, (d, y) in rows.items() if d == c and k != key)
        want |= {(key, n): (k, d) for n, (d, k) in enumerate(near[:4], 1)}
    got = {(r.key, r["rank"]): (r.other, r.d2) for r in neighbours.nearest_in_class(samples, 4, tile).collect()}
    assert got == want


def test_new_samples_lie_between(samples, spark):
    add = spark.createDataFrame([(0, 100), (1, 5), (9, 3)], "class int, add long")
    rows = {r.key: np.array(r.x) for r in samples.collect() if r.x}
    near = {(r.key, r.other) for r in neighbours.nearest_in_class(samples, 3).collect()}
    made = neighbours.between(samples, add, 3).collect()
    assert sum(r["class"] == 0 for r in made) == 100 and sum(r["class"] == 1 for r in made) == 5 and all(r["class"] != 9 for r in made)
    assert len({(r.key, r.copy) for r in made}) == 105 and len({r.u for r in made}) > 90
    for r in made:
        assert (r.key, r.other) in near and 0 <= r.u < 1
        np.testing.assert_allclose(r.x, rows[r.key] + r.u * (rows[r.other] - rows[r.key]))


@pytest.mark.parametrize("method", ["replicate", "jitter", "smote"])
def test_models_and_whole_numbers(spark, method):
    rng = np.random.default_rng(2)
    table = spark.createDataFrame([(k, k % 2, "a" if k < 60 else "b", int(k), float(v), float(w)) for k, (v, w) in enumerate(rng.normal(size=(100, 2)))], "id long, code int, model string, flag int, f1 double, f2 float")
    add = spark.createDataFrame([(1, 40)], "code int, add long")
    out = neighbours.augmented(table, "id", "code", add, method, "model", ["a"], k=3)
    assert out.columns == [*table.columns, "copy"] and out.dtypes[:-1] == table.dtypes
    new = out.where("copy > 0").collect()
    assert len(new) == 40 and all(r.code == 1 and r.model == "a" and r.flag == r.id for r in new)
    old = {r.id: r.f1 for r in table.collect()}
    assert (max(abs(r.f1 - old[r.id]) for r in new) == 0) == (method == "replicate")
    assert out.where("copy = 0").count() == 100


def test_components_equal_numpy(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 7)) @ rng.normal(size=(7, 7)) + 1000
    x[:, 6] = 5.0
    table = spark.createDataFrame([(k, v.tolist()) for k, v in enumerate(x)] + [(999, None)], "id long, x array<double>")
    groups = {"a": [0, 2, 4], "b": [1, 3, 5, 6]}
    model = reduction.fit_components(table, groups, 3)
    got = {(r.grp, r.component): r for r in model.collect()}
    out = {r.id: r.reduced for r in reduction.reduced(table, model).collect()}
    assert out[999] is None or all(v is None for v in out[999])
    at = 0
    for g, k in groups.items():
        z = (x[:, k] - x[:, k].mean(axis=0)) / np.where(x[:, k].std(axis=0) > 0, x[:, k].std(axis=0), 1)
        values, vectors = np.linalg.eigh(z.T @ z / len(z))
        for c in range(3):
            v = vectors[:, -1 - c]
            v = v * np.sign(v[np.abs(v).argmax()])
            assert got[g, c].variance == pytest.approx(values[-1 - c], abs=1e-9)
            np.testing.assert_allclose(got[g, c].loadings, v, atol=1e-7)
            np.testing.assert_allclose([out[i][at] for i in range(300)], z @ v, atol=1e-7)
            at += 1
    names = ["s2_b1_20200101", "s2_b2_20200101", "s2_b1_20200111", "s1_vv_20200101"]
    assert reduction.feature_groups(names, "sensor_band") == {"s1_vv": [3], "s2_b1": [0, 2], "s2_b2": [1]} and reduction.feature_groups(names, "date") == {"20200101": [0, 1, 3], "20200111": [2]}
    assert reduction.spread(reduction.reduced(table, model), 2).columns == ["id", "x", "reduced_1", "reduced_2"]


def test_matrix_files(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.csv").write_text(f"{files.ROWS}11\n{files.COLUMNS}11,12\n14258,52\n")
    (tmp_path / "in" / "b.csv").write_text(f"{files.ROWS}12\r\n{files.COLUMNS}11,12\r\n38,9372.5")
    got = sorted((r.ref, r["prod"], r.n) for r in files.read_matrices(spark, str(tmp_path / "in")).collect())
    assert got == [(11, 11, 14258), (11, 12, 52), (12, 11, 38), (12, 12, 9372.5)]
    (tmp_path / "in" / "c.csv").write_text(f"{files.ROWS}12\n{files.COLUMNS}11\n38,9\n")
    with pytest.raises(Exception, match="without a label"):
        files.read_matrices(spark, str(tmp_path / "in")).collect()
    cells = spark.createDataFrame([(1, 5, 5, 3), (1, 5, 7, 1), (1, 6, 6, 2), (2, 5, 9, 4)], "tile int, ref int, prod int, n long")
    files.write_matrices(cells, str(tmp_path / "out"), ["tile"])
    back = sorted((r.tile, r.ref, r["prod"], r.n) for r in files.read_matrices(spark, str(tmp_path / "out")).collect())
    assert back == [(1, 5, 5, 3), (1, 5, 6, 0), (1, 5, 7, 1), (1, 6, 5, 0), (1, 6, 6, 2), (1, 6, 7, 0), (2, 5, 9, 4)]
    bad = cells.selectExpr("tile", "if(tile = 2, raise_error('no'), ref) as ref", "prod", "n")
    with pytest.raises(Exception, match="no"):
        files.write_matrices(bad, str(tmp_path / "part"), ["tile"])
    assert not list((tmp_path / "part").rglob("part-*")) and not (tmp_path / "part" / "_SUCCESS").exists()


def test_rules_and_statistics(spark, tmp_path):
    (tmp_path / "rules.csv").write_text("1,2,4,2\n\n2,1,3,-1\r\n")
    assert files.read_rules(spark, str(tmp_path / "rules.csv")) == [(1, 2, 4, 2), (2, 1, 3, -1)]
    files.write_statistics(spark.createDataFrame([(1, 2.5)], "zone int, m double"), str(tmp_path / "s"), {"m": "mean"})
    assert files.read_statistics(spark, str(tmp_path / "s"), "zone int, mean double").collect() == [(1, 2.5)]
    with pytest.raises(Exception):
        files.read_statistics(spark, str(tmp_path / "s"), "zone int, other double").collect()


def test_hulls(spark):
    square = [(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (0.0, 4.0)]
    turned = [(0.0, 0.0), (3.0, 3.0), (2.0, 4.0), (-1.0, 1.0)]
    star = [(math.cos(k * math.pi / 5) * (2 if k % 2 == 0 else 1), math.sin(k * math.pi / 5) * (2 if k % 2 == 0 else 1)) for k in range(10)]
    ell = [(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 4.0), (0.0, 4.0)]
    shapes = spark.createDataFrame([(1, [square]), (2, [turned]), (3, [star]), (4, [ell]), (5, [[(1.0, 1.0), (2.0, 2.0)]]), (6, None), (7, [])], "fid long, rings array<array<struct<x:double,y:double>>>")
    got = {r.fid: r for r in spans.descriptors(shapes).collect()}
    assert (got[1].convexity, got[1].elongation, got[1].compactness) == (1, 1, pytest.approx(math.pi / 4))
    assert got[2].convexity == pytest.approx(1) and got[2].elongation == pytest.approx(3)
    pentagon = 5 / 2 * 4 * math.sin(2 * math.pi / 5)
    assert got[3].convexity == pytest.approx(10 * math.sin(math.pi / 5) / pentagon)
    assert got[4].convexity == pytest.approx(7 / 11.5) and got[5].convexity is None and got[6].area is None and got[7].convexity is None
