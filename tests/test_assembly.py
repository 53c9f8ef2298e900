"""Order, names and duplicates of assembled features."""

import math

import pytest

from landseries.operators import assembly as op


@pytest.fixture(scope="module")
def rows(spark):
    data = [(1, 1, [1.0, 2.0, 3.0]), (1, 0, [4.0, 5.0, 6.0]), (2, 0, [1.0, 1.0, -10000.0]), (2, 1, [0.0, 0.0, 0.0]), (2, None, [9.0, 9.0, 9.0])]
    return spark.createDataFrame(data, "pixel long, date_idx int, bands array<double>")


def test_order_and_names(rows):
    sensor = op.Sensor("s", ["a", "b", "c"], 1, 2, 3, user={"first": lambda b: b[0]})
    got = {r.pixel: r.features for r in op.assembled(rows, sensor).collect()}
    names = op.feature_names(sensor, ["d0", "d1"])
    assert names == ["s_a_d0", "s_b_d0", "s_c_d0", "s_a_d1", "s_b_d1", "s_c_d1", "s_NDVI_d0", "s_NDVI_d1", "s_NDWI_d0", "s_NDWI_d1", "s_Brightness_d0", "s_Brightness_d1", "s_first_d0", "s_first_d1"]
    assert got[1] == pytest.approx([4, 5, 6, 1, 2, 3, 1000 / 9, 1000 / 3, 1000 / 11, 200, math.sqrt(77), math.sqrt(14), 4, 1])
    assert got[2] == [1, 1, -10000, 0, 0, 0, -10000, 0, -10000, 0, -10000, 0, -10000, 0]


@pytest.mark.parametrize("reference, duplicates, left", [(1, False, ["NDWI", "Brightness"]), (2, False, ["NDVI", "Brightness"]), (3, False, ["NDVI", "NDWI", "Brightness"]), (1, True, ["NDVI", "NDWI", "Brightness"]), (None, False, ["NDVI", "NDWI", "Brightness"])])
def test_duplicates(rows, reference, duplicates, left):
    sensor = op.Sensor("s", ["a", "b", "c"], 1, 2, 3, reference=reference, duplicates=duplicates)
    assert sensor.indices() == left
    got = {r.pixel: r.features for r in op.assembled(rows, sensor).collect()}
    assert len(got[1]) == len(op.feature_names(sensor, ["d0", "d1"])) == 6 + 2 * len(left)
    if reference == 1:
        assert got[1][:3] == pytest.approx([4, 1 / 9, 2 / 10])


def test_checks_and_several_sensors(rows):
    with pytest.raises(ValueError, match="nir is band 9"):
        op.Sensor("s", ["a", "b", "c"], 1, 9)
    one, two = op.Sensor("s", ["a", "b", "c"], 1, 2), op.Sensor("t", ["a", "b", "c"], 1, 2, copies=False)
    assert one.indices() == ["NDVI", "Brightness"]
    parts = {"s": op.assembled(rows, one), "t": op.assembled(rows.where("pixel = 1"), two)}
    both, names = op.all_sensors(parts, {"s": op.feature_names(one, ["0", "1"]), "t": op.feature_names(two, ["0", "1"])})
    got = both.collect()
    assert [r.pixel for r in got] == [1] and len(got[0].features) == len(names) == 14 and names[10] == "t_NDVI_0"
    assert op.all_sensors(parts, {"s": ["x"], "t": ["y"]}, standard=True)[1] == ["value_0", "value_1"]
    assert op.assembled(rows.where("false"), one).count() == 0
