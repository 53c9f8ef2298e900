"""Super-pixels against plain loops on a small grid, and what is built on them."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landseries.operators import superpixels as op
from landseries.operators.forest import Settings
from landseries.plans import superpixels as plans


def plain(value: dict, step: int, weight: float, rounds: int) -> dict:
    centre = {}
    for x, y in value:
        centre.setdefault((x // step, y // step), []).append((x, y, value[x, y]))
    mean = lambda rows: tuple(round(sum(r[k] for r in rows) / len(rows), 6) for k in range(3))
    centre = {s: mean(rows) for s, rows in centre.items()}
    for k in range(rounds + 1):
        told = {}
        for x, y in value:
            near = [(s, c) for s, c in centre.items() if abs(s[0] - x // step) <= 1 and abs(s[1] - y // step) <= 1]
            w = weight / step**2
            told[x, y] = min(((x - c[0]) ** 2 * w + (y - c[1]) ** 2 * w + (value[x, y] - c[2]) ** 2, s) for s, c in near)[1]
        if k < rounds:
            groups = {}
            for (x, y), s in told.items():
                groups.setdefault(s, []).append((x, y, value[x, y]))
            centre |= {s: mean(rows) for s, rows in groups.items()}
    return told


@pytest.fixture(scope="module")
def image(spark):
    rng = np.random.default_rng(2)
    value = {(x, y): float(round((x > 17) + 2 * (y > 25) + rng.normal() * 0.2, 3)) for x in range(40) for y in range(40) if (x, y) != (5, 5)}
    label = lambda x, y: 1 + int(x > 17)
    return spark.createDataFrame([(x, y, v, label(x, y)) for (x, y), v in value.items()], "x long, y long, v double, label int"), value


def test_clusters_equal_plain_loops(image):
    cells, value = image
    got = {(r.x, r.y): (r.seed_x, r.seed_y) for r in op.clusters(cells, ["v"], 8, 2.0, 3).collect()}
    assert got == plain(value, 8, 2.0, 3)


def test_segments_are_connected_and_large_enough(image):
    cells, value = image
    got = {(r.x, r.y): r.segment for r in op.superpixels(cells, ["v"], 8, 0.3, 2, least=4).collect()}
    assert set(got) == set(value)
    for s in set(got.values()):
        own = {c for c in got if got[c] == s}
        seen, todo = set(), [next(iter(own))]
        while todo:
            x, y = todo.pop()
            if (x, y) in own and (x, y) not in seen:
                seen.add((x, y))
                todo += [(x + 1, y), (x - 1, y), (x, y + 1), (x, y - 1)]
        assert seen == own
    assert len(set(got.values())) < 60


def test_touched(image, spark):
    cells, _ = image
    segs = op.superpixels(cells, ["v"], 8, 2.0, 1).cache()
    of = {(r.x, r.y): r.segment for r in segs.collect()}
    refs = spark.createDataFrame([(0, 0, "a"), (1, 0, "b"), (30, 30, "c"), (99, 99, "off")], "x long, y long, name string")
    got = op.touched(segs, refs).collect()
    hit = {of[0, 0], of[1, 0], of[30, 30]}
    assert {(r.x, r.y) for r in got} == {c for c, s in of.items() if s in hit} and len(got) == len({(r.x, r.y) for r in got})
    assert {r.name for r in got if not r.is_super_pix} == {"a", "b", "c"} and all(r.name is None for r in got if r.is_super_pix)


def test_context_helps(image):
    cells, _ = image
    noisy = op.superpixels(cells, ["v"], 8, 2.0, 2).withColumn("u", F.rand(7) * 1.2 + F.col("label") * 0.8)
    rows = noisy.select((F.col("y") * 40 + F.col("x")).alias("key"), F.lit("m").alias("model"), "label", F.array("u").alias("x"), "segment").cache()
    settings = Settings("tree", 1, 3, 16)
    right = []
    for rounds in (0, 1):
        told = op.auto_context(rows.where("key % 2 = 0"), rows.withColumnRenamed("label", "ref"), [1, 2], settings, rounds)
        right.append(told.agg(F.avg((F.col("label") == F.col("ref")).cast("int"))).first()[0])
    assert right[1] > right[0]


def test_nearest_seeds_of_a_block():
    rng = np.random.default_rng(4)
    xy = np.stack(np.meshgrid(np.arange(-9, 12), np.arange(-5, 20)), axis=-1).reshape(-1, 2)
    cells = np.column_stack([xy, rng.integers(0, 3, len(xy))]).astype(float)
    square = xy // 4
    seeds = np.unique(square, axis=0)
    seeds = np.concatenate([seeds[rng.random(len(seeds)) < 0.8], [[50, 50]]])
    own = (square[:, None] == seeds).all(axis=2).any(axis=1)
    cells, square = cells[own], square[own]
    centres = np.column_stack([seeds * 4 + 1.5, rng.integers(0, 3, len(seeds))])
    scale = np.array([0.125, 0.125, 1.0])
    want = []
    for c, s in zip(cells, square, strict=True):
        near = [k for k in range(len(seeds)) if (abs(seeds[k] - s) <= 1).all()]
        want.append(min(near, key=lambda k, c=c: (((c - centres[k]) ** 2 * scale).sum(), *seeds[k])))
    assert op.nearest(cells, square, seeds, centres, scale).tolist() == want


def test_shares_with_the_number_of_cells(spark):
    rows = spark.createDataFrame([(1, 3), (1, 4), (2, 3)], "segment long, label int")
    assert {r.segment: (r.shares, r.n) for r in op.class_shares(rows, [3, 4], size="n").collect()} == {1: ([0.5, 0.5], 2), 2: ([1.0, 0.0], 1)}


def test_cells_of_auto_context_are_made_once(spark, monkeypatch):
    made = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            made.add(len(b))
            yield b

    k = F.col("id")
    cells = spark.range(300).select((k % 150).alias("x"), F.floor(k / 150).alias("y"), (1 + k % 5).cast("int").alias("label"), (k % 7 / 7).alias("conf"), (k % 9).alias("segment"))
    monkeypatch.setattr(plans, "segments", lambda t: cells.mapInPandas(counted, cells.schema))
    assert plans.auto_context(None).count() == 300 and made.value == 300
