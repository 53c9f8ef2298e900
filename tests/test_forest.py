"""Trees grown on Spark against trees grown by plain loops, and what settings promise."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from landseries.operators import forest as op
from landseries.operators.forest import POISSON, Settings

CLASSES = (1, 2, 3)


def mixed(key: int, by: int) -> int:
    return (key % 2**31 * 2654435761 % 2**32) * (2 * by + 1) % 2**32


def grown(x: np.ndarray, y: np.ndarray, weight: np.ndarray, tree: int, s: Settings) -> tuple[dict, dict]:
    """Splits and leaves of one tree: {node: (feature, bin)} and {node: class shares}."""
    splits, leaves, at = {}, {}, np.ones(len(x), int)

    def counts(rows: np.ndarray) -> np.ndarray:
        return np.array([weight[rows & (y == c)].sum() for c in CLASSES], float)

    for node in range(1, 2 << s.depth):
        rows = at == node
        n = counts(rows)
        if not n.sum():
            continue
        order = sorted(range(x.shape[1]), key=lambda f: (mixed(f + 1, tree * 2**s.depth + node), f))[: s.tried(x.shape[1])]
        best, own = None, (n**2).sum() / n.sum()
        for f in sorted(order):
            for b in sorted(set(x[rows & (weight > 0), f])) if node < 1 << s.depth else ():
                left = counts(rows & (x[:, f] <= b))
                right = n - left
                if min(left.sum(), right.sum()) >= s.least:
                    score = (left**2).sum() / left.sum() + (right**2).sum() / right.sum()
                    if score > own and (best is None or score > best[0]):
                        best = (score, f, b)
        if best:
            splits[node] = best[1:]
            at[rows] = 2 * node + (x[rows, best[1]] > best[2])
        else:
            leaves[node] = n / n.sum()
    return splits, leaves


@pytest.fixture(scope="module")
def samples(spark):
    rng = np.random.default_rng(3)
    rows = []
    for k in range(240):
        x = rng.normal(size=6)
        label = 1 + int(x[0] > 0) + int(x[0] > 0 and x[3] > 0.2)
        rows.append((k, f"m{k % 2}", label if rng.random() < 0.9 else 3, x.tolist(), k // 8))
    rows += [(900, "lone", 2, [0.0] * 6, 99), (901, "m0", None, [0.0] * 6, 99), (None, "m0", 1, [0.0] * 6, 99), (902, None, 1, [0.0] * 6, 99)]
    return spark.createDataFrame(rows, "key long, model string, label int, x array<double>, polygon int")


@pytest.mark.parametrize("settings", [Settings("forest", 2, 3, 8), Settings("bagging", 2, 2, 8, least=5)])
def test_trees_equal_plain_loops(samples, settings):
    forest = op.fit(samples, CLASSES, settings)
    rows = [r for r in samples.collect() if r.label and r.key is not None and r.model]
    x = np.array([r.x for r in rows])
    low, high = x.min(axis=0), x.max(axis=0)
    binned = np.minimum((x - low) / (high - low) * settings.bins, settings.bins - 1).astype(int)
    got, leaves = {}, {}
    for r in forest.splits.collect():
        got[r.model, r.tree, r.node] = (r.feature, r.bin)
    for r in forest.leaves.collect():
        leaves[r.model, r.tree, r.node] = r.proba
    want, want_leaves = {}, {}
    for model in ("m0", "m1", "lone"):
        own = np.array([r.model == model for r in rows])
        y, keys = np.array([r.label for r in rows])[own], [r.key for r in rows if r.model == model]
        for tree in range(settings.trees):
            w = np.array([1 if settings.kind == "tree" else sum(mixed(k, tree) >= c for c in POISSON) for k in keys])
            splits, ends = grown(binned[own], y, w, tree, settings)
            want |= {(model, tree, n): s for n, s in splits.items()}
            want_leaves |= {(model, tree, n): pytest.approx(p.tolist()) for n, p in ends.items()}
    assert got == want and leaves == want_leaves


def test_labels_by_the_model_of_a_row(samples):
    forest = op.fit(samples, CLASSES, Settings("bagging", 6, 3, 16))
    told = op.classify(forest, samples.withColumnRenamed("label", "ref")).collect()
    right = [r.label == r.ref for r in told if r.ref and r.model in ("m0", "m1")]
    assert np.mean(right) > 0.85 and all(r.label is None and r.conf is None for r in told if r.model is None)
    assert all(r.label == 2 and r.conf == 1 for r in told if r.model == "lone") and all(sum(r.proba) == pytest.approx(1) for r in told if r.proba)
    unseen = samples.select("key", F.lit("other").alias("model"), "x")
    assert op.classify(forest, unseen).where("label is not null").count() == 0
    assert op.fit(samples.where("false"), CLASSES, Settings("tree", 1, 2)).splits.count() == 0


def test_kinds_votes_and_boosting(samples):
    known = samples.where("model in ('m0', 'm1') and label is not null and key is not null")
    extra = op.fit(known, CLASSES, Settings("extra", 10, 3, 16, features=4))
    bag = op.fit(known, CLASSES, Settings("bagging", 4, 3, 16))
    bare = known.withColumnRenamed("label", "ref")
    right = lambda d: d.agg(F.avg((F.col("label") == F.col("ref")).cast("int"))).first()[0]
    assert right(op.classify(extra, bare)) > 0.7 and right(op.voted([extra, bag], bare)) > 0.8
    stumps = op.boosted(known, CLASSES, Settings("tree", 1, 1, 16), 3)
    assert right(op.boosted_label(stumps, bare)) > right(op.classify(stumps[0][0], bare)) and all(a > 0 for r in stumps[0][1].collect() for a in [r.alpha])


def test_search_keeps_groups_whole(samples):
    got = op.search(samples.where("label is not null and key is not null and model in ('m0', 'm1')"), CLASSES, [Settings("tree", 1, 1, 8), Settings("bagging", 3, 3, 8)], 2, "polygon").collect()
    assert [r.best for r in sorted(got)] == [False, True] and all(0 < r["mean"] < 1 for r in got)


def test_a_level_is_one_pass(spark, samples):
    """Jobs of a fit: two tables are stored and each pass, for ends, levels and leaves, is a map and a group."""
    context, known = spark.sparkContext, samples.cache()
    known.count()
    context.setJobGroup("fit", "")
    op.fit(known, CLASSES, Settings("bagging", 3, 3, 8))
    context.setJobGroup("told", "")
    told = op.voted([op.fit(known, CLASSES, Settings("bagging", 3, 3, 8))] * 3, known.drop("label"))
    context.setLocalProperty("spark.jobGroup.id", None)
    assert len(context.statusTracker().getJobIdsForGroup("fit")) <= 2 + 2 * (1 + 3 + 1)
    plan = told._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1 and "Join" not in plan


def test_features_that_are_null_short_or_not_numbers(spark):
    rows = [(k, "m", 1 + k % 2, x) for k, x in enumerate([[0.0, 1.0], [1.0, None], [float("nan"), 1.0], [1.0], None, [1.0, 0.0], [0.0, 0.0], [1.0, 0.5]])]
    table = spark.createDataFrame(rows, "key long, model string, label int, x array<double>")
    forest = op.fit(table, CLASSES, Settings("tree", 1, 1, 4))
    assert (forest.low, forest.high) == ([0.0, 0.0], [1.0, 1.0])
    assert [tuple(r) for r in forest.splits.collect()] == [("m", 0, 1, 0, 0)]
    assert {r.key: r.label for r in op.classify(forest, table.drop("label")).collect()} == {k: 2 if x and x[0] == 1 else 1 for k, _, _, x in rows}
