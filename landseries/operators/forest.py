"""Forests for many models at once: trees grown level by level from class counts in bins of the features."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.types import ArrayType, DoubleType, StructType

from landseries.sources.store import stored

#: A task sends its counts on when they hold this many numbers.
HELD = 1 << 23
#: Poisson(1) at or below 0, 1, 2, 3, 4, 5, in 2**32 parts: a row's weight in a tree is how many of them its number reaches.
POISSON = (1580030168, 3160060337, 3950075421, 4213413783, 4279248373, 4292415291)


@dataclass(frozen=True)
class Settings:
    """How trees are grown.

    kind: `forest` draws rows and features, `extra` takes all rows and one drawn bin a
    feature, `bagging` draws rows and takes all features, `tree` draws nothing.
    """

    kind: str = "forest"
    trees: int = 10
    depth: int = 5
    bins: int = 32
    features: int | None = None
    least: int = 1

    def tried(self, width: int) -> int:
        """Features tried at a node: the root of their number, unless told."""
        if self.kind in ("bagging", "tree"):
            return width
        return min(width, self.features or max(1, int(width**0.5)))


@dataclass(frozen=True)
class Forest:
    """Fitted trees. splits: (model, tree, node, feature, bin), rows of a greater bin go to node 2 n + 1, others to 2 n;
    leaves: (model, tree, node, proba), proba in the order of classes."""

    splits: DataFrame
    leaves: DataFrame
    low: list[float]
    high: list[float]
    classes: list
    settings: Settings = field(default_factory=Settings)


def mixed(key: Column, by: Column) -> Column:
    """A number below 2**32 that a key and a number below 2**30 fix."""
    return (F.pmod(key.cast("long"), F.lit(1 << 31)) * 2654435761 % (1 << 32)) * (2 * by.cast("long") + 1) % (1 << 32)


def mixed_numbers(key: np.ndarray, by: np.ndarray | int) -> np.ndarray:
    """mixed() of arrays."""
    return (key % (1 << 31) * 2654435761 % (1 << 32)) * (2 * by + 1) % (1 << 32)


def row_weight(key: pa.Array, tree: int, settings: Settings) -> np.ndarray:
    """How often a tree draws each row; a key that is no number is drawn by none."""
    if settings.kind in ("extra", "tree"):
        return np.ones(len(key), np.int64)
    h = mixed_numbers(key.fill_null(0).to_numpy(zero_copy_only=False), tree)
    return np.searchsorted(POISSON, h, "right") * key.is_valid().to_numpy(zero_copy_only=False)


def chosen(tree: int, node: int, width: int, settings: Settings) -> np.ndarray:
    """The features tried at a node, in order."""
    order = np.argsort(mixed_numbers(np.arange(1, width + 1), tree * (1 << settings.depth) + node), kind="stable")
    return np.sort(order[: settings.tried(width)])


def matrix(x: pa.Array, width: int) -> np.ndarray:
    """Arrays of numbers as rows of `width` places, NaN where there is none."""
    sizes = np.diff(x.offsets.to_numpy()) * x.is_valid().to_numpy(zero_copy_only=False)
    values = x.flatten().to_numpy(zero_copy_only=False)
    if (sizes == width).all():
        return values.reshape(len(x), width)
    out = np.full((len(x), width), np.nan)
    row = np.repeat(np.arange(len(x)), sizes)
    place = np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = place < width
    out[row[kept], place[kept]] = values[kept]
    return out


def binned(x: np.ndarray, low: Sequence[float], high: Sequence[float], bins: int) -> np.ndarray:
    """Each feature's bin among `bins` of equal width between its least and greatest value; null and NaN are in 0."""
    a, b = np.array(low, float), np.array(high, float)
    with np.errstate(invalid="ignore", divide="ignore"):
        place = np.floor((x - a) / (b - a) * bins)
    return np.where((b > a) & ~np.isnan(place), np.clip(place, 0, bins - 1), 0).astype(np.int32)


def nodes_of(bins: np.ndarray, splits: dict[int, tuple[int, int]], depth: int) -> np.ndarray:
    """The node that each row of bins reaches in a tree after `depth` levels; splits: feature and bin by node."""
    feature, cut = np.full(1 << depth, -1), np.zeros(1 << depth, int)
    for node, (f, b) in splits.items():
        if node < 1 << depth:
            feature[node], cut[node] = f, b
    at, row = np.ones(len(bins), int), np.arange(len(bins))
    for level in range(depth):
        f = np.where(at >= 1 << level, feature[at], -1)
        at = np.where(f < 0, at, 2 * at + (bins[row, f] > cut[at]))
    return at


def by_model(rows: Iterator[tuple]) -> dict:
    """{model: {tree: {node: value}}} of (model, tree, node, value)."""
    out = {}
    for model, tree, node, value in rows:
        out.setdefault(model, {}).setdefault(tree, {})[node] = value
    return out


def models_in(batch: pa.RecordBatch) -> Iterator[tuple[object, np.ndarray]]:
    """Each model of a batch and the places of its rows; null has none."""
    coded = batch["model"].dictionary_encode()
    code = coded.indices.fill_null(-1).to_numpy(zero_copy_only=False)
    for k, model in enumerate(coded.dictionary.to_pylist()):
        yield model, np.nonzero(code == k)[0]


def best_cut(counts: np.ndarray, features: np.ndarray, tree: int, node: int, settings: Settings) -> tuple[int, int] | None:
    """(feature, bin): the cut of a node of least impurity, if that is below the node's own.

    counts: of each feature tried, bin and class. The sum of squared class counts over their
    total, on both sides, is to be greatest (ties: least feature, then bin); with whole
    weights it comes out the same in any order. Cuts lie after bins that hold rows.
    """
    upto, every = counts.cumsum(axis=1), counts.sum(axis=1, keepdims=True)
    some = counts.sum(axis=2) > 0
    if settings.kind == "extra":
        drawn = mixed_numbers(features + 1, tree * (1 << settings.depth) + node) // 8 % (settings.bins - 1)
        below = some & (np.arange(some.shape[1]) <= drawn[:, None])
        last = some.shape[1] - 1 - below[:, ::-1].argmax(axis=1)
        some = below & (np.arange(some.shape[1]) == last[:, None])

    def squares(n: np.ndarray) -> np.ndarray:
        return sum(n[..., k] * n[..., k] for k in range(n.shape[-1]))

    left, all_ = (sum(n[..., k] for k in range(n.shape[-1])) for n in (upto, every))
    right = all_ - left
    with np.errstate(invalid="ignore", divide="ignore"):
        score = squares(upto) / left + squares(every - upto) / right
        better = some & (left >= settings.least) & (right >= settings.least) & (score > squares(every) / all_)
    if not better.any():
        return None
    place = int(np.where(better, score, -np.inf).argmax())  # the first of equals
    return int(features[place // score.shape[1]]), place % score.shape[1]


def counted(rows: DataFrame, splits: dict, width: int, classes: Sequence, settings: Settings, level: int, split: bool) -> list:
    """[(model, tree, node, value)] of the nodes of a level: the best cut, or with split=False the class counts of all nodes.

    A task adds up the counts of (tree, node, feature, bin, class) of its rows as arrays; a
    node's arrays meet in one group, which gives one row.
    """
    n, size = len(classes), 1 << level
    grown = rows.sparkSession.sparkContext.broadcast(splits)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, held = {}, 0

        def sent() -> pa.RecordBatch:
            model, tree, node = ([k[c] for k in total] for c in range(3))
            columns = {"model": pa.array(model, rows_model), "tree": pa.array(tree, pa.int32()), "node": pa.array(node, pa.int32()), "n": pa.array([v.tobytes() for v in total.values()], pa.binary())}
            return pa.RecordBatch.from_pydict(columns)

        rows_model = None
        for b in batches:
            rows_model = b.schema.field("model").type
            bins = np.frombuffer(b["bins"].buffers()[2], np.int32, len(b) * width, 4 * width * b["bins"].offset).reshape(len(b), width) if width else np.zeros((len(b), 0), np.int32)
            label, weight = b["label"].to_numpy(), b["weight"].to_numpy()
            for model, own in models_in(b):
                for tree in range(settings.trees):
                    w = row_weight(b["key"].take(pa.array(own)), tree, settings) * weight[own]
                    drawn = own[w > 0]
                    w = w[w > 0]
                    at = nodes_of(bins[drawn], grown.value.get(model, {}).get(tree, {}), level)
                    for node in np.unique(at):
                        if split and node < size:
                            continue  # a leaf of an earlier level
                        here = at == node
                        row = drawn[here]
                        if split:
                            tried = chosen(tree, int(node), width, settings)
                            place = (np.arange(len(tried)) * settings.bins + bins[row][:, tried]) * n + label[row][:, None]
                            add_ = np.bincount(place.ravel(), np.repeat(w[here], len(tried)), len(tried) * settings.bins * n)
                        else:
                            add_ = np.bincount(label[row], w[here], n)
                        key = (model, tree, int(node))
                        if key in total:
                            total[key] += add_
                        else:
                            total[key], held = add_, held + len(add_)
            if held > HELD:
                yield sent()
                total, held = {}, 0
        if total:
            yield sent()

    def choose(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        tree, node = int(pdf["tree"].iloc[0]), int(pdf["node"].iloc[0])
        total = np.zeros(len(pdf["n"].iloc[0]) // 8)
        for v in pdf["n"]:
            total += np.frombuffer(v)
        if split:
            tried = chosen(tree, node, width, settings)
            cut = best_cut(total.reshape(len(tried), settings.bins, n), tried, tree, node, settings)
            total = np.array(cut if cut else [], float)
        return pdf[["model", "tree", "node"]].iloc[:1].assign(value=[total])

    kind = rows.schema["model"].dataType.simpleString()
    parts = rows.mapInArrow(add, f"model {kind}, tree int, node int, n binary")
    found = parts.groupBy("model", "tree", "node").applyInPandas(choose, f"model {kind}, tree int, node int, value array<double>")
    return [(r.model, r.tree, r.node, r.value) for r in found.collect() if r.value]  # a row per node


def ends_of(rows: DataFrame, column: str = "x") -> tuple[list[float], list[float]]:
    """The least and greatest number of each feature, NaN apart (0 if there is none)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b["x"], int(np.diff(b["x"].offsets.to_numpy()).max(initial=0)))
            low, high = np.where(np.isnan(x), np.inf, x).min(axis=0, initial=np.inf), np.where(np.isnan(x), -np.inf, x).max(axis=0, initial=-np.inf)
            yield pa.RecordBatch.from_pydict({"feature": pa.array(np.arange(len(low)), pa.int32()), "low": pa.array(low), "high": pa.array(high)})

    parts = rows.select(F.col(column).alias("x")).mapInArrow(run, "feature int, low double, high double")
    ends = sorted(parts.groupBy("feature").agg(F.min("low"), F.max("high")).collect())  # a row per feature
    return [r[1] if r[1] <= r[2] else 0.0 for r in ends], [r[2] if r[1] <= r[2] else 0.0 for r in ends]


def fit(samples: DataFrame, classes: Sequence, settings: Settings = Settings(), weight: str | None = None) -> Forest:
    """Trees of every model in samples (key, model, label, x: array<double>), all grown together.

    A level takes one pass: a row adds its weight to the counts of (model, tree, node,
    feature, bin) for the node that it lies in and the features tried there. A task adds
    them up as arrays, whose number is bounded by nodes, features and bins, and only those
    are shuffled; what comes back is one cut per node. Rows are stored once, as bins, and walk
    the trees so far in each pass. weight: a column of samples that multiplies the draws.

    Rows without a label, key or model are left out; a model whose rows are of one class is a
    single leaf. No samples give no trees.
    """
    spark = samples.sparkSession
    known = samples.where(F.col("label").isin(list(classes)) & F.col("key").isNotNull() & F.col("model").isNotNull())
    place = (F.array_position(F.array(*map(F.lit, classes)), F.col("label")) - 1).cast("int").alias("label")
    known = stored(known.select(F.col("key").cast("long").alias("key"), "model", place, F.col("x").cast("array<double>").alias("x"), (F.col(weight) if weight else F.lit(1.0)).cast("double").alias("weight")))
    low, high = ends_of(known)
    width = len(low)

    def dealt(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            bins = binned(matrix(b["x"], width), low, high, settings.bins)
            columns = [b[c] for c in ("key", "model", "label", "weight")]
            yield pa.RecordBatch.from_arrays([*columns, pa.array([r.tobytes() for r in bins], pa.binary())], ["key", "model", "label", "weight", "bins"])

    kind = known.schema["model"].dataType.simpleString()
    rows = stored(known.mapInArrow(dealt, f"key long, model {kind}, label int, weight double, bins binary"))
    splits, cuts = [], {}
    for level in range(settings.depth):
        found = [(m, t, n, (int(v[0]), int(v[1]))) for m, t, n, v in counted(rows, cuts, width, classes, settings, level, True)]
        if not found:
            break
        splits += found
        cuts = by_model(splits)
    leaves = counted(rows, cuts, width, classes, settings, settings.depth, False)
    shares = [(m, t, n, [c / sum(v) for c in v]) for m, t, n, v in leaves]
    named = f"model {kind}, tree int, node int"
    return Forest(
        spark.createDataFrame([(m, t, n, *cut) for m, t, n, cut in splits], f"{named}, feature int, bin int"),
        spark.createDataFrame(shares, f"{named}, proba array<double>"), low, high, list(classes), settings,
    )


def walks(forest: Forest) -> dict:
    """{model: [(splits, {node: class shares}) of each tree]}."""
    splits = by_model((r.model, r.tree, r.node, (r.feature, r.bin)) for r in forest.splits.collect())
    leaves = by_model((r.model, r.tree, r.node, r.proba) for r in forest.leaves.collect())
    return {m: [(splits.get(m, {}).get(t, {}), trees.get(t, {})) for t in range(forest.settings.trees)] for m, trees in leaves.items()}


def shares_of(bins: np.ndarray, trees: list, depth: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """The mean class shares of the leaves that rows reach, and whether there is one."""
    total, met = np.zeros((len(bins), n)), np.zeros(len(bins), int)
    for splits, leaves in trees:
        table, some = np.zeros((2 << depth, n)), np.zeros(2 << depth, bool)
        for node, p in leaves.items():
            table[node], some[node] = p, True
        at = nodes_of(bins, splits, depth)
        total += table[at]
        met += some[at]
    return total / np.maximum(met, 1)[:, None], met > 0


def told_by(forests: Sequence[Forest], rows: DataFrame, names: Sequence[str]) -> DataFrame:
    """rows with the probabilities() of several forests, a column each, in one pass.

    All trees are sent to the tasks; models, trees and depth bound their size.
    """
    known = rows.sparkSession.sparkContext.broadcast([walks(f) for f in forests])
    shapes = [(f.low, f.high, f.settings, len(f.classes)) for f in forests]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            arrays, names_ = list(b.columns[:-1]), b.schema.names[:-1]  # the last is x as doubles
            own = list(models_in(b))
            for (low, high, settings, n), trees, name in zip(shapes, known.value, names, strict=True):
                bins = binned(matrix(b["_x"], len(low)), low, high, settings.bins)
                out, some = np.zeros((len(b), n)), np.zeros(len(b), bool)
                for model, at in own:
                    if model in trees:
                        out[at], some[at] = shares_of(bins[at], trees[model], settings.depth, n)
                ends = np.concatenate([[0], np.cumsum(np.full(len(b), n))]).astype(np.int32)
                none = pa.array(np.zeros(len(b), bool) | ~some)
                whole = pa.ListArray.from_arrays(pa.array(ends), pa.array(out.ravel()))
                arrays.append(pa.compute.if_else(none, pa.scalar(None, whole.type), whole))
                names_ = [*names_, name]
            yield pa.RecordBatch.from_arrays(arrays, names_)

    schema = StructType(list(rows.schema.fields))
    for name in names:
        schema = schema.add(name, ArrayType(DoubleType()))
    return rows.withColumn("_x", F.col("x").cast("array<double>")).mapInArrow(run, schema)


def probabilities(forest: Forest, rows: DataFrame) -> DataFrame:
    """rows (with model and x) and `proba`: the mean of the class shares of the leaves that a row falls into.

    Rows of a model without trees, or of none, get null.
    """
    return told_by([forest], rows, ["proba"])


def classify(forest: Forest, rows: DataFrame) -> DataFrame:
    """probabilities(), with `label` (the first class of the greatest probability) and `conf`, that probability."""
    named = F.array(*map(F.lit, forest.classes))
    out = probabilities(forest, rows)
    return out.withColumns({"label": F.get(named, (F.array_position("proba", F.array_max("proba")) - 1).cast("int")), "conf": F.array_max("proba")})


def standardised(rows: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """rows with x less its mean and over its population deviation (1 if zero), in each group."""
    width = rows.select(F.max(F.size("x"))).first()[0] or 0
    stats = rows.groupBy(*by).agg(
        F.array(*(F.avg(F.col("x")[k]) for k in range(width))).alias("_mean"), F.array(*(F.stddev_pop(F.col("x")[k]) for k in range(width))).alias("_std")
    )
    both = rows.join(F.broadcast(stats), list(by)) if by else rows.crossJoin(F.broadcast(stats))
    scaled = F.transform(F.arrays_zip("x", "_mean", "_std"), lambda v: (v["x"] - v["_mean"]) / F.when(v["_std"] > 0, v["_std"]).otherwise(1.0))
    return both.withColumn("x", scaled).drop("_mean", "_std")


def search(samples: DataFrame, classes: Sequence, grid: Sequence[Settings], folds: int = 5, group: str | None = None) -> DataFrame:
    """(setting, mean, std, best): accuracy of each setting (its place in the grid) over folds, and whether it is the best.

    A row's fold is drawn from its key, or from its group (a polygon's id), so that a group
    is never on both sides. All models and folds of a setting are fitted at once; a row is
    tested by the trees of its fold. Ties go to the first setting.
    """
    of = F.pmod(F.xxhash64(group or "key"), F.lit(folds)).cast("int")
    dealt = stored(samples.withColumn("fold", of))
    others = F.filter(F.sequence(F.lit(0), F.lit(folds - 1)), lambda k: k != F.col("fold"))
    learn = dealt.withColumn("without", F.explode(others)).withColumn("model", F.struct("model", F.col("without").alias("fold")).cast("string"))
    test = dealt.withColumn("model", F.struct("model", "fold").cast("string")).withColumnRenamed("label", "ref")
    scores = None
    for k, settings in enumerate(grid):
        tested = classify(fit(learn, classes, settings), test)
        own = tested.groupBy("fold").agg(F.avg((F.col("label").eqNullSafe(F.col("ref"))).cast("double")).alias("right"))
        own = own.agg(F.avg("right").alias("mean"), F.stddev_pop("right").alias("std")).select(F.lit(k).alias("setting"), "mean", "std")
        scores = own if scores is None else scores.unionByName(own)
    order = Window.partitionBy(F.lit(0)).orderBy(F.desc("mean"), "setting")  # a row per setting
    return stored(scores).withColumn("best", F.row_number().over(order) == 1)


def boosted(samples: DataFrame, classes: Sequence, settings: Settings = Settings("tree", trees=1, depth=2), rounds: int = 10) -> list[tuple[Forest, DataFrame]]:
    """Trees fitted one after the other, each with more weight on rows that the ones before got wrong (multi-class AdaBoost).

    Each round returns its trees and (model, alpha): the log odds of its weighted error plus
    log(classes - 1). A model with no error, or no better than chance, has alpha 0 from then on.
    """
    out, n = [], len(classes)
    rows = stored(samples.where(F.col("label").isin(list(classes))).withColumn("weight", F.lit(1.0)))
    for _ in range(rounds):
        forest = fit(rows, classes, settings, weight="weight")
        told = stored(classify(forest, rows.withColumnRenamed("label", "ref")).withColumn("wrong", F.col("label") != F.col("ref")))
        share = F.sum(F.when(F.col("wrong"), F.col("weight")).otherwise(0.0)) / F.sum("weight")
        alpha = told.groupBy("model").agg(share.alias("e")).select("model", F.when((F.col("e") > 0) & (F.col("e") < 1 - 1 / n), F.log((1 - F.col("e")) / F.col("e")) + F.log(F.lit(n - 1.0))).otherwise(0.0).alias("alpha"))
        alpha = stored(alpha)
        out.append((forest, alpha))
        grown = told.join(F.broadcast(alpha), "model").withColumn("weight", F.col("weight") * F.exp(F.when(F.col("wrong"), F.col("alpha")).otherwise(0.0)))
        rows = stored(grown.withColumnRenamed("label", "told").withColumnRenamed("ref", "label").select(*rows.columns))
    return out


def boosted_label(fits: Sequence[tuple[Forest, DataFrame]], rows: DataFrame) -> DataFrame:
    """rows with `label`: the class with the most alpha among the trees' labels (ties: first class)."""
    named = F.array(*map(F.lit, fits[0][0].classes))
    out, votes = told_by([forest for forest, _ in fits], rows, [f"_p{k}" for k in range(len(fits))]), []
    for k, (_, alpha) in enumerate(fits):
        out = out.join(F.broadcast(alpha.withColumnRenamed("alpha", f"_a{k}")), "model", "left")
        label = F.get(named, (F.array_position(f"_p{k}", F.array_max(f"_p{k}")) - 1).cast("int"))
        votes.append(F.struct(label.alias("label"), F.coalesce(f"_a{k}", F.lit(0.0)).alias("alpha")))
    out = out.withColumn("votes", F.array(*votes)).select(*rows.columns, "votes")
    classes = fits[0][0].classes
    weight = F.transform(F.array(*map(F.lit, classes)), lambda c: F.aggregate(F.filter("votes", lambda v: v["label"] == c), F.lit(0.0), lambda a, v: a + v["alpha"]))
    return out.withColumn("_w", weight).withColumn("label", F.get(F.array(*map(F.lit, classes)), (F.array_position("_w", F.array_max("_w")) - 1).cast("int"))).drop("votes", "_w")


def voted(forests: Sequence[Forest], rows: DataFrame) -> DataFrame:
    """rows with the mean `proba` of several classifiers of the same classes, its `label` and `conf`."""
    out = told_by(forests, rows, [f"_p{k}" for k in range(len(forests))])
    total = F.col("_p0")
    for k in range(1, len(forests)):
        total = F.zip_with(total, F.col(f"_p{k}"), lambda a, b: a + b)
    out = out.withColumn("proba", F.transform(total, lambda v: v / len(forests))).drop(*(f"_p{k}" for k in range(len(forests))))
    named = F.array(*map(F.lit, forests[0].classes))
    return out.withColumns({"label": F.get(named, (F.array_position("proba", F.array_max("proba")) - 1).cast("int")), "conf": F.array_max("proba")})
