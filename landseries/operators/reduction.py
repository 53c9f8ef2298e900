"""Principal components of groups of features, fitted for all groups in one pass and applied in expressions."""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landseries.sources.store import stored

MODES = ("global", "sensor_band", "sensor_date", "date", "band")


def feature_groups(names: Sequence[str], mode: str) -> dict[str, list[int]]:
    """Places of the features `sensor_band_date` by group: all, or those of equal parts."""
    if mode not in MODES:
        raise ValueError(f"{mode} is none of {MODES}")
    parts = {"sensor": 0, "band": 1, "date": 2}
    groups: dict[str, list[int]] = {}
    for k, name in enumerate(names):
        own = name.rsplit("_", 2)
        key = "global" if mode == "global" else "_".join(own[parts[p]] for p in mode.split("_"))
        groups.setdefault(key, []).append(k)
    return dict(sorted(groups.items()))


def correlations(rows: DataFrame, groups: dict[str, list[int]]) -> DataFrame:
    """(grp, i, j, r, mean, std): correlations of the features of each group, i and j counted in the group; mean and std are i's.

    Means and deviations come from one aggregate. The products of standardised features are
    then added up in tasks, as one matrix a group, and the tasks' sums by place. A constant
    feature counts as deviation 1, so its correlations are 0. Rows with nulls are left out.
    """
    known = rows.select(F.col("x").cast("array<double>").alias("x")).where(F.col("x").isNotNull() & F.forall("x", lambda v: v.isNotNull()))
    stats = sorted(known.select(F.posexplode("x").alias("k", "v")).groupBy("k").agg(F.avg("v"), F.stddev_pop("v"), F.count("*")).collect())  # a row per feature
    mean, std = np.array([r[1] for r in stats]), np.array([r[2] if r[2] else 1.0 for r in stats])
    n = stats[0][3] if stats else 0

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = {g: np.zeros((len(k), len(k))) for g, k in groups.items()}
        for batch in batches:
            z = (np.stack(batch["x"].to_numpy()) - mean) / std
            for g, k in groups.items():
                total[g] += z[:, k].T @ z[:, k]
        for g, m in total.items():
            i, j = np.indices(m.shape)
            yield pd.DataFrame({"grp": g, "i": i.ravel(), "j": j.ravel(), "v": m.ravel()})

    sums = known.mapInPandas(run, "grp string, i long, j long, v double").groupBy("grp", "i", "j").agg((F.sum("v") / F.lit(float(max(n, 1)))).alias("r"))
    own = rows.sparkSession.createDataFrame([(g, i, float(mean[k]), float(std[k]), k) for g, ks in groups.items() for i, k in enumerate(ks) if n], "grp string, i long, mean double, std double, feature int")
    return sums.join(F.broadcast(own), ["grp", "i"])


def fit_components(rows: DataFrame, groups: dict[str, list[int]], keep: int) -> DataFrame:
    """(grp, component, variance, features, mean, std, loadings): up to `keep` principal components of each group.

    Standardised features; the k x k eigenproblem of a group is solved in a task. Of a
    component's two signs the one with the greatest loading positive is taken.
    """

    def solve(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["i", "j"])
        k = int(pdf["i"].max()) + 1
        values, vectors = np.linalg.eigh(pdf["r"].to_numpy().reshape(k, k))
        first = pdf.groupby("i").first()
        out = []
        for c in range(min(keep, k)):
            v = vectors[:, k - 1 - c]
            v = v * np.sign(v[np.abs(v).argmax()])
            out.append((pdf["grp"].iloc[0], c, values[k - 1 - c], first["feature"].tolist(), first["mean"].tolist(), first["std"].tolist(), v.tolist()))
        return pd.DataFrame(out, columns=["grp", "component", "variance", "features", "mean", "std", "loadings"])

    schema = "grp string, component int, variance double, features array<int>, mean array<double>, std array<double>, loadings array<double>"
    return stored(correlations(rows, groups).groupBy("grp").applyInPandas(solve, schema))


def reduced(rows: DataFrame, model: DataFrame) -> DataFrame:
    """rows with `reduced`: the components of all groups, by group and component, from their array x.

    The model is one broadcast row, whose size the features bound. Names are reduced_1,
    reduced_2, .. (see spread()). A row with nulls in x gets nulls.
    """
    one = model.agg(F.array_sort(F.collect_list(F.struct("grp", "component", "features", "mean", "std", "loadings"))).alias("_model"))

    def score(c):
        z = F.zip_with(F.transform(c["features"], lambda k: F.get("x", k)), F.arrays_zip(c["mean"].alias("m"), c["std"].alias("s"), c["loadings"].alias("l")), lambda v, p: (v - p["m"]) / p["s"] * p["l"])
        return F.aggregate(z, F.lit(0.0), lambda a, v: a + v)

    return rows.crossJoin(F.broadcast(one)).withColumn("reduced", F.transform("_model", score)).drop("_model")


def spread(rows: DataFrame, n: int) -> DataFrame:
    """The array `reduced` as columns reduced_1 .. reduced_n."""
    return rows.select(*(c for c in rows.columns if c != "reduced"), *(F.get("reduced", F.lit(k)).alias(f"reduced_{k + 1}") for k in range(n)))
