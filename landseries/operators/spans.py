"""Shapes of any form as spans of cells along rows: their number grows with the shapes' height, not their area.

A span is (y, a, b): the cells a .. b - 1 of row y. A cell belongs to a shape if its centre
does by the even-odd rule over all rings, so holes and parts need no order. Operations work
on spans cut at tiles of TILE cells, so that a row of any length is many groups. Areas that pairs
of shapes share come from masks: SIDE rows of a word of SIDE bits each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TILE = 256
SIDE, COARSE = 64, 32
PARTS, PAIRS = 8, 1 << 20  # tasks that may share a coarse cell; pairs that numpy looks at together
MOST_CORNERS = 512  # points of a shape whose hull is found together with those of others
CROSSINGS = 1 << 19  # sides of rows that numpy sorts together, but for a shape of more
MEASURED = ("area", "perimeter", "hull", "long", "short")


def edges(shapes: DataFrame, keep: Sequence[str] = ("fid",)) -> DataFrame:
    """(keep, x1, y1, x2, y2): the sides of all rings, which may be closed or not."""
    ring = shapes.select(*keep, F.explode("rings").alias("ring"))
    ends = F.concat(F.slice("ring", 2, F.greatest(F.size("ring") - 1, F.lit(0))), F.slice("ring", 1, 1))
    side = ring.where(F.size("ring") > 1).select(*keep, F.explode(F.arrays_zip(F.col("ring").alias("p"), ends.alias("q"))).alias("e"))
    return side.select(*keep, F.col("e.p.x").alias("x1"), F.col("e.p.y").alias("y1"), F.col("e.q.x").alias("x2"), F.col("e.q.y").alias("y2"))


def shape_spans(shapes: DataFrame, keep: Sequence[str] = ("fid",)) -> DataFrame:
    """(keep, y, a, b): the spans of shapes (keep, rings: array of arrays of x, y).

    Each side gives its crossing with the middle of every row that it passes; a row's sorted
    crossings in pairs are its spans. A shape is one row and its spans come out of that row, so nothing
    is shuffled. Null and empty rings give none.
    """
    kinds = ", ".join(f"`{c}` {shapes.schema[c].dataType.simpleString()}" for c in keep)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            of, x, y, nexts, size = flat_points(batch.column(len(keep)))
            x2, y2 = x[nexts], y[nexts]
            low, high = np.ceil(np.minimum(y, y2) - 0.5), np.ceil(np.maximum(y, y2) - 0.5)
            met = (size > 1) & (high > low) & ~np.isnan(x + x2)
            of, x, y, x2, y2, low, n = of[met], x[met], y[met], x2[met], y2[met], low[met].astype(np.int64), (high - low)[met].astype(np.int64)
            upto = np.cumsum(np.bincount(of, n, batch.num_rows))[of] // CROSSINGS  # whole shapes at a time
            for part in np.split(np.arange(len(of)), np.nonzero(np.diff(upto))[0] + 1):
                k = np.repeat(part, n[part])
                row = np.repeat(low[part] - np.cumsum(n[part]) + n[part], n[part]) + np.arange(len(k))
                at = np.ceil(x[k] + (row + 0.5 - y[k]) * (x2[k] - x[k]) / (y2[k] - y[k]) - 0.5).astype(np.int64)
                order = np.lexsort((at, row, of[k]))
                k, row, at = k[order], row[order], at[order]
                first = np.ones(len(k), bool)
                first[1:] = (of[k[1:]] != of[k[:-1]]) | (row[1:] != row[:-1])
                place = np.arange(len(k)) - np.maximum.accumulate(np.where(first, np.arange(len(k)), 0))
                a = np.nonzero(place % 2 == 0)[0]
                a = a[a + 1 < len(k)]
                a = a[(place[a + 1] == place[a] + 1) & (at[a] < at[np.minimum(a + 1, len(k) - 1)])]
                own = pa.array(of[k[a]])
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(own) for c in range(len(keep))), *map(pa.array, (row[a], at[a], at[a + 1]))], [*keep, "y", "a", "b"])

    return shapes.select(*keep, "rings").mapInArrow(run, f"{kinds}, y long, a long, b long")


def rectangle_spans(rects: DataFrame, keep: Sequence[str] = ("fid",)) -> DataFrame:
    """(keep, y, a, b) of rectangles x0, y0, w, h; empty ones have none."""
    some = rects.where("w > 0 and h > 0").withColumn("y", F.explode(F.sequence(F.col("y0"), F.col("y0") + F.col("h") - 1)))
    return some.select(*keep, F.col("y").cast("long").alias("y"), F.col("x0").cast("long").alias("a"), (F.col("x0") + F.col("w")).cast("long").alias("b"))


def dealt(spans: DataFrame) -> DataFrame:
    """spans, whole, once for each tile `t` that they meet."""
    return spans.withColumn("t", F.explode(F.sequence(F.floor(F.col("a") / TILE), F.floor((F.col("b") - 1) / TILE))))


def tiled(spans: DataFrame) -> DataFrame:
    """spans cut at tiles, with the tile `t`."""
    return dealt(spans).withColumns({"a": F.greatest(F.col("a"), F.col("t") * TILE), "b": F.least(F.col("b"), (F.col("t") + 1) * TILE)})


def depths(by: Sequence[str] = (), **layers: DataFrame) -> DataFrame:
    """(by, y, t, a, b, a column for each layer): stretches on which no layer changes, and how often each covers them."""
    ends = None
    for name, spans in layers.items():
        for end, step in (("a", 1), ("b", -1)):
            own = tiled(spans).select(*by, "y", "t", F.col(end).alias("x"), *(F.lit(step if n == name else 0).alias(n) for n in layers))
            ends = own if ends is None else ends.unionByName(own)
    steps = ends.groupBy(*by, "y", "t", "x").agg(*(F.sum(n).alias(n) for n in layers))
    row = Window.partitionBy(*by, "y", "t").orderBy("x")
    upto = row.rowsBetween(Window.unboundedPreceding, 0)
    stretch = steps.select(*by, "y", "t", F.col("x").alias("a"), F.lead("x").over(row).alias("b"), *(F.sum(n).over(upto).alias(n) for n in layers))
    return stretch.where("b is not null")


def union(*layers: DataFrame) -> DataFrame:
    """(y, t, a, b): what any layer covers, in stretches that don't overlap."""
    every = layers[0].select("y", "a", "b")
    for more in layers[1:]:
        every = every.unionByName(more.select("y", "a", "b"))
    return depths(n=every).where("n > 0").select("y", "t", "a", "b")


def common(a: DataFrame, b: DataFrame, key: str = "fid") -> DataFrame:
    """(key, o_key, y, a, b): what each span of a shares with each of b, by an equi-join on row and tile.

    A common part is whole, in the tile where it begins, and comes out once. Where no spans of
    one key touch within a row, neither do the common parts of a pair.
    """
    other = dealt(b).select("y", "t", F.col(key).alias(f"o_{key}"), F.col("a").alias("o_a"), F.col("b").alias("o_b"))
    begin = F.greatest("a", "o_a")
    met = dealt(a).join(other, ["y", "t"]).where("a < o_b and o_a < b").where(F.floor(begin / TILE) == F.col("t"))
    return met.select(key, f"o_{key}", "y", begin.alias("a"), F.least("b", "o_b").alias("b"))


def masks(spans: DataFrame, keep: Sequence[str]) -> DataFrame:
    """(keep, x0, y0, rows, m, single): shapes as pieces of at most SIDE rows, each row a word with a bit per cell.

    Pieces are counted from a shape's least x and y, so a shape within SIDE x SIDE cells is one (single).
    """
    whole = Window.partitionBy(*keep)
    placed = spans.select(*keep, "y", "a", "b", F.min("y").over(whole).alias("_y"), F.min("a").over(whole).alias("_x"), F.max("y").over(whole).alias("_y1"), F.max("b").over(whole).alias("_x1"))
    placed = placed.withColumn("single", (F.col("_y1") - F.col("_y") < SIDE) & (F.col("_x1") - F.col("_x") <= SIDE))
    columns = F.sequence(F.floor((F.col("a") - F.col("_x")) / SIDE), F.floor((F.col("b") - 1 - F.col("_x")) / SIDE))
    cut = placed.withColumn("k", F.explode(columns)).withColumns({"x0": F.col("_x") + F.col("k") * SIDE, "y0": F.col("_y") + F.floor((F.col("y") - F.col("_y")) / SIDE) * SIDE})
    low, n = F.greatest(F.col("a") - F.col("x0"), F.lit(0)), F.least(F.col("b") - F.col("x0"), F.lit(SIDE))
    ones = F.call_function("shiftrightunsigned", F.lit(-1).cast("long"), (64 - n + low).cast("int"))
    cut = cut.select(*keep, "single", "x0", "y0", F.struct((F.col("y") - F.col("y0")).cast("int").alias("r"), F.call_function("shiftleft", ones, low.cast("int")).alias("m")).alias("s"))
    piece = cut.groupBy(*keep, "single", "x0", "y0").agg(F.collect_list("s").alias("s"), (F.max("s.r") + 1).alias("rows"))
    words = F.aggregate("s", F.array_repeat(F.lit(0).cast("long"), F.col("rows")), lambda m, s: F.transform(m, lambda v, r: F.when(r == s["r"], v.bitwiseOR(s["m"])).otherwise(v)))
    return piece.select(*keep, "single", "x0", "y0", "rows", words.alias("m"))


def bits(pieces: pd.DataFrame, more: int) -> np.ndarray:
    """Words of pieces as a matrix with a row per piece, zero after its last, and `more` zero columns."""
    rows = pieces["rows"].to_numpy()
    out = np.zeros((len(pieces), int(rows.max()) + more), np.uint64)
    out[np.arange(out.shape[1]) < rows[:, None]] = np.concatenate(pieces["m"].to_list()).astype(np.int64).view(np.uint64)
    return out


def common_bits(left: pd.DataFrame, right: pd.DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """[(i, j, area)] of the pairs of pieces of a coarse cell that share cells and whose common box begins there; i: of the whole left side."""
    if not len(left) or not len(right):
        return []
    ax, ay, an, aw, bx, by, bn, bw = (p[c].to_numpy() for p in (left, right) for c in ("x0", "y0", "rows", "cols"))
    low = {"x": np.maximum(ax[:, None], bx), "y": np.maximum(ay[:, None], by)}
    met = (low["x"] < np.minimum((ax + aw)[:, None], bx + bw)) & (low["y"] < np.minimum((ay + an)[:, None], by + bn))
    met &= (low["x"] // COARSE == left["cx"].iloc[0]) & (low["y"] // COARSE == left["cy"].iloc[0])
    i, j = np.nonzero(met)
    if not len(i):
        return []
    y, by_x = low["y"][i, j], ax[i] - bx[j]
    n = int((np.minimum(ay[i] + an[i], by[j] + bn[j]) - y).max())
    up, down = np.maximum(by_x, 0).astype(np.uint64), np.maximum(-by_x, 0).astype(np.uint64)
    a, b, at, bt = bits(left, n), bits(right, n), y - ay[i], y - by[j]
    area = np.zeros(len(i), np.int64)
    for k in range(n):
        area += np.bitwise_count(((a[i, at + k] << up) >> down) & b[j, bt + k])
    some = area > 0
    return [(i[some] + left.index[0], j[some], area[some])]


def common_area(a: DataFrame, b: DataFrame, keep: Sequence[str] = ("fid",), o_keep: Sequence[str] = ("fid",)) -> DataFrame:
    """(keep, o_keep with the prefix o_, area) of all pairs of shapes of two layers of spans that share cells.

    Pieces meet in coarse cells, and a pair of pieces counts in the cell where its common box
    begins. Pairs of shapes of one piece each, which most are, come out of that join as they
    are: pairs aren't shuffled. Only those with a shape of several pieces are added up.
    """
    names = [*keep, *(f"o_{c}" for c in o_keep)]

    def coarse(pieces: DataFrame) -> DataFrame:
        span = lambda low, n: F.sequence(F.floor(F.col(low) / COARSE), F.floor((F.col(low) + n - 1) / COARSE))
        return pieces.withColumn("cx", F.explode(span("x0", F.col("cols")))).withColumn("cy", F.explode(span("y0", F.col("rows"))))

    def measured(spans: DataFrame, by: Sequence[str]) -> DataFrame:
        p = masks(spans, by)
        every = F.aggregate("m", F.lit(0).cast("long"), lambda o, v: o.bitwiseOR(v))
        return p.withColumn("cols", F.length(F.bin(every)))

    one = measured(a, keep)
    two = measured(b, o_keep)

    kinds = [f"`{c}` {one.schema[c].dataType.simpleString()}" for c in keep] + [f"`o_{c}` {two.schema[c].dataType.simpleString()}" for c in o_keep]

    def run(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        right = right.rename(columns=lambda c: c[2:])
        out = [shared for part in range(0, len(left), max(1, PAIRS // max(1, len(right)))) for shared in common_bits(left.iloc[part : part + max(1, PAIRS // max(1, len(right)))], right)]
        i, j, area = (np.concatenate([o[k] for o in out]) if out else np.zeros(0, np.int64) for k in range(3))
        return pd.DataFrame({**{c: left[c].to_numpy()[i] for c in keep}, **{f"o_{c}": right[c].to_numpy()[j] for c in o_keep}, "area": area})

    def met(left: DataFrame, right: DataFrame) -> DataFrame:
        cell = ["cx", "cy", "part"]
        left = coarse(left).withColumn("part", F.pmod(F.xxhash64(*keep), F.lit(PARTS)).cast("int"))
        right = coarse(right).withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(PARTS - 1))))
        right = right.select(*(F.col(c).alias(f"o_{c}") for c in right.columns))  # both sides may come from one table
        return left.groupBy(*cell).cogroup(right.groupBy(*(f"o_{c}" for c in cell))).applyInPandas(run, ", ".join([*kinds, "area long"]))

    several = met(one.where("not single"), two).unionByName(met(one.where("single"), two.where("not single")))
    return met(one.where("single"), two.where("single")).unionByName(several.groupBy(*names).agg(F.sum("area").alias("area")))


def minus(a: DataFrame, b: DataFrame, key: str = "fid") -> DataFrame:
    """(key, y, a, b): what is left of each span of a outside all of b."""
    own = tiled(a).select(key, "y", "t", "a", "b")
    off = union(b).select("y", "t", F.col("a").alias("o_a"), F.col("b").alias("o_b"))
    met = own.join(off, ["y", "t"], "left")
    hit = F.when((F.col("o_a") < F.col("b")) & (F.col("a") < F.col("o_b")), F.struct("o_a", "o_b"))
    cuts = met.groupBy(key, "y", "t", "a", "b").agg(F.array_sort(F.collect_list(hit)).alias("c"))
    begins = F.concat(F.array("a"), F.transform("c", lambda c: c["o_b"]))
    stops = F.concat(F.transform("c", lambda c: c["o_a"]), F.array("b"))
    left = cuts.select(key, "y", F.explode(F.arrays_zip(begins.alias("a"), stops.alias("b"))).alias("s"))
    return left.select(key, "y", "s.a", "s.b").where("a < b")


def owned(spans: DataFrame, key: str = "fid") -> DataFrame:
    """(key, y, a, b): the spans with what several cover given to the least key."""
    part = depths(n=spans).where("n > 0").select("y", "t", "a", "b")
    of = tiled(spans).select("y", "t", key, F.col("a").alias("o_a"), F.col("b").alias("o_b"))
    met = part.join(of, ["y", "t"]).where("a < o_b and o_a < b")
    return met.groupBy("y", "t", "a", "b").agg(F.min(key).alias(key)).select(key, "y", "a", "b")


def half_widths(radius: int, square: bool) -> list[tuple[int, int]]:
    """(dy, w) of the rows of a ball or square around a cell."""
    return [(d, radius if square else int((radius * radius - d * d) ** 0.5)) for d in range(-radius, radius + 1)]


def covered(row: np.ndarray, a: np.ndarray, b: np.ndarray, least: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, a, b): the stretches of each row that at least this many of its spans cover; those that touch are one."""
    row, x, step = np.concatenate([row, row]), np.concatenate([a, b]), np.repeat([1, -1], len(a))
    order = np.lexsort((-step, x, row))
    row, x, step = row[order], x[order], step[order]
    depth = np.cumsum(step)
    start, stop = (step == 1) & (depth == least), (step == -1) & (depth == least - 1)
    some = x[start] < x[stop]
    return row[start][some], x[start][some], x[stop][some]


def reshaped(spans: DataFrame, radius: int, square: bool, key: str, erode: bool) -> DataFrame:
    """(key, y, a, b): dilated or eroded shapes, cut at tiles.

    A shape's spans of a tile of TILE x TILE cells and of a rim of the radius around it are one
    row, so spans are shuffled once and not per row of the ball; the tiles of a batch are computed together.
    """
    rows = half_widths(radius, square)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ty, tx = (batch.column(c).to_numpy() for c in (1, 2))
            lists = batch.column(3)
            of = np.repeat(np.arange(batch.num_rows), pc.list_value_length(lists).to_numpy())
            flat = lists.flatten()
            y, a, b = (pc.struct_field(flat, c).to_numpy() for c in "yab")
            y, a, b = y - ty[of] * TILE + radius, np.maximum(a - tx[of] * TILE, -radius), np.minimum(b - tx[of] * TILE, TILE + radius)
            high = TILE + 4 * radius + 1  # rows of a tile, with its rim and what moves beyond
            line = of * high + y + radius
            if erode:
                line, a, b = covered(line, a, b, 1)
            side = -1 if erode else 1
            line, a, b = np.concatenate([line + d for d, _ in rows]), np.concatenate([a - w * side for _, w in rows]), np.concatenate([b + w * side for _, w in rows])
            some = a < b
            line, a, b = covered(line[some], a[some], b[some], len(rows) if erode else 1)
            of, y, a, b = line // high, line % high - 2 * radius, np.maximum(a, 0), np.minimum(b, TILE)
            some = (a < b) & (y >= 0) & (y < TILE)
            of, y, a, b = (v[some] for v in (of, y, a, b))
            columns = [batch.column(0).take(pa.array(of)), *map(pa.array, (y + ty[of] * TILE, a + tx[of] * TILE, b + tx[of] * TILE))]
            yield pa.RecordBatch.from_arrays(columns, [key, "y", "a", "b"])

    tiles = lambda low, high: F.explode(F.sequence(F.floor((low - radius) / TILE), F.floor((high + radius) / TILE)))
    near = spans.where("a < b").select(key, *(F.col(c).cast("long").alias(c) for c in "yab"))
    near = near.withColumn("ty", tiles(F.col("y"), F.col("y"))).withColumn("tx", tiles(F.col("a"), F.col("b") - 1))
    whole = near.repartition(key, "ty", "tx").groupBy(key, "ty", "tx").agg(F.collect_list(F.struct("y", "a", "b")).alias("s"))
    return whole.mapInArrow(run, f"`{key}` {spans.schema[key].dataType.simpleString()}, y long, a long, b long")


def dilated(spans: DataFrame, radius: int, square: bool = False, key: str = "fid") -> DataFrame:
    """(key, y, a, b): cells within a radius of a shape's cells, each once."""
    return reshaped(spans, radius, square, key, erode=False)


def eroded(spans: DataFrame, radius: int, square: bool = False, key: str = "fid") -> DataFrame:
    """(key, y, a, b): cells whose whole surroundings are in the shape; its spans may overlap or touch."""
    return reshaped(spans, radius, square, key, erode=True)


def joined(spans: DataFrame, key: str = "fid") -> DataFrame:
    """(key, y, a, b): a shape's spans of a row with those that overlap or touch made one."""
    row = Window.partitionBy(key, "y").orderBy("a", "b")
    before = F.max("b").over(row.rowsBetween(Window.unboundedPreceding, -1))
    marked = spans.withColumn("new", F.when(before.isNull() | (F.col("a") > before), 1).otherwise(0))
    return marked.withColumn("k", F.sum("new").over(row)).groupBy(key, "y", "k").agg(F.min("a").alias("a"), F.max("b").alias("b")).drop("k")


def area(spans: DataFrame, *by: str) -> DataFrame:
    return spans.groupBy(*by).agg(F.sum(F.col("b") - F.col("a")).alias("area"))


def cells(spans: DataFrame) -> DataFrame:
    """spans with a row per cell, x: the last step, where cells are what is wanted."""
    return spans.withColumn("x", F.explode(F.sequence(F.col("a"), F.col("b") - 1))).drop("a", "b")


def at_points(points: DataFrame, spans: DataFrame, key: str = "fid") -> DataFrame:
    """points (x, y) with the key of each shape that covers their cell, by row and tile."""
    of = tiled(spans).select(F.col("t").alias("_t"), F.col("y").alias("_y"), key, F.col("a").alias("_a"), F.col("b").alias("_b"))
    x, y = F.floor("x"), F.floor("y")
    met = points.join(of, (F.floor(x / TILE) == F.col("_t")) & (y == F.col("_y")) & (x >= F.col("_a")) & (x < F.col("_b")))
    return met.select(*points.columns, key)


def ring_area(rings: Column) -> Column:
    """The signed areas of rings summed up: holes that run the other way count less."""
    def one(ring: Column) -> Column:
        nexts = F.concat(F.slice(ring, 2, F.greatest(F.size(ring) - 1, F.lit(0))), F.slice(ring, 1, 1))
        terms = F.zip_with(ring, nexts, lambda p, q: p["x"] * q["y"] - q["x"] * p["y"])
        return F.aggregate(terms, F.lit(0.0), lambda s, v: s + v) / 2

    return F.aggregate(F.transform(rings, one), F.lit(0.0), lambda s, v: s + v)


def flat_points(rings: pa.ListArray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of rings: the shape, x and y of every point, the place of the point after it in its ring, and its ring's size."""
    sizes = lambda a: pc.fill_null(pc.list_value_length(a), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    each = rings.flatten()
    points, n = each.flatten(), sizes(each)
    x, y = (pc.cast(pc.struct_field(points, c), pa.float64()).to_numpy(zero_copy_only=False) for c in "xy")
    shape = np.repeat(np.repeat(np.arange(len(rings)), sizes(rings)), n)
    nexts, stops = np.arange(1, len(x) + 1), np.cumsum(n)
    nexts[stops[n > 0] - 1] = (stops - n)[n > 0]
    return shape, x, y, nexts, np.repeat(n, n)


def hull(points: np.ndarray) -> np.ndarray:
    """The corners of the convex hull, anticlockwise (monotone chain)."""
    p = np.unique(points, axis=0)
    if len(p) < 3:
        return p
    sides = []
    for order in (p, p[::-1]):
        side: list = []
        for c in order:
            while len(side) > 1 and (side[-1][0] - side[-2][0]) * (c[1] - side[-2][1]) - (side[-1][1] - side[-2][1]) * (c[0] - side[-2][0]) <= 0:
                side.pop()
            side.append(c)
        sides += side[:-1]
    return np.array(sides)


def hull_measures(points: np.ndarray) -> tuple[float, float, float]:
    """Area of the convex hull, and the longer and shorter side of the smallest rectangle around it, which has a side on one of the hull's."""
    h = hull(points)
    if len(h) < 3:
        return 0.0, float(np.hypot(*(h[-1] - h[0]))) if len(h) else 0.0, 0.0
    nexts = np.roll(h, -1, axis=0)
    area = float((h[:, 0] * nexts[:, 1] - nexts[:, 0] * h[:, 1]).sum() / 2)
    way = (nexts - h) / np.hypot(*(nexts - h).T)[:, None]
    along, across = h @ way.T, h @ np.stack([-way[:, 1], way[:, 0]])
    sizes = np.stack([np.ptp(along, axis=0), np.ptp(across, axis=0)])
    best = sizes[:, sizes.prod(axis=0).argmin()]
    return area, float(best.max()), float(best.min())


def below(of: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The places of the lower hull's corners in each group `of`; points are distinct and sorted by group, x and y.

    A point on or above the line between those beside it is no corner, so all such points go at once.
    """
    at = np.arange(len(of))
    while True:
        a, b, c = at[:-2], at[1:-1], at[2:]
        off = (of[a] == of[c]) & ((x[b] - x[a]) * (y[c] - y[a]) - (y[b] - y[a]) * (x[c] - x[a]) <= 0)
        if not off.any():
            return at
        at = np.delete(at, np.nonzero(off)[0] + 1)


def all_hull_measures(of: np.ndarray, x: np.ndarray, y: np.ndarray, n: int) -> np.ndarray:
    """hull_measures() of each of n groups of points (of: ascending), NaN where there is none: all groups together, large ones by themselves."""
    out = np.full((n, 3), np.nan)
    sizes = np.bincount(of, minlength=n)
    many, stops = sizes > MOST_CORNERS, np.cumsum(sizes)
    for k in np.nonzero(many)[0]:
        own = slice(stops[k] - sizes[k], stops[k])
        out[k] = hull_measures(np.column_stack([x[own], y[own]]))
    here = ~many[of]
    order = np.lexsort((y[here], x[here], of[here]))
    of, x, y = (c[here][order] for c in (of, x, y))
    new = np.ones(len(of), bool)
    new[1:] = (of[1:] != of[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])
    of, x, y = of[new], x[new], y[new]
    lower, upper = below(of, x, y), len(of) - 1 - below(of[::-1], x[::-1], y[::-1])
    ends = np.ones((2, len(of)), bool)
    ends[0, 1:], ends[1, :-1] = of[1:] != of[:-1], of[1:] != of[:-1]
    upper = upper[~ends.any(axis=0)[upper]]  # both chains have the ends
    corner, side = np.concatenate([lower, upper]), np.repeat([0, 1], [len(lower), len(upper)])
    corner = corner[np.lexsort((np.where(side, -corner, corner), side, of[corner]))]
    of, x, y = of[corner], x[corner], y[corner]
    count = np.bincount(of, minlength=n)
    first = np.cumsum(count) - count
    some = np.nonzero((count > 0) & (count < 3))[0]
    last = first[some] + count[some] - 1
    out[some] = np.column_stack([np.zeros(len(some)), np.hypot(x[last] - x[first[some]], y[last] - y[first[some]]), np.zeros(len(some))])
    for whole in np.split(np.nonzero(count > 2)[0], np.nonzero(np.diff(np.cumsum(count[count > 2] ** 2) // PAIRS))[0] + 1):
        if len(whole):
            out[whole] = rectangles(x, y, first[whole], count[whole])
    return out


def rectangles(x: np.ndarray, y: np.ndarray, first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """Area, longer and shorter side of the smallest rectangle of hulls of three and more corners, each a stretch of x and y."""
    start = np.cumsum(count) - count
    within = np.arange(count.sum()) - np.repeat(start, count)
    own, size = np.repeat(first, count) + within, np.repeat(count, count)
    nexts = np.repeat(first, count) + (within + 1) % size
    area = np.add.reduceat(x[own] * y[nexts] - x[nexts] * y[own], start) / 2
    dx, dy = x[nexts] - x[own], y[nexts] - y[own]
    length = np.hypot(dx, dy)
    dx, dy = dx / length, dy / length
    begin = np.cumsum(size) - size  # every side meets all corners of its hull
    side = np.repeat(np.arange(len(size)), size)
    other = np.repeat(np.repeat(first, count), size) + np.arange(len(side)) - np.repeat(begin, size)
    sizes = []
    for way in (x[other] * dx[side] + y[other] * dy[side], y[other] * dx[side] - x[other] * dy[side]):
        sizes.append(np.maximum.reduceat(way, begin) - np.minimum.reduceat(way, begin))
    box = sizes[0] * sizes[1]
    least = box == np.repeat(np.minimum.reduceat(box, start), count)
    best = np.minimum.reduceat(np.where(least, np.arange(len(box)), len(box)), start)
    return np.column_stack([area, np.maximum(*sizes)[best], np.minimum(*sizes)[best]])


def descriptors(shapes: DataFrame, key: str = "fid") -> DataFrame:
    """(key, area, perimeter, convexity, compactness, elongation) of shapes (key, rings).

    convexity: area over that of the convex hull; compactness: 4 pi area over the squared
    perimeter; elongation: longer over shorter side of the smallest rectangle around. Rings
    that run the other way are holes. Flat shapes have null instead of a division by zero.
    """
    kind = shapes.schema[key].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rings, n = batch.column(1), batch.num_rows
            of, x, y, nexts, size = flat_points(rings)
            area = np.abs(np.bincount(of, x * y[nexts] - x[nexts] * y, n)) / 2.0
            area[~pc.is_valid(rings).to_numpy(zero_copy_only=False)] = np.nan
            sides = size > 1
            length = np.bincount(of[sides], np.hypot(x[nexts] - x, y[nexts] - y)[sides], n).astype(float)  # of no sides: whole zeros
            length[np.bincount(of[sides], minlength=n) == 0] = np.nan
            columns = [area, length, *all_hull_measures(of, x, y, n).T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *(pa.array(c, from_pandas=True) for c in columns)], [key, *MEASURED])

    sized = shapes.select(key, "rings").mapInArrow(run, f"`{key}` {kind}, {', '.join(f'{c} double' for c in MEASURED)}")
    over = lambda a, b: F.when(b > 0, a / b)
    return sized.select(key, "area", "perimeter", over(F.col("area"), F.col("hull")).alias("convexity"), over(4 * F.pi() * F.col("area"), F.col("perimeter") ** 2).alias("compactness"), over(F.col("long"), F.col("short")).alias("elongation"))
