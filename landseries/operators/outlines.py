"""Outlines of patches: sides of cells chained into rings and arcs by pointer doubling, and their simplification."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landseries.sources.store import stored

#: Chains are first settled within blocks of this many cells a side.
SIDE = 256


def vertex(x: Column, y: Column) -> Column:
    """One number for a corner of the grid."""
    return (y + (1 << 30)) * (1 << 31) + x + (1 << 30)


def sides(cells: DataFrame, patch: str = "patch") -> DataFrame:
    """(patch, other, x1, y1, x2, y2): straight stretches of border with the patch on the left; other: the patch on the right, null off the grid.

    Rows and columns are compared by one shifted join each. Unit sides that go on in a line
    between the same two patches are one stretch; the cell x, y covers x .. x + 1, y .. y + 1.
    """
    own = cells.select("x", "y", F.col(patch).alias("p"))

    def walls(dx: int, dy: int) -> DataFrame:
        """Borders between a cell (or none) and its neighbour to the right or above."""
        after = own.select((F.col("x") - dx).alias("x"), (F.col("y") - dy).alias("y"), F.col("p").alias("q"))
        return own.join(after, ["x", "y"], "full").where(~F.col("p").eqNullSafe(F.col("q")))

    side = lambda p, q, line, at, way, flat: F.struct(p.alias("patch"), q.alias("other"), line.alias("line"), at.alias("at"), F.lit(way).alias("way"), F.lit(flat).alias("flat"))
    p, q, x, y = (F.col(c) for c in "pqxy")
    # a wall right of a cell stands on x + 1: the left cell's patch sees it going up, the right one's going down
    upright = walls(1, 0).select(F.explode(F.array(side(p, q, x + 1, y, 1, False), side(q, p, x + 1, y, -1, False))).alias("s"))
    # a wall above a cell lies on y + 1: the lower patch sees it going left, the upper one going right
    level = walls(0, 1).select(F.explode(F.array(side(p, q, y + 1, x, -1, True), side(q, p, y + 1, x, 1, True))).alias("s"))
    units = upright.unionByName(level).select("s.*").where("patch is not null")
    group = ["flat", "line", "patch", "other", "way"]
    row = F.row_number().over(Window.partitionBy(*group).orderBy("at"))
    stretches = units.withColumn("run", F.col("at") - row).groupBy(*group, "run").agg(F.min("at").alias("lo"), (F.max("at") + 1).alias("hi"))
    begin, end = (F.when(F.col("way") == w, F.col("lo")).otherwise(F.col("hi")) for w in (1, -1))
    flat = F.col("flat")
    return stretches.select(
        "patch", "other", F.when(flat, begin).otherwise(F.col("line")).alias("x1"), F.when(flat, F.col("line")).otherwise(begin).alias("y1"),
        F.when(flat, end).otherwise(F.col("line")).alias("x2"), F.when(flat, F.col("line")).otherwise(end).alias("y2"),
    )


def chained(links: DataFrame, most: int = 40) -> DataFrame:
    """(id, chain, pos) of links (id, next[, n]): next is the id that follows, or null; each id follows at most one.

    Pointer doubling: a round joins every id with what it points to, which doubles the
    reach, so a chain of n takes log2(n) rounds. A closed chain is cut before its least id.
    chain is the id of its last member, pos counts from 0, by n places for an id that has n.
    """
    places = F.col("n") if "n" in links.columns else F.lit(1)
    new, open_ = stored(links.select("id", "next", F.col("id").alias("low"))), -1
    for _ in range(most):
        ahead = new.select(F.col("id").alias("next"), F.col("next").alias("next2"), F.col("low").alias("low2"))
        reach = F.coalesce("low2", "low")
        new = stored(new.join(ahead, "next", "left").select("id", F.col("next2").alias("next"), F.least("low", reach).alias("low"), (reach < F.col("low")).alias("moved")))
        left, moved = new.agg(F.count("next"), F.coalesce(F.max(F.col("moved").cast("int")), F.lit(0))).first()
        if left == open_ and not moved:  # what still points on is closed and knows its least id
            break
        new, open_ = new.drop("moved"), left
    else:
        raise RuntimeError("chains did not settle")
    closed = stored(new.where("next is not null and id = low").select(F.col("id").alias("cut")))
    opened = links.select("id", "next", places.alias("n")).join(closed, F.col("next") == F.col("cut"), "left").select("id", F.when(F.col("cut").isNull(), F.col("next")).alias("next"), "n")
    now = stored(opened.select("id", "next", F.when(F.col("next").isNull(), 0).otherwise(F.col("n")).cast("long").alias("far"), F.coalesce("next", "id").alias("last")))
    for _ in range(most):
        if not now.where("next is not null").limit(1).count():
            break
        ahead = now.select(F.col("id").alias("next"), F.col("next").alias("next2"), F.col("far").alias("far2"), F.col("last").alias("last2"))
        now = stored(now.join(ahead, "next", "left").select("id", F.col("next2").alias("next"), (F.col("far") + F.coalesce("far2", F.lit(0))).alias("far"), F.coalesce("last2", "last").alias("last")))
    lengths = now.groupBy("last").agg(F.max("far").alias("most"))
    return now.join(lengths, "last").select("id", F.col("last").alias("chain"), (F.col("most") - F.col("far")).alias("pos"))


def numbered(stretches: DataFrame) -> DataFrame:
    """stretches with their direction and the numbers of their ends."""
    way = F.when(F.col("x2") > F.col("x1"), 0).when(F.col("y2") > F.col("y1"), 1).when(F.col("x2") < F.col("x1"), 2).otherwise(3)
    ends = {"way": way, "from": vertex(F.col("x1"), F.col("y1")), "to": vertex(F.col("x2"), F.col("y2"))}
    return stretches.withColumns(ends)


def heads(after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For places that point to the place after them (-1: none): the first place of the chain of each and how far it is.

    A closed chain is cut before its least place.
    """
    n = len(after)
    before = np.full(n, -1)
    before[after[after >= 0]] = np.nonzero(after >= 0)[0]

    def back() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        first, low = np.where(before < 0, np.arange(n), before), np.arange(n)
        far = (before >= 0).astype(int)
        for _ in range(n.bit_length()):
            low, far, first = np.minimum(low, low[first]), far + far[first], first[first]
        return first, far, low

    first, far, low = back()
    closed = before[first] >= 0
    if closed.any():
        before[low[closed]] = -1
        first, far, _ = back()
    return first, far


def after_turn(steps: pd.DataFrame, begins: pd.DataFrame) -> pd.DataFrame:
    """(i, j): which of begins follows a step round its patch; left turns first, then straight on."""
    both = steps.merge(begins, left_on=["patch", "to"], right_on=["patch", "from"], suffixes=("", "2"))
    turn = (both["way2"] - both["way"]) % 4  # 1: left, 0: straight on, 3: right
    return both.assign(rank=np.where(turn == 1, 0, np.where(turn == 0, 1, 2))).sort_values(["i", "rank"]).drop_duplicates("i")


def after_node(steps: pd.DataFrame, begins: pd.DataFrame) -> pd.DataFrame:
    """(i, j): which of begins goes on between the same two patches; nothing does where other than two ends meet."""
    vertex, ends = np.unique(np.concatenate([steps["to"], begins["from"]]), return_counts=True)
    inner = begins[begins["from"].isin(vertex[ends == 2])]
    keys = ["patch", "other", "alone"]
    return steps.merge(inner, left_on=[*keys, "to"], right_on=[*keys, "from"], suffixes=("", "2"))


def chained_steps(steps: DataFrame, follows: Callable[[pd.DataFrame, pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """steps (patch, other, x1, y1, x2, y2, way, from, to) with `chain`, a number, and `pos`, from 0.

    follows(steps, begins) tells for steps that end on corners of a block, by their place i,
    the place j of the step that begins there. A block gets the steps that begin or end in
    it, finds what follows each, and turns stretches of a chain within it into one link.
    Only the links between blocks are chained by pointer doubling. Directed steps have the
    patch on the left, so a corner and a way are one step.
    """
    side = SIDE
    home = [F.floor(F.col(c) / side) for c in ("x1", "y1", "x2", "y2")]
    blocks = F.array_distinct(F.array(F.struct(home[0].alias("bx"), home[1].alias("by")), F.struct(home[2].alias("bx"), home[3].alias("by"))))
    columns = ["patch", "other", "alone", "x1", "y1", "x2", "y2"]

    def run(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        begins_here, ends_here = ((pdf[x] // side == key[0]) & (pdf[y] // side == key[1]) for x, y in (("x1", "y1"), ("x2", "y2")))
        pdf = pdf.assign(own=begins_here, ends=ends_here).sort_values(["own", "from", "way"], ascending=[False, True, True], ignore_index=True)
        name, n = (pdf["from"].to_numpy() << 2) | pdf["way"].to_numpy(), int(pdf["own"].sum())
        wanted, begins = pdf[pdf["ends"]], pdf[pdf["own"]]
        found = follows(wanted.assign(i=wanted.index), begins.assign(j=begins.index))
        i, j = found["i"].to_numpy(np.int64), found["j"].to_numpy(np.int64)
        after = np.full(n, -1)
        after[i[i < n]] = j[i < n]
        first, far = heads(after)
        members = pdf[columns].iloc[:n].assign(head=name[first], off=far)
        tail = np.nonzero(~pdf["ends"].to_numpy()[:n])[0]  # what follows these is known where they end
        runs = pd.DataFrame({"head": name[first[tail]], "off": far[tail] + 1, "id": name[tail]})
        links = pd.DataFrame({"head": name[j[i >= n]], "id": name[i[i >= n]]})
        whole = [f.reindex(columns=[*columns, "head", "off", "id"]).astype("Int64") for f in (members, runs, links)]  # numbers beyond a double's digits
        return pd.concat([f.assign(kind=k) for k, f in enumerate(whole)])

    known = steps.withColumns({"alone": F.col("other").isNull().cast("long"), "other": F.coalesce("other", F.lit(0).cast("long"))})
    dealt = known.withColumn("b", F.explode(blocks)).select(*columns, "way", "from", "to", "b.bx", "b.by")
    schema = ", ".join(f"{c} long" for c in (*columns, "head", "off", "id")) + ", kind int"
    made = stored(dealt.groupBy("bx", "by").applyInPandas(run, schema))
    into = made.where("kind = 2").select("id", F.col("head").alias("next"))
    links = stored(made.where("kind = 1").select("id", F.col("head").alias("run"), F.col("off").alias("n")).join(into, "id").select(F.col("run").alias("id"), "next", "n"))
    last = links.select(F.col("next").alias("id")).join(links.select("id"), "id", "left_anti").select("id", F.lit(None).cast("long").alias("next"), F.lit(0).cast("long").alias("n"))
    order = chained(links.unionByName(last)).select(F.col("id").alias("head"), "chain", "pos")
    placed = made.where("kind = 0").join(order, "head", "left")
    other = F.when(F.col("alone") == 0, F.col("other")).alias("other")
    return placed.select("patch", other, "x1", "y1", "x2", "y2", F.coalesce("chain", "head").alias("chain"), (F.coalesce("pos", F.lit(0)) + F.col("off")).alias("pos"))


def rings(cells: DataFrame, patch: str = "patch") -> DataFrame:
    """(patch, ring, pos, x, y, x2, y2): the corners of each patch's rings in order and the ones after, outer ones anticlockwise and holes clockwise.

    A corner where a patch touches itself belongs to two passes; a pass turns left there if
    it can, so patches of four neighbours get rings that don't cross. Nothing of a ring is
    gathered: rings of any length are rows.
    """
    steps = chained_steps(numbered(sides(cells, patch)), after_turn)
    return steps.select("patch", F.col("chain").alias("ring"), "pos", F.col("x1").alias("x"), F.col("y1").alias("y"), "x2", "y2")


def ring_sizes(corners: DataFrame) -> DataFrame:
    """(patch, ring, area): the signed area of each ring."""
    cross = F.col("x") * F.col("y2") - F.col("x2") * F.col("y")
    return corners.groupBy("patch", "ring").agg((F.sum(cross) / 2).alias("area"))


def ring_lengths(corners: DataFrame) -> DataFrame:
    """(patch, ring, length): sides are along the axes."""
    return corners.groupBy("patch", "ring").agg(F.sum(F.abs(F.col("x2") - F.col("x")) + F.abs(F.col("y2") - F.col("y"))).alias("length"))


def arcs(cells: DataFrame, patch: str = "patch") -> DataFrame:
    """(arc, left, right, pos, x, y, closed): borders between two patches from node to node, each once.

    Nodes are corners where other than two stretches of border meet. An arc without nodes is
    closed: its last point is its first. left is the lesser patch; right is null off the grid.
    """
    once = numbered(sides(cells, patch)).where("other is null or patch < other")
    placed = stored(numbered(chained_steps(once, after_node)))
    first, last = (placed.groupBy("chain").agg(f(c, "pos").alias(c)) for f, c in ((F.min_by, "from"), (F.max_by, "to")))
    closed = first.join(last, "chain").select("chain", (F.col("from") == F.col("to")).alias("closed"))
    final = placed.groupBy("chain").agg(*(F.max_by(c, "pos").alias(c) for c in ("patch", "other", "x2", "y2")), (F.max("pos") + 1).alias("pos"))
    points = placed.select("chain", "patch", "other", "pos", F.col("x1").alias("x"), F.col("y1").alias("y")).unionByName(final.withColumnsRenamed({"x2": "x", "y2": "y"}))
    return points.join(closed, "chain").select(F.col("chain").alias("arc"), F.col("patch").alias("left"), F.col("other").alias("right"), "pos", "x", "y", "closed")


def kept_corners(x: np.ndarray, y: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points of a line stay (Douglas-Peucker): both ends, and in each part the farthest point if beyond the tolerance."""
    keep = np.zeros(len(x), bool)
    keep[[0, -1]] = True
    parts = [(0, len(x) - 1)]
    while parts:
        a, b = parts.pop()
        if b - a < 2:
            continue
        px, py, dx, dy = x[a + 1 : b] - x[a], y[a + 1 : b] - y[a], x[b] - x[a], y[b] - y[a]
        length = np.hypot(dx, dy)
        far = np.abs(dx * py - dy * px) / length if length else np.hypot(px, py)
        k = int(far.argmax())
        if far[k] > tolerance:
            keep[a + 1 + k] = True
            parts += [(a, a + 1 + k), (a + 1 + k, b)]
    return keep


def simplified(points: DataFrame, tolerance: float) -> DataFrame:
    """arcs() without the corners that Douglas-Peucker drops, pos counted anew.

    An arc is simplified once and serves both its patches, so neighbours still fit. Closed
    arcs keep the point farthest from their start, and a third point, so none collapses.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            xs, ys = [], []
            for row in batch.itertuples():
                p = sorted(row.points, key=lambda q: q["pos"])
                x, y = (np.array([q[c] for q in p], float) for c in "xy")
                if row.closed and len(x) > 3:
                    k = int(np.hypot(x - x[0], y - y[0]).argmax())
                    keep = np.concatenate([kept_corners(x[: k + 1], y[: k + 1], tolerance)[:-1], kept_corners(x[k:], y[k:], tolerance)])
                    if keep.sum() < 4:
                        off = np.abs((x[k] - x[0]) * (y - y[0]) - (y[k] - y[0]) * (x - x[0]))
                        keep[int(off.argmax())] = True
                else:
                    keep = kept_corners(x, y, tolerance)
                xs.append(x[keep].astype(int)), ys.append(y[keep].astype(int))
            yield pd.DataFrame({"arc": batch["arc"], "left": batch["left"], "right": batch["right"].astype("Int64"), "closed": batch["closed"], "xs": xs, "ys": ys})

    whole = points.groupBy("arc", "left", "right", "closed").agg(F.collect_list(F.struct("pos", "x", "y")).alias("points"))
    out = whole.mapInPandas(run, "arc long, left long, right long, closed boolean, xs array<long>, ys array<long>")
    spread = out.select("arc", "left", "right", "closed", F.posexplode(F.arrays_zip("xs", "ys")).alias("pos", "p"))
    return spread.select("arc", "left", "right", F.col("pos").cast("long").alias("pos"), F.col("p.xs").alias("x"), F.col("p.ys").alias("y"), "closed")


def patch_areas(points: DataFrame) -> DataFrame:
    """(patch, area) from arcs: what is on an arc's left gains the area under it, what is on its right loses it."""
    after = points.select("arc", (F.col("pos") - 1).alias("pos"), F.col("x").alias("x2"), F.col("y").alias("y2"))
    part = points.join(after, ["arc", "pos"]).withColumn("a", (F.col("x") * F.col("y2") - F.col("x2") * F.col("y")) / 2)
    both = part.select(F.explode(F.array(F.struct(F.col("left").alias("patch"), F.col("a").alias("a")), F.struct(F.col("right").alias("patch"), (-F.col("a")).alias("a")))).alias("s"))
    return both.where("s.patch is not null").groupBy("s.patch").agg(F.sum("s.a").alias("area"))
