"""Row numbers and running sums of groups of any size, over range partitions instead of one task per group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from landseries.sources.store import stored


def unused(df: DataFrame, *names: str, also: Sequence[str] = ()) -> list[str]:
    """Column names like these that are neither df's nor among `also`, in any case."""
    taken = {c.lower() for c in (*df.columns, *also)}
    found = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def attach(left: DataFrame, right: DataFrame, by: Sequence[str]) -> DataFrame:
    """left with the other columns of right, which has a row for every key; null keys are equal."""
    other = dict(zip(by, unused(left, *(f"{c}_" for c in by)), strict=True))
    right = right.withColumnsRenamed(other)
    on = F.lit(True)
    for c, o in other.items():
        on = on & F.col(c).eqNullSafe(F.col(o))
    return left.join(right, on, "left").drop(*other.values())


def ranked(rows: DataFrame, order: Sequence[Column | str], by: Sequence[str] = (), rank: str = "rank", size: str | None = None, sums: dict[str, str] | None = None) -> DataFrame:
    """rows with a row number from 1 in each group; size: the group's rows; sums: {column: name of its sum over the rows before}.

    rows are sorted by group and order into range partitions, so that a group, however
    large, is spread over tasks. A row's place is its place in its partition plus the rows
    of the partitions before; of the partitions only one count each is put in order. The
    order should be total: rows equal in group and order share a partition and are numbered
    as they fall. Nulls are a group of their own; columns of any name stay.
    """
    results = [rank, *filter(None, [size]), *(sums or {}).values()]
    at, part, place, first, many = unused(rows, "at", "part", "place", "first", "many", also=results)
    keys = [F.col(b) for b in by] + [F.col(o) if isinstance(o, str) else o for o in order]
    placed = stored(rows.repartitionByRange(*keys).sortWithinPartitions(*keys).withColumn(at, F.monotonically_increasing_id()))
    placed = placed.withColumn(part, F.shiftright(at, 33)).withColumn(at, F.col(at).bitwiseAND((1 << 33) - 1))
    before = Window.partitionBy(F.lit(0)).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
    parts = placed.groupBy(part).agg(F.count("*").alias(many)).select(part, F.coalesce(F.sum(many).over(before), F.lit(0)).alias(place))  # a row per partition
    out = placed.join(F.broadcast(parts), part).withColumn(place, F.col(place) + F.col(at))
    groups = out.groupBy(*by).agg(F.min(place).alias(first), F.count("*").alias(many))
    if by:
        out = attach(out, groups, by)
    else:
        out = out.crossJoin(F.broadcast(groups))  # one row
    out = out.withColumn(rank, F.col(place) - F.col(first) + 1)
    if size:
        out = out.withColumn(size, F.col(many))
    for column, name in (sums or {}).items():
        (total,) = unused(out, "total", also=results)
        inside = Window.partitionBy(*by, part).orderBy(at).rowsBetween(Window.unboundedPreceding, -1)
        earlier = Window.partitionBy(*by).orderBy(part).rowsBetween(Window.unboundedPreceding, -1)
        totals = placed.groupBy(*by, part).agg(F.sum(column).alias(total))
        totals = totals.select(*by, F.col(part), F.coalesce(F.sum(total).over(earlier), F.lit(0)).alias(total))  # a row per partition of a group
        out = attach(out, totals, [*by, part]).withColumn(name, F.col(total) + F.coalesce(F.sum(column).over(inside), F.lit(0))).drop(total)
    return out.drop(at, part, place, first, many)
