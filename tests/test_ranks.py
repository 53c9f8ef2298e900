"""Row numbers and running sums over range partitions against windows."""

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from landseries.operators import tables
from landseries.operators.ranks import ranked


@pytest.fixture(scope="module")
def rows(spark):
    n = F.col("id")
    kind = F.when(n % 10 == 3, F.lit(None)).when(n % 10 == 4, 7).otherwise(1)  # most rows are of one group
    return spark.range(5000).select((n * 7919 % 20011).alias("id"), kind.alias("kind"), (n % 100).alias("v"), F.lit("x").alias("part"), F.lit("y").alias("At"))


def test_equal_to_windows(rows):
    spark = rows.sparkSession
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # groups then span partitions
    try:
        got = ranked(rows, [F.desc("v"), "id"], ["kind"], rank="place", size="n", sums={"v": "before"})
        w = Window.partitionBy("kind").orderBy(F.desc("v"), "id")
        want = rows.withColumns({
            "place": F.row_number().over(w).cast("long"), "n": F.count("*").over(Window.partitionBy("kind")),
            "before": F.coalesce(F.sum("v").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)),
        })
        assert set(got.columns) == set(want.columns)
        got = got.select(want.columns)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0
        every = ranked(rows, ["id"], rank="part2")
        assert [r.part2 for r in every.orderBy("id").select("part2").collect()] == list(range(1, 5001))
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_empty_and_tied(rows):
    assert ranked(rows.where("false"), ["id"], ["kind"], size="n", sums={"v": "b"}).count() == 0
    tied = ranked(rows.select("kind", F.lit(1).alias("o")), ["o"], ["kind"]).groupBy("kind").agg(F.max("rank").alias("top"), F.countDistinct("rank").alias("n"), F.count("*").alias("all"))
    assert all(r.top == r.n == r["all"] for r in tied.collect())


def test_rules_read_copies_of_earlier_rules(spark):
    samples = spark.createDataFrame([(k, 1, 0) for k in range(4)] + [(9, 2, 0)], "id int, class int, model int")
    got = tables.copy_by_rules(samples, [(0, 1, 1, 2), (1, 2, 1, -1), (2, 0, 1, 1), (0, 3, 1, 9)], "id").collect()
    made = sorted((r.id, r.model, r.path) for r in got if r.path)
    assert made == sorted([(0, 1, "/1"), (1, 1, "/1"), (0, 2, "/1/2"), (1, 2, "/1/2"), (0, 0, "/1/2/3"), *((k, 3, "/4") for k in range(4)), (0, 3, "/1/2/3/4")])
