"""Joins that move only rows that may have a partner, and the number of buckets of passages."""

from pyspark.sql import functions as F

from landseries.llm import line_dedup
from landseries.llm import substring_dedup as sd
from landseries.llm.common import split_by_keys


def test_rows_with_a_partner_are_all_in_one_part(spark):
    rows = spark.range(20_000).select(F.when(F.col("id") != 7, F.col("id")).alias("doc_id"), F.lit("x").alias("odd.`name"))
    keys = spark.range(0, 40_000, 100).select(F.col("id").alias("doc_id"))
    maybe, never = split_by_keys(rows, keys, ["doc_id"])
    assert maybe.columns == never.columns == rows.columns
    left, right = ([r.doc_id for r in df.collect()] for df in (maybe, never))
    assert set(range(0, 20_000, 100)) <= set(left) and len(left) < 220
    assert len(left) + len(right) == 20_000 and not {x for x in left if x is not None} & set(right)
    maybe, never = split_by_keys(rows, keys.limit(0), ["doc_id"])
    assert maybe.count() == 0 and never.count() == 20_000


def test_buckets_follow_the_texts_and_not_the_partitions(spark):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for partitions in (16, 211):
            spark.conf.set("spark.sql.shuffle.partitions", partitions)
            assert sd.buckets_of(spark.createDataFrame([(5,), (9,)], "n int")) == 1
            assert sd.buckets_of(spark.createDataFrame([(2**31 - 1,)] * 4, "n int")) == min(4 * partitions, 618)
            assert sd.buckets_of(spark.createDataFrame([], "n int")) == 1
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_texts_that_stay_are_not_shuffled(spark):
    """Neither stage deals out the texts of documents that it leaves alone."""
    same = "the same line of words that stands in several texts and goes from all but the first of them"
    rows = [(k, f"{k} own words {k * k} {k * 7} here\n" + (same if k < 3 else f"and {k * 11} more {k * 13}")) for k in range(200)]
    docs = spark.createDataFrame([*rows, (None, same), (500, None)], "doc_id long, text string")
    for stage in (line_dedup.remove_later, sd.remove_repeats):
        out = stage(docs)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lstrip().startswith(("Union", "'Union"))  # the part that stays is read as it lies
        got = {r.doc_id: r.text for r in out.collect()}
        assert len(got) == 202 and all(got[k] == t for k, t in rows if k > 2 or k == 0 or stage is sd.remove_repeats)
        assert got[None] == same and got[500] is None
    assert {k: r for k, r in ((r.doc_id, r.text) for r in line_dedup.remove_later(docs).collect()) if k in (1, 2)} == {k: rows[k][1].split("\n")[0] for k in (1, 2)}
