"""Text files that the chain reads and writes: confusion matrices, rules, statistics and split tables.

All of it goes through Spark's readers and writers, so paths may be in any store and a
write that fails leaves nothing behind that a reader takes for a result.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Fixed values of the format: the lines that name a matrix's rows and columns.
ROWS, COLUMNS = "#Reference labels (rows):", "#Produced labels (columns):"


def write_matrices(cells: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write (by, ref, prod, n) as one matrix file for each value of by, in folders by=value.

    A file names its reference labels and its produced labels, then has a line for each
    reference label; cells that are missing are 0. Labels are in order. A matrix is one row
    of text, whose size its classes bound; files appear when the write is committed.
    """
    labels = cells.groupBy(*by).agg(F.array_sort(F.collect_set("ref")).alias("refs"), F.array_sort(F.collect_set("prod")).alias("prods"), F.collect_list(F.struct("ref", "prod", "n")).alias("cells"))

    def line(r):
        def value(p):
            own = F.filter("cells", lambda c: (c["ref"] == r) & (c["prod"] == p))
            return F.coalesce(F.get(own, F.lit(0))["n"], F.lit(0)).cast("string")

        return F.array_join(F.transform("prods", value), ",")

    text = F.concat_ws("\n", F.concat(F.lit(ROWS), F.array_join(F.col("refs").cast("array<string>"), ",")), F.concat(F.lit(COLUMNS), F.array_join(F.col("prods").cast("array<string>"), ",")), F.array_join(F.transform("refs", line), "\n"))
    labels.select(*by, text.alias("value")).write.partitionBy(*by).text(path)


def read_matrices(spark: SparkSession, path: str) -> DataFrame:
    """(folder columns, file, ref, prod, n) of all matrix files below a path; a file is one row until its cells are apart.

    A value without a label in the head, and what isn't a number, is an error.
    """
    files = spark.read.text(path, wholetext=True)
    keep = [c for c in files.columns if c != "value"]
    lines = F.filter(F.split("value", "\r?\n"), lambda v: F.trim(v) != "")
    labels = lambda head: F.split(F.substring_index(F.get(F.filter("lines", lambda v: v.startswith(head)), F.lit(0)), ":", -1), ",")
    parsed = files.select(*keep, F.input_file_name().alias("file"), lines.alias("lines"))
    parsed = parsed.withColumns({"refs": labels(ROWS), "prods": labels(COLUMNS), "body": F.filter("lines", lambda v: ~v.startswith("#"))})
    each = parsed.select(*keep, "file", "refs", "prods", F.posexplode("body").alias("row", "line"))
    cells = each.select(*keep, "file", "refs", "prods", "row", F.posexplode(F.split("line", ",")).alias("column", "n"))
    named = lambda labels, at: F.when(F.size(labels) > F.col(at), F.get(labels, F.col(at))).otherwise(F.raise_error(F.lit("a value without a label"))).cast("int")
    return cells.select(*keep, "file", named("refs", "row").alias("ref"), named("prods", "column").alias("prod"), F.trim("n").cast("double").alias("n"))


def read_rules(spark: SparkSession, path: str) -> list[tuple[int, int, int, int]]:
    """Rules (source model, target model, class, number; -1 for all) of a file, in the order of its lines; the driver runs them one by one."""
    lines = spark.read.text(path, wholetext=True).select(F.posexplode(F.split("value", "\r?\n")).alias("at", "line")).where(F.trim("line") != "")
    fields = lines.select("at", F.split(F.trim("line"), "[,;:\t ]+").alias("fields")).orderBy("at")
    return [tuple(map(int, r.fields)) for r in fields.collect()]


def write_split(rows: DataFrame, path: str, by: Sequence[str]) -> None:
    """Write rows in folders by the values of some columns: a region, class, tile or set each."""
    rows.repartition(*by).sortWithinPartitions(*by).write.partitionBy(*by).parquet(path)


def write_statistics(rows: DataFrame, path: str, names: dict[str, str] | None = None) -> None:
    """Write a table as CSV files with a header, columns renamed to their aliases."""
    rows.withColumnsRenamed(names or {}).write.option("header", True).csv(path)


def read_statistics(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A table of statistics from CSV files with a header; lines that don't fit the schema are an error."""
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).csv(path)
