"""Consecutive numbers for rows and for the lines of files, without one task that sees them all.

Rows are counted where they are read; the counts, one for each partition or
part of a file, are summed up, and each row's number is its place there plus
what came before.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levyframe.sources.tables import materialize

#: Counts are broadcast only if there are at most so many of them.
BROADCAST_COUNTS = 100_000
#: monotonically_increasing_id has the row's place within its partition in so many low bits.
PLACE_BITS = 33


def _beside(rows: DataFrame, counts: DataFrame, keys: list[str]) -> DataFrame:
    few = counts.limit(BROADCAST_COUNTS + 1).count() <= BROADCAST_COUNTS
    return rows.join(F.broadcast(counts) if few else counts, keys)


def number_rows(df: DataFrame, name: str, order: list[Column] | None = None, start: int = 0) -> DataFrame:
    """df with consecutive numbers from `start`, in the given order, else in that of its partitions; rows that repeat have
    numbers of their own.  df is written once, so that the numbers stay."""
    if order:
        df = df.repartitionByRange(*order).sortWithinPartitions(*order)
    rows = materialize(df.withColumn("__at", F.monotonically_increasing_id()))
    rows = rows.withColumn("__part", F.shiftright("__at", PLACE_BITS))
    counts = materialize(rows.groupBy("__part").agg(F.count("*").alias("__n")))
    before = F.sum("__n").over(Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))  # one row a partition
    counts = counts.select("__part", F.coalesce(before, F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__at").bitwiseAND((1 << PLACE_BITS) - 1) + start
    return _beside(rows, counts, ["__part"]).withColumn(name, number).drop("__at", "__part", "__before")


def read_numbered_lines(spark: SparkSession, path: str, schema: str = "value string") -> DataFrame:
    """Text files -> file, line_no (from 1, as the file has them) and the schema's columns (value, and those of folders).

    Large files are read in splits: a first scan counts the lines of each, and
    a second one adds what stands before.  The two scans are dealt alike, as
    they read the same files under the same settings.
    """
    source = spark.read.schema(schema).text(path)
    fields = source.columns
    lines = source.select("*", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__at"))
    counts = materialize(lines.groupBy("file", "__block").agg(F.min("__at").alias("__first"), F.count("*").alias("__n")))
    before = F.sum("__n").over(Window.partitionBy("file").orderBy("__block").rowsBetween(Window.unboundedPreceding, -1))  # one row a split
    counts = counts.select("file", "__block", "__first", F.coalesce(before, F.lit(0)).alias("__before"))
    number = F.col("__before") + F.col("__at") - F.col("__first") + 1
    return _beside(lines, counts, ["file", "__block"]).select("file", number.alias("line_no"), *fields)
