"""Outputs: partitioned, sorted or replaced by partition, each in one pass."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.sources.numbering import number_rows


def feature_lines(df: DataFrame, rings: str, properties: list[str]) -> Column:
    """A row as a GeoJSON feature; rings are closed."""
    point = lambda p: F.array(p["x"], p["y"])
    closed = lambda r: F.transform(F.concat(r, F.slice(r, F.lit(1), F.lit(1))), point)
    geometry = F.struct(F.lit("Polygon").alias("type"), F.transform(rings, closed).alias("coordinates"))
    return F.to_json(F.struct(F.lit("Feature").alias("type"), F.struct(*[F.col(p) for p in properties]).alias("properties"), geometry.alias("geometry")))


def write_features(df: DataFrame, path: str, partition_by: str, rings: str, properties: list[str]) -> None:
    """Newline-delimited GeoJSON, a folder for each value of partition_by."""
    df.select(partition_by, feature_lines(df, rings, properties).alias("value")).write.mode("overwrite").partitionBy(partition_by).text(path)


def write_sharded_tsv(df: DataFrame, path: str, shard: str, key: str, line: str) -> None:
    """Gzipped lines, sorted by key in each shard's folder.

    Rows are dealt by ranges of (shard, key): a large shard is spread over
    several files in order, and small ones share a task.
    """
    dealt = df.select(shard, key, line).repartitionByRange(shard, key).sortWithinPartitions(shard, key)
    dealt.select(shard, F.col(line).alias("value")).write.mode("overwrite").partitionBy(shard).option("compression", "gzip").text(path)


def upsert_by_partition(df: DataFrame, path: str, partition_by: str) -> None:
    """Replace the partitions that df has rows of, and leave the others."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by).parquet(path)


def reuse_or_build(spark: SparkSession, path: str, build: Callable[[], DataFrame], rebuild: bool = False) -> DataFrame:
    """The table at path if it has rows, else what build() gives, written there."""
    if not rebuild:
        try:
            kept = spark.read.parquet(path)
            if kept.limit(1).count():
                return kept
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e) and "UNABLE_TO_INFER_SCHEMA" not in str(e):
                raise
    build().write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def add_row_id(df: DataFrame, name: str = "uid") -> DataFrame:
    """Numbers from 1, one for each row, if df has none; rows that repeat have numbers of their own."""
    return df if name in df.columns else number_rows(df, name, start=1)


def n_parts(size_bytes: Column, over: int = 500_000_000, each: int = 450_000_000) -> Column:
    """How many files an export of this size becomes."""
    return F.when(size_bytes > over, F.ceil(size_bytes / each)).otherwise(1)


def split_interleaved(df: DataFrame, n: int, order: list[Column]) -> DataFrame:
    """df with part, 0 to n - 1: the rows in order are dealt to the parts in turn, so parts differ by one row at most."""
    return number_rows(df, "__row", order, start=1).withColumn("part", (F.col("__row") % n).cast("int")).drop("__row")


def search_meta(shards: DataFrame) -> DataFrame:
    """(index, shard, n, bytes) -> rows, shards and bytes of each index."""
    return shards.groupBy("index").agg(F.sum("n").alias("n_rows"), F.count("*").alias("n_shards"), F.sum("bytes").alias("n_bytes"))
