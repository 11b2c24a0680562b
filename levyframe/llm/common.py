"""Small helpers that the operators of this subpackage share."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from levyframe.sources.tables import materialize

__all__ = ["BROADCAST_ROWS", "WORD", "broadcast_if_small", "columns_of", "drop_columns", "materialize", "n_words", "packed", "partitions", "quoted", "read", "result_schema", "row_hash", "unpacked"]

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

#: A table is broadcast only if it was counted and has at most so many rows (a few MB for the narrow rows used here).
BROADCAST_ROWS = 100_000


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def broadcast_if_small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has at most so many rows, else df as it is; df should be cheap to count (materialized)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def n_words(text: Column) -> Column:
    """Number of words; null text has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quoted(name: str) -> str:
    """A column's name as expressions take it, whatever it is made of."""
    return f"`{name.replace('`', '``')}`"


def columns_of(df: DataFrame) -> list[np.ndarray]:
    """The columns of a few narrow rows without nulls, brought to the driver as arrays."""
    return [c.to_numpy() for c in df.toArrow().columns]


def drop_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """df without columns of these names, whatever their case (Spark resolves names without case)."""
    low = {n.lower() for n in names}
    return df.select([quoted(c) for c in df.columns if c.lower() not in low])


def result_schema(kept: Iterable[StructField], results: str) -> StructType:
    """The schema of rows that keep some fields and have results (as DDL) after them."""
    return StructType([*kept, *StructType.fromDDL(results)])


def packed(df: DataFrame, leave: Sequence[str] = (), **more: Column) -> DataFrame:
    """df's columns, but for those to leave, in one struct `rest`, so that they clash with no other name; and more columns beside it."""
    return df.select(F.struct(*[F.col(quoted(c)) for c in df.columns if c not in leave], F.lit(0).alias("__none")).alias("rest"), *[v.alias(k) for k, v in more.items()])


def unpacked(df: DataFrame, names: Sequence[str], **new: Column) -> list[Column]:
    """The columns of these names, out of `rest` or new."""
    return [new[c].alias(c) if c in new else F.col("rest").getField(c).alias(c) for c in names]


def row_hash(df: DataFrame) -> Column:
    """A hash of all columns; maps, which can't be hashed, go in as JSON, entry by entry."""
    return F.xxhash64(*[F.to_json(F.struct(quoted(f.name))) if "map<" in f.dataType.simpleString() else F.col(quoted(f.name)) for f in df.schema.fields])
