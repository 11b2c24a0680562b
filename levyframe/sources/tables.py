"""Tables written once and read again."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Observation, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, named by spark.checkpoint.dir; where none is set, a temporary one if all run on this machine, else an error."""
    if not spark.conf.get("spark.checkpoint.dir", None):
        if not spark.sparkContext.master.startswith("local") or spark.sparkContext.master.startswith("local-cluster"):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        spark.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="spark-shared-"))
    return spark.conf.get("spark.checkpoint.dir").rstrip("/")


def new_path(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/levyframe-{uuid.uuid4().hex}"


#: Folders that the open scratch contexts have to remove.
_scratch: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Tables that are materialized within this context are removed at its end; what is made of them must be written by then.

    Contexts may stand within each other; each removes its own, also after an error.
    """
    _scratch.append([])
    try:
        yield
    finally:
        for path in _scratch.pop():
            remove(spark, path)


def written(df: DataFrame, lasting: bool = False) -> str:
    """df as Parquet in a new folder of the shared one, and where; lasting: beyond a scratch context."""
    path = new_path(df.sparkSession)
    if _scratch and not lasting:
        _scratch[-1].append(path)
    df.write.option("compression", "zstd").parquet(path)
    return path


def materialize(df: DataFrame) -> DataFrame:
    """df written and read again: its lineage ends there, and no lost executor takes a part of it along."""
    return df.sparkSession.read.schema(df.schema).parquet(written(df))


def _folder(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def remove(spark: SparkSession, path: str) -> None:
    files, place = _folder(spark, path)
    files.delete(place, True)


class GateError(ValueError):
    """A table was not published; `metrics` says what was measured."""

    def __init__(self, broken: list[str], metrics: dict) -> None:
        super().__init__(f"{'; '.join(broken)}: {metrics}")
        self.broken, self.metrics = broken, metrics


def write_gated(df: DataFrame, path: str, metrics: dict[str, Column], gates: dict[str, Callable[[dict], bool]]) -> dict:
    """Write df to path as Parquet, if its metrics pass all gates, and return them; else raise GateError and leave path as it was.

    The metrics (aggregates, not distinct ones) are observed while df is
    written, beside path, so there is no second pass; what passes is moved into place.
    """
    spark, seen, beside = df.sparkSession, Observation(), f"{path.rstrip('/')}.{uuid.uuid4().hex}"
    df.observe(seen, *[c.alias(k) for k, c in metrics.items()]).write.option("compression", "zstd").parquet(beside)
    values = seen.get
    broken = [name for name, passes in gates.items() if not passes(values)]
    if broken:
        remove(spark, beside)
        raise GateError(broken, values)
    remove(spark, path)
    files, place = _folder(spark, beside)
    if not files.rename(place, _folder(spark, path)[1]):
        raise OSError(f"can't move {beside} to {path}")
    return values
