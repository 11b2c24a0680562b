"""Dedup, ranking, set and gate operators that are not tied to one domain table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyframe.functions.text import has_real_id
from levyframe.sources.tables import materialize

#: Bytes of long values that a task puts beside rows, about, and tasks that do so, at most.
LONG_BYTES, LONG_TASKS = 1 << 27, 20_000


def dedup_real_ids(df: DataFrame, keys: list[str], order: list[Column], id_col: str = "prop_id") -> DataFrame:
    """The first row of each key by `order`; rows without a real id are no duplicates of each other and all stay.

    Those rows are kept out of the window, where one value would hold them all.
    """
    real = has_real_id(F.col(id_col))
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    first = df.where(real).withColumn("__rank", rank).where("__rank = 1").drop("__rank")
    return first.unionByName(df.where(~real))


def top_per_group(df: DataFrame, group: str, n: int, value: str, tie: str) -> DataFrame:
    """The n rows of largest value of each group, null values last, ties by `tie`; with rank."""
    rank = F.row_number().over(Window.partitionBy(group).orderBy(F.col(value).desc_nulls_last(), tie))
    return df.withColumn("rank", rank).where(F.col("rank") <= n)


def first_seen(df: DataFrame, key: str, position: str) -> DataFrame:
    """One row a key, that of the least position; a null one comes first."""
    if set(df.columns) == {key, position}:  # nothing else to bring along: sums up where the rows are
        least = F.when(F.count_if(F.col(position).isNull()) == 0, F.min(position))
        return df.groupBy(key).agg(least.alias(position)).select(*df.columns)
    rank = F.row_number().over(Window.partitionBy(key).orderBy(position))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def first_part_wins(parts: DataFrame, keys: list[str], part: str, values: list[str]) -> DataFrame:
    """One row a key from the first part that has it; within a part each value's least, so results repeat."""
    rank = Window.partitionBy(*keys)
    here = parts.groupBy(*keys, part).agg(*[F.min(v).alias(v) for v in values])
    return here.withColumn("__first", F.min(part).over(rank)).where(F.col(part) == F.col("__first")).drop("__first", part)


def mode(df: DataFrame, keys: list[str], value: str, weight: str) -> DataFrame:
    """The value of most weight in each group, the least of equals; with its weight."""
    sums = df.groupBy(*keys, value).agg(F.sum(weight).alias("__n"))
    best = F.max_by(F.struct(F.col(value).alias("v"), F.col("__n").alias("n")), F.struct("__n", (-F.col(value)).alias("less")))
    return sums.groupBy(*keys).agg(best.alias("__best")).select(*keys, F.col("__best.v").alias(value), F.col("__best.n").alias("n"))


def uniform_value(df: DataFrame, keys: list[str], value: str) -> DataFrame:
    """The one value of each group, else null; with least and largest, 0 where there is none."""
    return df.groupBy(*keys).agg(F.when(F.count_distinct(value) == 1, F.min(value)).alias("uniform"), F.coalesce(F.min(value), F.lit(0)).alias("least"), F.coalesce(F.max(value), F.lit(0)).alias("largest"))


def curated_wins(curated: DataFrame, derived: DataFrame, key: str) -> DataFrame:
    """Curated rows, and derived ones of keys that have none."""
    return curated.unionByName(derived.join(curated.select(key).distinct(), key, "left_anti"))


def not_loaded(new: DataFrame, loaded: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of `new` whose keys, nulls included, are not in `loaded`."""
    have = loaded.select([F.col(k).alias(f"__{k}") for k in keys]).distinct()
    on = [new[k].eqNullSafe(have[f"__{k}"]) for k in keys]
    return new.join(have, on, "left_anti")


def violations(rule: str, bad: DataFrame, detail: Column) -> DataFrame:
    """(rule, detail) for each row that breaks a rule."""
    return bad.select(F.lit(rule).alias("rule"), detail.cast("string").alias("detail"))


def require_none(found: DataFrame) -> None:
    """Stops a build whose gates have been broken."""
    some = found.limit(5).collect()
    if some:
        raise ValueError("; ".join(f"{r.rule}: {r.detail}" for r in some))


def recipe_gates(recipes: DataFrame, units: DataFrame, counties: DataFrame, n_counties: int, corrections: DataFrame | None = None) -> DataFrame:
    """All violations that must stop a build: unknown units, bases outside [0, 1.8), code and name that disagree, the number of counties, a correction's key twice."""
    unknown = recipes.join(units.select("unit_id"), "unit_id", "left_anti")
    bases = recipes.join(units, "unit_id").groupBy(recipes["county_code"]).agg(F.sum("rate_per_100").alias("base"))
    wrong_base = bases.where("base < 0 or base >= 1.8")
    foreign = recipes.where(F.substring("unit_id", 1, 3) != F.col("county_code"))
    size = counties.agg(F.count("*").alias("n")).where(F.col("n") != n_counties)
    out = violations("unknown unit", unknown, F.col("unit_id")).unionByName(violations("base", wrong_base, F.concat_ws(" ", "county_code", "base"))).unionByName(violations("foreign unit", foreign, F.concat_ws(" ", "county_code", "unit_id"))).unionByName(violations("counties", size, F.col("n")))
    if corrections is not None:
        twice = corrections.groupBy("county", "city_name", "isd_name").count().where("count > 1")
        out = out.unionByName(violations("area twice", twice, F.concat_ws("|", "county", "city_name", "isd_name")))
    return out


def with_long(rows: DataFrame, long: DataFrame, keys: list[str], size: Column, by: Column) -> DataFrame:
    """rows joined with the long values (texts, lists) of their keys.

    keys: without nulls.  long: keys, n (how many rows meet them) and further
    columns, size bytes each row.  Rows are moved without their values: both are
    dealt by key, and a key whose values are much in all is dealt to several
    tasks, by a hash of its rows.  Rows of one key end up side by side.
    """
    bytes_ = F.col("n") * F.coalesce(size, F.lit(0))
    long = materialize(long.withColumns({"__bytes": bytes_, "__spread": F.greatest(F.lit(1), F.ceil(bytes_ / LONG_BYTES)).cast("long")}).drop("n"))
    spread = long.groupBy(*keys).agg(F.max("__spread").alias("__spread"))
    tasks = int(long.agg(F.sum("__bytes")).first()[0] or 0) // LONG_BYTES
    tasks = max(rows.sparkSession.sparkContext.defaultParallelism, min(tasks, LONG_TASKS))
    dealt = rows.join(spread, keys).withColumn("__salt", F.pmod(by, "__spread")).drop("__spread")
    copies = long.join(spread.withColumnRenamed("__spread", "__most"), keys).withColumn("__salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("__most") - 1))).drop("__bytes", "__spread", "__most")
    deal = [*keys, "__salt"]
    return dealt.repartition(tasks, *deal).join(copies.repartition(tasks, *deal).hint("merge"), deal).drop("__salt")
