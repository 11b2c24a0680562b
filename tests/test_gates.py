"""Gates measured while a table is written, and corrections that are applied until none is left."""

import pytest
from pyspark.sql import functions as F

from levyframe.operators import reconcile as R
from levyframe.sources.tables import GateError, write_gated


def test_a_table_is_published_only_if_it_passes(spark, tmp_path):
    path, metrics = str(tmp_path / "t"), {"n": F.count(F.lit(1)), "bad": F.count_if(F.col("v") < 0), "most": F.max("v")}
    gates = {"no bad rows": lambda m: m["bad"] == 0, "some rows": lambda m: m["n"] > 0}
    assert write_gated(spark.range(10).select(F.col("id").alias("v")), path, metrics, gates) == {"n": 10, "bad": 0, "most": 9}
    with pytest.raises(GateError, match="no bad rows") as e:
        write_gated(spark.range(-2, 5).select(F.col("id").alias("v")), path, metrics, gates)
    assert e.value.metrics["bad"] == 2 and spark.read.parquet(path).count() == 10
    assert write_gated(spark.range(3).select(F.col("id").alias("v")), path, metrics, gates)["n"] == 3
    assert spark.read.parquet(path).count() == 3 and sorted(p.name for p in tmp_path.iterdir()) == ["t"]
    with pytest.raises(GateError, match="some rows"):
        write_gated(spark.range(0).select(F.col("id").alias("v")), path, metrics, gates)


SOLVED = "county_code string, total decimal(12,4), isd_unit string, city_unit string, rates array<decimal(12,6)>, units array<string>, n_ways long"


def test_a_planted_gap_is_found_once(spark):
    solved = spark.createDataFrame([("001", 2, "s1", "c1", [], ["u1"], 1), ("001", 3, "s2", None, [], ["u2", "u3"], 1), ("001", 4, "s3", None, [], [], 1)], SOLVED.replace("decimal(12,4)", "int").replace("decimal(12,6)", "int"))
    solved = solved.select([F.col(c).cast(k) for c, k in zip(solved.columns, ("string", "decimal(12,4)", "string", "string", "array<decimal(12,6)>", "array<string>", "long"), strict=True)])
    missing = spark.sql("select '001' as county_code, unit_id, '40' as unit_type, cast(rate as decimal(12,6)) as rate_per_100 from values ('u1', 0.25), ('u2', 0.5), ('u3', 0.25) as t(unit_id, rate)")
    trust = spark.sql("select '001' as county_code, 0.9D as trust")
    asked = []

    def modes_of(known, takes=True):
        asked.append(known.count())
        plain = spark.sql("select '001' as county_code, city_unit, isd_unit, cast(rate as decimal(12,6)) as rate, 5L as n from values ('c1', 's1', 1.75), (null, 's2', 2.25), (null, 's3', 4.0) as t(city_unit, isd_unit, rate)")
        extra = known.select(F.col("isd_unit"), "extra_rate") if takes else known.select("isd_unit", "extra_rate").limit(0)
        return plain.join(extra, "isd_unit", "left").withColumn("rate", (F.col("rate") + F.coalesce("extra_rate", F.lit(0))).cast("decimal(12,6)")).drop("extra_rate")

    found = {(r["isd_unit"], float(r["extra_rate"]), tuple(r["extra_units"]), r["round"]) for r in R.correct_until_stable(solved, missing, trust, modes_of).collect()}
    assert found == {("s1", 0.25, ("u1",), 1), ("s2", 0.75, ("u2", "u3"), 1)} and asked == [0, 2]
    with pytest.raises(ValueError, match="don't take"):
        R.correct_until_stable(solved, missing, trust, lambda known: modes_of(known, takes=False))


def test_areas_of_corrections(spark):
    names = spark.createDataFrame([("001", "A", "s1", "North"), ("001", "A", "s1", "South"), ("001", "A", "c1", "Town")], "county_code string, county string, unit_id string, name string")
    found = spark.createDataFrame([("001", "s1", "c1", 0.5, ["u1", "u2"]), ("001", "s1", None, 0.25, ["u3"]), ("001", "s1", "c9", 1.0, ["u4"])], "county_code string, isd_unit string, city_unit string, extra_rate double, extra_units array<string>")
    from levyframe.operators.rates import area_extra

    got = {(r["city_name"], r["isd_name"], float(r["extra_rate"]), tuple(r["extra_units"])) for r in area_extra(R.correction_areas(found, names)).collect()}
    assert got == {("Town", "North", 0.5, ("u1", "u2")), ("Town", "South", 0.5, ("u1", "u2")), (None, "North", 0.25, ("u3",)), (None, "South", 0.25, ("u3",))}


def test_scratch_tables_go_with_their_context(spark):
    import os

    from levyframe.sources.tables import materialize, scratch, shared_dir, written

    top = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(top))
    with scratch(spark):
        a = materialize(spark.range(3))
        with pytest.raises(ZeroDivisionError), scratch(spark):
            materialize(spark.range(4))
            1 / 0  # noqa: B018
        assert a.count() == 3 and len(set(os.listdir(top)) - before) == 1
        stays = written(spark.range(5), lasting=True)
    assert [f"{top}/{x}" for x in set(os.listdir(top)) - before] == [stays.removeprefix("file:")]
