"""Steps over all roll lines and parcels: what they move, and that results stay."""

import re

from levyframe.operators import rates, tables
from levyframe.operators import reconcile as R
from levyframe.plans import fixtures
from levyframe.plans.fixtures import FIXTURES, MET, Tables
from levyframe.plans.registry import QUERIES


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_first_seen_sums_up_where_rows_are(spark):
    rows = spark.createDataFrame([("a", 3), ("a", 1), ("b", None), ("b", 2), (None, 5), (None, 4)], "k string, at long")
    first = tables.first_seen(rows, "k", "at")
    assert sorted(map(tuple, first.collect()), key=repr) == sorted([("a", 1), ("b", None), (None, 4)], key=repr)
    assert "Window" not in plan(first)


def test_roll_rates_deal_lines_once_by_property(spark):
    lines = spark.createDataFrame([("001", "7", "E1", "X ISD"), ("001", "7", "E2", "Y"), ("001", "7", "E2", "Y"), ("001", "8", "E1", "X ISD")], "county_code string, prop_id string, entity_code string, entity_name string")
    known = spark.createDataFrame([("001", "X ISD", "u1", "X", "02", 1.0), ("001", "Y", "u2", "Y county", "00", 0.5)], "county_code string, name string, unit_id string, unit_name string, unit_type string, rate double")
    known = known.selectExpr("* except (rate)", "cast(rate as decimal(12,6)) as rate_per_100")
    out = rates.roll_rates(lines, known)
    assert [(r.prop_id, float(r.roll_rate), len(r.stack)) for r in out.collect()] == [("7", 1.5, 2)]
    assert not re.search(r"hashpartitioning\([^)]*unit_name", plan(out))


def test_deltas_meet_their_middle_by_value(spark):
    ids = [("001", str(k)) for k in range(9)]
    p = spark.createDataFrame(ids, "county_code string, prop_id string")
    delta = [0.0, 0.0, -0.1, 0.2, None, 0.0, 0.3, -0.2, 0.2]
    complete = spark.createDataFrame([(*i, d) for i, d in zip(ids, delta, strict=True)], "county_code string, prop_id string, r double").selectExpr("county_code", "prop_id", "cast(r as decimal(12,6)) as roll_rate")
    place = p.selectExpr("county_code", "prop_id", "cast(0 as decimal(12,6)) as rate")
    out = R.validate_rolls(p, p, complete, place)
    row = out.first()
    assert (float(row.middle_delta), row.share_lower, row.join_rate, row.complete_share) == (0.0, 0.25, 1.0, 1.0)
    assert "row_number" not in plan(out)


def test_ways_of_repeated_rows_are_one(spark):
    dec = "cast({} as decimal(12,6)) as {}".format
    one = lambda cols, rows, *more: spark.createDataFrame(rows, cols).selectExpr(*more)
    totals = one("county_code string, total double", [("001", 1.5), ("001", 1.5)], "county_code", "cast(total as decimal(12,4)) as total")
    base = one("county_code string, base double", [("001", 1.0)], "county_code", dec("base", "base"))
    school = one("county_code string, unit_id string, r double", [("001", "s", 0.3), ("001", "s", 0.3)], "county_code", "unit_id", dec("r", "rate_per_100"))
    city = one("county_code string, unit_id string, r double", [("001", "c", 0.1)], "county_code", "unit_id", dec("r", "rate_per_100"))
    extras = one("county_code string, unit_id string, r double", [("001", "x", 0.1), ("001", "y", 0.1), ("001", "z", 0.2)], "county_code", "unit_id", dec("r", "rate_per_100"))
    ways = R.solve_totals(totals, base, school, city, R.subset_sums(R.top_extras(extras)))
    got = sorted((w.city_unit or "", [float(r) for r in w.rates], w.units, w.n_ways) for w in ways.collect())
    assert got == [("", [0.1, 0.1], ["x", "y"], 3), ("", [0.2], ["z"], 3), ("c", [0.1], ["x"], 3)]
    assert not re.search(r"hashpartitioning\([^)]*isd_unit[^)]*rates", plan(ways))


def test_stored_fixtures_meet_few_rows(spark, sf_dir):
    t = Tables(spark, sf_dir)
    for name, of in MET.items():
        want = t.sql(FIXTURES[name])
        got = t(name)
        assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0
        for other, body in of.items():
            few, all_ = t.sql(body).count(), t(other).count()
            assert few < all_ if other == "fx_units" else few <= all_


def test_parcels_stay_where_they_are_on_the_way_to_their_rates(spark, sf_dir, monkeypatch):
    t, plans = Tables(spark, sf_dir), {}
    monkeypatch.setattr(fixtures, "_written", {})
    write = fixtures.written
    monkeypatch.setattr(fixtures, "written", lambda df, lasting=False: plans.setdefault(tuple(df.columns), plan(df)) and write(df, lasting))
    assert t("fx_rated").count() > 0
    named = next(p for c, p in plans.items() if "city_unit" in c)
    assert "REPARTITION" not in named and "SortMergeJoin" not in named
    for name in ("fx_located", "fx_rated"):
        assert "SortMergeJoin" not in plan(t(name)) and "hashpartitioning" not in plan(t(name))
    want, got = t.sql(FIXTURES["fx_located"]), t("fx_located")
    assert got.schema.simpleString() == want.schema.simpleString()
    assert got.exceptAll(want).count() == want.exceptAll(got).count() == 0


def test_district_stats_move_groups_and_no_parcels(spark, sf_dir):
    """Also where units are more than Spark broadcasts."""
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "4000")
    try:
        text = plan(QUERIES["e3_district_stats"](spark, sf_dir))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
    assert set(re.findall(r"hashpartitioning\((\w+?)#", text)) == {"county"}
