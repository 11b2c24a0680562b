from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from levyframe.functions.text import norm_city
from levyframe.operators import documents, rates, reconcile, resolve, tables
from levyframe.sources import readers, writers

UNITS = "county_code string, unit_id string, name string, unit_type string, rate_per_100 decimal(12,6)"


def units(spark, rows):
    return spark.createDataFrame([(u[:3], u, n, u[-2:], Decimal(r)) for u, n, r in rows], UNITS)


@pytest.fixture
def adjacency(spark):
    return spark.createDataFrame([("001", "002"), ("002", "001")], "a string, b string")


def test_entities_find_their_units(spark, adjacency):
    u = units(spark, [("001-000-00", "Kaufman", "0.4"), ("001-001-03", "Kaufman", "0.6"), ("001-002-40", "Kaufman ESD #1", "0.1"), ("002-002-40", "Wilson ESD 1", "0.09"), ("002-003-02", "Lufkin ISD", "1.1"), ("001-004-18", "Kaufman County Navigation District", "0.02"), ("001-005-04", "Meadowbrook MUD", "0.3")])
    counties = spark.createDataFrame([("001", "Kaufman"), ("002", "Wilson")], "county_code string, county string")
    names = spark.createDataFrame([("001", n) for n in ("KAUFMAN COUNTY", "City of Kaufman", "ESD 1", "LUFKIN ISD (FP)", "Navigation District", "MEADOWBROOKS MUD", "nothing at all")], "county_code string, name string")
    got = {r.name: (r.unit_id, r.stage, r.pool, r.retried) for r in resolve.match_entities(names, u, adjacency, counties).collect()}
    assert got == {
        "KAUFMAN COUNTY": ("001-000-00", 1, 1, False), "City of Kaufman": ("001-001-03", 1, 1, False), "ESD 1": ("001-002-40", 2, 1, False), "LUFKIN ISD (FP)": ("002-003-02", 1, 2, False),
        "Navigation District": ("001-004-18", 1, 1, True), "MEADOWBROOKS MUD": ("001-005-04", 3, 1, False), "nothing at all": (None, None, None, None),
    }


def test_names_resolve_by_tier(spark, adjacency):
    u = units(spark, [("001-001-03", "City of A", "0.1"), ("002-001-03", "A", "0.2"), ("002-002-03", "B", "0.3"), ("003-001-03", "C", "0.4"), ("003-002-03", "D", "0.4"), ("004-001-03", "D", "0.5")])
    asked = spark.createDataFrame([("001", n) for n in "ABCDE"], "county_code string, name string")
    got = {r.name: (r.tier, r.unit_id) for r in resolve.resolve_names(asked, u, adjacency, norm_city).collect()}
    assert got == {"A": (1, "001-001-03"), "B": (2, "002-002-03"), "C": (3, "003-001-03"), "D": (None, None), "E": (None, None)}


def test_rows_without_an_id_are_no_duplicates(spark):
    df = spark.createDataFrame([("x", "0", 1), ("x", "0", 2), ("x", None, 3), ("x", "7", 4), ("x", "7", 5)], "county string, prop_id string, n int")
    assert sorted(r.n for r in tables.dedup_real_ids(df, ["county", "prop_id"], [F.col("n")]).collect()) == [1, 2, 3, 4]


def test_gates_stop_a_build(spark):
    with pytest.raises(ValueError, match="unknown unit"):
        tables.require_none(spark.createDataFrame([("unknown unit", "1")], "rule string, detail string"))
    tables.require_none(spark.createDataFrame([], "rule string, detail string"))


def test_split_cells_are_rejoined_and_forms_skipped(spark):
    long = "x" * 50
    lines = [
        *(("a", i, x) for i, x in enumerate(["0.91", "0.81", "Carson County", "0.41", "  0.062294 ", "0.472294", "", "0.31", "0.32", "12. Some ISD  0.5 0.3 0.8", "Total 1.5", "Panhandle Water", "0.0091"])),
        ("b", 1, "Form 50-856"), ("b", 2, "X County 0.50"),
        *(("c", i, long) for i in range(117)), ("c", 117, "y" * 25 + " Form 50-856"), ("c", 118, "Y County 0.50"),
        *(("d", i, long) for i in range(300)), ("d", 301, "Form 50-856"), ("d", 302, "Z County\t0.50\t0.25"),
    ]
    df = spark.createDataFrame(lines, "doc string, line_no int, line string")
    joined = {r.line_no: r.line for r in documents.rejoin_split_rows(df.where("doc = 'a'")).collect()}
    assert joined == {0: "0.91", 1: "0.81", 2: "Carson County\t0.41\t0.062294\t0.472294", 6: "\t0.31", 8: "0.32", 9: "12. Some ISD  0.5 0.3 0.8", 10: "Total 1.5", 11: "Panhandle Water\t0.0091"}
    got = {(r.doc, r.name, float(r.rate)) for r in documents.parse_rate_lines(df).collect()}
    # the form of document c begins within its first 6000 characters but ends behind them
    assert got == {("a", "Carson County", 0.472294), ("a", "Panhandle Water", 0.0091), ("c", "Y County", 0.5), ("d", "Z County", 0.5)}


def test_year_of_the_label_wins(spark):
    df = spark.createDataFrame([("c", "2016 certified roll", "https://x/uploads/2023/a.zip", 5, True), ("c", "certified roll 2019", "https://x/b.zip", 4, True), ("c", "gis 2025 roll", "https://x/c", 3, True)], "county string, label string, url string, bytes int, usable boolean")
    r = documents.pick_roll_file(df).first()
    assert (r.year, r.url) == (2019, "https://x/b.zip")


def test_incomplete_stacks_fall_back(spark):
    roll = [("001", "1", "E", "co"), ("001", "1", "E", "isd"), ("001", "1", "E", "isd"), ("001", "2", "E", "co"), ("001", "0", "E", "co"), ("001", "3", "CAD", "co")]
    df = spark.createDataFrame(roll, "county_code string, prop_id string, entity_code string, entity_name string")
    m = spark.createDataFrame([("001", "co", "u1", "Co", "00", Decimal("0.3")), ("001", "isd", "u2", "Isd", "02", Decimal("1.1"))], "county_code string, name string, unit_id string, unit_name string, unit_type string, rate_per_100 decimal(12,6)")
    assert [(r.prop_id, float(r.roll_rate), float(r.roll_isd_rate)) for r in rates.roll_rates(df, m).collect()] == [("1", 1.4, 1.1)]


def test_golden_sums(spark):
    # county 0.299999, with the published city and school rates of one address
    df = spark.createDataFrame([(Decimal("0.276331"), Decimal("0.023668"))], "a decimal(12,6), b decimal(12,6)")
    assert df.select((F.col("a") + F.col("b")).alias("s")).first().s == Decimal("0.299999")


def test_totals_are_taken_apart(spark):
    extras = spark.createDataFrame([("001", f"e{i}", Decimal(r)) for i, r in enumerate(("0.1", "0.05", "0.025", "0.1"))], "county_code string, unit_id string, rate_per_100 decimal(12,6)")
    subsets = reconcile.subset_sums(reconcile.top_extras(extras))
    assert subsets.count() == 16
    county = spark.createDataFrame([("001", Decimal("0.4"))], "county_code string, base decimal(12,6)")
    schools = spark.createDataFrame([("001", "s", Decimal("1.0"))], "county_code string, unit_id string, rate_per_100 decimal(12,6)")
    cities = spark.createDataFrame([("001", "c", Decimal("0.5"))], "county_code string, unit_id string, rate_per_100 decimal(12,6)")
    totals = spark.createDataFrame([("001", Decimal("1.5500")), ("001", Decimal("2.0000")), ("001", Decimal("9.0000"))], "county_code string, total decimal(12,4)")
    got = {float(r.total): (r.n_ways, r.city_unit, len(r.units)) for r in reconcile.solve_totals(totals, county, schools, cities, subsets).collect()}
    assert got == {1.55: (1, None, 2), 2.0: (1, "c", 1)}


def test_absent_feature_file_is_empty(spark, tmp_path):
    assert readers.read_feature_collection(spark, str(tmp_path / "none.json")).collect() == []


def test_workbook_and_shards(spark, tmp_path):
    (tmp_path / "u.csv").write_text('Rates,,\nx,,\nname,id,rate\n"Some County **",001-000-00,0.5\nblank,,1\nNo rate,001-001-03,\n')
    got = readers.read_taxing_units(spark, str(tmp_path / "u.csv"), 2025).collect()
    assert [(r.name, r.unit_type, float(r.rate_per_100)) for r in got] == [("Some County", "00", 0.5), ("No rate", "03", 0.0)]
    df = spark.createDataFrame([(f"s{i % 3}", f"{i:03}", f"line{i:03}") for i in range(90)], "shard string, k string, line string")
    writers.write_sharded_tsv(df, str(tmp_path / "out"), "shard", "k", "line")
    for s in range(3):
        part = spark.read.text(str(tmp_path / "out" / f"shard=s{s}"))
        lines = [r.value for r in part.collect()]
        assert lines == sorted(lines)
        assert len(lines) == 30
