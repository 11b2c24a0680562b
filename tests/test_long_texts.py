"""Texts that grow with a county's units: parcels carry numbers of them, and meet them at the end."""

from itertools import groupby

import duckdb
from pyspark.sql import functions as F

from levyframe.operators import rates, spatial, tables
from levyframe.plans import rating
from levyframe.plans.registry import QUERIES, SQL
from tests.test_many_units import many  # noqa: F401
from tests.test_queries import TABLES, plain


def test_parcels_are_moved_without_their_texts(spark, many, monkeypatch):  # noqa: F811
    monkeypatch.setattr(tables, "LONG_BYTES", 1 << 14)  # some texts go to several tasks
    moved, write = [], rating.materialize
    monkeypatch.setattr(rating, "materialize", lambda df: moved.append(df) or write(df))
    out = QUERIES["h9_parcel_export"](spark, many)
    parcels = next(df for df in moved if "own" in df.columns)
    text = parcels._jdf.queryExecution().optimizedPlan().toString()
    assert {f.dataType.typeName() for f in parcels.schema.fields} <= {"long", "integer", "string", "decimal", "double"}
    assert parcels.agg(F.max(F.length("sdn"))).first()[0] < 500 < out.agg(F.max(F.length("sdn"))).first()[0]
    assert "array_join(extra_units" not in text
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{many}/{t}.parquet'")
    want = con.sql(SQL["h9_parcel_export"])
    order = [want.columns.index(c) for c in out.columns]
    assert sorted(repr(tuple(plain(v) for v in r)) for r in out.collect()) == sorted(repr(tuple(plain(r[i]) for i in order)) for r in want.fetchall())


def test_rows_get_the_text_of_their_keys(spark, monkeypatch):
    monkeypatch.setattr(tables, "LONG_BYTES", 4)
    rows = spark.createDataFrame([(k % 3, i) for i, k in enumerate([0] * 20 + [1, 2, 2])], "k int, uid long")
    texts = spark.createDataFrame([(0, 20, "long"), (1, 1, None), (2, 2, ""), (7, 0, "no row")], "k int, n long, word string")
    got = tables.with_long(rows, texts, ["k"], F.octet_length("word"), F.xxhash64("uid")).collect()
    assert sorted((r.uid, r.word) for r in got) == [(i, "long") for i in range(20)] + [(20, None), (21, ""), (22, "")]


def test_extras_of_overlapping_corrections(spark):
    rows = [(["a", "b"], ["s"], 0.1, "u"), (["a", "b"], ["s"], 0.1, "u"), (["b"], ["s", "t"], 0.2, "v"), (None, ["s"], 0.3, "w"), ([None], ["s"], 0.4, None)]
    c = spark.createDataFrame([("c", *r) for r in rows], "county string, city_names array<string>, isd_names array<string>, r double, unit_id string").selectExpr("* except (r)", "cast(r as decimal(12,6)) as extra_rate")
    got = {(r.city_name, r.isd_name): (float(r.extra_rate), r.extra_units) for r in rates.area_extra(c).collect()}
    assert got == {("a", "s"): (0.2, ["u"]), ("b", "s"): (0.4, ["u", "v"]), ("b", "t"): (0.2, ["v"]), (None, "s"): (0.7, ["w"])}


def test_polygons_of_one_outline_come_as_lists(spark, monkeypatch):
    monkeypatch.setattr(tables, "LONG_BYTES", 4000)  # an outline's points go to several tasks
    monkeypatch.setattr(spatial, "LIST", 7)
    square = lambda x: [[{"x": x, "y": 0.0}, {"x": x + 2.0, "y": 0.0}, {"x": x + 2.0, "y": 2.0}, {"x": x, "y": 2.0}]]
    names = [(i, float(i % 2)) for i in range(40)] + [(None, 0.0), (3, 1.0)]
    polygons = spark.createDataFrame([(n, square(x)) for n, x in names], "poly long, rings array<array<struct<x: double, y: double>>>")
    points = [(i, 0.25 + (i * 37 % 100) / 37, 0.5 + i / 100) for i in range(100)]
    rows = spatial.points_in_polygons(spark.createDataFrame(points, "uid long, x double, y double"), polygons, "uid", "poly")
    got = rows.rdd.glom().collect()
    want = sorted(((i, n) for i, x, _ in points for n, left in names if left < x < left + 2), key=repr)
    assert sorted((tuple(r) for part in got for r in part), key=repr) == want
    assert max(map(len, got)) < len(want) / 2
    for part in got:
        of = [tuple(r.poly for r in group) for _, group in groupby(part, key=lambda r: r.uid)]
        assert len(list(groupby(of))) <= 3  # one outline's points, then the other's
