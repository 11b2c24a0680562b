"""Counties of more than a thousand units: their ids stay apart, and queries that order by them give the SQL's rows."""

import os

import duckdb
import pytest

from levyframe.plans.fixtures import Tables
from levyframe.plans.registry import QUERIES, SQL
from tests.test_queries import TABLES, plain


@pytest.fixture(scope="module")
def many(sf_dir, tmp_path_factory):
    """The smallest tables, with the parts that units are made of repeated to 26,000."""
    folder = str(tmp_path_factory.mktemp("many"))
    for t in TABLES:
        source = os.path.join(sf_dir, f"{t}.parquet")
        if t == "part":
            duckdb.sql(f"copy (select * exclude (i) replace (p_partkey + 200 * i as p_partkey) from '{source}', (select unnest(range(130)) as i) r) to '{folder}/part.parquet'")
        else:
            os.symlink(source, f"{folder}/{t}.parquet")
    return folder


def test_unit_ids_are_unique(spark, many):
    units = Tables(spark, many)("fx_units")
    assert units.count() == 26000 == units.select("unit_id").distinct().count()


@pytest.mark.parametrize("name", ["a2_boundaries", "a3_feature_collection", "a8_json_report", "d10_resolve_districts", "k5_rate_rows", "a1_taxing_units"])
def test_matches_sql(spark, many, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{many}/{t}.parquet'")
    got, want = QUERIES[name](spark, many), con.sql(SQL[name])
    order = sorted(got.columns)
    place = [want.columns.index(c) for c in order]
    mine = sorted(repr(tuple(plain(r[c]) for c in order)) for r in got.collect())
    assert mine == sorted(repr(tuple(plain(r[i]) for i in place)) for r in want.fetchall())
