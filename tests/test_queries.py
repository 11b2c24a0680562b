"""Every query with SQL gives the SQL's rows, here on the smallest tables."""

import os

import duckdb
import pytest
from pyspark.sql import functions as F

from levyframe.plans.registry import QUERIES, SQL

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def con(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from '{os.path.join(sf_dir, t)}.parquet'")
    return con


def plain(v):
    return float(v) if v.__class__.__name__ == "Decimal" else v


@pytest.mark.parametrize("name", sorted(SQL))
def test_matches_sql(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir)
    want = con.sql(SQL[name])
    assert sorted(got.columns) == sorted(want.columns)
    order = sorted(got.columns)
    place = [want.columns.index(c) for c in order]
    mine = sorted(repr(tuple(plain(r[c]) for c in order)) for r in got.collect())
    assert mine == sorted(repr(tuple(plain(r[i]) for i in place)) for r in want.fetchall())


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_runs(spark, sf_dir, name):
    assert QUERIES[name](spark, sf_dir).columns


def test_ratio_matches_add_what_difflib_finds(spark, sf_dir):
    """h8_with_ratio: roll names that no exact stage knows get the unit of the largest ratio, by hand over all units."""
    from difflib import SequenceMatcher

    from levyframe.functions.text import ROLL_TYPE_RULES, norm_entity, type_hint
    from levyframe.operators import resolve
    from levyframe.plans.fixtures import Tables
    from levyframe.plans.joins import ENTITIES, adjacency

    t = Tables(spark, sf_dir)
    names = t.sql(ENTITIES).select("county_code", F.concat(F.col("name"), F.lit("Q")).alias("name")).distinct()
    got = {(r.county_code, r.name): r for r in resolve.match_entities(names, t("fx_units"), adjacency(t), t("fx_counties")).collect()}
    assert len(got) == names.count()
    near = {}
    for r in adjacency(t).collect():
        near.setdefault(r.a, set()).add(r.b)
    units = t("fx_units").where("rate_per_100 > 0").withColumn("un", norm_entity(F.col("name"))).collect()
    asked = names.withColumn("n", norm_entity(F.col("name"))).withColumn("hint", type_hint(F.col("name"), ROLL_TYPE_RULES)).collect()
    n = 0
    for a in asked:
        r = got[a.county_code, a.name]
        if r.stage != 3 or r.retried:
            continue
        pool = [u for u in units if (u.county_code == a.county_code if r.pool == 1 else u.county_code in near[a.county_code])]
        scored = []
        for u in pool:
            x, typed = SequenceMatcher(None, a.n, u.un).ratio(), u.unit_type == a.hint
            if x >= 0.88 and (typed or x >= 0.9):
                scored.append((-(x + 0.05 * typed), u.county_code, u.unit_id))
        assert min(scored)[2] == r.unit_id
        n += 1
    assert n > 10
