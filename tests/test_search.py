"""Searches by posting lists against all rows and queries; index tables and what is read of them."""

import random
import re
import uuid

import pytest

from levyframe.operators import search as S
from levyframe.plans.fixtures import Tables
from levyframe.plans.pages import base


@pytest.fixture(scope="module")
def index():
    rng = random.Random(6)
    words = ["SMITH", "SMITHSON", "SMI", "AB", "A", "JOHNSON", "ANNABELLE", "LI", "SMITHFIELDS", "12", "MAIN"]
    rows = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 4))) for _ in range(400)]
    return [(k[:3], k, "\t".join([f"C{i % 3}", str(i), f"{i % 90} MAIN ST", k, "1.0", "2.0"])) for i, k in enumerate([*rows, *rows[:20]])]


QUERIES = ["smith", "John Smith", "ab li", "a smi", "LI", "smithson annabelle", "annabelle smithfields", "x", "zzz", "smi ab", "ab a", "johnson, ann", "smith a"]


def found(rows, q, most=500):
    n = " ".join("".join(c if c.isalnum() else " " for c in q.upper()).split())
    if len(n) < 3:
        return set()
    tokens = n.split(" ")
    shards = {n[:3], tokens[-1][:3]}
    return {line.split("\t")[1] for shard, k, line in rows if shard in shards and all(t in k for t in tokens)}


def test_owner_search_equals_all_pairs(spark, index, monkeypatch):
    df, asked = spark.createDataFrame(index, "shard string, k string, line string"), spark.createDataFrame([(q,) for q in [*QUERIES, QUERIES[0]]], "q string")
    for rows in (50_000, 7):  # long lists are dealt out
        monkeypatch.setattr(S, "LIST_ROWS", rows)
        got = {}
        for r in S.search_owner(df, asked).collect():
            got.setdefault(r["q"], []).append(r["prop_id"])
        assert {q: set(v) for q, v in got.items()} == {q: found(index, q) for q in QUERIES if found(index, q)}
        assert all(len(set(v)) == len(v) for v in got.values())
    kept = S.posting_lists(df).cache()
    assert S.search_owner(df, asked, kept).count() == sum(len(v) for v in got.values())


def test_addresses_with_and_without_numbers(spark):
    rows = ["12 MAIN ST", "123 MAIN ST", "120 OAK AVE", "MAIN PLAZA", "OLD MAINE RD", "MAIL MAIN"]
    index = spark.createDataFrame([(("t_" + k[:3]) if not k[0].isdigit() else k.split(" ")[0][:3], k, f"C\t{i}\t{k}\t\t0\t0") for i, k in enumerate(rows)], "shard string, k string, line string")
    asked = spark.createDataFrame([("12 main",), ("120 oak",), ("123",), ("main",), ("main plaza",)], "q string")
    got = {}
    for r in S.search_addr(index, asked).collect():
        got.setdefault(r["q"], []).append(r["k"])
    assert got == {"12 main": ["12 MAIN ST"], "120 oak": ["120 OAK AVE"], "123": ["123 MAIN ST"], "main": ["MAIN PLAZA", "MAIL MAIN"], "main plaza": ["MAIN PLAZA"]}


def test_index_tables_are_read_by_bucket(spark, tmp_path):
    rows = [(f"{i:06d}"[:3], f"{i:06d}", f"C\t{i:06d}\t\t\t0\t0") for i in range(3000)]
    df = spark.createDataFrame(rows, "shard string, k string, line string").repartition(3)
    table = f"index_{uuid.uuid4().hex}"
    S.write_index_table(df, table, str(tmp_path / "t"), 8)
    one = S.look_up(spark, table, "0012")
    assert {r["k"] for r in one.collect()} == {f"{i:06d}" for i in range(1200, 1300)}
    spark.conf.set("spark.sql.sources.bucketing.autoBucketedScan.enabled", "false")  # else buckets are pruned all the same, but not told
    try:
        plan = S.look_up(spark, table, "0012")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.sources.bucketing.autoBucketedScan.enabled")
    assert "SelectedBucketsCount: 1 out of 8" in plan
    kept = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        all_of = S.look_up_all(spark, table, spark.createDataFrame([("0012",), ("00121",), ("99",), ("002999",)], "q string"))
        plan = all_of._jdf.queryExecution().executedPlan().toString()
        assert all_of.count() == 111
        scan = [x for x in plan.splitlines() if "FileScan" in x and table in x]
        above = plan[: plan.index(scan[0])].splitlines()[-4:]
        assert not any("Exchange" in x for x in above)  # what the queries need is moved to the table
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", kept)
        spark.sql(f"drop table {table}")


def test_keys_of_many_rows_stand_in_the_lists_once(spark):
    rows = [("ANN", k, f"C\t{i}\t\t{k}\t0\t0") for k in ("ANN SMITH", "ANN LI") for i in range(600)]
    df, asked = spark.createDataFrame(rows, "shard string, k string, line string"), spark.createDataFrame([("ann smith",), ("ann",)], "q string")
    assert S.posting_lists(df).count() == S.posting_lists(df.dropDuplicates(["shard", "k"])).count()
    count = lambda most: {r["q"]: r["count"] for r in S.search_owner(df, asked, most=most).groupBy("q").count().collect()}
    assert count(None) == {"ann smith": 600, "ann": 600} and count(500) == {"ann smith": 500, "ann": 500}


def test_base_moves_rows_once_for_owner_and_address(spark, sf_dir):
    plan = base(Tables(spark, sf_dir))._jdf.queryExecution().executedPlan().toString()
    assert "own_id" in plan and not re.search(r"hashpartitioning\([^)]*addr", plan)
