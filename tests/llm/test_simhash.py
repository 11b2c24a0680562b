import random

import pytest
from pyspark.sql import functions as F

from levyframe.llm import simhash
from levyframe.llm.components import connected_components
from levyframe.llm.simhash import MANY_PARTS, PARTS, near_groups, near_links, simhash_components, simhash_documents
from tests.llm import brute


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def clustered(n, seed):
    rng, out = random.Random(seed), [0, 1, (1 << 64) - 1]
    while len(out) < n:
        x = rng.getrandbits(64) if rng.random() < 0.4 else rng.choice(out)
        for _ in range(rng.randint(0, 5)):
            x ^= 1 << rng.randrange(64)
        out.append(x)
    return out


@pytest.mark.parametrize("parts", [PARTS, MANY_PARTS])
def test_all_links_are_kept(spark, monkeypatch, parts):
    prints = clustered(400, 5)
    want = brute.components(set(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    for crowd in (2048, 3):  # 3: nearly all anchors with links are split
        monkeypatch.setattr(simhash, "HOMES", crowd)
        df = spark.createDataFrame([(signed(x),) for x in set(prints)], "fp long")
        got = {r.node & ((1 << 64) - 1): r.component for r in connected_components(near_links(df, 4, parts)).collect()}
        groups = {}
        for x, c in want.items():
            groups.setdefault(c, []).append(x)
        for members in groups.values():
            if len(members) > 1:
                assert len({got[m] for m in members}) == 1
            else:
                assert members[0] not in got
        assert len(set(got.values())) == sum(len(m) > 1 for m in groups.values())


def test_documents_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    extra = [(1000, None), (1001, ""), (1002, "One two"), (1003, "one TWO"), (None, "one two"), (1000, None), (1004, "w " * 20000), (None, "alone in the world")]
    docs = docs.select("doc_id", "text").unionByName(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("fp", F.lit("clash")).withColumn("label", F.lit(1))
    rows = docs.collect()
    prints = [brute.simhash(r.text) for r in rows]
    least = {}
    comp = brute.components(set(prints), lambda a, b: (a ^ b).bit_count() <= 4)
    for r, p in zip(rows, prints, strict=True):
        ids = [x for x in (least.get(comp[p]), r.doc_id) if x is not None]
        least[comp[p]] = min(ids) if ids else None
    want = sorted((repr(r.doc_id), f"{p:016x}", repr(least[comp[p]])) for r, p in zip(rows, prints, strict=True))
    got = simhash_components(docs)
    assert got.columns == ["doc_id", "fingerprint", "component_id"]
    assert sorted((repr(r.doc_id), r.fingerprint, repr(r.component_id)) for r in got.collect()) == want
    kept = simhash_documents(docs)
    assert kept.columns == docs.columns
    left = kept.collect()
    assert len(left) == len(least)
    assert sorted(comp[brute.simhash(r.text)] for r in left) == sorted(least)
    assert {r.doc_id for r in left} == set(least.values())


def test_long_paths_become_one_component(spark):
    edges = spark.range(300).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b")).unionByName(spark.createDataFrame([(5, 5), (None, 3), (900, 901), (901, 900)], "a long, b long"))
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {900: 900, 901: 900}


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash_components(docs).collect() == []
    assert simhash_documents(docs).collect() == []
    assert near_groups(spark.createDataFrame([], "doc_id long, fp long")).collect() == []
