import os

import duckdb
import pytest
from pyspark.sql import functions as F

from levyframe.llm import mixing
from levyframe.llm.mixing import mix_sources, mixed_documents
from levyframe.llm.registry import SQL


def brute_targets(sizes, weights=(5, 2, 1), share=1.5, most=2.0):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out, free = share * sum(sizes.values()), {}, set(names)
    while free:
        level = (total - sum(out.values())) / sum(w[s] for s in free)
        above = {s for s in free if w[s] * level > most * sizes[s]}
        if not above:
            return out | {s: w[s] * level for s in free}
        out |= {s: most * sizes[s] for s in above}
        free -= above
    return out


def rows(n=3000):
    out = [(i, "w " * (1 + i % 17), f"s{i * i % 11}") for i in range(n)]
    out += [(n + i, "w " * 40, "hot") for i in range(n)] + [(9_000_000, None, "s1"), (9_000_001, "", None), (9_000_002, "a b", None), (None, "c d e", "s2"), (None, "c d e", "s2"), (9_000_003, None, "empty")]
    return out


@pytest.mark.parametrize("levels", [(12, 12, 12, 12, 12), (2, 2, 20, 36)])
def test_targets_and_what_is_taken(spark, monkeypatch, levels):
    monkeypatch.setattr(mixing, "LEVELS", levels)
    docs = spark.createDataFrame(rows(), "doc_id long, text string, source string").withColumn("SIZE", F.lit("clash"))
    got = mix_sources(docs)
    assert got.columns == ["doc_id", "text", "source", "size", "source_size", "target", "taken"]
    out = got.collect()
    assert len(out) == len(rows())
    sizes = {}
    for _, t, s in rows():
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    targets, taken = brute_targets(sizes), {}
    for r in out:
        assert r.size == len((r.text or "").split())
        assert r.source_size == sizes[r.source]
        assert abs(r.target - targets[r.source]) < 1e-6 * (1 + targets[r.source])
        assert r.taken in (0, r.size, 2 * r.size)
        taken[r.source] = taken.get(r.source, 0) + r.taken
    for s, target in targets.items():
        assert abs(taken[s] - target) <= 20 + 1e-6
    assert sorted(map(repr, out)) == sorted(map(repr, mix_sources(docs).collect()))
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    assert mixed.count() == sum(r.taken // r.size for r in out if r.size)


def test_equal_rows_at_the_threshold_are_numbered(spark):
    docs = spark.createDataFrame([(1, "a b", "x")] * 1000 + [(2, "c", "y")] * 1000, "doc_id long, text string, source string")
    out = mix_sources(docs).collect()
    for s in "xy":
        mine = [r for r in out if r.source == s]
        assert abs(sum(r.taken for r in mine) - mine[0].target) <= 2


def test_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view documents as select * from '{os.path.join(sf_dir, 'documents.parquet')}'")
    want = sorted(map(tuple, con.sql(SQL["op1_mix"]).fetchall()))
    got = sorted((r.doc_id, r.size, r.source_size, r.target, r.taken) for r in mixing.op1_mix(spark, sf_dir).collect())
    assert got == want


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, source string")
    assert mix_sources(docs).collect() == []
    assert mixed_documents(docs).collect() == []
