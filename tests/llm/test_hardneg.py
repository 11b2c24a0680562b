"""Hard negatives against brute force, and table lookups against plain inner products."""

import math
import random

import duckdb
import numpy as np
from pyspark.sql import functions as F

from levyframe.llm import hardneg

SCHEMA = "vec_id long, embedding array<double>, label int, score string"


def brute(rows, divisor=10, n_pos=5, n_neg=10):
    usable = [(i, [math.floor(256 * x) for x in v], y, k) for k, (i, v, y) in enumerate(rows) if y is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    dot = lambda a, b: sum(x * y for x, y in zip(a, b, strict=False))
    order = lambda t: (-t[0], t[1] is None, t[1] or 0)
    out = []
    for i, v, y, k in usable:
        if i is None or i % divisor:
            continue
        found = [(dot(v, w), j, z, m) for j, w, z, m in usable if m != k]
        for ps, p, _, _ in sorted((t for t in found if t[2] == y), key=order)[:n_pos]:
            far = sorted((t for t in found if t[2] != y and 30 * ps <= 100 * t[0] <= 90 * ps), key=order)[:n_neg]
            out += [(i, p, r + 1, n, ps, ns) for r, (ns, n, _, _) in enumerate(far)]
    return sorted(out, key=repr)


def got(spark, rows, **how):
    df = spark.createDataFrame([(i, v, y, "clash") for i, v, y in rows], SCHEMA)
    return sorted((tuple(r) for r in hardneg.hard_negatives(df, F.col("id") % 10 == 0, **how).collect()), key=repr)


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    return [(k, [rng.gauss(0, spread) for _ in range(dims)], rng.randrange(3)) for k in range(n)]


def test_equals_brute_force(spark):
    rows = vectors(150, 19, 1)
    assert got(spark, rows) == brute(rows)
    assert len(got(spark, rows)) > 300


def test_odd_rows(spark):
    rows = vectors(60, 8, 2)
    rows += [rows[0], rows[10], rows[11], (None, rows[3][1], 1), (None, rows[4][1], 2)]  # repeated rows, null ids
    rows += [(70, None, 1), (80, [1.0] * 8, None), (90, [1.0, None], 1), (100, [float("nan")] * 8, 1), (110, [float("inf")] * 8, 1)]
    rows += [(120, [], 1), (121, [0.5], 1), (122, [0.25] * 17, 2), (130, [30000.0, -30000.0], 0)]  # other lengths, large components
    assert got(spark, rows) == brute(rows)


def test_ties_go_by_id(spark):
    rows = [(k, [1.0, 1.0], k % 2) for k in range(40)]
    rows += [(k, [0.5, 0.5], 1 - k % 2) for k in range(100, 130)]
    assert got(spark, rows) == brute(rows)


def test_empty_tables_and_none_that_ask(spark):
    assert got(spark, []) == []
    assert got(spark, [(1, [1.0], 0), (2, [1.0], 1)]) == []
    assert got(spark, [(10, [1.0], 0)]) == []


def test_blocks_do_not_change_results(spark, monkeypatch):
    monkeypatch.setattr(hardneg, "BLOCK_ANCHORS", 2)
    rows = vectors(80, 9, 5)
    assert got(spark, rows) == brute(rows)


def test_lookups_equal_inner_products():
    rng = np.random.default_rng(3)
    for low, high, dims in ((-100, 100, 64), (-1, 1, 3), (0, 1, 8), (-(1 << 23) + 1, 1 << 23, 20), (-1, 0, 1)):
        a, c = rng.integers(low, high, (7, dims)), rng.integers(low, high, (11, dims))
        planes, groups, raw = hardneg.bit_planes(c)
        packed = raw.reshape(11, planes, groups)
        assert (hardneg.from_planes(planes, packed)[:, :dims] == c).all()
        tables = hardneg._narrow(hardneg.subset_sums(a), planes)
        assert (hardneg.scores(tables, planes, packed) == c @ a.T).all()


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view embeddings as select * from '{sf_dir}/embeddings.parquet'")
    df = hardneg.op12_hard_negatives(spark, sf_dir)
    want = con.execute(f"select {', '.join(df.columns)} from ({hardneg.SQL['op12_hard_negatives']}) x").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want) and want
