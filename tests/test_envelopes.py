"""Envelopes that touch, against all pairs."""

import random

from levyframe.operators import spatial as S


def test_envelopes_near_are_those_of_all_pairs(spark):
    rng = random.Random(5)
    kinds = [(x / 10, y / 10, (x + rng.randrange(0, 12)) / 10, (y + rng.randrange(0, 12)) / 10) for x, y in ((rng.randrange(-50, 50), rng.randrange(-50, 50)) for _ in range(60))]
    rows = [(n, *kinds[rng.randrange(60)]) for n in range(400)]
    boxes = spark.createDataFrame(rows, "n long, x0 double, y0 double, x1 double, y1 double")
    want = sorted((a[0], b[0]) for a in rows for b in rows if a[0] < b[0] and a[1] - 0.1 <= b[3] and a[3] + 0.1 >= b[1] and a[2] - 0.1 <= b[4] and a[4] + 0.1 >= b[2])
    got = S.envelopes_near(boxes, "n", 0.1)
    assert sorted((r.a, r.b) for r in got.collect()) == want
    assert "NestedLoop" not in got._jdf.queryExecution().toString()
