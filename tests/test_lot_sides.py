"""Sides of lots against a plain loop, and each leg worked out once."""

import math

import pytest

from levyframe.functions import geometry as G


def brute(ring, turn=12.0, least=3.0):
    if not 3 <= len(ring) <= 400:
        return None
    legs = []
    for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
        a, b, d = math.radians(y1), math.radians(y2), math.radians(x2) - math.radians(x1)
        h = math.sin((b - a) / 2) ** 2 + math.cos(a) * math.cos(b) * math.sin(d / 2) ** 2
        deg = math.degrees(math.atan2(math.sin(d) * math.cos(b), math.cos(a) * math.sin(b) - math.sin(a) * math.cos(b) * math.cos(d)))
        legs.append((2 * G.EARTH_FT * math.asin(math.sqrt(h)), (deg + 360) % 360))
    apart = lambda a, b: min((a - b) % 360, (b - a) % 360)
    sides = []
    for ft, deg in legs:
        if sides and apart(sides[-1][2], deg) < turn:
            sides[-1] = (sides[-1][0] + ft, sides[-1][1], deg)
        else:
            sides.append((ft, deg, deg))
    if len(sides) > 1 and apart(sides[-1][2], sides[0][1]) < turn:
        sides = [(sides[-1][0] + sides[0][0], sides[-1][1], sides[0][2]), *sides[1:-1]]
    return [s[0] for s in sides if s[0] > least]


def circle(n):
    return [(0.01 * math.cos(2 * math.pi * k / n), 0.01 * math.sin(2 * math.pi * k / n)) for k in range(n)]


RINGS = [
    [(0.0, 0.0), (0.0005, 0.0), (0.001, 0.00001), (0.001, 0.002), (0.0, 0.002)],
    [(0.0005, 0.0), (0.001, 0.0), (0.001, 0.002), (0.0, 0.002), (0.0, 0.0)],  # the last side goes on in the first
    [(0.0, 0.0), (0.001, 0.0), (0.001, 0.000001), (0.001, 0.001)],
    [(0.0, 0.0), (0.001, 0.0)],
    [],
    circle(3), circle(8), circle(60), circle(400), circle(401),
]


def test_sides_are_those_of_a_loop(spark):
    rows = spark.createDataFrame([(n, [{"x": x, "y": y} for x, y in r]) for n, r in enumerate(RINGS)] + [(99, None)], "n int, ring array<struct<x: double, y: double>>")
    got = {r.n: r.sides for r in rows.select("n", G.lot_sides(rows["ring"]).alias("sides")).collect()}
    assert got.pop(99) is None
    for n, ring in enumerate(RINGS):
        want = brute(ring)
        assert got[n] == (want if want is None else pytest.approx(want, abs=1e-3)), n


def test_each_leg_is_worked_out_once(spark):
    rows = spark.createDataFrame([], "ring array<struct<x: double, y: double>>")
    plan = rows.select(G.lot_sides(rows["ring"]).alias("sides"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.lower().count("asin(") == 1
