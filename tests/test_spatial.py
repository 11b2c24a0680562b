"""Covers, touching, dissolving and overlays against plain ray casts, all pairs and sampled areas."""

import math
import random

import pytest
from pyspark.sql import functions as F

from levyframe.functions import geometry as G
from levyframe.operators import spatial as S

RINGS = "array<array<struct<x:double,y:double>>>"


def inside(rings, x, y):
    odd = False
    for ring in rings:
        for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True):
            if (y1 > y) != (y2 > y) and x < x1 + (y - y1) / (y2 - y1) * (x2 - x1):
                odd = not odd
    return odd


def star(rng, cx, cy, n, grid=4):
    return [(cx + round(grid * rng.uniform(0.3, 1) * math.cos(2 * math.pi * i / n)) / grid, cy + round(grid * rng.uniform(0.3, 1) * math.sin(2 * math.pi * i / n)) / grid) for i in range(n)]


def box(x, y, w, h):
    return [(x, y), (x + w, y), (x + w, y + h), (x, y + h)]


def frame(spark, rows, name="poly"):
    return spark.createDataFrame([(k, [[(float(x), float(y)) for x, y in r] for r in rings]) for k, rings in rows], f"{name} int, rings {RINGS}")


@pytest.fixture(scope="module")
def shapes():
    rng = random.Random(4)
    rows = [(k, [star(rng, rng.randint(0, 8), rng.randint(0, 8), rng.randint(3, 60))] if k % 2 else [box(rng.randint(0, 8), rng.randint(0, 8), rng.randint(1, 4) / 4, rng.randint(1, 4) / 4)]) for k in range(24)]
    rows.append((100, [box(0, 0, 8, 8), box(1, 1, 2, 2)]))  # with a hole
    rows.append((101, [box(10, 10, 1, 1), box(-4, -4, 0.001, 3)]))  # in two parts, of different sizes
    rows.append((102, [[(5 + 2 * math.cos(t / 200), 5 + 2 * math.sin(t / 200)) for t in range(0, 1256)]]))  # many points
    return rows


def test_covers_equal_ray_casts_on_corners_and_borders_of_cells_too(spark, shapes):
    rng = random.Random(5)
    points = [(i, rng.randint(-40, 90) / 8 + rng.choice([0, 0, 0.0625]), rng.randint(-40, 90) / 8 + rng.choice([0, 0.03])) for i in range(2500)]
    points += [(10_000 + i, rng.uniform(-1, 9), rng.uniform(-1, 9)) for i in range(1500)]
    df = spark.createDataFrame(points, "uid int, x double, y double")
    got = {tuple(r) for r in S.points_in_polygons(df, frame(spark, shapes), "uid", "poly").collect()}
    assert got == {(i, k) for i, x, y in points for k, rings in shapes if inside(rings, x, y)}
    assert S.points_in_polygons(df, frame(spark, []), "uid", "poly").count() == 0


def test_cells_wholly_inside_carry_no_edges(spark):
    cover = S.cell_cover(frame(spark, [(1, [box(0.1, 0.1, 4, 4)])]), "poly")
    assert cover.where("edges is null").count() > 100
    assert cover.agg(F.max(F.size("edges"))).first()[0] <= 4


def test_touching_equals_all_pairs(spark, shapes):
    def meets(a, b):
        def side(p, q, r):
            d = (q[0] - p[0]) * (r[1] - p[1]) - (q[1] - p[1]) * (r[0] - p[0])
            return (d > 0) - (d < 0)

        edges = lambda rings: [(p, q) for r in rings for p, q in zip(r, r[1:] + r[:1], strict=True)]
        for p, q in edges(a):
            for r, s in edges(b):
                boxes = all(min(p[i], q[i]) <= max(r[i], s[i]) and max(p[i], q[i]) >= min(r[i], s[i]) for i in (0, 1))
                if boxes and side(r, s, p) * side(r, s, q) <= 0 and side(p, q, r) * side(p, q, s) <= 0:
                    return True
        return inside(b, *a[0][0]) or inside(a, *b[0][0])

    rows = shapes[:-1]
    got = {tuple(r) for r in S.touching(frame(spark, rows), "poly").collect()}
    assert got == {(a, b) for i, (a, p) in enumerate(rows) for b, q in rows[i + 1 :] if meets(p, q)}


def area(ring):
    return sum(x1 * y2 - x2 * y1 for (x1, y1), (x2, y2) in zip(ring, ring[1:] + ring[:1], strict=True)) / 2


def rings_of(rows, *by):
    out = {}
    for r in rows:
        out.setdefault(tuple(r[b] for b in by), []).append([(p["x"], p["y"]) for p in r["ring"]])
    return out


def test_dissolved_rings_hold_the_cells_they_are_made_of(spark):
    rng = random.Random(9)
    group = {(i, j): rng.randrange(3) for i in range(12) for j in range(12)}
    group |= {(i, j): 0 for i in (2, 3, 4) for j in (2, 3, 4)} | {(3, 3): 1}
    rows = [(g, [box(i, j, 1, 1) if rng.random() < 0.5 else box(i, j, 1, 1)[::-1]]) for (i, j), g in group.items()]
    found = rings_of(S.dissolve_rings(frame(spark, rows, "g"), ["g"]).collect(), "g")
    for g in range(3):
        rings = found[(g,)]
        assert sum(map(area, rings)) == sum(v == g for v in group.values())
        assert all(inside(rings, i + 0.5, j + 0.5) == (v == g) for (i, j), v in group.items())
    assert any(area(r) < 0 for rings in found.values() for r in rings)  # holes


def test_long_rings_are_ranked_in_few_rounds(spark):
    n = 5000
    ids = list(range(n))
    random.Random(1).shuffle(ids)
    follows = [(ids[k], ids[(k + 1) % n]) for k in range(n)] + [(n, n), (n + 1, n + 2), (n + 2, n + 1)]
    got = {r["id"]: (r["cycle"], r["ahead"]) for r in S.rank_cycles(spark.createDataFrame(follows, "id long, next long")).collect()}
    at = {v: k for k, v in enumerate(ids)}
    assert all(got[v] == (0, (at[0] - at[v]) % n) for v in ids)
    assert got[n] == (n, 0) and got[n + 1] == (n + 1, 0) and got[n + 2] == (n + 1, 1)


def test_overlay_of_shapes_and_dissolved_regions(spark):
    rng = random.Random(12)
    group = {(i, j): rng.randrange(2) for i in range(4) for j in range(4)}
    regions = frame(spark, [(g, [box(i, j, 1, 1)]) for (i, j), g in group.items()], "region")
    whole = S.as_polygons(S.dissolve_rings(regions, ["region"]), ["region"])
    shapes = [(0, [box(0.25, 0.5, 3, 1.75)]), (1, [star(rng, 2, 2, 17, 64)]), (2, [box(1, 1, 1, 1)]), (3, [box(-1, -1, 7, 7), box(0.5, 0.5, 2.25, 2.5)]), (4, [[(0.1, 0.2), (3.7, 1.9), (1.3, 3.6)]]), (5, [box(7, 7, 1, 1)]), (6, [box(1.2, 1.2, 0.1, 0.1)])]
    found = rings_of(S.clip(frame(spark, shapes), "poly", whole, "region").collect(), "poly", "region")
    points = [(rng.uniform(-1, 5), rng.uniform(-1, 5)) for _ in range(3000)]
    for k, rings in shapes:
        for g in (0, 1):
            cut = found.get((k, g), [])
            for x, y in points:
                want = inside(rings, x, y) and group.get((math.floor(x), math.floor(y))) == g
                assert inside(cut, x, y) == want, (k, g, x, y)
    assert sum(map(area, found[(2, group[(1, 1)])])) == 1 and not found.get((5, 0))
    parts = sum(area(r) for g in (0, 1) for r in found.get((4, g), []))
    assert abs(parts - abs(area(shapes[4][1][0]))) < 1e-6


def test_directions_follow_holes(spark):
    rings = [box(0, 0, 9, 9)[::-1], box(1, 1, 3, 3), box(2, 2, 1, 1)[::-1]]
    e = S.directed_edges(frame(spark, [(1, rings)]), ["poly"])
    assert e.agg(F.sum(F.expr("x1 * y2 - x2 * y1")) / 2).first()[0] == 81 - 9 + 1
    assert G.EARTH_FT > 0


def test_copies_of_a_polygon_are_covered_once(spark, monkeypatch):
    """Work follows different shapes; each copy still has its points, and the least name is the one a point is located in."""
    diamond = "array(array(named_struct('x', 0.0D, 'y', 1.0D), named_struct('x', 1.0D, 'y', 0.0D), named_struct('x', 2.0D, 'y', 1.0D), named_struct('x', 1.0D, 'y', 2.0D)))"
    moved = diamond.replace("'x', ", "'x', 0.5D + ")
    polygons = spark.sql(f"select id as name, {diamond} as rings from range(300) union all select 300 + id, {moved} from range(300)")
    points = spark.sql("select * from values (1L, 0.3D, 1.01D), (2L, 1.2D, 1.1D), (3L, 9.0D, 9.0D) as p(uid, x, y)")
    covered, cover = [], S.cell_cover

    def counted(polygons, name):
        covered.append(polygons.count())
        return cover(polygons, name)

    monkeypatch.setattr(S, "cell_cover", counted)
    got = {(r.uid, r.name) for r in S.points_in_polygons(points, polygons, "uid", "name").collect()}
    assert got == {(1, n) for n in range(300)} | {(2, n) for n in range(600)}
    assert {(r.uid, r.name) for r in S.locate(points, polygons, "uid", "name").collect()} == {(1, 0), (2, 0), (3, None)}
    assert covered == [2, 2]


def test_clip_cuts_polygons_of_the_same_rings_once(spark, monkeypatch):
    square = lambda x0, y0, x1, y1: [[(x0, y0), (x1, y0), (x1, y1), (x0, y1)]]
    shape = "rings array<array<struct<x: double, y: double>>>"
    a = spark.createDataFrame([(3, square(0.0, 0.0, 2.0, 2.0)), (1, square(0.0, 0.0, 2.0, 2.0)), (2, square(1.0, 1.0, 4.0, 4.0)), (4, None)], f"id long, {shape}")
    b = spark.createDataFrame([("r", square(1.0, 0.0, 3.0, 3.0)), ("s", square(1.0, 0.0, 3.0, 3.0)), ("far", square(8.0, 8.0, 9.0, 9.0))], f"region string, {shape}")
    covered, cover = [], S.cell_cover
    monkeypatch.setattr(S, "cell_cover", lambda p, name: covered.append(p.where("rings is not null").count()) or cover(p, name))
    got = sorted((r.id, r.region, round(r.area, 6)) for r in S.clip(a, "id", b, "region").collect())
    assert got == [(i, r, area) for i, area in ((1, 2.0), (2, 4.0), (3, 2.0)) for r in "rs"]
    assert covered == [2, 2]
