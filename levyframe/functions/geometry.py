"""Geometry on arrays of points, as column expressions.

A ring is an array of (x, y) structs, first point not repeated; rings is an
array of rings.  Parity over the edges of all rings takes care of holes and of
several parts.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: the earth's radius in feet and metres, the web mercator radius, square metres of an acre
EARTH_FT, EARTH_M, MERCATOR_M, ACRE_M2 = 20_902_231.0, 6_371_008.8, 6_378_137.0, 4046.8564


def following(ring: Column) -> Column:
    """The ring turned by one point: what comes after each of its points."""
    return F.concat(F.slice(ring, F.lit(2), F.size(ring)), F.slice(ring, F.lit(1), F.lit(1)))


def edges(ring: Column) -> Column:
    """Array of (x1, y1, x2, y2), the last edge closing the ring."""
    return F.zip_with(ring, following(ring), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))


def all_edges(rings: Column) -> Column:
    return F.flatten(F.transform(rings, edges))


def total(array: Column, of) -> Column:
    return F.aggregate(array, F.lit(0.0), lambda s, e: s + of(e))


def to_wgs84(x: Column, y: Column, crs: Column) -> tuple[Column, Column]:
    """Longitude and latitude; geographic systems pass (NAD83 is taken as WGS84), web mercator is undone, others raise."""
    geographic, mercator = crs.isin("EPSG:4326", "EPSG:4269"), crs.isin("EPSG:3857", "EPSG:102100")
    wrong = F.raise_error(F.concat(F.lit("unknown CRS "), crs))
    lon = F.when(geographic, x).when(mercator, F.degrees(x / MERCATOR_M)).otherwise(wrong.cast("double"))
    lat = F.when(geographic, y).when(mercator, F.degrees(2 * F.atan(F.exp(y / MERCATOR_M)) - F.pi() / 2)).otherwise(wrong.cast("double"))
    return lon, lat


def centroid(rings: Column) -> Column:
    """Area-weighted (x, y) of all rings."""
    cross = lambda e: e["x1"] * e["y2"] - e["x2"] * e["y1"]
    every = all_edges(rings)
    area = total(every, cross)
    return F.struct((total(every, lambda e: (e["x1"] + e["x2"]) * cross(e)) / (3 * area)).alias("x"), (total(every, lambda e: (e["y1"] + e["y2"]) * cross(e)) / (3 * area)).alias("y"))


def crossings(rings: Column, y: Column) -> Column:
    """Sorted x where the edges cross the line at y."""
    hit = F.filter(all_edges(rings), lambda e: (e["y1"] > y) != (e["y2"] > y))
    return F.array_sort(F.transform(hit, lambda e: e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])))


def interior_point(rings: Column) -> Column:
    """A point inside: the middle of the widest stretch inside, of those on a line through each ring.

    The lines are moved off the rings' middles a little, so that they miss the corners of regular shapes.
    """

    def height(ring: Column) -> Column:
        ys = F.transform(ring, lambda p: p["y"])
        return F.array_min(ys) + (F.array_max(ys) - F.array_min(ys)) * 0.5000123

    def stretches(y: Column) -> Column:
        xs = crossings(rings, y)
        pairs = F.sequence(F.lit(1), F.greatest(F.lit(1), (F.size(xs) / 2).cast("int")))
        return F.transform(pairs, lambda k: F.struct((F.get(xs, 2 * k - 1) - F.get(xs, 2 * k - 2)).alias("width"), ((F.get(xs, 2 * k - 1) + F.get(xs, 2 * k - 2)) / 2).alias("x"), y.alias("y")))

    widest = F.array_max(F.flatten(F.transform(F.transform(rings, height), stretches)))
    return F.struct(widest["x"].alias("x"), widest["y"].alias("y"))


def crosses_oddly(sides: Column, x: Column, y: Column) -> Column:
    """Whether a ray from a point to the right crosses an odd number of edges."""

    def crossed(n: Column, e: Column) -> Column:
        across = ((e["y1"] > y) != (e["y2"] > y)) & (x < e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"]))
        return n + across.cast("int")

    return F.aggregate(sides, F.lit(0), crossed) % 2 == 1


def contains(rings: Column, x: Column, y: Column) -> Column:
    """Whether a point is inside: parity of the edges that a ray to the right crosses.  On an edge it is undefined."""
    return crosses_oddly(all_edges(rings), x, y)


def envelope(rings: Column) -> dict[str, Column]:
    points = F.flatten(rings)
    xs, ys = F.transform(points, lambda p: p["x"]), F.transform(points, lambda p: p["y"])
    return {"x0": F.array_min(xs), "y0": F.array_min(ys), "x1": F.array_max(xs), "y1": F.array_max(ys)}


def overlap(a: str, b: str, margin: float = 0.0) -> Column:
    """Whether the envelopes of two aliased sides touch, the first widened by a margin."""
    return (F.col(f"{a}.x0") - margin <= F.col(f"{b}.x1")) & (F.col(f"{a}.x1") + margin >= F.col(f"{b}.x0")) & (F.col(f"{a}.y0") - margin <= F.col(f"{b}.y1")) & (F.col(f"{a}.y1") + margin >= F.col(f"{b}.y0"))


def haversine(lon1: Column, lat1: Column, lon2: Column, lat2: Column, radius: float = EARTH_FT) -> Column:
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin((F.radians(lon2) - F.radians(lon1)) / 2), 2)
    return 2 * radius * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def bearing(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Degrees from north, 0 to 360."""
    a, b, d = F.radians(lat1), F.radians(lat2), F.radians(lon2) - F.radians(lon1)
    turn = F.degrees(F.atan2(F.sin(d) * F.cos(b), F.cos(a) * F.sin(b) - F.sin(a) * F.cos(b) * F.cos(d)))
    return F.pmod(turn + 360, F.lit(360.0))


def spherical_area(ring: Column, radius: float = EARTH_FT) -> Column:
    """Area of a ring of degrees on the sphere, in the radius's unit squared."""
    part = lambda e: (F.radians(e["x2"]) - F.radians(e["x1"])) * (2 + F.sin(F.radians(e["y1"])) + F.sin(F.radians(e["y2"])))
    return F.abs(total(edges(ring), part)) * radius * radius / 2


def acres(recorded: Column, ring: Column) -> Column:
    """The recorded area if there is one, else that of the ring."""
    return F.round(F.when(recorded > 0, recorded).otherwise(spherical_area(ring, EARTH_M) / ACRE_M2), 3)


def path_length(points: Column) -> Column:
    """Feet along an array of points, not closed."""
    n = F.size(points)
    legs = F.zip_with(F.slice(points, F.lit(1), F.greatest(n - 1, F.lit(0))), F.slice(points, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda a, b: haversine(a["x"], a["y"], b["x"], b["y"]))
    return total(legs, lambda x: x)


def lot_sides(ring: Column, turn: float = 12.0, least: float = 3.0) -> Column:
    """Lengths in feet of a lot's straight sides.

    Segments that turn by less than `turn` degrees from the one before belong to
    one side, the last side to the first too; sides of up to `least` feet go.
    Null for rings of fewer than 3 or more than 400 points.
    """
    segments = F.transform(edges(ring), lambda e: F.struct(haversine(e["x1"], e["y1"], e["x2"], e["y2"]).alias("ft"), bearing(e["x1"], e["y1"], e["x2"], e["y2"]).alias("deg")))
    apart = lambda a, b: F.least(F.pmod(a - b, F.lit(360.0)), F.pmod(b - a, F.lit(360.0)))
    one = lambda ft, head, tail: F.array(F.struct(ft.alias("ft"), head.alias("head"), tail.alias("tail")))

    # sides is a lambda's variable throughout: an expression that is named twice is worked out twice
    def add(sides: Column, s: Column) -> Column:
        last = F.get(sides, F.size(sides) - 1)
        rest = F.slice(sides, F.lit(1), F.greatest(F.size(sides) - 1, F.lit(0)))
        return F.when(apart(last["tail"], s["deg"]) < turn, F.concat(rest, one(last["ft"] + s["ft"], last["head"], s["deg"]))).otherwise(F.concat(sides, one(s["ft"], s["deg"], s["deg"])))

    def close(sides: Column) -> Column:
        a, z = F.get(sides, 0), F.get(sides, F.size(sides) - 1)
        return F.when((F.size(sides) > 1) & (apart(z["tail"], a["head"]) < turn), F.concat(one(z["ft"] + a["ft"], z["head"], a["tail"]), F.slice(sides, F.lit(2), F.size(sides) - 2))).otherwise(sides)

    none = F.array().cast("array<struct<ft: double, head: double, tail: double>>")
    lengths = F.filter(F.transform(F.aggregate(segments, none, add, close), lambda s: s["ft"]), lambda ft: ft > least)
    return F.when(F.size(ring).between(3, 400), lengths)
