"""Geometry and spatial joins (inventory groups B14 to B16, D1 to D3, E15, J, M)."""

from __future__ import annotations

from pyspark.sql import functions as F

from levyframe.functions import geometry as G
from levyframe.operators import spatial as S
from levyframe.plans.fixtures import query
from levyframe.plans.inputs import county_squares, districts
from levyframe.sources.tables import materialize


@query("b14_to_wgs84", """select uid, round(case when uid % 2 = 0 then x else degrees(x * 1000 / 6378137.0) end, 6) as lon, round(case when uid % 2 = 0 then y else degrees(2 * atan(exp(y * 1000 / 6378137.0)) - pi() / 2) end,
    6) as lat from fx_parcels""")
def b14(t):
    even = F.col("uid") % 2 == 0
    lon, lat = G.to_wgs84(F.when(even, F.col("x")).otherwise(F.col("x") * 1000), F.when(even, F.col("y")).otherwise(F.col("y") * 1000), F.when(even, "EPSG:4269").otherwise("EPSG:3857"))
    return t("fx_parcels").select("uid", F.round(lon, 6).alias("lon"), F.round(lat, 6).alias("lat"))


@query("b15_points", "select poly_id, round(cx, 6) as x, round(cy, 6) as y, true as inside from fx_polys")
def b15(t):
    rows = districts(t).withColumn("c", G.centroid(F.col("rings"))).withColumn("p", G.interior_point(F.col("rings")))
    return rows.select("poly_id", F.round("c.x", 6).alias("x"), F.round("c.y", 6).alias("y"), G.contains(F.col("rings"), F.col("p.x"), F.col("p.y")).alias("inside"))


AREA = """abs(radians(1e0) * (2 + sin(radians(cast(gy as double))) + sin(radians(cast(gy as double)))) - radians(1e0) * (2 + sin(radians(gy + 1e0)) + sin(radians(gy + 1e0)))) / 2"""


@query("b16_acres", f"""select county_code, case when gx % 2 = 0 then 5e0 else round({AREA} * 6371008.8 * 6371008.8 / 4046.8564, 3) end as acres, round({AREA} * 20902231.0 * 20902231.0 / 1e6,
    2) as area from fx_counties""")
def b16(t):
    rows = county_squares(t)
    return rows.select("county_code", G.acres(F.when(F.col("gx") % 2 == 0, 5.0).otherwise(0.0), F.col("rings")[0]).alias("acres"), F.round(G.spherical_area(F.col("rings")[0]) / 1e6, 2).alias("area"))


def hav(r="20902231.0"):
    return f"2 * {r} * asin(least(1, sqrt(pow(sin((radians(y2) - radians(y1)) / 2), 2) + cos(radians(y1)) * cos(radians(y2)) * pow(sin((radians(x2) - radians(x1)) / 2), 2))))"


@query("m1_haversine", f"""select uid, round({hav()}, 2) as ft from (select uid, x as x1, y as y1, cx as x2, cy as y2
  from fx_parcels join fx_polys on poly_id = uid % 10)""")
def m1(t):
    rows = t("fx_parcels").join(F.broadcast(t("fx_polys")), F.col("poly_id") == F.col("uid") % 10)
    return rows.select("uid", F.round(G.haversine(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")), 2).alias("ft"))


@query("m1_path", f"""select uid, round(sum({hav()}), 2) as ft from (select uid, x as x1, y as y1, x + 0.01 as x2, y as y2
  from fx_parcels union all select uid, x + 0.01, y, x + 0.01, y + 0.02
  from fx_parcels) group by uid""")
def m1_path(t):
    p = lambda x, y: F.struct(x.alias("x"), y.alias("y"))
    x, y = F.col("x"), F.col("y")
    return t("fx_parcels").select("uid", F.round(G.path_length(F.array(p(x, y), p(x + 0.01, y), p(x + 0.01, y + 0.02))), 2).alias("ft"))


@query("m2_bearing", """select uid, round(((degrees(atan2(sin(radians(cx) - radians(x)) * cos(radians(cy)), cos(radians(y)) * sin(radians(cy)) - sin(radians(y)) * cos(radians(cy)) * cos(radians(cx) - radians(x)))) + 360) % 360),
    4) as deg from fx_parcels join fx_polys on poly_id = uid % 10""")
def m2(t):
    rows = t("fx_parcels").join(F.broadcast(t("fx_polys")), F.col("poly_id") == F.col("uid") % 10)
    return rows.select("uid", F.round(G.bearing(F.col("x"), F.col("y"), F.col("cx"), F.col("cy")), 4).alias("deg"))


def lots(t):
    """A lot of four sides round each parcel, two of them drawn in two segments."""
    at = lambda dx, dy: f"named_struct('x', x + {dx}D, 'y', y + {dy}D)"
    ring = ", ".join([at(0.0, 0.0), at(0.0005, 0.0), at(0.001, 0.00001), at(0.001, 0.002), at(0.0, 0.002)])
    return t.sql(f"select uid, array({ring}) as ring from fx_parcels")


def _leg(x1, y1, x2, y2):
    return hav().replace("y2", f"(y+{y2})").replace("y1", f"(y+{y1})").replace("x2", f"(x+{x2})").replace("x1", f"(x+{x1})")


@query("m4_lot_sides", f"""select uid, 4 as n_sides, round({_leg(0.0, 0.0, 0.0005, 0.0)} + {_leg(0.0005, 0.0, 0.001, 0.00001)}, 1) as front, round({_leg(0.0, 0.0, 0.0005, 0.0)} + {_leg(0.0005, 0.0, 0.001, 0.00001)} + {_leg(0.001, 0.00001, 0.001, 0.002)} + {_leg(0.001, 0.002, 0.0, 0.002)} + {_leg(0.0, 0.002, 0.0, 0.0)},
    1) as perimeter from fx_parcels""")
def m4(t):
    sides = lots(t).withColumn("sides", G.lot_sides(F.col("ring")))
    return sides.select("uid", F.size("sides").alias("n_sides"), F.round(F.col("sides")[0], 1).alias("front"), F.round(F.aggregate("sides", F.lit(0.0), lambda s, x: s + x), 1).alias("perimeter"))


IN_DISTRICT = "abs(p.x - d.cx) + abs(p.y - d.cy) < d.r"


@query("d1_locate", f"""select p.uid, min(d.poly_id) as poly_id from fx_parcels p left join fx_polys d on {IN_DISTRICT}
  group by p.uid having min(d.poly_id) is not null""")
def d1(t):
    """The outer form gives null for parcels outside all districts, counted by d1_outside."""
    return S.locate(t("fx_parcels").select("uid", "x", "y"), districts(t), "uid", "poly_id").where("poly_id is not null").select("uid", "poly_id")


@query("d1_outside", f"select count(*) as n from fx_parcels p where not exists (select 1 from fx_polys d where {IN_DISTRICT})")
def d1_outside(t):
    return S.locate(t("fx_parcels").select("uid", "x", "y"), districts(t), "uid", "poly_id").where("poly_id is null").agg(F.count("*").alias("n"))


@query("d2_inside", f"select p.uid, d.poly_id from fx_parcels p join fx_polys d on {IN_DISTRICT}")
def d2(t):
    return S.points_in_polygons(t("fx_parcels"), districts(t), "uid", "poly_id")


PAIRS = """select a.county_code as a, b.county_code as b from fx_counties a
  join fx_counties b on a.county_code < b.county_code and abs(a.gx - b.gx) <= 1 and abs(a.gy - b.gy) <= 1"""


def neighbours(t):
    return S.touching(county_squares(t), "county_code")


@query("d3_touching", PAIRS)
def d3(t):
    return neighbours(t)


@query("j5_adjacency", f"select a, b from ({PAIRS}) union all select b, a from ({PAIRS})")
def j5(t):
    return S.both_ways(neighbours(t))


@query("j4_rings", """select county_code as name, cast(greatest(abs(gx - 2), abs(gy - 2)) as int) as ring
  from fx_counties where greatest(abs(gx - 2), abs(gy - 2)) <= 4""")
def j4(t):
    return S.adjacency_rings(S.both_ways(neighbours(t)), "012", 4)


EDGES = """select region, gx as x1, gy as y1, gx + 1 as x2, gy as y2 from fx_counties
  union all select region, gx, gy + 1, gx + 1, gy + 1 from fx_counties
  union all select region, gx, gy, gx, gy + 1 from fx_counties
  union all select region, gx + 1, gy, gx + 1, gy + 1 from fx_counties"""


@query("m5_dissolve", f"""with e as ({EDGES}), o as (select region, x1, y1, x2, y2 from e
  group by all having count(*) = 1) select region, count(*) as n_edges, cast(sum(x1 + y1) as double) as s
  from o group by region""")
def m5(t):
    return S.dissolve(county_squares(t), "region").groupBy("region").agg(F.count("*").alias("n_edges"), F.sum(F.col("x1") + F.col("y1")).alias("s"))


@query("m5_rings", f"""with e as ({EDGES}), o as (select region, x1, y1, x2, y2 from e group by all having count(*) = 1),
n as (select region, count(*) as n_points from o group by region)
select c.region, n.n_points, cast(count(*) as double) as area from fx_counties c join n on n.region = c.region group by 1, 2""")
def m5_rings(t):
    """Outlines chained to rings; holes count against the area."""
    rings = S.dissolve_rings(county_squares(t), ["region"])
    return rings.groupBy("region").agg(F.sum(F.size("ring")).alias("n_points"), F.round(F.sum("area"), 9).alias("area"))


def _below(x, y):
    """SQL for the area of a diamond of radius r about the origin that lies to the left of x and below y."""

    def half(m):
        return f"(case when {m} <= 0 or {x} <= -({m}) then 0 when {x} <= 0 then ({x} + {m}) * ({x} + {m}) / 2 when {x} < {m} then ({m}) * ({m}) - ({m} - {x}) * ({m} - {x}) / 2 else ({m}) * ({m}) end)"

    return f"(case when {y} >= 0 then 2 * {half('d.r')} - {half(f'(d.r - {y})')} else {half(f'(d.r + {y})')} end)"


X0, X1, Y0, Y1 = "(c.gx - d.cx)", "(c.gx + 1 - d.cx)", "(c.gy - d.cy)", "(c.gy + 1 - d.cy)"


@query("m6_region_clip", f"""select poly_id, region, round(sum({_below(X1, Y1)} - {_below(X0, Y1)} - {_below(X1, Y0)} + {_below(X0, Y0)}), 6) as area
  from fx_polys d join fx_counties c on c.gx < d.cx + d.r and c.gx + 1 > d.cx - d.r and c.gy < d.cy + d.r and c.gy + 1 > d.cy - d.r
  group by 1, 2 having round(sum({_below(X1, Y1)} - {_below(X0, Y1)} - {_below(X1, Y0)} + {_below(X0, Y0)}), 6) > 0""")
def m6_region(t):
    """Districts cut by regions, which are dissolved from counties and are neither convex nor in one part."""
    regions = S.as_polygons(S.dissolve_rings(county_squares(t), ["region"]), ["region"])
    cut = S.clip(districts(t), "poly_id", regions, "region").groupBy("poly_id", "region").agg(F.round(F.sum("area"), 6).alias("area"))
    return cut.where("area > 0")


@query("m6_clip", """select county_code, round(greatest(0, least(gx + 1, 3.4e0) - greatest(gx, 0.7e0)) * greatest(0, least(gy + 1, 2.9e0) - greatest(gy,
    1.2e0)), 6) as area from fx_counties""")
def m6(t):
    piece = S.clip_to_box(F.col("rings")[0], 0.7, 1.2, 3.4, 2.9)
    return county_squares(t).withColumn("piece", piece).select("county_code", F.round(F.when(F.size("piece") > 2, S.planar_area(F.col("piece"))).otherwise(0.0), 6).alias("area"))


@query("m7_envelopes", """select a.poly_id as a, b.poly_id as b from fx_polys a join fx_polys b on a.poly_id < b.poly_id and a.cx - a.r - 0.1 <= b.cx + b.r and a.cx + a.r + 0.1 >= b.cx - b.r and a.cy - a.r - 0.1 <= b.cy + b.r and a.cy + a.r + 0.1 >= b.cy - b.r""")
def m7(t):
    box = districts(t).select("poly_id", *[v.alias(k) for k, v in G.envelope(F.col("rings")).items()])
    return S.envelopes_near(box, "poly_id", 0.1)
