"""Joins of points and polygons by grid cells, adjacency, and overlays of polygon layers.

Whatever meets does so through an equi-join on cells.  A polygon is covered by
cells as large as its own size suggests: cells wholly inside need no further
test, border cells carry only the edges that cross them.  The cells' sizes
change the work, never the result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from levyframe.functions.geometry import all_edges, crosses_oddly, edges, envelope, overlap
from levyframe.operators.tables import with_long
from levyframe.sources.tables import materialize

#: A cover is broadcast only if it was counted and has at most so many cells (some MB).
BROADCAST_CELLS = 100_000
#: A polygon is so many cells wide, by the number of its points.
LEAST_ACROSS, MOST_ACROSS = 16, 256
#: Cells are widened by this part of their size where edges are dealt to them, so that rounding loses none.
MARGIN = 1e-6
#: Where an outline stands for so many polygons or more, on average, these are met as lists of at most so many.
ALIKE, LIST = 8, 4096
#: Decimals that overlays keep of coordinates.
PLACES = 9


def _down(value: Column, size: Column) -> Column:
    return F.floor(value / size)


def _x_at(e: Column, y: Column) -> Column:
    """Where an edge that is not level is at a height, between its ends."""
    at = e["x1"] + (y - e["y1"]) / (e["y2"] - e["y1"]) * (e["x2"] - e["x1"])
    return F.least(F.greatest(at, F.least(e["x1"], e["x2"])), F.greatest(e["x1"], e["x2"]))


def edge_cells(e: Column, size: Column) -> Column:
    """Array of the (i, j) of cells that an edge passes, row by row; with a margin, so a few more."""
    low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
    pad = size * MARGIN

    def row(j: Column) -> Column:
        held = lambda y: F.least(F.greatest(y, low), high)
        p, q = held(j * size - pad), held((j + 1) * size + pad)
        a = F.when(e["y1"] == e["y2"], e["x1"]).otherwise(_x_at(e, p))
        b = F.when(e["y1"] == e["y2"], e["x2"]).otherwise(_x_at(e, q))
        return F.transform(F.sequence(_down(F.least(a, b) - pad, size), _down(F.greatest(a, b) + pad, size)), lambda i: F.struct(i.alias("i"), j.alias("j")))

    return F.flatten(F.transform(F.sequence(_down(low - pad, size), _down(high + pad, size)), row))


def _power(value: Column) -> Column:
    """The power of two that is next above."""
    return F.when(value > 0, F.pow(F.lit(2.0), F.ceil(F.log2(value)))).otherwise(1.0)


def cell_cover(polygons: DataFrame, name: str) -> DataFrame:
    """(name, size, i, j, odd, edges): the cells that cover each polygon (name, rings).

    edges is null for a cell wholly inside.  For a border cell it has the edges
    that pass it, and odd says whether a ray to the right from the middle of its
    right side crosses an odd number of edges.
    """
    box = envelope(F.col("rings"))
    side = F.greatest(box["x1"] - box["x0"], box["y1"] - box["y0"])
    points = F.size(F.flatten("rings"))
    sized = polygons.select(name, all_edges(F.col("rings")).alias("all"), _power(side / F.least(F.greatest(points, F.lit(LEAST_ACROSS)), F.lit(MOST_ACROSS))).alias("size"))
    e = sized.select(name, "size", F.explode("all").alias("e"))
    border = e.select(name, "size", "e", F.explode(edge_cells(F.col("e"), F.col("size"))).alias("c")).groupBy(name, "size", "c.i", "c.j").agg(F.collect_list("e").alias("edges"))
    border = materialize(border)
    # where the edges cross the middle line of each row of cells
    rows = e.select(name, "size", "e", F.explode(F.sequence(_down(F.least("e.y1", "e.y2"), F.col("size")), _down(F.greatest("e.y1", "e.y2"), F.col("size")))).alias("j"))
    middle = (F.col("j") + 0.5) * F.col("size")
    rows = rows.where((F.col("e.y1") > middle) != (F.col("e.y2") > middle)).select(name, "size", "j", _x_at(F.col("e"), middle).alias("x"))
    lines = materialize(rows.groupBy(name, "size", "j").agg(F.array_sort(F.collect_list("x")).alias("xs")))
    odd = F.size(F.filter("xs", lambda x: x > (F.col("i") + 1) * F.col("size"))) % 2 == 1
    spans = lines.select(name, "size", "j", "xs", F.explode(F.sequence(_down(F.get("xs", 0), F.col("size")), _down(F.element_at("xs", -1), F.col("size")))).alias("i"))
    within = spans.where(odd).join(border.select(name, "size", "i", "j"), [name, "size", "i", "j"], "left_anti")
    within = within.select(name, "size", "i", "j", F.lit(True).alias("odd"), F.lit(None).cast(border.schema["edges"].dataType).alias("edges"))
    return within.unionByName(border.join(lines, [name, "size", "j"], "left").select(name, "size", "i", "j", F.coalesce(odd, F.lit(False)).alias("odd"), "edges"))


def _inside_cell() -> Column:
    """Whether (x, y) is inside, for a point beside the cell of a cover that it is in.

    The way goes right to the cell's side and along it to its middle, and counts the edges it crosses.
    """
    x, y = F.col("x"), F.col("y")
    right, middle = (F.col("i") + 1) * F.col("size"), (F.col("j") + 0.5) * F.col("size")

    def crossed(n: Column, e: Column) -> Column:
        low, high = F.least(e["y1"], e["y2"]), F.greatest(e["y1"], e["y2"])
        rising = F.when(e["x1"] > right, e["y1"] > e["y2"]).otherwise(e["y2"] > e["y1"])
        # where the edge passes the side is told by the same numbers as whether it is beyond it at a height, so the two agree
        beyond = lambda h: F.when((low <= h) & (h < high), _x_at(e, h) > right).otherwise(F.when(rising, h >= high).otherwise(h < low))
        level = F.when((low <= y) & (y < high), (x < _x_at(e, y)) & (_x_at(e, y) <= right)).otherwise(False)
        passed = F.when((e["x1"] > right) != (e["x2"] > right), beyond(y) != beyond(middle)).otherwise(False)
        return n + level.cast("int") + passed.cast("int")

    count = F.aggregate("edges", F.col("odd").cast("int"), crossed)
    return F.col("edges").isNull() | (count % 2 == 1)


def points_in_cover(points: DataFrame, cover: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name) for each covered polygon that a point is in; points: key, x, y.  A point looks up one cell of each size there is."""
    sizes = [r["size"] for r in cover.select("size").distinct().orderBy("size").collect()]  # powers of two, so a few dozen at most
    if not sizes:
        return points.select(key).join(cover.select(name), F.lit(False))
    here = F.array(*[F.struct(F.lit(s).alias("size"), _down(F.col("x"), F.lit(s)).alias("i"), _down(F.col("y"), F.lit(s)).alias("j")) for s in sizes])
    asked = points.select(key, "x", "y", F.explode(here).alias("c")).select(key, "x", "y", "c.size", "c.i", "c.j")
    few = cover.limit(BROADCAST_CELLS + 1).count() <= BROADCAST_CELLS
    return asked.join(F.broadcast(cover) if few else cover, ["size", "i", "j"]).where(_inside_cell()).select(key, name)


def shapes(polygons: DataFrame, name: str) -> DataFrame:
    """(name, rings): of polygons with the same rings the one of least name, which stands for them all."""
    return polygons.groupBy("rings").agg(F.min(name).alias(name)).select(name, "rings")


def points_in_polygons(points: DataFrame, polygons: DataFrame, key: str, name: str) -> DataFrame:
    """(key, name) for each polygon that a point is in.

    points: key, x, y, one row a key, computed beforehand.  polygons: name, rings, one row a name.
    Polygons of the same rings are covered and met once, and told apart at the end.
    Where there are many of one outline, its points come side by side, each with
    all polygons in the same order, which Parquet packs to a fraction.
    """
    polygons = materialize(polygons.select(name, "rings"))
    one = materialize(shapes(polygons, name))
    stands = one.select(F.col(name).alias("__shape"), "rings")
    members = materialize(polygons.join(stands, "rings").select("__shape", name))
    found = points_in_cover(points, materialize(cell_cover(one, name)), key, name).withColumnRenamed(name, "__shape")
    if members.count() < ALIKE * one.count():
        return found.join(members, "__shape").select(key, name)
    found = materialize(found)
    part = F.pmod(F.xxhash64(name), F.ceil(F.col("__many") / LIST))
    lists = members.join(members.groupBy("__shape").agg(F.count("*").alias("__many")), "__shape").groupBy("__shape", part.alias("__part")).agg(F.collect_list(F.struct(name)).alias("__of")).drop("__part")
    lists = lists.join(found.groupBy("__shape").agg(F.count("*").alias("n")), "__shape")
    return with_long(found, lists, ["__shape"], 16 * F.size("__of"), F.xxhash64(key)).select(key, F.inline("__of"))


def locate(points: DataFrame, polygons: DataFrame, key: str, name: str) -> DataFrame:
    """points with the polygon that each is in, the least name of several, null outside all."""
    cover = materialize(cell_cover(materialize(shapes(polygons, name)), name))
    found = points_in_cover(points, cover, key, name).groupBy(key).agg(F.min(name).alias(name))
    return points.join(found, key, "left")


def edges_that_may_meet(a: DataFrame, b: DataFrame) -> DataFrame:
    """Pairs (p, q) of rows of a and b, structs with x1, y1, x2, y2, whose edges share a cell; each pair may come several times.

    Each edge has cells of about its own size, and also goes to the cells of all
    larger sizes that edges of the other side have.  So long edges don't pass
    through many small cells, and a cell in which short edges crowd pairs them
    only with edges that are no shorter.
    """
    size = _power(F.greatest(F.abs(F.col("e.x2") - F.col("e.x1")), F.abs(F.col("e.y2") - F.col("e.y1")))).alias("size")
    own = lambda df, what: materialize(df.select(F.struct(*df.columns).alias("e")).select("e", size)).withColumnRenamed("e", what)
    p, q = own(a, "p"), own(b, "q")

    def half(small: DataFrame, s: str, large: DataFrame, g: str, equal: bool) -> DataFrame:
        sizes = F.array(*[F.lit(r["size"]) for r in large.select("size").distinct().orderBy("size").collect()]).cast("array<double>")
        up = small.select(s, F.explode(F.filter(sizes, lambda z: (z >= F.col("size")) if equal else (z > F.col("size")))).alias("size"))
        cells = lambda df, what: df.select(what, "size", F.explode(edge_cells(F.col(what), F.col("size"))).alias("c")).select(what, "size", "c.i", "c.j")
        return cells(up, s).join(cells(large, g), ["size", "i", "j"]).select("p", "q")

    return half(p, "p", q, "q", True).unionByName(half(q, "q", p, "p", False))


def _side(ax, ay, bx, by, px, py) -> Column:
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def _edges_touch(p: Column, q: Column) -> Column:
    side = lambda *v: F.signum(_side(*v))
    d1 = side(q["x1"], q["y1"], q["x2"], q["y2"], p["x1"], p["y1"])
    d2 = side(q["x1"], q["y1"], q["x2"], q["y2"], p["x2"], p["y2"])
    d3 = side(p["x1"], p["y1"], p["x2"], p["y2"], q["x1"], q["y1"])
    d4 = side(p["x1"], p["y1"], p["x2"], p["y2"], q["x2"], q["y2"])
    boxes = (F.least(p["x1"], p["x2"]) <= F.greatest(q["x1"], q["x2"])) & (F.greatest(p["x1"], p["x2"]) >= F.least(q["x1"], q["x2"])) & (F.least(p["y1"], p["y2"]) <= F.greatest(q["y1"], q["y2"])) & (F.greatest(p["y1"], p["y2"]) >= F.least(q["y1"], q["y2"]))
    return boxes & (d1 * d2 <= 0) & (d3 * d4 <= 0)


def touching(polygons: DataFrame, name: str) -> DataFrame:
    """Unordered pairs a < b of polygons that share a point, corners included.

    Shared corners are found by equality, edges that cross or touch by cells, and
    polygons within others by a corner of theirs.
    """
    polygons = materialize(polygons.select(name, "rings"))
    e = polygons.select(F.col(name).alias("n"), F.explode(all_edges(F.col("rings"))).alias("e")).select("n", "e.x1", "e.y1", "e.x2", "e.y2")
    corners = e.select("n", F.col("x1").alias("x"), F.col("y1").alias("y")).distinct()
    pair = lambda m, n: (F.least(m, n).alias("a"), F.greatest(m, n).alias("b"))
    shared = corners.join(corners.withColumnRenamed("n", "m"), ["x", "y"]).where("m < n").select(*pair("m", "n"))
    met = edges_that_may_meet(e, e).where((F.col("p.n") != F.col("q.n")) & _edges_touch(F.col("p"), F.col("q"))).select(*pair("p.n", "q.n"))
    first = polygons.select(F.col(name).alias("m"), F.col("rings")[0][0]["x"].alias("x"), F.col("rings")[0][0]["y"].alias("y"))
    within = points_in_polygons(first, polygons.withColumnRenamed(name, "n"), "m", "n").where("m <> n").select(*pair("m", "n"))
    return shared.distinct().unionByName(met.distinct()).unionByName(within).distinct()


def envelopes_near(boxes: DataFrame, name: str, margin: float) -> DataFrame:
    """Pairs a < b of (name, x0, y0, x1, y1) whose envelopes touch, a's widened by a margin.

    Equal envelopes are met once: different ones meet by cells as large as the
    largest is, and pairs of names are made of those that do.
    """
    corners = ["x0", "y0", "x1", "y1"]
    boxes = materialize(boxes.select(name, *corners))
    one = materialize(boxes.groupBy(*corners).agg(F.min(name).alias("__box")))
    members = materialize(boxes.join(one, corners).select("__box", name))
    side = one.agg(F.max(F.greatest(F.col("x1") - F.col("x0"), F.col("y1") - F.col("y0")))).first()[0]
    size = F.lit(float((side or 0.0) + 2 * abs(margin)) or 1.0)
    wide = margin * (1 + MARGIN) + MARGIN
    # every pair whose widened envelopes touch shares a cell; the exact test is on the corners as given
    span = lambda low, high, pad: F.sequence(_down(F.col(low) - pad, size), _down(F.col(high) + pad, size))
    cells = lambda df, pad: df.select(F.struct("__box", *corners).alias("e"), F.explode(span("x0", "x1", pad)).alias("i"), span("y0", "y1", pad).alias("js")).select("e", "i", F.explode("js").alias("j"))
    p, q = cells(one, wide).withColumnRenamed("e", "a"), cells(one, 0.0).withColumnRenamed("e", "b")
    met = materialize(p.join(q, ["i", "j"]).where(overlap("a", "b", margin)).select(F.col("a.__box").alias("__p"), F.col("b.__box").alias("__q")).distinct())
    m = lambda key, to: members.select(F.col("__box").alias(key), F.col(name).alias(to))
    # dealt out by name before the pairs are made
    return met.join(m("__p", "a"), "__p").select("a", "__q").repartition("a").join(m("__q", "b"), "__q").where("a < b").select("a", "b")


def both_ways(pairs: DataFrame) -> DataFrame:
    """The directed edges of undirected pairs."""
    return pairs.select("a", "b").unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))


def adjacency_rings(edges_both: DataFrame, seed: str, depth: int = 4) -> DataFrame:
    """(name, ring): how many borders lie between the seed and each name, up to `depth`."""
    spark = edges_both.sparkSession
    edges_both = materialize(edges_both)
    known = spark.createDataFrame([(seed, 0)], "name string, ring int")
    for ring in range(1, depth + 1):
        last = known.where(F.col("ring") == ring - 1).select(F.col("name").alias("a"))
        new = edges_both.join(last, "a").select(F.col("b").alias("name")).distinct().join(known, "name", "left_anti")
        known = materialize(known.unionByName(new.withColumn("ring", F.lit(ring))))
    return known


def dissolve(polygons: DataFrame, by: str) -> DataFrame:
    """Edges of each group's outline: what two polygons share cancels.  For layers whose borders match corner by corner."""
    e = polygons.select(by, F.explode(all_edges(F.col("rings"))).alias("e")).select(by, "e.x1", "e.y1", "e.x2", "e.y2")
    turned = F.when((F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") <= F.col("y2"))), False).otherwise(True)
    put = lambda a, b: F.when(turned, F.col(b)).otherwise(F.col(a))
    same = e.select(by, put("x1", "x2").alias("x1"), put("y1", "y2").alias("y1"), put("x2", "x1").alias("x2"), put("y2", "y1").alias("y2"))
    return same.groupBy(by, "x1", "y1", "x2", "y2").count().where("count = 1").drop("count")


def clip_to_box(ring: Column, x0: float, y0: float, x1: float, y1: float) -> Column:
    """The part of a ring inside a box, cut side by side; exact for convex rings."""
    sides = [("x", x0, 1), ("x", x1, -1), ("y", y0, 1), ("y", y1, -1)]

    def cut(points: Column, side: tuple[str, float, int]) -> Column:
        axis, at, sign = side
        inside = lambda v: sign * v >= sign * at
        point = lambda x, y: F.struct(x.alias("x"), y.alias("y"))

        def part(e: Column) -> Column:
            a, b = e[f"{axis}1"], e[f"{axis}2"]
            t = (at - a) / (b - a)
            meet = point(e["x1"] + t * (e["x2"] - e["x1"]), e["y1"] + t * (e["y2"] - e["y1"]))
            end = point(e["x2"], e["y2"])
            nothing = F.slice(F.array(end), F.lit(1), F.lit(0))
            return F.when(inside(a) & inside(b), F.array(end)).when(inside(b), F.array(meet, end)).when(inside(a), F.array(meet)).otherwise(nothing)

        return F.flatten(F.transform(edges(points), part))

    return reduce(cut, sides, ring)


def planar_area(ring: Column) -> Column:
    return F.abs(F.aggregate(edges(ring), F.lit(0.0), lambda s, e: s + e["x1"] * e["y2"] - e["x2"] * e["y1"])) / 2


def directed_edges(polygons: DataFrame, by: list[str]) -> DataFrame:
    """(by, x1, y1, x2, y2): the edges of polygons (by, rings), turned so that the inside is to the left, whichever way rings were drawn."""
    area = lambda r: F.aggregate(edges(r), F.lit(0.0), lambda s, e: s + e["x1"] * e["y2"] - e["x2"] * e["y1"])

    def turned(ring: Column, k: Column) -> Column:
        # the middle of a side, as corners may lie on other rings
        x, y = (ring[0]["x"] + ring[1]["x"]) / 2, (ring[0]["y"] + ring[1]["y"]) / 2
        others = F.filter(F.col("rings"), lambda r, m: (m != k) & crosses_oddly(edges(r), x, y))
        return F.when((area(ring) > 0) == (F.size(others) % 2 == 0), ring).otherwise(F.reverse(ring))

    e = polygons.select(*by, F.explode(all_edges(F.transform(F.col("rings"), turned))).alias("e"))
    return e.select(*by, "e.x1", "e.y1", "e.x2", "e.y2").where("x1 <> x2 or y1 <> y2")


def outline(directed: DataFrame, by: list[str]) -> DataFrame:
    """Directed edges without those that another of the same group runs along the other way."""
    forth = (F.col("x1") < F.col("x2")) | ((F.col("x1") == F.col("x2")) & (F.col("y1") < F.col("y2")))
    put = lambda a, b, to: F.when(forth, F.col(a)).otherwise(F.col(b)).alias(to)
    same = directed.select(*by, put("x1", "x2", "ax"), put("y1", "y2", "ay"), put("x2", "x1", "bx"), put("y2", "y1", "by_"), F.when(forth, 1).otherwise(-1).alias("way"))
    left = same.groupBy(*by, "ax", "ay", "bx", "by_").agg(F.sum("way").alias("way")).where("way <> 0")
    on = F.col("way") > 0
    pick = lambda a, b, to: F.when(on, F.col(a)).otherwise(F.col(b)).alias(to)
    return left.select(*by, pick("ax", "bx", "x1"), pick("ay", "by_", "y1"), pick("bx", "ax", "x2"), pick("by_", "ay", "y2"))


def rank_cycles(follows: DataFrame) -> DataFrame:
    """(id, next), each id followed by one -> (id, cycle, ahead): the smallest id of its cycle, and how many steps ahead that is.

    Pointers double each round, so a cycle of n ids takes about log n joins.
    """
    known = materialize(follows.select("id", F.col("next").alias("hop"), F.col("id").alias("cycle"), F.lit(0).cast("long").alias("ahead")))
    step = 1
    while True:
        far = known.select(F.col("id").alias("hop"), F.col("hop").alias("hop2"), F.col("cycle").alias("cycle2"), F.col("ahead").alias("ahead2"))
        nearer = F.col("cycle2") < F.col("cycle")
        both = known.join(far, "hop").select("id", F.col("hop2").alias("hop"), F.least("cycle", "cycle2").alias("cycle"), F.when(nearer, F.col("ahead2") + step).otherwise(F.col("ahead")).alias("ahead"), nearer.alias("moved"))
        both = materialize(both)
        if not both.where("moved").limit(1).count():
            return known.select("id", "cycle", "ahead")
        known, step = both.drop("moved"), 2 * step


def chain_rings(directed: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, area): directed edges with the inside to the left, chained to rings; area is negative for holes.

    Where several rings meet in a point, each edge goes on with the one most to
    the left, so parts that only touch there become rings of their own; a hole
    that touches its outline in a point is one ring with it.  Edges
    are followed by list ranking, however long a ring is; a ring is one row.
    """
    e = materialize(directed.select(F.monotonically_increasing_id().alias("id"), *by, "x1", "y1", "x2", "y2"))
    into = e.select(*by, F.col("x2").alias("x"), F.col("y2").alias("y"), "id", F.atan2(F.col("y1") - F.col("y2"), F.col("x1") - F.col("x2")).alias("back"))
    out = e.select(*by, F.col("x1").alias("x"), F.col("y1").alias("y"), F.col("id").alias("next"), F.atan2(F.col("y2") - F.col("y1"), F.col("x2") - F.col("x1")).alias("on"))
    turn = F.pmod(F.col("back") - F.col("on"), F.lit(2) * F.pi())
    turn = F.when(turn < 1e-12, F.lit(2) * F.pi()).otherwise(turn)
    follows = into.join(out, [*by, "x", "y"]).groupBy("id").agg(F.min_by("next", F.struct(turn.alias("t"), "next")).alias("next"))
    ranked = rank_cycles(follows)
    point = F.struct((F.col("ahead") > 0).alias("later"), (-F.col("ahead")).alias("at"), F.col("x1").alias("x"), F.col("y1").alias("y"))
    rings = e.join(ranked, "id").groupBy(*by, "cycle").agg(F.sort_array(F.collect_list(point)).alias("points"))
    rings = rings.select(*by, F.transform("points", lambda p: F.struct(p["x"].alias("x"), p["y"].alias("y"))).alias("ring"))
    # about the first point, so that large coordinates cost no places
    x0, y0 = F.col("ring")[0]["x"], F.col("ring")[0]["y"]
    area = F.aggregate(edges(F.col("ring")), F.lit(0.0), lambda s, p: s + (p["x1"] - x0) * (p["y2"] - y0) - (p["x2"] - x0) * (p["y1"] - y0)) / 2
    return rings.withColumn("area", area)


def dissolve_rings(polygons: DataFrame, by: list[str]) -> DataFrame:
    """(by, ring, area): the outlines of groups of polygons (by, rings) that don't overlap and whose shared borders match corner by corner."""
    return chain_rings(outline(directed_edges(polygons, by), by), by)


def as_polygons(rings: DataFrame, by: list[str]) -> DataFrame:
    """(by, rings) of (by, ring): all rings of a group as one polygon."""
    return rings.groupBy(*by).agg(F.collect_list("ring").alias("rings"))


def _snapped(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.round(c, PLACES) for c in ("x1", "y1", "x2", "y2")}).where("x1 <> x2 or y1 <> y2")


def _meeting_points(p: Column, q: Column) -> Column:
    """Points at which p is to be split for q: where they cross, or q's ends that lie on it."""
    px, py, qx, qy = p["x2"] - p["x1"], p["y2"] - p["y1"], q["x2"] - q["x1"], q["y2"] - q["y1"]
    cross = px * qy - py * qx
    near = 10.0**-PLACES
    point = lambda x, y: F.struct(F.round(x, PLACES).alias("x"), F.round(y, PLACES).alias("y"))
    length = F.sqrt(px * px + py * py)

    def on(x: Column, y: Column) -> Column:
        along = ((x - p["x1"]) * px + (y - p["y1"]) * py) / length
        return (F.abs(_side(p["x1"], p["y1"], p["x2"], p["y2"], x, y)) / length <= near) & (along >= -near) & (along <= length + near)

    ends = F.array(F.when(on(q["x1"], q["y1"]), point(q["x1"], q["y1"])), F.when(on(q["x2"], q["y2"]), point(q["x2"], q["y2"])))
    t = ((q["x1"] - p["x1"]) * qy - (q["y1"] - p["y1"]) * qx) / cross
    u = ((q["x1"] - p["x1"]) * py - (q["y1"] - p["y1"]) * px) / cross
    # the point is computed along p and q alike: the same numbers on both sides, whichever is split
    crossing = F.when((t >= 0) & (t <= 1) & (u >= 0) & (u <= 1), point(p["x1"] + t * px, p["y1"] + t * py))
    parallel = F.abs(cross) <= 1e-15 * length * F.sqrt(qx * qx + qy * qy)
    return F.when(parallel, ends).otherwise(F.concat(ends, F.array(F.when(F.size(F.filter(ends, lambda z: z.isNotNull())) == 0, crossing))))


def _split(e: DataFrame, points: DataFrame) -> DataFrame:
    """(of, other, x1, y1, x2, y2): directed edges (id, of, ..) cut for each other polygon at points (id, other, at: array of x, y); pieces keep the direction."""
    cut = e.join(points.groupBy("id", "other").agg(F.array_distinct(F.flatten(F.collect_list("at"))).alias("at")), "id")
    along = lambda z: (z["x"] - F.col("x1")) * (F.col("x2") - F.col("x1")) + (z["y"] - F.col("y1")) * (F.col("y2") - F.col("y1"))
    own = F.array(F.struct(F.col("x1").alias("x"), F.col("y1").alias("y")), F.struct(F.col("x2").alias("x"), F.col("y2").alias("y")))
    order = F.array_sort(F.transform(F.array_distinct(F.concat(own, "at")), lambda z: F.struct(along(z).alias("t"), z["x"].alias("x"), z["y"].alias("y"))))
    cut = cut.select("of", "other", order.alias("z"))
    n = F.size("z")
    pieces = F.zip_with(F.slice("z", F.lit(1), n - 1), F.slice("z", F.lit(2), n - 1), lambda a, b: F.struct(a["x"].alias("x1"), a["y"].alias("y1"), b["x"].alias("x2"), b["y"].alias("y2")))
    return cut.select("of", "other", F.explode(pieces).alias("e")).select("of", "other", "e.x1", "e.y1", "e.x2", "e.y2").where("x1 <> x2 or y1 <> y2")


SHAPE = ("x1", "y1", "x2", "y2")


def _kept_inside(e: DataFrame, pieces: DataFrame, cover: DataFrame, met: DataFrame, along: DataFrame) -> DataFrame:
    """(of, other, ..): pieces whose middle lies in the other polygon they were cut for, and whole edges that met none of its edges but lie in it."""
    middle = [((F.col("x1") + F.col("x2")) / 2).alias("x"), ((F.col("y1") + F.col("y2")) / 2).alias("y")]
    open_ = pieces.join(along, ["of", "other", *SHAPE], "left_anti")
    within = points_in_cover(open_.select(F.struct("of", "other", *SHAPE).alias("e"), *middle), cover, "e", "name").where(F.col("e.other") == F.col("name")).select("e.*")
    whole = points_in_cover(e.select(F.struct("id", "of", *SHAPE).alias("e"), *middle), cover, "e", "name").select("e.id", F.col("name").alias("other"), "e.of", *[f"e.{c}" for c in SHAPE])
    return within.unionByName(whole.join(met.select("id", "other").distinct(), ["id", "other"], "left_anti").drop("id"))


def clip(polygons: DataFrame, name: str, regions: DataFrame, region: str) -> DataFrame:
    """(name, region, ring, area): what each polygon (name, rings) and each region (region, rings) have in common, as rings; area is negative for holes.

    Neither need be convex, or in one part.  Edges of both are split where they
    meet, which they do by cells; pieces of one that lie inside the other stay,
    of pieces that run along each other one stays if both have the same side
    inside; what stays is chained.  Coordinates are rounded to PLACES decimals.
    Polygons of the same rings are cut once, and told apart at the end.
    """
    sides, covers, members = [], [], []
    for df, key in ((polygons, name), (regions, region)):
        each = materialize(df.select(F.col(key).alias("of"), "rings"))
        df = materialize(shapes(each, "of"))
        members.append(materialize(each.join(df.withColumnRenamed("of", "shape"), "rings").select("shape", "of")))
        e = _snapped(directed_edges(df, ["of"]))
        sides.append(materialize(e.select(F.monotonically_increasing_id().alias("id"), "of", *SHAPE)))
        covers.append(materialize(cell_cover(df.withColumnRenamed("of", "name"), "name")))
    a, b = sides
    met = materialize(edges_that_may_meet(a, b).distinct())
    p, q = F.col("p"), F.col("q")
    some = lambda z: F.filter(z, lambda x: x.isNotNull())
    # a crossing is computed once, along p, and cuts both; where an end of one lies on the other, only that one is cut
    on_p, on_q = some(_meeting_points(p, q)), some(_meeting_points(q, p))
    ends_of_q = F.array(*[F.struct(F.col(f"q.x{k}").alias("x"), F.col(f"q.y{k}").alias("y")) for k in (1, 2)])
    crossing = F.size(F.array_except(on_p, ends_of_q)) > 0
    met_a = materialize(met.select("p.id", F.col("q.of").alias("other"), on_p.alias("at")))
    met_b = materialize(met.select("q.id", F.col("p.of").alias("other"), F.when(crossing, on_p).otherwise(on_q).alias("at")))
    in_a, in_b = materialize(_split(a, met_a)), materialize(_split(b, met_b))
    mirrored = in_b.select(F.col("other").alias("of"), F.col("of").alias("other"), *SHAPE)
    same = in_a.join(mirrored, ["of", "other", *SHAPE]).select("of", "other", *SHAPE)
    turned = mirrored.select("of", "other", F.col("x2").alias("x1"), F.col("y2").alias("y1"), F.col("x1").alias("x2"), F.col("y1").alias("y2"))
    against = in_a.join(turned, ["of", "other", *SHAPE]).select("of", "other", *SHAPE)
    same, against = materialize(same), materialize(against)
    flip = lambda df, back: df.select(F.col("other").alias("of"), F.col("of").alias("other"), *([F.col(f"{c}{3 - k}").alias(f"{c}{k}") for k in (1, 2) for c in "xy"] if back else SHAPE))
    from_a = _kept_inside(a, in_a, covers[1], met_a, same.unionByName(against))
    from_b = _kept_inside(b, in_b, covers[0], met_b, flip(same, False).unionByName(flip(against, True)))
    kept = from_a.unionByName(flip(from_b, False)).unionByName(same)
    found = materialize(chain_rings(kept, ["of", "other"])).withColumnsRenamed({"of": "__shape_a", "other": "__shape_b"})
    for side, all_, key in (("__shape_a", members[0], name), ("__shape_b", members[1], region)):
        found = found.join(all_.select(F.col("shape").alias(side), F.col("of").alias(key)), side).drop(side)
    return found.select(name, region, "ring", "area")
