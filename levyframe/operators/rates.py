"""Rates of parcels: parts, sums, stacks, statistics and calculators.  All rates are DECIMAL(12,6)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyframe.functions.text import has_real_id
from levyframe.sources.tables import materialize

RATE = "decimal(12,6)"
# fixed values: buyers' exemptions and shares, bands of the colour scale, limits of what is worth telling
HOMESTEAD, OVER65, LOCAL_SHARE = 140_000, 60_000, 0.8
BAND_LOW, BAND_HIGH, BAND_STOPS = 1.0, 2.6, 7
ABOUT, GAP, LEAST_SIGMA = 0.05, 0.005, 0.02
SKIPPED_CODES = ("CAD", "APR")


def county_base(recipes: DataFrame, units: DataFrame) -> DataFrame:
    """(county_code, base): the sum of each county's countywide units."""
    return recipes.join(units.select("unit_id", "rate_per_100"), "unit_id").groupBy("county_code").agg(F.sum("rate_per_100").cast(RATE).alias("base"))


def special_rates(parcel_districts: DataFrame, district_units: DataFrame) -> DataFrame:
    """(uid, county_code, name) x resolved districts -> uid, special_rate, stack: distinct units, though several polygons may stand for one."""
    hit = parcel_districts.join(district_units, ["county_code", "name"]).select("uid", "unit_id", "unit_name", "rate_per_100").distinct()
    return hit.groupBy("uid").agg(F.round(F.sum("rate_per_100"), 4).cast(RATE).alias("special_rate"), F.array_sort(F.collect_list(F.struct(F.col("unit_name").alias("name"), F.col("rate_per_100").alias("rate"), "unit_id"))).alias("stack"))


def area_extra(corrections: DataFrame) -> DataFrame:
    """One row for each city and school district of a correction; a correction without cities is for land outside any."""
    # units of the same places as one row with their list, before the places are told apart
    lists = corrections.groupBy("county", "city_names", "isd_names").agg(F.sum("extra_rate").alias("extra_rate"), F.collect_set("unit_id").alias("units"))
    one = lists.withColumn("city_name", F.explode_outer("city_names")).withColumn("isd_name", F.explode_outer("isd_names"))
    return one.groupBy("county", "city_name", "isd_name").agg(F.sum("extra_rate").cast(RATE).alias("extra_rate"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("units")))).alias("extra_units"))


def roll_rates(roll: DataFrame, matches: DataFrame, approved: DataFrame | None = None) -> DataFrame:
    """Roll rows (county_code, prop_id, entity_code, entity_name) -> county_code, prop_id, roll_rate, roll_isd_rate, stack.

    Units count once a property, by name.  Only a stack with one school
    district, at most one city and a county is complete; the others are left
    to where the parcel lies.
    """
    rows = roll.where(has_real_id(F.col("prop_id")) & ~F.col("entity_code").isin(*SKIPPED_CODES))
    if approved is not None:
        rows = rows.join(approved.select("county_code").distinct(), "county_code", "left_semi")
    known = matches.where("unit_id is not null").select("county_code", F.col("name").alias("entity_name"), "unit_name", "unit_type", "rate_per_100")
    # dealt by property once, for the units and for their sums
    lines = rows.select("county_code", "prop_id", "entity_name").join(known, ["county_code", "entity_name"]).drop("entity_name").repartition("county_code", "prop_id")
    unit = lines.groupBy("county_code", "prop_id", "unit_name").agg(F.min(F.struct("unit_type", "rate_per_100")).alias("u")).select("county_code", "prop_id", "unit_name", "u.unit_type", "u.rate_per_100")
    kinds = {k: F.count_if(F.col("unit_type") == t) for k, t in (("n_isd", "02"), ("n_city", "03"), ("n_county", "00"))}
    stack = F.array_sort(F.collect_list(F.struct(F.col("unit_name").alias("name"), F.col("rate_per_100").alias("rate"))))
    whole = unit.groupBy("county_code", "prop_id").agg(*[v.alias(k) for k, v in kinds.items()], F.round(F.sum("rate_per_100"), 4).cast(RATE).alias("roll_rate"), F.sum(F.when(F.col("unit_type") == "02", F.col("rate_per_100"))).cast(RATE).alias("roll_isd_rate"), stack.alias("stack"))
    return whole.where("n_isd = 1 and n_city <= 1 and n_county >= 1").select("county_code", "prop_id", "roll_rate", "roll_isd_rate", "stack")


def nominal_rates(parcels: DataFrame, base: DataFrame, cities: DataFrame, isds: DataFrame, special: DataFrame, extra: DataFrame, roll: DataFrame) -> DataFrame:
    """parcels with base, city_rate, isd_rate, special_rate, extra_rate, roll_rate and nominal_rate: the roll's, else the sum of the parts; with special_stack, extra_units and roll_stack, of what they are made.

    base, cities (county_code, city_name), isds (county_code, isd_name) and
    extra are a few rows a county; Spark broadcasts them by their size.
    """
    zero = F.lit(0).cast(RATE)
    out = parcels.join(base.select("county_code", "base"), "county_code", "left").join(cities.select("county_code", "city_name", F.col("rate_per_100").alias("city_rate")), ["county_code", "city_name"], "left")
    out = out.join(isds.select("county_code", "isd_name", F.col("rate_per_100").alias("own_isd_rate")), ["county_code", "isd_name"], "left").join(special.select("uid", "special_rate", F.col("stack").alias("special_stack")), "uid", "left")
    e = extra.select(F.col("county").alias("e_county"), F.col("city_name").alias("e_city"), F.col("isd_name").alias("e_isd"), "extra_rate", "extra_units")
    out = out.join(e, (out["county"] == e["e_county"]) & out["city_name"].eqNullSafe(e["e_city"]) & out["isd_name"].eqNullSafe(e["e_isd"]), "left").drop("e_county", "e_city", "e_isd")
    # rows without an id have no roll; they'd all share one key
    r = roll.select("county_code", "prop_id", "roll_rate", "roll_isd_rate", F.col("stack").alias("roll_stack"))
    key = F.when(has_real_id(F.col("prop_id")), F.col("prop_id")).otherwise(F.concat(F.lit("#"), F.xxhash64("uid").cast("string")))
    out = out.withColumn("__key", key).join(r.withColumnRenamed("prop_id", "__key"), ["county_code", "__key"], "left").drop("__key")
    parts = ["base", "city_rate", "own_isd_rate", "special_rate", "extra_rate"]
    out = out.withColumns({p: F.coalesce(p, zero) for p in parts})
    total = sum((F.col(p) for p in parts[1:]), F.col("base")).cast(RATE)
    return out.withColumn("nominal_rate", F.coalesce("roll_rate", total)).withColumn("isd_rate", F.coalesce("roll_isd_rate", "own_isd_rate")).withColumn("roll_verified", F.col("roll_rate").isNotNull()).drop("roll_isd_rate").withColumnRenamed("own_isd_rate", "place_isd_rate")


def rate_summary(rated: DataFrame, by: str, rate: str = "nominal_rate") -> DataFrame:
    return rated.groupBy(by).agg(F.count("*").alias("n"), F.min(rate).alias("least"), F.round(F.median(F.col(rate).cast("double")), 6).alias("middle"), F.max(rate).alias("largest"))


def layer_stats(rated: DataFrame, by: list[str], layer: DataFrame, fallback: str | None = None) -> DataFrame:
    """Median rate, parcels and median value of each area of a layer; with a fallback column, areas without parcels show that rate."""
    stats = rated.groupBy(*by).agg(F.round(F.median(F.col("nominal_rate").cast("double")), 4).alias("rate"), F.count("*").alias("parcels"), F.round(F.median("mkt")).cast("long").alias("value"))
    if fallback is None:
        return layer.join(stats, by)
    out = layer.join(stats, by, "left")
    return out.withColumn("rate", F.coalesce("rate", F.round(F.col(fallback).cast("double"), 4))).withColumn("parcels", F.coalesce("parcels", F.lit(0))).drop(fallback)


def anchor_stats(rated: DataFrame, by: str) -> DataFrame:
    """Median, standard deviation (that of all where a group has none worth the name) and size of each group, 4 places."""
    rate = F.col("nominal_rate").cast("double")
    whole = rated.agg(F.stddev_samp(rate).alias("all_sd"))
    groups = rated.groupBy(by).agg(F.round(F.median(rate), 4).alias("middle"), F.stddev_samp(rate).alias("sd"), F.count("*").alias("n"))
    sd = F.when(F.coalesce(F.col("sd") < LEAST_SIGMA, F.lit(True)), F.col("all_sd")).otherwise(F.col("sd"))
    return groups.join(F.broadcast(whole)).select(by, "middle", F.round(sd, 4).alias("sd"), "n")


def spread_of_medians(rated: DataFrame, by: str) -> DataFrame:
    """One row: median and standard deviation of all rates, and of the groups' medians."""
    rate = F.col("nominal_rate").cast("double")
    medians = rated.groupBy(by).agg(F.median(rate).alias("m")).agg(F.round(F.median("m"), 6).alias("group_middle"), F.round(F.stddev_samp("m"), 6).alias("group_sd"))
    return rated.agg(F.round(F.median(rate), 6).alias("middle"), F.round(F.stddev_samp(rate), 6).alias("sd")).join(F.broadcast(medians))


def breakdown(parts: dict[str, Column]) -> Column:
    """Array of (name, rate) of the parts that are there and above 0."""
    return F.filter(F.array(*[F.struct(F.lit(n).alias("name"), c.cast(RATE).alias("rate")) for n, c in parts.items()]), lambda s: F.coalesce(s["rate"] > 0, F.lit(False)))


def stack_total(stack: Column) -> Column:
    return F.aggregate(stack, F.lit(0).cast("decimal(22,6)"), lambda s, x: (s + x["rate"]).cast("decimal(22,6)")).cast(RATE)


def unexplained(rate: Column, stack: Column) -> Column:
    """What a stack leaves of a rate; null if too little to tell."""
    gap = (rate - stack_total(stack)).cast(RATE)
    return F.when(F.abs(gap) >= GAP, gap)


def estimated_tax(value: Column, rate: Column) -> Column:
    return F.when(value > 0, F.round(value * rate / 100, 2))


def buyer_projection(price: Column, rate: Column, isd_rate: Column, homestead: Column, over65: Column, local_option: Column, veteran: Column) -> Column:
    """A buyer's yearly tax: school taxes on the price less exemptions, the others on 0.8 of it with homestead and local option."""
    school_base = F.greatest(price - F.when(homestead, HOMESTEAD).otherwise(0) - F.when(over65, OVER65).otherwise(0), F.lit(0))
    other_base = price * F.when(homestead & local_option, LOCAL_SHARE).otherwise(1.0)
    tax = F.round((school_base * isd_rate.cast("double") + other_base * (rate - isd_rate).cast("double")) / 100, 2)
    return F.when(price <= 0, F.lit(None)).when(veteran, F.lit(0.0)).otherwise(tax)


def against_median(rate: Column, middle: Column) -> Column:
    d = rate.cast("double") - middle
    return F.when(F.abs(d) < ABOUT, "about at").when(d > 0, "above").otherwise("below")


def rate_band(rate: Column) -> Column:
    """0 to BAND_STOPS - 1, with what is between two stops as a fraction."""
    held = F.least(F.greatest(rate.cast("double"), F.lit(BAND_LOW)), F.lit(BAND_HIGH))
    return (held - BAND_LOW) / (BAND_HIGH - BAND_LOW) * (BAND_STOPS - 1)


def band_colour(rate: Column, stops: list[tuple[int, int, int]]) -> Column:
    """Red, green and blue between the two stops around a rate's band."""
    table = F.array(*[F.array(*[F.lit(float(v)) for v in s]) for s in stops])
    band = rate_band(rate)
    low = F.least(F.floor(band), F.lit(len(stops) - 2)).cast("int")
    at = lambda k: F.round(F.get(F.get(table, low), F.lit(k)) + (F.get(F.get(table, low + 1), F.lit(k)) - F.get(F.get(table, low), F.lit(k))) * (band - low)).cast("int")
    return F.array(at(0), at(1), at(2))


def compare_parcels(pairs: DataFrame, stacks: DataFrame) -> DataFrame:
    """(a, b) ids x (uid, stack) -> a row for each unit of either, with both rates (null where one lacks it)."""
    one = lambda side: pairs.select("a", "b").join(stacks.select(F.col("uid").alias(side), F.explode("stack").alias("s")), side).select("a", "b", F.col("s.name").alias("name"), F.col("s.rate").alias(f"rate_{side}"))
    return one("a").join(one("b"), ["a", "b", "name"], "full_outer")


def county_breakdown(base_units: DataFrame, cities: DataFrame) -> DataFrame:
    """county_code, base (array of name, rate of the levying base units), cities (map of normalised city name to rate; the last unit holds)."""
    base = base_units.where("rate_per_100 > 0").groupBy("county_code").agg(F.array_sort(F.collect_list(F.struct("name", F.col("rate_per_100").alias("rate")))).alias("base"))
    last = cities.groupBy("county_code", "city_key").agg(F.max_by("rate_per_100", "unit_id").alias("rate"))
    named = last.groupBy("county_code").agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("city_key", "rate")))).alias("cities"))
    return base.join(named, "county_code", "left")


def packed_groups(rows: DataFrame, order: str, size: str, budget: float) -> DataFrame:
    """rows (one a county, say) with `group`: in their order, a group takes rows until the next would pass the budget, and the
    next group begins with that one; a row too large for any group is with no more than rows of size 0 before it.

    Where a group that begins at a row ends is known for each row at once, from
    running sums; which rows begin one follows by doubling these pointers.  The
    windows are over one narrow row a row.
    """
    w = Window.orderBy(order)
    upto = F.sum(size).over(w.rowsBetween(Window.unboundedPreceding, 0))
    narrow = materialize(rows.select(F.row_number().over(w).alias("k"), F.col(order), F.col(size).alias("size"), upto.alias("upto")))
    # the first row whose running sum passes a value: rows and values side by side in one order
    points = narrow.select("k", F.col("upto").cast("double").alias("v"), F.lit(1).alias("is_row"))

    def first_past(value: Column, name: str) -> DataFrame:
        asked = narrow.select(F.col("k").alias("of"), value.cast("double").alias("v"), F.lit(0).alias("is_row"), F.lit(None).cast("int").alias("k"))
        both = asked.unionByName(points.withColumn("of", F.lit(None).cast("int")))
        # a row of the same value is not past it, so it comes first
        later = Window.orderBy("v", F.desc("is_row")).rowsBetween(0, Window.unboundedFollowing)
        return both.withColumn(name, F.min("k").over(later)).where("is_row = 0").select(F.col("of").alias("k"), name)

    before = F.col("upto") - F.col("size")
    full, some = first_past(before + budget, "full"), first_past(before, "some")
    # the group has a row of size above 0 from `some` on, so the row after that is the first that can be left out
    jump = full.join(some, "k").select("k", F.greatest("full", F.col("some") + 1).alias("next")).where("full is not null")
    hop, starts = materialize(jump), materialize(narrow.where("k = 1").select("k"))
    while True:
        # starts that so many steps reach, and as many more
        more = materialize(starts.join(hop, "k").select(F.col("next").alias("k")))
        if not more.limit(1).count():
            break
        starts = materialize(starts.unionByName(more))
        hop = materialize(hop.join(hop.select(F.col("k").alias("next"), F.col("next").alias("next2")), "next").select("k", F.col("next2").alias("next")))
    group = F.sum(F.col("start").isNotNull().cast("int")).over(Window.orderBy("k").rowsBetween(Window.unboundedPreceding, 0)) - 1
    marked = narrow.join(starts.withColumn("start", F.lit(1)), "k", "left").select(F.col(order), group.cast("int").alias("group"))
    return rows.join(marked, order)


def regions(counts: DataFrame, budget: float, band: float = 1.5) -> DataFrame:
    """(county, n, lat, lon) -> also sweep and region: counties in latitude bands, swept east and west in turn, packed into regions of at most `budget` rows."""
    band_no = F.bround(F.col("lat") / band).cast("int")
    sweep = Window.orderBy(F.desc("band"), F.when(F.pmod("band", F.lit(2)) == 0, F.col("lon")).otherwise(-F.col("lon")), "county")
    rows = counts.withColumn("band", band_no).withColumn("sweep", F.row_number().over(sweep))
    return packed_groups(rows, "sweep", "n", budget).withColumnRenamed("group", "region")
