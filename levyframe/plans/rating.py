"""Rates of parcels, calculators, recipes and regions (inventory groups H and J)."""

from __future__ import annotations

from pyspark.sql import functions as F

from levyframe.functions.geometry import acres
from levyframe.functions.text import has_real_id, norm_city, norm_district, norm_isd, render_stack
from levyframe.operators import rates as R
from levyframe.operators import resolve
from levyframe.operators.spatial import points_in_polygons, shapes
from levyframe.operators.tables import with_long
from levyframe.plans.fixtures import query
from levyframe.plans.inputs import city_strips, school_strips
from levyframe.plans.joins import ENTITY_MATCH, adjacency
from levyframe.plans.shapes import IN_DISTRICT, districts
from levyframe.sources.tables import materialize

# what stands behind a name in a county: the last levying utility district, the first city or school district
WD_UNITS = """select county_code, lower(name) as k, max_by(struct_pack(unit_id, name, rate_per_100), unit_id) as u
 from fx_units where unit_type = '04' and rate_per_100 > 0 group by 1, 2"""
SPECIAL = f"""select uid, round(sum(rate_per_100), 4) as special_rate, count(*) as n_units,
  string_agg(name || '=' || cast(rate_per_100 as varchar), '; ' order by name, rate_per_100, unit_id) as stack
 from (select distinct p.uid, w.u.unit_id as unit_id, w.u.name as name, w.u.rate_per_100 as rate_per_100
       from fx_parcels p join fx_polys d on {IN_DISTRICT} join ({WD_UNITS}) w on w.county_code = p.county_code and w.k = lower(d.poly_name)) x group by uid"""


def district_names(t):
    """(poly, name): the names of all districts that a district of least id stands for, as their rings are the same."""
    rows = materialize(districts(t).select("poly_id", "poly_name", "rings"))
    return rows.join(shapes(rows, "poly_id").withColumnRenamed("poly_id", "poly"), "rings").select("poly", F.col("poly_name").alias("name")).distinct()


def special(t, at=None, lists=None):
    """Special-district rates; at: (uid, county_code, polys), the districts that each parcel is in, one for all of the same rings, else found here.

    Parcels of a county that are in the same districts have the same rates, so these are worked out once for each such place.
    lists: gets "special", (number, stack) a place, whose number is then each parcel's stack.
    """
    if at is None:
        polygons = shapes(districts(t), "poly_id")
        found = points_in_polygons(t("fx_parcels").select(F.struct("uid", "county_code").alias("at"), "x", "y"), polygons, "at", "poly_id")
        at = materialize(found.groupBy("at").agg(F.array_sort(F.collect_set("poly_id")).alias("polys")).select("at.uid", "at.county_code", "polys"))
    places = materialize(at.where(F.size("polys") > 0).select(F.struct("county_code", "polys").alias("uid")).distinct())
    inside = places.select("uid", "uid.county_code", F.explode("uid.polys").alias("poly")).join(district_names(t), "poly")
    named = materialize(inside.select("uid", "county_code", "name").distinct())
    found = resolve.resolve_districts(named.select("county_code", "name").distinct(), t("fx_units"), t("fx_recipes"), norm_district)
    rates = materialize(R.special_rates(named, found.join(t("fx_units").select("unit_id", F.col("name").alias("unit_name")), "unit_id")))
    of_place = rates.select("uid.county_code", "uid.polys", "special_rate", "stack")
    if lists is not None:
        of_place = materialize(of_place.withColumn("number", F.monotonically_increasing_id()))
        lists["special"] = of_place.select("number", "stack")
        of_place = of_place.drop("stack").withColumnRenamed("number", "stack")
    return at.join(of_place, ["county_code", "polys"]).select("uid", "special_rate", "stack")


@query("h4_special_rates", f"select uid, cast(special_rate as double) as special_rate, n_units from ({SPECIAL}) s")
def h4(t):
    return special(t).select("uid", "special_rate", F.size("stack").alias("n_units"))


CORRECTIONS = """select county, cast(0.05 as decimal(12,6)) as extra_rate, unit_id
  from fx_counties c join fx_units u on u.county_code = c.county_code and u.unit_type = '40' and u.rate_per_100 > 0"""
AREAS = "select distinct county, city_name, isd_name from fx_named where isd_name is not null"
EXTRA = f"""select county, city_name, isd_name, sum(extra_rate) as extra_rate, string_agg(distinct unit_id, '; ' order by unit_id) as units
 from (select a.*, x.extra_rate, x.unit_id from ({CORRECTIONS}) x join ({AREAS}) a on a.county = x.county) y group by 1, 2, 3"""


@query("h5_area_extra", f"select county, city_name, isd_name, cast(extra_rate as double) as extra_rate from ({EXTRA}) e")
def h5(t):
    return extra(t).select("county", "city_name", "isd_name", "extra_rate")


def extra(t):
    lists = t.sql(AREAS).groupBy("county", "city_name").agg(F.collect_set("isd_name").alias("isd_names")).select("county", F.array("city_name").alias("city_names"), "isd_names")
    return R.area_extra(t.sql(CORRECTIONS).join(lists, "county"))


ROLL_ROWS = f"""select r.county_code, r.prop_id, m.unit_name, min(m.unit_type) as unit_type, min_by(m.rate_per_100, (m.unit_type, m.rate_per_100)) as rate_per_100
 from (select c.county_code, e.* from fx_roll_entities e join fx_counties c on c.county = e.county) r
 join ({ENTITY_MATCH}) m on m.county_code = r.county_code and m.name = r.entity_name
 where r.prop_id <> '0' and r.entity_code not in ('CAD', 'APR') group by 1, 2, 3"""
ROLL = f"""select county_code, prop_id, round(sum(rate_per_100), 4) as roll_rate, sum(rate_per_100) filter (where unit_type = '02') as roll_isd_rate, count(*) as n_units,
  string_agg(unit_name || '=' || cast(rate_per_100 as varchar), '; ' order by unit_name, rate_per_100) as stack
 from ({ROLL_ROWS}) x group by 1, 2
 having count(*) filter (where unit_type = '02') = 1 and count(*) filter (where unit_type = '03') <= 1 and count(*) filter (where unit_type = '00') >= 1"""


def roll(t, with_ratio=False, near=None):
    """Roll lines by the units that their names stand for; names are matched once each.  SQL has no ratio of two names, so only *_with_ratio asks for it."""
    rows = t("fx_roll_entities").join(t("fx_counties").select("county", "county_code"), "county")
    names = rows.where(~F.col("entity_code").isin(*R.SKIPPED_CODES)).select("county_code", F.col("entity_name").alias("name")).distinct()
    return R.roll_rates(rows, materialize(resolve.match_entities(names, t("fx_units"), adjacency(t) if near is None else near, t("fx_counties"), with_ratio)))


@query("h7_roll_rates", f"""select county_code, prop_id, cast(roll_rate as double) as roll_rate, cast(roll_isd_rate as double) as roll_isd_rate, n_units
  from ({ROLL}) r""")
def h7(t):
    return roll(t).select("county_code", "prop_id", "roll_rate", "roll_isd_rate", F.size("stack").alias("n_units"))


def first_of_name(units):
    return f"select county_code, lower(name) as k, min_by(rate_per_100, unit_id) as rate from {units} group by 1, 2"


def nominal(extra):
    return f"""select n.uid, n.county, n.prop_id, n.mkt,
  coalesce(cast(r.roll_rate as decimal(18,6)), b.base + coalesce(c.rate, 0) + coalesce(i.rate, 0) + cast(coalesce(s.special_rate, 0) as decimal(18,6)) + coalesce(e.extra_rate, 0)) as nominal_rate,
  coalesce(r.roll_isd_rate, i.rate, 0) as isd_rate, r.roll_rate is not null as roll_verified, coalesce(s.special_rate, 0) + coalesce(e.extra_rate, 0) as sd,
  coalesce(r.stack, nullif(concat_ws('; ', s.stack, e.units), '')) as stack, b.base, coalesce(c.rate, 0) as city_part, coalesce(i.rate, 0) as isd_part
from fx_named n join fx_base b on b.county_code = n.county_code
left join ({first_of_name('fx_city_units')}) c on c.county_code = n.county_code and c.k = lower(n.city_name)
left join ({first_of_name('fx_isd_units')}) i on i.county_code = n.county_code and i.k = lower(n.isd_name)
left join ({SPECIAL}) s on s.uid = n.uid
left join ({extra}) e on e.county = n.county and e.city_name is not distinct from n.city_name and e.isd_name is not distinct from n.isd_name
left join ({ROLL}) r on r.county_code = n.county_code and r.prop_id = n.prop_id and n.prop_id <> '0'"""


NOMINAL = nominal(EXTRA)


def placed(t, parcels):
    """(uid, county_code, city_name, isd_name, polys): what each parcel is in, of all layers in one pass over the parcels; districts of the same rings count once, by the least id."""
    layer = lambda df, key, name, of: df.select(F.struct(F.lit(of).alias("layer"), F.col(key).cast("string").alias("poly")).alias("place"), name.alias("name"), "rings")
    layers = layer(city_strips(t), "poly", F.col("name"), "city").unionByName(layer(school_strips(t), "poly", F.col("name"), "isd"))
    layers = materialize(layers.unionByName(layer(shapes(districts(t), "poly_id"), "poly_id", F.lit(None).cast("string"), "district")))
    at = points_in_polygons(parcels.select(F.struct("uid", "county_code").alias("at"), "x", "y"), layers.select("place", "rings"), "at", "place")
    rows = at.join(layers.select("place", "name"), "place").select("at.uid", "at.county_code", "place.layer", "place.poly", "name")
    one = lambda layer, name: F.min(F.when(F.col("layer") == layer, F.col("name"))).alias(name)
    polys = F.array_sort(F.collect_set(F.when(F.col("layer") == "district", F.col("poly").cast("long")))).alias("polys")
    return rows.groupBy("uid", "county_code").agg(one("city", "city_name"), one("isd", "isd_name"), polys)


def rated(t, with_ratio=False, corrections=None, lists=None):
    """The whole build: parcels placed in cities, school and special districts, these names resolved to units, corrections by place, and the roll, which wins.

    lists: gets "special", (number, stack), and "extra", (number, units); special_stack and extra_units are then numbers of these.
    A county's units and districts make long lists, which parcels would carry wherever they are moved.
    """
    parcels = t("fx_located").select("uid", "county", "county_code", "prop_id", "addr", "mkt", "x", "y")
    near = materialize(adjacency(t))
    places = materialize(placed(t, parcels))

    def resolved(unit_type, name, normalise):
        pairs = places.where(F.col(name).isNotNull()).select("county_code", F.col(name).alias("name")).distinct()
        units = resolve.resolve_names(pairs, t("fx_units").where(F.col("unit_type") == unit_type), near, normalise)
        return units.select("county_code", F.col("name").alias(name), "rate_per_100")

    extras = extra(t) if corrections is None else corrections
    if lists is not None:
        extras = materialize(extras)
        lists["extra"] = materialize(extras.select(F.col("extra_units").alias("units")).distinct().withColumn("number", F.monotonically_increasing_id()))
        extras = extras.join(lists["extra"], F.col("extra_units") == F.col("units")).drop("extra_units", "units").withColumnRenamed("number", "extra_units")
    rows = parcels.join(places.select("uid", "city_name", "isd_name"), "uid", "left")
    return R.nominal_rates(rows, t("fx_base"), resolved("03", "city_name", norm_city), resolved("02", "isd_name", norm_isd), special(t, places, lists), extras, roll(t, with_ratio, near))


@query("h8_nominal_rate", f"select uid, cast(nominal_rate as double) as nominal_rate, cast(isd_rate as double) as isd_rate, roll_verified from ({NOMINAL}) x")
def h8(t):
    return rated(t).select("uid", "nominal_rate", "isd_rate", "roll_verified")


@query("h8_with_ratio")
def h8_with_ratio(t):
    """The same with the roll's names matched by ratio as well; tested against the stages by hand."""
    return rated(t, with_ratio=True).select("uid", "nominal_rate", "isd_rate", "roll_verified")


# owners and recorded areas by account; an area of 0 is not recorded
ATTRS = """select distinct p.county, p.prop_id, c_name as owner, cast(case when uid % 3 = 0 then 0 else uid % 700 end as double) / 100 as gis_area
  from fx_parcels p join orders on o_orderkey = uid join customer on c_custkey = o_custkey
  where p.prop_id <> '0'"""
LOT = "radians(0.001e0) * 2 * abs(sin(radians(y + 0.002e0)) - sin(radians(y))) / 2 * 6371008.8 * 6371008.8 / 4046.8564"


@query(
    "h9_parcel_export",
    f"""select x.uid, x.county, cast(round(cast(nominal_rate as decimal(18,6)), 4) as double) as r, cast(round(cast(isd_rate as decimal(18,6)), 4) as double) as isdr,
  case when roll_verified then 0e0 else cast(round(cast(sd as decimal(18,6)), 4) as double) end as sd, stack as sdn, case when roll_verified then 1 else 0 end as rv,
  a.owner as own, round(case when coalesce(a.gis_area, 0) > 0 then a.gis_area else {LOT} end, 3) as ac
from ({NOMINAL}) x join fx_parcels p on p.uid = x.uid left join ({ATTRS}) a on a.county = x.county and a.prop_id = x.prop_id""",
)
def h9(t):
    """Texts of places, which may be long, are made once for each that differs, and meet their parcels at the end; parcels of one text are written side by side."""
    lists = {}
    sd = F.when(F.col("roll_verified"), 0.0).otherwise(F.round(F.col("special_rate") + F.col("extra_rate"), 4).cast("double"))
    four = lambda c: F.round(F.col(c), 4)
    corner = lambda dx, dy: F.struct((F.col("x") + dx).alias("x"), (F.col("y") + dy).alias("y"))
    lot = F.array(corner(0.0, 0.0), corner(0.001, 0.0), corner(0.001, 0.002), corner(0.0, 0.002))
    key = F.when(has_real_id(F.col("prop_id")), F.col("prop_id")).otherwise(F.concat(F.lit("#"), "uid"))
    attrs = t.sql(ATTRS.replace(" as double) / 100", " as double) / 100D")).withColumnRenamed("prop_id", "key")
    rows = rated(t, lists=lists).withColumn("key", key).join(attrs, ["county", "key"], "left")
    number = lambda c: F.coalesce(c, F.lit(-1))
    rows = materialize(rows.select("uid", "county", four("nominal_rate").alias("r"), four("isd_rate").alias("isdr"), sd.alias("sd"), render_stack(F.col("roll_stack")).alias("sdn"), F.col("roll_verified").cast("int").alias("rv"), F.col("owner").alias("own"), acres(F.col("gis_area"), lot).alias("ac"), number("special_stack").alias("special"), number("extra_units").alias("extra")))
    by_place = rows.where("sdn is null").drop("sdn")
    texts = by_place.groupBy("special", "extra").agg(F.count("*").alias("n"))
    texts = texts.join(lists["special"].select(F.col("number").alias("special"), render_stack(F.col("stack")).alias("first")), "special", "left").join(lists["extra"].select(F.col("number").alias("extra"), F.array_join("units", "; ").alias("then")), "extra", "left")
    sdn = F.nullif(F.concat_ws("; ", "first", "then"), F.lit(""))
    out = with_long(by_place, texts.select("special", "extra", "n", sdn.alias("sdn")), ["special", "extra"], F.octet_length("sdn"), F.xxhash64("uid"))
    return rows.where("sdn is not null").select(out.columns).unionByName(out).select("uid", "county", "r", "isdr", "sd", "sdn", "rv", "own", "ac")


PLACED = "cast(base + city_part + isd_part + sd as decimal(18,6))"


@query("h10_breakdown", f"""select uid, (case when base > 0 then 1 else 0 end) + (case when city_part > 0 then 1 else 0 end) + (case when isd_part > 0 then 1 else 0 end) + (case when sd > 0 then 1 else 0 end) as n_parts,
  coalesce(case when abs(nominal_rate - {PLACED}) >= 0.005 then cast(nominal_rate - {PLACED} as double) end, -1) as gap from ({NOMINAL}) x""")
def h10(t):
    """What a parcel's place explains of its rate; where the roll wins, the rest is a gap."""
    rows = rated(t).withColumn("stack", R.breakdown({"county": F.col("base"), "city": F.col("city_rate"), "isd": F.col("place_isd_rate"), "special": F.col("special_rate") + F.col("extra_rate")}))
    return rows.select("uid", F.size("stack").alias("n_parts"), F.coalesce(R.unexplained(F.col("nominal_rate"), F.col("stack")).cast("double"), F.lit(-1.0)).alias("gap"))


@query("h11_estimated_tax", "select uid, round(mkt * cast(nominal_rate as double) / 100, 2) as tax from fx_rated where mkt > 0")
def h11(t):
    return t("fx_rated").withColumn("tax", R.estimated_tax(F.col("mkt"), F.col("nominal_rate").cast("double"))).where("tax is not null").select("uid", "tax")


SCENARIOS = """(select 1 as s, true as homestead, false as over65, true as local_option, false as veteran
  union all select 2, true, true, false, false union all select 3, false, false, false, true
  union all select 4, false, true, true, false)"""


@query("h12_buyer_projection", f"""select uid, s, round((greatest(mkt - case when homestead then 140000 else 0 end - case when over65 then 60000 else 0 end, 0) * cast(isd_rate as double) + mkt * case when homestead and local_option then 0.8e0 else 1e0 end * cast(nominal_rate - isd_rate as double)) / 100,
    2) * case when veteran then 0 else 1 end as tax from fx_rated, {SCENARIOS} q
  where mkt > 0""")
def h12(t):
    """All parcels by four scenarios, a fixed few rows."""
    s = F.broadcast(t.sql(f"select * from {SCENARIOS}"))
    tax = R.buyer_projection(F.col("mkt"), F.col("nominal_rate"), F.col("isd_rate"), F.col("homestead"), F.col("over65"), F.col("local_option"), F.col("veteran"))
    return t("fx_rated").where("mkt > 0").join(s).select("uid", "s", tax.alias("tax"))


@query("h13_compare_parcels", """with p as (select uid as a, uid + 1 as b from fx_named where uid + 1 in (select uid
  from fx_named)), s as (select uid, 'city' as name, city_rate as rate
  from fx_named where city_rate > 0 union all select uid, 'school', isd_rate
  from fx_named where isd_rate > 0) select coalesce(x.a, y.a) as a, coalesce(x.name, y.name) as name, cast(coalesce(x.rate, -1) as double) as rate_a,
    cast(coalesce(y.rate, -1) as double) as rate_b from (select p.*, s.name, s.rate
  from p join s on s.uid = p.a) x full join (select p.*, s.name, s.rate
  from p join s on s.uid = p.b) y on x.a = y.a and x.name = y.name""")
def h13(t):
    rows = t("fx_named").withColumn("stack", R.breakdown({"city": F.col("city_rate"), "school": F.col("isd_rate")})).select("uid", "stack")
    pairs = rows.select(F.col("uid").alias("a"), (F.col("uid") + 1).alias("b")).join(rows.select(F.col("uid").alias("b")), "b")
    out = R.compare_parcels(pairs, rows)
    return out.select("a", "name", F.coalesce(F.col("rate_a").cast("double"), F.lit(-1.0)).alias("rate_a"), F.coalesce(F.col("rate_b").cast("double"), F.lit(-1.0)).alias("rate_b"))


@query("h14_against_median", """with m as (select county, round(median(cast(nominal_rate as double)), 4) as m
  from fx_rated group by county) select uid, case when abs(cast(nominal_rate as double) - m) < 0.05 then 'about at' when cast(nominal_rate as double) > m then 'above' else 'below' end as place
  from fx_rated r join m on m.county = r.county""")
def h14(t):
    r = t("fx_rated")
    m = F.broadcast(R.anchor_stats(r, "county").select("county", "middle"))
    return r.join(m, "county").select("uid", R.against_median(F.col("nominal_rate"), F.col("middle")).alias("place"))


@query("h15_rate_band", "select uid, round((least(greatest(cast(nominal_rate as double), 1.0), 2.6) - 1.0) / 1.6 * 6, 9) as band from fx_rated")
def h15(t):
    return t("fx_rated").select("uid", F.round(R.rate_band(F.col("nominal_rate")), 9).alias("band"))


@query("h16_anchor_stats", """with a as (select stddev_samp(cast(nominal_rate as double)) as s
  from fx_rated) select county, round(median(cast(nominal_rate as double)), 4) as middle, round(case when coalesce(stddev_samp(cast(nominal_rate as double)) < 0.02,
    true) then any_value(a.s) else stddev_samp(cast(nominal_rate as double)) end, 4) as sd, count(*) as n
  from fx_rated, a group by county""")
def h16(t):
    return R.anchor_stats(t("fx_rated"), "county")


@query("h17_county_breakdown", """select b.county_code, b.n_base, coalesce(c.n_cities, 0) as n_cities
  from (select r.county_code, count(*) as n_base from fx_recipes r
  join fx_units u on u.unit_id = r.unit_id where rate_per_100 > 0
  group by 1) b left join (select county_code, count(distinct lower(name)) as n_cities
  from fx_city_units group by 1) c on c.county_code = b.county_code""")
def h17(t):
    base = t("fx_recipes").join(t("fx_units").drop("county_code"), "unit_id")
    cities = t("fx_city_units").select("county_code", "unit_id", F.lower("name").alias("city_key"), "rate_per_100")
    out = R.county_breakdown(base, cities)
    return out.select("county_code", F.size("base").cast("long").alias("n_base"), F.coalesce(F.size("cities"), F.lit(0)).cast("long").alias("n_cities"))


COLLEGES, SPECIALS = ["ring mud"], ["hot plate"]
INFERRED = """(unit_type = '00' or (unit_type in ('06', '11', '23', '33') and starts_with(regexp_replace(lower(name), '[^a-z]', '', 'g'), regexp_replace(lower(c.county),
    '[^a-z]', '', 'g'))) or (unit_type = '15' and contains(lower(name), 'ring mud')) or contains(lower(name), 'hot plate'))"""


def j_inputs(t):
    return t("fx_units"), t("fx_counties"), t("fx_counties").where("gx = 0"), COLLEGES, SPECIALS


@query("j1_infer_countywide", f"""select u.county_code, unit_id from fx_units u join fx_counties c on c.county_code = u.county_code
  where c.gx <> 0 and {INFERRED}""")
def j1(t):
    return resolve.infer_countywide(*j_inputs(t))


@query("j2_review", f"""select u.county_code, unit_id, unit_type, name, cast(rate_per_100 as double) as rate_per_100
  from fx_units u join fx_counties c on c.county_code = u.county_code
  where c.gx <> 0 and not {INFERRED} and unit_type in ('06', '11', '12', '15', '18', '23', '27', '28', '33') and rate_per_100 >= 0.05""")
def j2(t):
    return resolve.review_exclusions(*j_inputs(t))


@query("j3_regions", """with recursive n as (select c.county, count(p.uid) as n, c.gx, c.gy from fx_counties c
  left join fx_parcels p on p.county_code = c.county_code group by all), o as (select *, cast(round_even((gy + 25.5) / 1.5, 0) as int) as band
  from n), s as (select *, row_number() over (order by band desc, case when band % 2 = 0 then gx else -gx end, county) as sweep from o),
b as (select count(*) / 8e0 as budget from fx_parcels),
w as (select sweep, n as acc, 0 as region from s where sweep = 1 union all
  select s.sweep, case when w.acc > 0 and w.acc + s.n > budget then s.n else w.acc + s.n end, case when w.acc > 0 and w.acc + s.n > budget then w.region + 1 else w.region end
  from w join s on s.sweep = w.sweep + 1 cross join b)
select s.county, s.n, s.sweep, cast(w.region as int) as region from s join w on w.sweep = s.sweep""")
def j3(t):
    n = t("fx_parcels").groupBy("county_code").agg(F.count("*").alias("n"))
    counts = t("fx_counties").join(n, "county_code", "left").na.fill(0, ["n"]).select("county", "n", (F.col("gy") + 25.5).alias("lat"), F.col("gx").cast("double").alias("lon"))
    budget = t("fx_parcels").count() / 8
    return R.regions(counts, budget).select("county", "n", "sweep", "region")


@query("j6_largest", "select county, count(*) as n from fx_parcels group by county order by n desc, county limit 12")
def j6(t):
    """A report of the 12 largest."""
    return t("fx_parcels").groupBy("county").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "county").limit(12)
