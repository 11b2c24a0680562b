"""Joins, aggregates, windows and set operations (inventory groups D4 to D16, E, F, G)."""

from __future__ import annotations

from pyspark.sql import functions as F

from levyframe.functions.text import ROLL_TYPE_RULES, SHEET_TYPE_RULES, has_real_id, norm_city, norm_district
from levyframe.operators import documents as D
from levyframe.operators import rates, resolve
from levyframe.operators import tables as O
from levyframe.plans.fixtures import query
from levyframe.plans.inputs import NORM_ENTITY, norm_label_sql, _hint_sql
from levyframe.plans.shapes import PAIRS, neighbours
from levyframe.operators.spatial import both_ways

ADJ = f"(select a, b from ({PAIRS}) union all select b, a from ({PAIRS}))"


def adjacency(t):
    return both_ways(neighbours(t))


@query("d4_boundary_rates", "select uid, cast(coalesce(city_rate, 0) as double) as city_rate from fx_named")
def d4(t):
    rows = t("fx_located").select("uid", "county_code", "city_key")
    return rows.join(t("fx_city_units").select("county_code", "city_key", "rate_per_100"), ["county_code", "city_key"], "left").select("uid", F.coalesce("rate_per_100", F.lit(0)).alias("city_rate"))


@query("d5_owners", """select p.uid, case when p.prop_id <> '0' then c_name end as owner
  from fx_parcels p join orders on o_orderkey = uid join customer on c_custkey = o_custkey""")
def d5(t):
    """Rows without an id are kept out of the join's key."""
    attrs = t.sql("select p.county, p.prop_id as k, c_name as owner from fx_parcels p join orders on o_orderkey = uid join customer on c_custkey = o_custkey where p.prop_id <> '0'")
    rows = t("fx_parcels").withColumn("k", F.when(has_real_id(F.col("prop_id")), F.col("prop_id")).otherwise(F.concat(F.lit("#"), "uid")))
    return rows.join(attrs, ["county", "k"], "left").select("uid", "owner")


AREAS = """select county, city_name, isd_name, cast(count(*) % 7 as decimal(12,6)) / 100 as extra_rate
  from fx_named group by county, city_name, isd_name having count(*) % 3 <> 0"""


@query("d6_null_safe", f"""select n.uid, cast(coalesce(e.extra_rate, 0) as double) as extra_rate
  from fx_named n left join ({AREAS}) e on e.county = n.county and e.city_name is not distinct from n.city_name and e.isd_name is not distinct from n.isd_name""")
def d6(t):
    n, e = t("fx_named").select("uid", "county", "city_name", "isd_name").alias("n"), t.sql(AREAS).alias("e")
    on = (F.col("n.county") == F.col("e.county")) & F.col("n.city_name").eqNullSafe(F.col("e.city_name")) & F.col("n.isd_name").eqNullSafe(F.col("e.isd_name"))
    return n.join(e, on, "left").select("n.uid", F.coalesce("e.extra_rate", F.lit(0)).alias("extra_rate"))


STATS = "round(median(cast(nominal_rate as double)), 4) as rate, count(*) as parcels, cast(round(median(mkt)) as bigint) as value"


LAYER = "select county, base from fx_base union all select 'No parcels', cast(0.5 as decimal(12,6))"


@query("d7_county_layer", f"""select b.county, coalesce(s.rate, round(cast(b.base as double), 4)) as rate, coalesce(s.parcels, 0) as parcels, coalesce(s.value, -1) as value
  from ({LAYER}) b left join (select county, {STATS} from fx_rated
  group by county) s on s.county = b.county""")
def d7(t):
    """A county without parcels shows its base."""
    return rates.layer_stats(t("fx_rated"), ["county"], t.sql(LAYER), "base").na.fill(-1, ["value"])


@query("d8_not_loaded", """select uid, county, addr from fx_parcels where uid % 3 = 0 and not exists (select 1
  from fx_parcels q where q.uid % 3 = 1 and q.county = fx_parcels.county and q.addr is not distinct from fx_parcels.addr)""")
def d8(t):
    rows = t("fx_parcels").select("uid", "county", "addr")
    return O.not_loaded(rows.where("uid % 3 = 0"), rows.where("uid % 3 = 1"), ["county", "addr"])


CITY_PAIRS = """select distinct p.county_code, u.name from fx_counties p join fx_units u on u.unit_type = '03' and (u.county_code = p.county_code or cast(u.county_code as int) % 5 = cast(p.county_code as int) % 7)"""
NORM_CITY = "regexp_replace(replace(regexp_replace(lower(trim(NAME)), '^(city|town|village) of ', ''), '-', ' '), '\\s+', ' ', 'g')"


def tiers_sql(pairs, units, norm):
    return f"""with u as (select county_code as uc, unit_id, rate_per_100, {norm.replace('NAME', 'name')} as k from {units}), v as (select *, count(*) over (partition by k) = 1 as alone from u),
c as (select p.county_code, p.name, v.uc, v.unit_id, v.rate_per_100, case when v.uc = p.county_code then 1 when a.b is not null then 2 when alone then 3 end as tier
  from ({pairs}) p join v on v.k = {norm.replace('NAME', 'p.name')} left join {ADJ} a on a.a = p.county_code and a.b = v.uc),
r as (select *, row_number() over (partition by county_code, name order by tier, uc, unit_id) as n from c where tier is not null)
select p.county_code, p.name, coalesce(tier, 0) as tier, unit_id, cast(rate_per_100 as double) as rate_per_100 from ({pairs}) p left join r on r.county_code = p.county_code and r.name = p.name and r.n = 1"""


@query("d9_resolve_names", tiers_sql(CITY_PAIRS, "(select * from fx_units where unit_type = '03')", NORM_CITY))
def d9(t):
    got = resolve.resolve_names(t.sql(CITY_PAIRS), t("fx_units").where("unit_type = '03'"), adjacency(t), norm_city)
    return got.select("county_code", "name", F.coalesce("tier", F.lit(0)).alias("tier"), "unit_id", "rate_per_100")


@query("a13_unmatched", tiers_sql(CITY_PAIRS, "(select * from fx_units where unit_type = '03')", NORM_CITY).replace("select p.county_code, p.name, coalesce(tier, 0) as tier, unit_id, cast(rate_per_100 as double) as rate_per_100 from", "select p.county_code, p.name from") + " where r.unit_id is null")
def a13(t):
    got = resolve.resolve_names(t.sql(CITY_PAIRS), t("fx_units").where("unit_type = '03'"), adjacency(t), norm_city)
    return got.where("unit_id is null").select("county_code", "name").orderBy("county_code", "name")


DISTRICT_PAIRS = """select distinct county_code, case when length(name) % 2 = 0 then replace(name, 'MUD', 'Municipal Utility District No 7') else name || ' of X' end as name
  from fx_units where unit_type in ('04', '40')"""
NORM_WD = """regexp_replace(regexp_replace(regexp_replace(replace(lower(NAME), 'municipal utility district', 'mud'), '\\bof\\b.*$', ''), '\\bnumber\\b|\\bno\\b',
    '', 'g'), '[^a-z0-9]', '', 'g')"""


@query(
    "d10_resolve_districts",
    f"""with u as (select county_code, unit_id, rate_per_100, {NORM_WD.replace('NAME', 'name')} as k from fx_units where rate_per_100 > 0),
e as (select county_code, k, max(unit_id) as unit_id from u group by 1, 2), b as (select county_code, regexp_replace(k, '[0-9]+', '', 'g') as bare, min(unit_id) as unit_id from u group by 1, 2 having count(*) = 1 and regexp_replace(k, '[0-9]+', '', 'g') <> ''),
p as (select county_code, name, {NORM_WD.replace('NAME', 'name')} as k from ({DISTRICT_PAIRS}) x),
r as (select p.county_code, p.name, coalesce(e.unit_id, b.unit_id) as unit_id from p left join e on e.county_code = p.county_code and e.k = p.k left join b on b.county_code = p.county_code and b.bare = regexp_replace(p.k, '[0-9]+', '', 'g'))
select r.county_code, r.name, r.unit_id, cast(u.rate_per_100 as double) as rate_per_100 from r join u on u.unit_id = r.unit_id where r.unit_id not in (select unit_id from fx_units where unit_type = '40' and length(name) % 3 = 0)""",
)
def d10(t):
    base = t.sql("select county_code, unit_id from fx_units where unit_type = '40' and length(name) % 3 = 0")
    return resolve.resolve_districts(t.sql(DISTRICT_PAIRS), t("fx_units"), base, norm_district)


ENTITIES = """select distinct r.county, c.county_code, r.entity_name as name
  from fx_roll_entities r join fx_counties c on c.county = r.county
  where r.entity_code <> 'CAD'"""


ENTITY_MATCH = f"""with u as (select county_code as uc, unit_id, name as unit_name, unit_type, rate_per_100, {NORM_ENTITY.replace('NAME', 'name')} as un, case when regexp_matches(lower(name), 'esd\\s*#?\\s*\\d+') then regexp_extract(lower(name), 'esd\\s*#?\\s*(\\d+)', 1) end as unum from fx_units where rate_per_100 > 0),
a as (select county_code, name, {NORM_ENTITY.replace('NAME', 'name')} as n, {_hint_sql(ROLL_TYPE_RULES)} as hint, case when regexp_matches(lower(name), 'esd\\s*#?\\s*\\d+') then regexp_extract(lower(name), 'esd\\s*#?\\s*(\\d+)', 1) end as num from ({ENTITIES}) x),
p as (select a.*, county_code as uc, 1 as pool from a union all select a.*, j.b as uc, 2 as pool from a join {ADJ} j on j.a = a.county_code),
x as (select p.county_code, p.name, pool, u.uc, unit_id, unit_name, unit_type, rate_per_100, coalesce(unit_type = hint, false) as typed, hint from p join u on u.uc = p.uc and u.un = p.n),
y as (select *, row_number() over (partition by county_code, name, pool order by typed desc, uc, unit_id) as k, coalesce(hint in ('00', '03') and not bool_or(typed) over w and bool_or(unit_type in ('00', '03')) over w, false) as trap from x window w as (partition by county_code, name, pool)),
s1 as (select county_code, name, pool, 1 as stage, unit_id, unit_name, unit_type, rate_per_100 from y where k = 1 and not trap),
z as (select p.county_code, p.name, p.pool, unit_id, unit_name, unit_type, rate_per_100, row_number() over (partition by p.county_code, p.name, p.pool order by u.uc, unit_id) as k from p join u on u.uc = p.uc and u.unum = p.num where not exists (select 1 from y where y.county_code = p.county_code and y.name = p.name and y.pool = p.pool)),
s as (select *, row_number() over (partition by county_code, name order by pool, stage) as k from (select * from s1 union all select county_code, name, pool, 2, unit_id, unit_name, unit_type, rate_per_100 from z where k = 1))
select county_code, name, pool, stage, unit_id, unit_name, unit_type, rate_per_100 from s where k = 1"""


@query("d11_match_entities", f"select * replace (cast(rate_per_100 as double) as rate_per_100) from ({ENTITY_MATCH}) m")
def d11(t):
    """Stages 1 and 2; the ratio is beyond SQL and tested by hand."""
    names = t.sql(ENTITIES).select("county_code", "name").distinct()
    got = resolve.match_entities(names, t("fx_units"), adjacency(t), t("fx_counties"), with_ratio=False).where("unit_id is not null and not retried")
    return got.select("county_code", "name", "pool", "stage", "unit_id", "unit_name", "unit_type", "rate_per_100")


@query("h6_match_with_ratio")
def h6(t):
    names = t.sql(ENTITIES).select("county_code", F.concat(F.col("name"), F.lit("X")).alias("name")).distinct()
    return resolve.match_entities(names, t("fx_units"), adjacency(t), t("fx_counties"))


LABELS = """select distinct county_code, case when unit_type = '02' then name || ' SBL' when unit_type = '40' then '2025 ' || name else upper(name) end as label
  from fx_units"""


@query(
    "d12_match_labels",
    f"""with u as (select county_code, unit_id, unit_type, {norm_label_sql('name')} as pn from fx_units), l as (select county_code, label, {norm_label_sql('label')} as cn, {_hint_sql(SHEET_TYPE_RULES, 'label')} as hint from ({LABELS}) x),
b as (select l.county_code, label, unit_id, case when cn = pn then 3e0 when starts_with(cn, pn) or starts_with(pn, cn) then 2e0 * least(length(cn), length(pn)) / greatest(length(cn), length(pn)) when contains(cn, pn) or contains(pn, cn) then 1.5e0 * least(length(cn), length(pn)) / greatest(length(cn), length(pn)) end
   + case when hint is null then 0 when hint = unit_type then 0.8e0 else -0.8e0 end as score from l join u on u.county_code = l.county_code where cn <> '' and pn <> ''),
r as (select *, row_number() over (partition by county_code, label order by score desc, unit_id) as k from b where score >= 1.4)
select l.county_code, l.label, r.unit_id, round(coalesce(r.score, 0), 6) as score from l left join r on r.county_code = l.county_code and r.label = l.label and k = 1""",
)
def d12(t):
    got = resolve.match_labels(t.sql(LABELS), t("fx_units"))
    return got.select("county_code", "label", "unit_id", F.round(F.coalesce("score", F.lit(0.0)), 6).alias("score"))


# what stands for a county in pages: the beginning of one page's headline
HEADLINES = "select c.county, substr(p.html, instr(p.html, '<h1>') + 4, 9) as k from fx_counties c join pages p on p.page_id = cast(c.county_code as int)"


@query("d13_mentions_of_counties", f"""select p.page_id, h.county from pages p join ({HEADLINES}) h on contains(replace(lower(p.html), ' ', ''), replace(lower(h.k), ' ', ''))""")
def d13(t):
    return D.named_in(t("pages"), "page_id", "html", t.sql(HEADLINES), "county")


@query("d14_unit_bridge", """select county_code, unit_id, string_agg(name, '|' order by name) as names
  from (select distinct county_code, unit_id, n as name from (select county_code, unit_id, name as n
  from fx_units union all select county_code, unit_id, upper(name)
  from fx_units)) group by 1, 2""")
def d14(t):
    names = t("fx_units").select("county_code", "unit_id", F.explode(F.array("name", F.upper("name"))).alias("name"))
    return names.groupBy("county_code", "unit_id").agg(F.array_join(F.array_sort(F.collect_set("name")), "|").alias("names"))


@query("d15_coverage", """select p.county_code, count(*) as n, count(*) filter (where r.prop_id is not null) as joined, round(avg(case when r.prop_id is not null then 1e0 else 0e0 end),
    6) as join_rate from (select distinct county_code, prop_id
  from fx_parcels where prop_id <> '0') p left join (select distinct prop_id
  from fx_roll_entities where assessed % 2 = 0) r on r.prop_id = p.prop_id
  group by 1""")
def d15(t):
    p = t("fx_parcels").where(has_real_id(F.col("prop_id"))).select("county_code", "prop_id").distinct()
    r = t("fx_roll_entities").where("assessed % 2 = 0").select("prop_id").distinct().withColumn("here", F.lit(True))
    return p.join(r, "prop_id", "left").groupBy("county_code").agg(F.count("*").alias("n"), F.count_if("here").alias("joined"), F.round(F.avg(F.col("here").isNotNull().cast("double")), 6).alias("join_rate"))


@query("d16_curated_wins", """select county_code, 'curated' as kind from fx_counties where gx = 1
  union all select county_code, 'derived' from fx_counties where gx <> 1 and gy > 0""")
def d16(t):
    c = t("fx_counties").where("gx = 1").select("county_code", F.lit("curated").alias("kind"))
    return O.curated_wins(c, t("fx_counties").where("gy > 0").select("county_code", F.lit("derived").alias("kind")), "county_code")


@query("e1_county_base", "select county_code, cast(base as double) as base from fx_base")
def e1(t):
    return rates.county_base(t("fx_recipes"), t("fx_units"))


@query("e2_rate_summary", """select county, count(*) as n, cast(min(nominal_rate) as double) as least, round(median(cast(nominal_rate as double)), 6) as middle,
    cast(max(nominal_rate) as double) as largest from fx_rated
  group by county""")
def e2(t):
    return rates.rate_summary(t("fx_rated"), "county").orderBy(F.desc("n"))


@query("e3_district_stats", f"select county, isd_name, {STATS} from fx_rated where isd_name is not null group by county, isd_name")
def e3(t):
    rated = t("fx_rated").where("isd_name is not null")
    return rates.layer_stats(rated, ["county", "isd_name"], rated.select("county", "isd_name").distinct())


@query("e5_medians_of_medians", """with m as (select county, median(cast(nominal_rate as double)) as m
  from fx_rated group by county) select (select round(median(cast(nominal_rate as double)), 6)
  from fx_rated) as middle, (select round(stddev_samp(cast(nominal_rate as double)), 6)
  from fx_rated) as sd, round(median(m), 6) as group_middle, round(stddev_samp(m), 6) as group_sd
  from m""")
def e5(t):
    return rates.spread_of_medians(t("fx_rated"), "county")


@query("e7_conditional_counts", """select county, count(*) filter (where city_name is null) as outside, count(distinct isd_name) as n_isd, count(*) filter (where prop_id = '0') as no_id
  from fx_rated group by county""")
def e7(t):
    return t("fx_rated").groupBy("county").agg(F.count_if(F.col("city_name").isNull()).alias("outside"), F.count_distinct("isd_name").alias("n_isd"), F.count_if(F.col("prop_id") == "0").alias("no_id"))


@query("e8_representatives", """with p as (select county, entity_code, min(assessed % 4) as part
  from fx_roll_entities group by 1, 2) select r.county, r.entity_code, min(entity_name) as entity_name, min(assessed) as assessed
  from fx_roll_entities r join p on p.county = r.county and p.entity_code = r.entity_code and r.assessed % 4 = p.part
  group by 1, 2""")
def e8(t):
    return O.first_part_wins(t("fx_roll_entities").withColumn("part", F.col("assessed") % 4), ["county", "entity_code"], "part", ["entity_name", "assessed"]).select("county", "entity_code", "entity_name", "assessed")


@query("e9_histogram", "select county, city_name, isd_name, cast(round(nominal_rate, 6) as double) as rate, count(*) as n from fx_rated group by all")
def e9(t):
    return t("fx_rated").groupBy("county", "city_name", "isd_name", F.round("nominal_rate", 6).alias("rate")).agg(F.count("*").alias("n"))


@query("e10_mode", """with h as (select county, cast(nominal_rate as double) as rate, count(*) as n
  from fx_rated group by 1, 2), r as (select *, row_number() over (partition by county order by n desc, rate) as k
  from h) select county, rate, n from r where k = 1""")
def e10(t):
    h = t("fx_rated").groupBy("county", F.col("nominal_rate").alias("rate")).agg(F.count("*").alias("w"))
    return O.mode(h, ["county"], "rate", "w")


@query("e11_uniform", """select county_code, unit_type, coalesce(case when count(distinct rate_per_100) = 1 then cast(min(rate_per_100) as double) end, -1) as uniform,
    cast(min(rate_per_100) as double) as least, cast(max(rate_per_100) as double) as largest
  from fx_units group by 1, 2""")
def e11(t):
    return O.uniform_value(t("fx_units"), ["county_code", "unit_type"], "rate_per_100").na.fill({"uniform": -1})


@query("e13_entity_frequency", """select entity_code, entity_name, count(*) as n from fx_roll_entities
  group by 1, 2 order by n desc, entity_code, entity_name limit 15""")
def e13(t):
    """A report of the 15 most frequent."""
    return t("fx_roll_entities").groupBy("entity_code", "entity_name").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "entity_code", "entity_name").limit(15)


@query("e16_categories", "select unit_type, count(*) as n, count(*) filter (where rate_per_100 > 0) as levying from fx_units group by 1")
def e16(t):
    return t("fx_units").groupBy("unit_type").agg(F.count("*").alias("n"), F.count_if(F.col("rate_per_100") > 0).alias("levying"))


@query("f1_dedup", """with d as (select *, row_number() over (partition by county, prop_id, addr order by city_name nulls last, isd_name nulls last, uid) as k
  from (select uid, county, case when prop_id = '0' then '0' else substr(prop_id, 1, 3) end as prop_id, addr, city_name, isd_name
  from fx_named)) select uid, county, prop_id, addr from d where prop_id = '0' or k = 1""")
def f1(t):
    rows = t("fx_named").withColumn("prop_id", F.when(F.col("prop_id") == "0", "0").otherwise(F.substring("prop_id", 1, 3)))
    return O.dedup_real_ids(rows, ["county", "prop_id", "addr"], [F.col("city_name").asc_nulls_last(), F.col("isd_name").asc_nulls_last(), F.col("uid")]).select("uid", "county", "prop_id", "addr")


@query("f2_samples", """select county, uid, rank from (select county, uid, row_number() over (partition by county order by mkt desc nulls last, uid) as rank
  from fx_located where prop_id <> '0') where rank <= 5""")
def f2(t):
    """Five samples a county, of largest value."""
    return O.top_per_group(t("fx_located").where(has_real_id(F.col("prop_id"))), "county", 5, "mkt", "uid").select("county", "uid", "rank")


@query("f3_one_sample", "select county, min(uid) as uid from fx_located where mkt > 200000 group by county")
def f3(t):
    return t("fx_located").where("mkt > 200000").groupBy("county").agg(F.min("uid").alias("uid"))


@query("f7_gaps", """select county_code, unit_id, cast(rate_per_100 as double) as rate_per_100
  from fx_units where unit_type = '40' order by rate_per_100 desc, unit_id limit 200""")
def f7(t):
    """A report of the 200 largest."""
    return t("fx_units").where("unit_type = '40'").select("county_code", "unit_id", "rate_per_100").orderBy(F.desc("rate_per_100"), "unit_id").limit(200)


@query("f11_first_seen", "select entity_name, min(assessed * 100000 + cast(prop_id as bigint)) as position from fx_roll_entities group by 1")
def f11(t):
    rows = t("fx_roll_entities").withColumn("position", F.col("assessed") * 100000 + F.col("prop_id").cast("long"))
    return O.first_seen(rows.select("entity_name", "position"), "entity_name", "position")


@query("g2_difference", "select county_code, unit_id from fx_units where rate_per_100 > 0 except select county_code, unit_id from fx_recipes")
def g2(t):
    return t("fx_units").where("rate_per_100 > 0").select("county_code", "unit_id").exceptAll(t("fx_recipes")).distinct()


@query("g3_union", "select county_code, unit_id from fx_recipes union select county_code, unit_id from fx_units where unit_type in ('11', '40')")
def g3(t):
    return t("fx_recipes").unionByName(t("fx_units").where("unit_type in ('11', '40')").select("county_code", "unit_id")).distinct()


@query("g4_distinct_pairs", "select distinct county, city_name, isd_name from fx_named")
def g4(t):
    return t("fx_named").select("county", "city_name", "isd_name").distinct()


@query("g5_labels_of_two", """select a.county_code as a, b.county_code as b, count(*) as n from fx_counties a
  join fx_counties b on b.gx = a.gx + 1 and b.gy = a.gy join (select distinct county_code, name
  from fx_units) u on u.county_code = a.county_code or u.county_code = b.county_code
  group by 1, 2 having count(*) < 0 union all select a.county_code, b.county_code, (select count(distinct name)
  from fx_units u where u.county_code in (a.county_code, b.county_code))
  from fx_counties a join fx_counties b on b.gx = a.gx + 1 and b.gy = a.gy""")
def g5(t):
    c = t("fx_counties")
    pairs = c.alias("p").join(c.alias("q"), (F.col("q.gx") == F.col("p.gx") + 1) & (F.col("q.gy") == F.col("p.gy"))).select(F.col("p.county_code").alias("a"), F.col("q.county_code").alias("b"))
    stacks = t("fx_units").groupBy(F.col("county_code").alias("uid")).agg(F.collect_list(F.struct("name", F.col("rate_per_100").alias("rate"))).alias("stack"))
    both = rates.compare_parcels(pairs, stacks)
    return both.select("a", "b", "name").distinct().groupBy("a", "b").agg(F.count("*").alias("n"))
