"""Audits, reconciliation and validation (inventory group I)."""

from __future__ import annotations

from pyspark.sql import functions as F

from levyframe.functions.text import has_real_id
from levyframe.operators import rates
from levyframe.operators import reconcile as R
from levyframe.plans.fixtures import query
from levyframe.plans.rating import ROLL, nominal, rated, roll
from levyframe.sources.tables import materialize

COVERED = """select county_code, unit_id from fx_recipes union select county_code, unit_id
  from fx_units where unit_type in ('02', '03') union select county_code, unit_id
  from fx_units where unit_type = '40' and length(name) % 2 = 0"""
MISSING = f"select * from fx_units where rate_per_100 > 0 and unit_id not in (select unit_id from ({COVERED}) c)"
# published sheets: each county's units in two tables, the second with old rates and units twice
SHEETS = """select county_code, 1 as table_id, case when unit_type = '03' and length(name) % 4 = 0 then name || ' in city limits' else name end as label, case when rate_per_100 between 0.1 and 0.11 then rate_per_100 + 0.01 else rate_per_100 end as rate, unit_id, rate_per_100 from fx_units
union all select county_code, 2, name, rate_per_100 + 0.002, unit_id, rate_per_100 from fx_units union all select county_code, 2, name, rate_per_100, unit_id, rate_per_100 from fx_units"""


def missing(t):
    return R.missing_units(t("fx_units"), R.covered_units(t("fx_recipes"), t.sql(COVERED)))


def sheets(t):
    return t.sql(SHEETS).withColumn("rate", F.col("rate").cast("decimal(12,6)"))


@query("i1_missing_units", f"select county_code, unit_id, cast(rate_per_100 as double) as rate_per_100 from ({MISSING}) m")
def i1(t):
    return missing(t).select("county_code", "unit_id", "rate_per_100")


@query("i1_coverage_audit", f"""select l.county_code, n_levying, coalesce(n_missing, 0) as n_missing, coalesce(n_emergency, 0) as n_emergency, coalesce(missing_rate,
    0) as missing_rate, coalesce(u, -1) as emergency_rate, coalesce(lo, -1) as emergency_least, coalesce(hi, -1) as emergency_largest
  from (select county_code, count(*) as n_levying from fx_units
  where rate_per_100 > 0 group by 1) l left join (select county_code, count(*) as n_missing, cast(sum(rate_per_100) as double) as missing_rate,
    count(*) filter (where unit_type = '40') as n_emergency, case when count(distinct rate_per_100) filter (where unit_type = '40') = 1 then cast(min(rate_per_100) filter (where unit_type = '40') as double) end as u,
    coalesce(cast(min(rate_per_100) filter (where unit_type = '40') as double), 0) as lo, coalesce(cast(max(rate_per_100) filter (where unit_type = '40') as double),
    0) as hi from ({MISSING}) m group by 1) x on x.county_code = l.county_code""")
def i1_audit(t):
    a = R.coverage_audit(t("fx_units"), R.covered_units(t("fx_recipes"), t.sql(COVERED)))
    d = lambda c, v: F.coalesce(F.col(c).cast("double"), F.lit(v)).alias(c)
    return a.select("county_code", "n_levying", "n_missing", "n_emergency", d("missing_rate", 0.0), d("emergency_rate", -1.0), d("emergency_least", -1.0), d("emergency_largest", -1.0))


@query("e12_totals_by_type", f"""select unit_type, count(*) as n, cast(sum(rate_per_100) as double) as total, round(avg(cast(rate_per_100 as double)), 6) as mean
  from ({MISSING}) m group by 1""")
def e12(t):
    return R.totals_by_type(missing(t)).orderBy(F.desc("total"))


SCORES = f"""select county_code, table_id, count(distinct unit_id) as n_units, round(avg(case when abs(rate - rate_per_100) <= 0.0005 then 1e0 else 0e0 end),
    6) as agreement, round(1 - count(distinct unit_id) / count(*), 6) as duplicates
  from ({SHEETS}) s group by 1, 2"""


@query("i3_table_scores", f"select *, round(n_units * agreement * (1 - duplicates), 6) as score from ({SCORES}) x")
def i3(t):
    return R.score_tables(sheets(t))


BEST = f"""select county_code, table_id, agreement as trust, n_units from (select *, row_number() over (partition by county_code order by round(n_units * agreement * (1 - duplicates),
    6) desc, table_id) as k from ({SCORES}) x) y where k = 1"""


@query("i3_best_tables", BEST)
def i3_best(t):
    return R.best_tables(sheets(t))


COMBO = "regexp_matches(label, '(?i)\\b(in|out|outside|inside|within)\\b.*\\b(city|limits?)\\b|/|\\+|combined|total')"


@query("i4_combos", f"select county_code, unit_id, {COMBO} as combo from ({SHEETS}) s where table_id = 1")
def i4(t):
    return sheets(t).where("table_id = 1").select("county_code", "unit_id", R.is_combo(F.col("label"), F.col("rate"), F.lit(True)).alias("combo"))


MISMATCHES = f"""select s.county_code, unit_id, label, cast(rate as double) as rate, cast(rate_per_100 as double) as rate_per_100, cast(cast(rate - rate_per_100 as decimal(12,6)) as double) as delta
  from ({SHEETS}) s join ({BEST}) b on b.county_code = s.county_code and b.table_id = s.table_id
  where trust >= 0.6 and not {COMBO} and abs(rate - rate_per_100) > 0.0005"""


@query("i5_rate_mismatches", MISMATCHES)
def i5(t):
    s = sheets(t)
    return R.rate_mismatches(s, R.best_tables(s))


@query("i6_confirmed_missing", f"""select m.county_code, m.unit_id, coalesce(p.n, 0) as n_rows, coalesce(p.rate, -1) as published
  from ({MISSING}) m left join (select county_code, unit_id, count(*) as n, cast(max(rate) as double) as rate
  from ({SHEETS}) s group by 1, 2) p on p.county_code = m.county_code and p.unit_id = m.unit_id""")
def i6(t):
    return R.confirmed_missing(missing(t), sheets(t)).select("county_code", "unit_id", "n_rows", F.coalesce(F.col("published").cast("double"), F.lit(-1.0)).alias("published"))


# fifteen special units of largest rate a county; its totals are published in parts of 28 units each, and made of the county,
# a school, perhaps a city, and some of these
EXTRAS = """select county_code, unit_id, unit_type, rate_per_100, row_number() over (partition by county_code order by rate_per_100 desc, unit_id) as rank
  from fx_units where unit_type in ('40', '04') and rate_per_100 > 0 qualify rank <= 15"""
PART = "cast(floor(cast(split_part(unit_id, '-', 2) || split_part(unit_id, '-', 4) as int) / 28) as int) as part"
SCHOOLS = f"select county_code, {PART}, unit_id, rate_per_100 from fx_units where unit_type = '02' and rate_per_100 > 0"
CITIES = f"select county_code, {PART}, unit_id, rate_per_100 from fx_units where unit_type = '03' and rate_per_100 > 0"
NUMBERED = "select *, row_number() over (partition by county_code, part order by unit_id) as k from"
TOTALS = f"""select distinct s.county_code, s.part, cast(round(b.base + s.rate_per_100 + coalesce(c.rate_per_100, 0) + coalesce(x.rate_per_100, 0) + coalesce(y.rate_per_100, 0), 4) as decimal(12,4)) as total
 from ({NUMBERED} ({SCHOOLS}) a) s join fx_base b on b.county_code = s.county_code
 left join ({NUMBERED} ({CITIES}) e) c on c.county_code = s.county_code and c.part = s.part and c.k = s.k and s.k % 2 = 0
 left join ({EXTRAS}) x on x.county_code = s.county_code and x.rank = s.k
 left join ({EXTRAS}) y on y.county_code = s.county_code and y.rank = s.k + 2 and s.k % 3 = 0"""
SUBSETS = f"""with e as ({EXTRAS}), m as (select county_code, count(*) as n from e group by 1),
 k as (select county_code, unnest(range(0, cast(pow(2, n) as bigint))) as mask from m)
 select k.county_code, k.mask, cast(round(coalesce(sum(e.rate_per_100), 0), 4) as decimal(12,4)) as need,
  coalesce(string_agg(cast(e.rate_per_100 as varchar), ',' order by e.rate_per_100), '') as rates, count(e.unit_id) as n_units
 from k left join e on e.county_code = k.county_code and (k.mask & cast(pow(2, e.rank - 1) as bigint)) <> 0 group by 1, 2"""


def subsets(t):
    return R.subset_sums(R.top_extras(t("fx_units").where("unit_type in ('40', '04') and rate_per_100 > 0")))


@query("i7_subset_sums", f"select county_code, cast(mask as bigint) as mask, cast(need as double) as need, n_units from ({SUBSETS}) s")
def i7(t):
    return subsets(t).select("county_code", F.col("mask").cast("long").alias("mask"), "need", F.size("units").cast("long").alias("n_units"))


SOLVED = f"""select county_code, part, total, isd_unit, city_unit, rates, count(*) over (partition by county_code, part, total) as n_ways, any_value(mask) as mask from (
 select distinct t.county_code, t.part, t.total, s.unit_id as isd_unit, c.unit_id as city_unit, x.rates,
  min(x.mask) over (partition by t.county_code, t.part, t.total, s.unit_id, c.unit_id, x.rates) as mask
 from ({TOTALS}) t join fx_base b on b.county_code = t.county_code join ({SCHOOLS}) s on s.county_code = t.county_code and s.part = t.part
 join (select county_code, part, unit_id, rate_per_100 from ({CITIES}) q union all select distinct county_code, part, null, 0 from ({SCHOOLS}) v) c on c.county_code = t.county_code and c.part = t.part
 join ({SUBSETS}) x on x.county_code = t.county_code and x.need = round(t.total - b.base - s.rate_per_100 - c.rate_per_100, 4)) z group by 1, 2, 3, 4, 5, 6"""


# the same of all special units: how many choices of rates make each sum, unit by unit, up to the largest sum that is asked for
ALL_EXTRAS = "select county_code, unit_id, unit_type, rate_per_100 from fx_units where unit_type in ('40', '04') and rate_per_100 > 0"
ALL_TOTALS = TOTALS.replace(EXTRAS, f"select *, row_number() over (partition by county_code order by rate_per_100 desc, unit_id) as rank from ({ALL_EXTRAS}) a")
COUNTED = f"""with recursive w as (select distinct t.county_code, t.part, t.total, s.unit_id as isd_unit, c.unit_id as city_unit, cast(round(t.total - b.base - s.rate_per_100 - c.rate_per_100, 4) * 10000 as bigint) as need
 from ({ALL_TOTALS}) t join fx_base b on b.county_code = t.county_code join ({SCHOOLS}) s on s.county_code = t.county_code and s.part = t.part
 join (select county_code, part, unit_id, rate_per_100 from ({CITIES}) q union all select distinct county_code, part, null, 0 from ({SCHOOLS}) v) c on c.county_code = t.county_code and c.part = t.part),
lim as (select county_code, max(need) * 100 + 49 as most from w where need >= 0 group by 1),
x as (select county_code, cast(rate_per_100 * 1000000 as bigint) as r, list(unit_id order by unit_id) as us, row_number() over (partition by county_code order by rate_per_100 desc) as d from ({ALL_EXTRAS}) e group by county_code, rate_per_100),
y as (select county_code, d, r * j as r, us[1:j] as us from (select *, unnest(range(0, len(us) + 1)) as j from x) z),
dp as (select county_code, cast(0 as bigint) as d, cast(0 as bigint) as s, cast(1 as hugeint) as n, cast([] as varchar[]) as units, most from lim
 union all
 select p.county_code, y.d, p.s + y.r, cast(sum(p.n) as hugeint), case when sum(p.n) = 1 then any_value(list_concat(p.units, y.us)) end, p.most from dp p join y on y.county_code = p.county_code and y.d = p.d + 1 and p.s + y.r <= p.most group by 1, 2, 3, 6),
g as (select dp.county_code, (s + 50) // 100 as need, sum(n) as n, case when sum(n) = 1 then any_value(units) end as units from dp
 left join (select county_code, max(d) as last from x group by 1) k on k.county_code = dp.county_code where d = coalesce(last, 0) group by 1, 2)
select w.county_code, part, total, sum(n) as n_ways, min(isd_unit) as isd_unit, case when sum(n) = 1 then any_value(city_unit) end as city_unit, case when sum(n) = 1 then any_value(units) end as units
 from w join g on g.county_code = w.county_code and g.need = w.need group by 1, 2, 3"""


def totals(t):
    return t.sql(TOTALS.replace(EXTRAS, f"select * from ({EXTRAS.replace(' qualify rank <= 15', '')}) w where rank <= 15"))


def solved(t):
    ways = R.solve_totals(totals(t), t("fx_base").select("county_code", "base"), t.sql(SCHOOLS), t.sql(CITIES), materialize(subsets(t)), area=("county_code", "part"))
    return materialize(ways)


def all_totals(t):
    return t.sql(ALL_TOTALS)


def counted(t):
    """Totals and their ways by all special units of a county."""
    return materialize(R.count_ways(all_totals(t), t("fx_base").select("county_code", "base"), t.sql(SCHOOLS), t.sql(CITIES), t.sql(ALL_EXTRAS), area=("county_code", "part")))


@query("i8_solve_totals", f"""select county_code, part, cast(total as double) as total, cast(n_ways as double) as n_ways, isd_unit, cast(n_ways as double) as n
  from ({COUNTED}) s""")
def i8(t):
    return counted(t).select("county_code", "part", "total", "n_ways", "isd_unit", F.col("n_ways").alias("n"))


MODES = """select n.county_code, n.city_unit, n.isd_unit, cast(round(b.base + coalesce(n.city_rate, 0) + n.isd_rate, 6) as decimal(12,6)) as rate,
    count(*) as n from fx_named n join fx_base b on b.county_code = n.county_code
  where n.isd_unit is not null group by 1, 2, 3, 4"""


def modes(t):
    """MODES, counted by the parcels' keys before these are named."""
    areas = materialize(t("fx_located").groupBy("county_code", "city_key", "isd_key").agg(F.count("*").alias("n")))
    city = t("fx_city_units").select("county_code", "city_key", F.col("unit_id").alias("city_unit"), F.col("rate_per_100").alias("city_rate"))
    isd = t("fx_isd_units").select("county_code", "isd_key", F.col("unit_id").alias("isd_unit"), F.col("rate_per_100").alias("isd_rate"))
    rows = areas.join(isd, ["county_code", "isd_key"]).join(city, ["county_code", "city_key"], "left").join(t("fx_base").select("county_code", "base"), "county_code")
    rate = F.round(F.col("base") + F.coalesce("city_rate", F.lit(0)) + F.col("isd_rate"), 6).cast("decimal(12,6)")
    return rows.groupBy("county_code", "city_unit", "isd_unit", rate.alias("rate")).agg(F.sum("n").alias("n"))


def reconciled(solved):
    return f"""select s.*, m.rate as map_rate, cast(s.total - m.rate as decimal(12,6)) as gap, coalesce(abs(s.total - m.rate) <= 0.0002, false) as ok
 from (select * from ({solved}) q where n_ways = 1) s
 left join ({MODES}) m on m.county_code = s.county_code and m.city_unit is not distinct from s.city_unit and m.isd_unit = s.isd_unit"""


RECONCILED = reconciled(SOLVED)


@query("i9_reconcile", f"""select county_code, cast(total as double) as total, isd_unit, city_unit, coalesce(cast(map_rate as double), -1) as map_rate, ok
  from ({RECONCILED}) r""")
def i9(t):
    r = R.reconcile(solved(t), modes(t))
    return r.select("county_code", "total", "isd_unit", "city_unit", F.coalesce(F.col("map_rate").cast("double"), F.lit(-1.0)).alias("map_rate"), "ok")


@query(
    "i10_emergency_coverage",
    f"""with s as (select * from ({COUNTED}) q where n_ways = 1), h as (select s.county_code, exists (select 1 from ({ALL_EXTRAS}) e where e.county_code = s.county_code and list_contains(s.units, e.unit_id) and e.unit_type = '40') as has from s),
seen as (select county_code, count(*) as n_solved, bool_and(has) as every, bool_or(has) as part from h group by 1),
n as (select county_code, count(*) as n_totals from ({ALL_TOTALS}) t group by 1),
esd as (select county_code, count(*) as n_esd from fx_units where unit_type = '40' and rate_per_100 > 0 group by 1)
select u.county_code, case when n_esd is null then 'none' when coalesce(trust, 0) < 0.6 or coalesce(n_solved / n_totals, 0) < 0.6 then 'unknown'
  when every then 'countywide' when part then 'partial' else 'not in published areas' end as coverage
from (select distinct county_code from fx_units) u left join esd on esd.county_code = u.county_code left join ({BEST}) b on b.county_code = u.county_code
left join seen on seen.county_code = u.county_code left join n on n.county_code = u.county_code""",
)
def i10(t):
    n = all_totals(t).groupBy("county_code").agg(F.count("*").alias("n_totals"))
    return R.emergency_coverage(counted(t), t("fx_units"), R.best_tables(sheets(t)), n)


def off(reconciled):
    return f"""select * from (select r.*, count(*) over (partition by county_code, isd_unit, city_unit) as n_totals from ({reconciled}) r
  where county_code in (select county_code from ({BEST}) b where trust >= 0.6)) o where not ok and gap is not null"""


def i11_sql(off, chosen):
    """chosen: what joins the units of a way (s) to the extras (e)."""
    return f"""with s as (select * from ({off}) o where n_totals = 1 and gap > 0),
u as (select s.*, g.unit_id, g.unit_type, g.rate_per_100 as unit_rate from s join {chosen}
      join ({MISSING}) g on g.unit_id = e.unit_id),
f as (select county_code, isd_unit, city_unit, total, gap, sum(unit_rate) as extra_rate, string_agg(unit_id, ',' order by unit_id) as extra_units from u
      group by 1, 2, 3, 4, 5 having abs(sum(unit_rate) - gap) <= 0.0006)
select f.county_code, f.isd_unit, f.city_unit, cast(total as double) as total, cast(gap as double) as gap, cast(extra_rate as double) as extra_rate, extra_units,
  coalesce((select string_agg(distinct a.unit_id, ',' order by a.unit_id) from ({MISSING}) a join u on u.county_code = a.county_code and u.unit_rate = a.rate_per_100 and u.unit_type = a.unit_type
    where u.county_code = f.county_code and u.isd_unit = f.isd_unit and u.city_unit is not distinct from f.city_unit and u.total = f.total and not contains(f.extra_units, a.unit_id)), '') as alternatives
from f"""


I11 = i11_sql(off(RECONCILED), f"({EXTRAS}) e on e.county_code = s.county_code and (s.mask & cast(pow(2, e.rank - 1) as bigint)) <> 0")
ALL_OFF = off(reconciled(COUNTED))
ALL_I11 = i11_sql(ALL_OFF, f"({ALL_EXTRAS}) e on e.county_code = s.county_code and list_contains(s.units, e.unit_id)")


@query("i11_area_corrections", I11)
def i11(t):
    out = R.area_corrections(R.reconcile(solved(t), modes(t)), missing(t), R.best_tables(sheets(t)))
    return out.withColumn("extra_units", F.array_join("extra_units", ",")).withColumn("alternatives", F.array_join("alternatives", ","))


def corrections(t, solved=solved):
    """Gaps found and applied until none is left; the areas' modal rates are those of the map with what is known so far."""
    named, base = materialize(t("fx_named").where("isd_unit is not null").select("county_code", "city_unit", "isd_unit", "city_rate", "isd_rate")), t("fx_base").select("county_code", "base")

    def modes_of(known):
        extra = known.groupBy("county_code", F.col("city_unit").alias("c"), F.col("isd_unit").alias("i")).agg(F.sum("extra_rate").alias("extra_rate"))
        areas = named.groupBy("county_code", "city_unit", "isd_unit", "city_rate", "isd_rate").agg(F.count("*").alias("n")).join(base, "county_code")
        e = extra.withColumnRenamed("county_code", "k")
        areas = areas.join(e, (F.col("k") == F.col("county_code")) & F.col("c").eqNullSafe(F.col("city_unit")) & (F.col("i") == F.col("isd_unit")), "left")
        rate = (F.col("base") + F.coalesce("city_rate", F.lit(0)) + F.col("isd_rate") + F.coalesce("extra_rate", F.lit(0))).cast("decimal(12,6)")
        return areas.groupBy("county_code", "city_unit", "isd_unit", rate.alias("rate")).agg(F.sum("n").alias("n"))

    return R.correct_until_stable(solved(t), materialize(missing(t)), materialize(R.best_tables(sheets(t))), modes_of)


@query("i11_fixed_point", f"select county_code, isd_unit, city_unit, total, extra_rate, extra_units, 1 as round from ({I11}) f")
def i11_fixed_point(t):
    """All gaps are found in the first round; with them applied, the next finds none."""
    return corrections(t).select("county_code", "isd_unit", "city_unit", "total", "extra_rate", F.array_join("extra_units", ",").alias("extra_units"), "round")


FOUND = f"""select a.county, a.city_name, a.isd_name, sum(cast(f.extra_rate as decimal(12,6))) as extra_rate, string_agg(distinct f.extra_units, '; ') as units from ({ALL_I11}) f
 join (select distinct county, county_code, city_unit, city_name, isd_unit, isd_name from fx_named where isd_unit is not null) a
   on a.county_code = f.county_code and a.isd_unit = f.isd_unit and a.city_unit is not distinct from f.city_unit group by 1, 2, 3"""


@query("h8_corrected", f"select uid, cast(nominal_rate as double) as nominal_rate, cast(isd_rate as double) as isd_rate, roll_verified from ({nominal(FOUND)}) x")
def h8_corrected(t):
    """The build with the corrections that the audit finds, in place of given ones."""
    n = t("fx_named")
    names = n.select("county_code", "county", F.col("city_unit").alias("unit_id"), F.col("city_name").alias("name")).unionByName(n.select("county_code", "county", F.col("isd_unit").alias("unit_id"), F.col("isd_name").alias("name")))
    found = rates.area_extra(R.correction_areas(corrections(t, counted), names.where("unit_id is not null").distinct()))
    return rated(t, corrections=materialize(found)).select("uid", "nominal_rate", "isd_rate", "roll_verified")


@query("i11_ambiguous", f"select county_code, count(*) as n_ambiguous from ({ALL_OFF}) o where n_totals > 1 group by 1")
def i11_ambiguous(t):
    return R.ambiguous_areas(R.reconcile(counted(t), modes(t)), R.best_tables(sheets(t)))


@query("i12_fix_routes", f"""select county_code, case when county_code in (select county_code
  from fx_counties where gx = 0) then 'area' when county_code in (select county_code
  from ({ROLL}) r) then 'roll' when county_code in (select county_code
  from fx_counties where gx = 4) then 'layer' else 'none' end as route
  from ({MISSING}) m group by 1""")
def i12(t):
    c = t("fx_counties")
    return R.fix_routes(missing(t), c.where("gx = 0"), roll(t), c.where("gx = 4"))


REAL = "prop_id <> '0'"
ROLL_IDS = f"select distinct c.county_code, e.prop_id from fx_roll_entities e join fx_counties c on c.county = e.county where e.{REAL}"


@query(
    "i13_validate_rolls",
    f"""with p as (select distinct county_code, prop_id from fx_rated where {REAL}), i as ({ROLL_IDS}), w as ({ROLL}),
j as (select p.county_code, count(*) as n, round(avg(case when i.prop_id is null then 0e0 else 1e0 end), 6) as join_rate from p left join i on i.county_code = p.county_code and i.prop_id = p.prop_id group by 1),
c as (select i.county_code, round(avg(case when w.prop_id is null then 0e0 else 1e0 end), 6) as complete_share from i left join w on w.county_code = i.county_code and w.prop_id = i.prop_id group by 1),
d as (select w.county_code, cast(w.roll_rate - r.nominal_rate as decimal(12,6)) as d from w join fx_rated r on r.county_code = w.county_code and r.prop_id = w.prop_id and r.{REAL}),
k as (select *, row_number() over (partition by county_code order by d) as k, count(*) over (partition by county_code) as m from d),
x as (select county_code, cast(max(d) filter (where k = m // 2 + 1) as double) as middle_delta, round(avg(case when d < -0.0005 then 1e0 else 0e0 end), 6) as share_lower from k group by 1),
o as (select j.county_code, n, join_rate, coalesce(complete_share, 0) as complete_share, middle_delta, share_lower,
  concat_ws('; ', case when join_rate < 0.8 then 'few parcels join' end, case when coalesce(complete_share, 0) < 0.85 then 'few complete stacks' end, case when share_lower >= 0.05 then 'many lower' end) as reasons
  from j left join c on c.county_code = j.county_code left join x on x.county_code = j.county_code)
select *, reasons = '' as passes from o""",
)
def i13(t):
    p = t("fx_rated").where(has_real_id(F.col("prop_id")))
    ids = t("fx_roll_entities").join(t("fx_counties").select("county", "county_code"), "county").select("county_code", "prop_id").where(has_real_id(F.col("prop_id")))
    place = p.select("county_code", "prop_id", F.col("nominal_rate").alias("rate"))
    return R.validate_rolls(p.select("county_code", "prop_id"), ids, roll(t), place)


@query(
    "i15_run_summary",
    f"""select (select count(distinct county_code) from fx_units where rate_per_100 > 0) as n_counties, (select count(*) from ({MISSING}) m) as n_missing, (select count(*) from ({MISSING}) m where unit_type = '40') as n_emergency,
  (select count(*) from ({MISMATCHES}) m) as n_mismatches, (select count(*) from (select distinct county_code, part, total from ({COUNTED}) s) d) as n_solved,
  (select count(*) from (select distinct county_code, part, total from ({COUNTED}) s where n_ways = 1) d) as n_unique""",
)
def i15(t):
    s = sheets(t)
    return R.run_summary(R.coverage_audit(t("fx_units"), R.covered_units(t("fx_recipes"), t.sql(COVERED))), R.rate_mismatches(s, R.best_tables(s)), counted(t))
