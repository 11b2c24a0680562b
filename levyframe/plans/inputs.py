"""Sources, sinks, cleansing and gates (inventory groups A to C)."""

from __future__ import annotations

from pyspark.sql import functions as F

from levyframe.functions import text as T
from levyframe.operators.tables import recipe_gates
from levyframe.plans.fixtures import query
from levyframe.sources import readers as R
from levyframe.sources import writers as Wr
from levyframe.sources.tables import GateError, new_path, write_gated


WORKBOOK = """select case when unit_type = '40' then ' ' || name || ' **' else name end as name, unit_id, case when rate_per_100 = 0 then null else cast(rate_per_100 as varchar(20)) end as rate
  from fx_units"""


@query("a1_taxing_units", """select tax_year, unit_id, name, county_code, substr(unit_id, 5, 3) as serial, unit_type, cast(rate_per_100 as double) as rate_per_100
  from fx_units""")
def a1(t):
    return R.taxing_units(t.sql(WORKBOOK), 2025)


@query("a1_county_names", "select county_code, name as county from fx_units where substr(unit_id, 5, 3) = '000'")
def a1_names(t):
    return R.county_names(R.taxing_units(t.sql(WORKBOOK), 2025))


RINGS = """array(array(named_struct('x', cx - r, 'y', cy), named_struct('x', cx, 'y', cy - r), named_struct('x', cx + r, 'y', cy), named_struct('x',
    cx, 'y', cy + r)))"""
SQUARES = """array(array(named_struct('x', cast(gx as double), 'y', cast(gy as double)), named_struct('x', gx + 1.0D, 'y', cast(gy as double)), named_struct('x',
    gx + 1.0D, 'y', gy + 1.0D), named_struct('x', cast(gx as double), 'y', gy + 1.0D)))"""


def districts(t):
    return t.sql(f"select poly_id, poly_name, cx, cy, r, {RINGS} as rings from fx_polys")


def city_strips(t):
    """(poly, name, rings): the part of its county that each city covers, which is where fx_located puts its parcels."""
    at = "c.gy + cast(substr(u.city_key, 2) as int)/12.0D"
    return _boxes(t, "fx_city_units", "cast(substr(u.city_key, 2) as int) < 12", "c.gx + 0.0D", "c.gx + 0.75D", at, f"{at} + 1/12.0D")


def school_strips(t):
    """(poly, name, rings) of school districts."""
    at = "c.gx + cast(substr(u.isd_key, 2) as int)/9.0D"
    return _boxes(t, "fx_isd_units", "cast(substr(u.isd_key, 2) as int) < 9", at, f"{at} + 1/9.0D", "c.gy + 0.0D", "c.gy + 1.0D")


def _boxes(t, units, where, x0, x1, y0, y1):
    corner = lambda x, y: f"named_struct('x', {x}, 'y', {y})"
    ring = ", ".join([corner(x0, y0), corner(x1, y0), corner(x1, y1), corner(x0, y1)])
    return t.sql(f"select u.unit_id as poly, u.name, array(array({ring})) as rings from {units} u join fx_counties c on c.county_code = u.county_code where {where}")


def county_squares(t):
    return t.sql(f"select county_code, county, region, gx, gy, {SQUARES} as rings from fx_counties")


@query("a2_boundaries", """select poly_id, poly_name as name, round(cx - r, 6) as x0, round(cy - r, 6) as y0, round(cx + r, 6) as x1, round(cy + r, 6) as y1
  from fx_polys""")
def a2(t):
    from levyframe.functions.geometry import envelope

    return districts(t).select("poly_id", F.col("poly_name").alias("name"), *[F.round(v, 6).alias(k) for k, v in envelope(F.col("rings")).items()])


@query("a3_feature_collection", """select poly_name || ' ' || cast(poly_id as varchar(20)) as name, 'MUD' as type, 4 as n_points, round(cx - r, 6) as x0
  from fx_polys""")
def a3(t):
    rows = districts(t).withColumn("NAME", F.concat_ws(" ", "poly_name", "poly_id")).withColumn("TYPE", F.lit("MUD"))
    line = Wr.feature_lines(rows, "rings", ["NAME", "TYPE"])
    collections = rows.select(F.floor(F.col("poly_id") / 500).alias("file"), line.alias("f")).groupBy("file").agg(F.concat(F.lit('{"type":"FeatureCollection","features":['), F.concat_ws(",", F.collect_list("f")), F.lit("]}")).alias("json"))
    got = R.features(collections)
    return got.select("name", "type", F.size(F.col("rings")[0]).alias("n_points"), F.round(F.col("rings")[0][0]["x"], 6).alias("x0"))


@query("a4_scan_parcels", """select p.uid, b.county, cast(b.base as double) as base from fx_parcels p
  join fx_base b on b.county_code = p.county_code where b.county_code <> '007'""")
def a4(t):
    parts = t.sql("select '48' || lpad(cast(2*cast(county_code as int)+1 as varchar(10)),3,'0') as fips, uid from fx_parcels")
    counties = t.sql("select c.fips, c.county, cast(b.base as decimal(12,6)) as base from fx_counties c join fx_base b on b.county_code = c.county_code where c.county_code <> '007'")
    return R.scan_parcels(parts, counties).select("uid", "county", "base")


@query("a5_parcel_attrs", """select c.county, cast(o_orderkey as varchar(20)) as prop_id, c_name as owner
  from orders join customer on c_custkey = o_custkey join fx_counties c on c.county_code = lpad(cast(o_custkey % 25 as varchar(10)),3,'0')
  where o_orderkey % 29 <> 0""")
def a5(t):
    rows = t.sql("select p.county, p.prop_id, c_name as owner, p.addr, p.x, p.y from fx_parcels p join orders on o_orderkey = uid join customer on c_custkey = o_custkey")
    return rows.where(T.has_real_id(F.col("prop_id"))).select("county", "prop_id", "owner")


EXPORT = """select county, rpad(lpad(prop_id, 12, '0'), 12, ' ') || rpad('2025', 5, ' ') || rpad('', 36, ' ') || rpad(case when length(entity_name) % 9 = 0 then ' ' else entity_code end, 10, ' ') || rpad(entity_name, 50, ' ')
  || rpad('', 35, ' ') || lpad(cast(assessed as varchar(20)), 15, '0') || lpad(cast(assessed - exemptions as varchar(20)), 15, '0')
  || case when assessed % 3 = 0 then rpad('', 120, ' ') || lpad(cast(exemptions as varchar(20)), 15, '0') || lpad('0', 15, '0') || rpad('', 30, ' ') || rpad('HS', 15, ' ') else '' end as line from fx_roll_entities"""
PARSED = """select county, length(entity_name) % 9 <> 0 as ok, prop_id, 2025 as tax_year, entity_code, entity_name, assessed, assessed - exemptions as taxable,
  case when assessed % 3 = 0 then exemptions end as hs_amt, case when assessed % 3 = 0 then cast(0 as bigint) end as ov65_amt, case when assessed % 3 = 0 then 'HS' end as exemptions from fx_roll_entities"""


@query(
    "a6_fixed_width",
    f"""select county, ok, case when ok then case when prop_id = '0' then '0' else prop_id end end as prop_id, case when ok then tax_year else -1 end as tax_year, case when ok then entity_code end as entity_code, case when ok then entity_name end as entity_name,
  case when ok then assessed else -1 end as assessed, case when ok then taxable else -1 end as taxable, coalesce(case when ok then hs_amt end, -1) as hs_amt, coalesce(case when ok then ov65_amt end, -1) as ov65_amt, case when ok then exemptions end as exemptions from ({PARSED}) p""",
)
def a6(t):
    return R.parse_fixed_width(t.sql(EXPORT)).na.fill(-1)


@query(
    "a15_ingest_report",
    f"""select county, count(*) filter (where ok) as n_rows, count(*) filter (where not ok) as n_unparsed, count(distinct prop_id) filter (where ok) as n_properties, count(distinct entity_code) filter (where ok) as n_codes,
  count(distinct entity_code) filter (where ok and regexp_matches(entity_name, '(?i)\\b(fire|esd|emergency)\\b')) as n_fire_codes from ({PARSED}) p group by county""",
)
def a15(t):
    return R.ingest_report(R.parse_fixed_width(t.sql(EXPORT)))


@query("a8_json_report", """select county_code, table_id, name, rate from (select county_code, 1 + row_number() over (partition by county_code order by unit_id) % 3 as table_id,
    name, cast(rate_per_100 as varchar(20)) as rate from fx_units)""")
def a8(t):
    rows = t.sql("select county_code, 1 + row_number() over (partition by county_code order by unit_id) % 3 as table_id, name, cast(rate_per_100 as varchar(20)) as rate from fx_units")
    nested = rows.groupBy("county_code", "table_id").agg(F.collect_list(F.array("name", "rate")).alias("pairs")).groupBy("county_code").agg(F.collect_list(F.struct("table_id", "pairs")).alias("tables"))
    path = new_path(t.spark)
    nested.write.json(path)
    back = t.spark.read.schema("county_code string, tables array<struct<table_id: bigint, pairs: array<array<string>>>>").json(path)
    flat = back.select("county_code", F.explode("tables").alias("x")).select("county_code", "x.table_id", F.explode("x.pairs").alias("p"))
    return flat.select("county_code", "table_id", F.col("p")[0].alias("name"), F.col("p")[1].alias("rate"))


@query("a9_features", "select c.region, count(*) as n from fx_parcels p join fx_counties c on c.county_code = p.county_code group by c.region")
def a9(t):
    rows = t.sql("select c.region, p.uid, p.county, array(array(named_struct('x', x, 'y', y), named_struct('x', x + 0.001D, 'y', y), named_struct('x', x, 'y', y + 0.001D))) as rings from fx_parcels p join fx_counties c on c.county_code = p.county_code")
    path = new_path(t.spark)
    Wr.write_features(rows, path, "region", "rings", ["uid", "county"])
    back = t.spark.read.schema("value string, region string").text(path)
    return back.where(F.get_json_object("value", "$.geometry.type") == "Polygon").groupBy("region").agg(F.count("*").alias("n"))


@query("a10_sharded_tsv", "select substr(c_name, 10, 6) as shard, count(*) as n, min(c_name) as least from customer group by 1")
def a10(t):
    rows = t.sql("select substr(c_name, 10, 6) as shard, c_name as k, concat_ws('\\t', c_name, c_mktsegment) as line from customer")
    path = new_path(t.spark)
    Wr.write_sharded_tsv(rows, path, "shard", "k", "line")
    back = t.spark.read.schema("value string, shard string").text(path)
    return back.groupBy("shard").agg(F.count("*").alias("n"), F.min(F.split("value", "\t")[0]).alias("least"))


@query("a11_upsert", """select county, count(*) as n, max(assessed) as largest from (select county, case when county < 'NATION_2' then assessed + 1 else assessed end as assessed
  from fx_roll_entities) group by county""")
def a11(t):
    path = new_path(t.spark)
    rows = t("fx_roll_entities").select("county", "prop_id", "assessed")
    Wr.upsert_by_partition(rows, path, "county")
    Wr.upsert_by_partition(rows.where("county < 'NATION_2'").withColumn("assessed", F.col("assessed") + 1), path, "county")
    return t.spark.read.schema("prop_id string, assessed bigint, county string").parquet(path).groupBy("county").agg(F.count("*").alias("n"), F.max("assessed").alias("largest"))


@query("a12_reuse", "select county_code, count(*) as n from fx_units group by county_code")
def a12(t):
    path = new_path(t.spark)
    first = Wr.reuse_or_build(t.spark, path, lambda: t("fx_units"))
    again = Wr.reuse_or_build(t.spark, path, lambda: first.limit(0))
    return again.groupBy("county_code").agg(F.count("*").alias("n"))


@query("a14_row_id", "select unnest(range(1, cast(n as bigint) + 1)) as uid from (select 2 * count(*) as n from fx_parcels) x")
def a14(t):
    """Every parcel twice, without its id: rows that repeat have ids of their own."""
    rows = t("fx_parcels").drop("uid")
    return Wr.add_row_id(rows.unionByName(rows)).select("uid")


@query("a16_split", "select uid, cast((row_number() over (order by uid)) % 4 as int) as part from fx_parcels")
def a16(t):
    return Wr.split_interleaved(t("fx_parcels").select("uid"), 4, [F.col("uid")])


@query("a17_search_meta", """select 'owner' as index, cast(count(*) as bigint) as n_rows, count(distinct substr(c_name, 10, 6)) as n_shards, cast(sum(length(c_name)) as bigint) as n_bytes
  from customer""")
def a17(t):
    shards = t.sql("select 'owner' as index, substr(c_name, 10, 6) as shard, count(*) as n, sum(length(c_name)) as bytes from customer group by 2")
    return Wr.search_meta(shards)


def _names(t):
    return t("fx_units").select("unit_id", "name", "unit_type", "county_code")


@query("b1_clean_number", """select uid, cast(regexp_replace(mkt_text, '[^0-9.]', '', 'g') as double) as mkt, try_cast(case when uid % 2 = 0 then '1.2.3' else '' end as double) as bad
  from fx_parcels""")
def b1(t):
    return t("fx_parcels").select("uid", T.clean_number(F.col("mkt_text")).alias("mkt"), T.clean_number(F.when(F.col("uid") % 2 == 0, "1.2.3").otherwise("-x")).alias("bad"))


@query("b2_norm_city", """select unit_id, regexp_replace(replace(regexp_replace(lower(trim(name)), '^(city|town|village) of ', ''), '-', ' '), '\\s+', ' ', 'g') as k
  from fx_units""")
def b2(t):
    return _names(t).select("unit_id", T.norm_city(F.col("name")).alias("k"))


@query("b3_norm_isd", """select unit_id, regexp_replace(regexp_replace(replace(replace(lower(n), 'independent school district', 'isd'), ' county isd', ' isd'),
    '\\bcisd\\b', 'isd', 'g'), '[^a-z0-9]', '', 'g') as k from (select unit_id, case when unit_type = '02' then replace(name, 'ISD',
    'County Independent School District') else name || ' CISD' end as n
  from fx_units)""")
def b3(t):
    name = F.when(F.col("unit_type") == "02", F.replace("name", F.lit("ISD"), F.lit("County Independent School District"))).otherwise(F.concat("name", F.lit(" CISD")))
    return _names(t).select("unit_id", T.norm_isd(name).alias("k"))


@query("b4_norm_county", "select county_code, regexp_replace(lower(county), '[^a-z]', '', 'g') as k from fx_counties")
def b4(t):
    return t("fx_counties").select("county_code", T.norm_county(F.col("county")).alias("k"))


@query("b5_norm_district", """select unit_id, regexp_replace(regexp_replace(regexp_replace(replace(lower(n), 'municipal utility district', 'mud'), '\\bof\\b.*$',
    ''), '\\bnumber\\b|\\bno\\b', '', 'g'), '[^a-z0-9]', '', 'g') as k
  from (select unit_id, replace(name, 'MUD', 'Municipal Utility District No 3 of X County') as n
  from fx_units)""")
def b5(t):
    return _names(t).select("unit_id", T.norm_district(F.replace("name", F.lit("MUD"), F.lit("Municipal Utility District No 3 of X County"))).alias("k"))


STOPS = "('city','of','the','county','area','number','no','district','underground','conservation','co','dist','ranch')"
NORM_ENTITY = f"""array_to_string(list_filter(string_split(regexp_replace(regexp_replace(regexp_replace(lower(NAME), '\\s+\\d{{4,}}\\s*$', ''), '\\((fp|rp|pp|mn|bpp)\\)',
    ' ', 'g'), '[^a-z0-9 ]', ' ', 'g'), ' '), lambda w: w <> '' and w not in {STOPS}), '')"""


@query("b6_norm_entity", f"select county, entity_name, count(*) as n, {NORM_ENTITY.replace('NAME', 'entity_name')} as k from fx_roll_entities group by county, entity_name")
def b6(t):
    return t("fx_roll_entities").groupBy("county", "entity_name").agg(F.count("*").alias("n")).withColumn("k", T.norm_entity(F.col("entity_name")))


@query("b7_numbered_key", """select unit_id, case when regexp_matches(lower(name), 'esd\\s*#?\\s*\\d+') then 'esd' || regexp_extract(lower(name), 'esd\\s*#?\\s*(\\d+)',
    1) end as k from fx_units""")
def b7(t):
    return _names(t).select("unit_id", T.numbered_key(F.col("name")).alias("k"))


def _hint_sql(rules, name="name"):
    return "case " + " ".join(f"when regexp_matches({name}, '(?i){p}') then '{c}'" for c, p in rules) + " end"


@query("b8_type_hint", f"select unit_id, {_hint_sql(T.ROLL_TYPE_RULES)} as roll_hint, {_hint_sql(T.SHEET_TYPE_RULES)} as sheet_hint from fx_units")
def b8(t):
    return _names(t).select("unit_id", T.type_hint(F.col("name"), T.ROLL_TYPE_RULES).alias("roll_hint"), T.type_hint(F.col("name"), T.SHEET_TYPE_RULES).alias("sheet_hint"))


def norm_label_sql(name):
    out = f"regexp_replace(lower({name}), '{T.LABEL_NOISE}', ' ', 'g')"
    for pattern, short in T.LABEL_ABBREVIATIONS:
        out = f"regexp_replace({out}, '{pattern}', '{short}', 'g')"
    return f"regexp_replace({out}, '[^a-z0-9]+', '', 'g')"


@query("b9_norm_label", f"""select unit_id, {norm_label_sql('n')} as k from (select unit_id, '2025 ' || replace(replace(name, 'ISD', 'Independent School District'),
    'ESD #', 'Emergency Services District Number ') || ' Total Rate' as n
  from fx_units)""")
def b9(t):
    name = F.concat(F.lit("2025 "), F.replace(F.replace("name", F.lit("ISD"), F.lit("Independent School District")), F.lit("ESD #"), F.lit("Emergency Services District Number ")), F.lit(" Total Rate"))
    return _names(t).select("unit_id", T.norm_label(name).alias("k"))


@query("b10_search_norm", """select uid, trim(regexp_replace(upper(addr), '[^A-Z0-9]+', ' ', 'g')) as k, regexp_replace('a' || chr(9) || addr || chr(10), '[\\t\\r\\n]+',
    ' ', 'g') as s from fx_parcels""")
def b10(t):
    return t("fx_parcels").select("uid", T.search_norm(F.col("addr")).alias("k"), T.scrub_control(F.concat(F.lit("a\t"), "addr", F.lit("\n"))).alias("s"))


@query("b12_slug_join", "select county_code, lower(replace(county, '_', '-')) as slug from fx_counties")
def b12(t):
    folders = t("fx_counties").select(F.lower(F.replace("county", F.lit("_"), F.lit("-"))).alias("slug"))
    return t("fx_counties").select("county_code", T.slug(F.col("county")).alias("slug")).join(folders, "slug").select("county_code", "slug")


@query("b13_account", "select uid, prop_id as k, uid % 29 <> 0 as has_id from fx_parcels")
def b13(t):
    return t("fx_parcels").select("uid", T.canonical_account(F.concat(F.lit("  00"), "prop_id", F.lit(" "))).alias("k"), T.has_real_id(F.col("prop_id")).alias("has_id"))


@query("b17_links", """select uid, case when county_code in (select county_code from fx_counties
  where gx <> 3) and prop_id <> '0' then 'https://x.example/' || prop_id || '?a' else 'https://fallback.example/' end as link
  from fx_parcels""")
def b17(t):
    links = t.sql("select county_code, 'https://x.example/{id}?a' as template from fx_counties where gx <> 3")
    rows = t("fx_parcels").join(F.broadcast(links), "county_code", "left")
    return rows.select("uid", T.fill_link_template(F.col("template"), F.col("prop_id"), F.lit("https://fallback.example/")).alias("link"))


@query("b18_stacks", "select county_code, name, cast(rate_per_100 as double) as rate, count(*) as n from fx_units where rate_per_100 > 0 group by 1, 2, 3")
def b18(t):
    rows = t("fx_units").groupBy("county_code").agg(F.collect_list(F.struct("name", F.col("rate_per_100").alias("rate"))).alias("stack"))
    back = rows.select("county_code", F.explode(T.parse_stack(T.render_stack(F.col("stack")))).alias("s"))
    return back.groupBy("county_code", F.col("s.name").alias("name"), F.col("s.rate").alias("rate")).agg(F.count("*").alias("n"))


GATES = """select county_code, unit_id from fx_recipes union all select '003', '003-999-00'
  union all select '004', '005-000-00' union all select county_code, unit_id
  from fx_units where county_code = '006'"""


@query(
    "c12_gates",
    f"""with r as ({GATES})
select 'unknown unit' as rule, r.unit_id as detail from r where unit_id not in (select unit_id from fx_units)
union all select 'base', r.county_code || ' ' || cast(sum(u.rate_per_100) as varchar(30)) from r join fx_units u on u.unit_id = r.unit_id group by r.county_code having sum(u.rate_per_100) < 0 or sum(u.rate_per_100) >= 1.8
union all select 'foreign unit', county_code || ' ' || unit_id from r where substr(unit_id, 1, 3) <> county_code
union all select 'counties', cast(count(*) as varchar(20)) from fx_counties having count(*) <> 254""",
)
def c12(t):
    return recipe_gates(t.sql(GATES), t("fx_units").drop("county_code"), t("fx_counties"), 254)


GOOD = "select county_code, unit_id from fx_recipes"
OBSERVED = """select '{}' as load, count(*) as n_rows, count(*) filter (where u.unit_id is null) as n_unknown, count(*) filter (where substr(r.unit_id, 1, 3) <> r.county_code) as n_foreign,
  cast(max(u.rate_per_100) as double) as largest, {} as published from ({}) r left join fx_units u on u.unit_id = r.unit_id"""


@query("c12_observed", f"{OBSERVED.format('given', 'false', GATES)} union all {OBSERVED.format('recipes', 'true', GOOD)}")
def c12_observed(t):
    """Gates that are measured while a table is written: with broken ones nothing is published."""
    metrics = {"n_rows": F.count(F.lit(1)), "n_unknown": F.count_if(F.col("rate_per_100").isNull()), "n_foreign": F.count_if(F.substring("unit_id", 1, 3) != F.col("county_code")), "largest": F.max("rate_per_100").cast("double")}
    gates = {"unknown unit": lambda m: m["n_unknown"] == 0, "foreign unit": lambda m: m["n_foreign"] == 0, "some rows": lambda m: m["n_rows"] > 0}
    rows = []
    for load, body in (("given", GATES), ("recipes", GOOD)):
        loaded, path = t.sql(body).join(t("fx_units").select("unit_id", "rate_per_100"), "unit_id", "left"), new_path(t.spark)
        try:
            seen, published = write_gated(loaded, path, metrics, gates), True
        except GateError as e:
            seen, published = e.metrics, False
        rows.append((load, *(seen[m] for m in metrics), published))
    return t.spark.createDataFrame(rows, "load string, n_rows long, n_unknown long, n_foreign long, largest double, published boolean")


@query(
    "c_filters",
    """select count(*) filter (where prop_id <> '0') as real_ids, count(*) filter (where county in ('NATION_1', 'NATION_2')) as members, count(*) filter (where x between 1.9 and 3.1 and y between 1.9 and 3.1) as in_envelope,
  count(*) filter (where addr is not null) as with_addr from fx_parcels""",
)
def c_filters(t):
    """Filters C2 to C5 on the parcels; the envelope is that of one county, widened by 0.1."""
    rows = t("fx_parcels")
    box = t("fx_counties").where("gx = 2 and gy = 2").agg(F.min("gx").alias("bx0"), (F.max("gx") + 1).alias("bx1"), F.min("gy").alias("by0"), (F.max("gy") + 1).alias("by1"))
    inside = F.col("x").between(F.col("bx0") - 0.1, F.col("bx1") + 0.1) & F.col("y").between(F.col("by0") - 0.1, F.col("by1") + 0.1)
    members = t("fx_counties").where("county_code in ('001', '002')").select("county", F.lit(True).alias("member"))
    joined = rows.join(F.broadcast(box)).join(F.broadcast(members), "county", "left")
    return joined.agg(F.count_if(T.has_real_id(F.col("prop_id"))).alias("real_ids"), F.count_if(F.coalesce("member", F.lit(False))).alias("members"), F.count_if(inside).alias("in_envelope"), F.count_if(F.col("addr").isNotNull()).alias("with_addr"))


@query("c10_buckets", """select county, cast(nominal_rate as double) as nominal_rate, count(*) as n
  from fx_rated where nominal_rate between 0.0001 and 3.5 group by 1, 2
  having count(*) >= 5""")
def c10(t):
    return t("fx_rated").where(F.col("nominal_rate").between(0.0001, 3.5)).groupBy("county", "nominal_rate").agg(F.count("*").alias("n")).where("n >= 5")
