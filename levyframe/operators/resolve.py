"""Names to taxing units.

Names are few and facts are many, so all of this runs on distinct (county,
name) pairs, and the results are joined back.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyframe.functions.similarity import ratio
from levyframe.functions.text import ROLL_TYPE_RULES, SHEET_TYPE_RULES, norm_county, norm_entity, norm_label, numbered_key, type_hint
from levyframe.sources.tables import materialize

LEVYING = "rate_per_100 > 0"
# fixed values: thresholds of the ratio stage, and scores of the label match
RATIO, RATIO_OTHER_TYPE, TYPE_BONUS = 0.88, 0.9, 0.05
EQUAL, PREFIX, PART, HINT, ACCEPT = 3.0, 2.0, 1.5, 0.8, 1.4


def _best(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).where("__rank = 1").drop("__rank")


def resolve_names(pairs: DataFrame, units: DataFrame, adjacency: DataFrame, normalise: Callable[[Column], Column]) -> DataFrame:
    """Distinct (county_code, name) -> also tier, unit_id, rate_per_100; null where nothing fits.

    Tier 1 is a unit of the same normalised name in the county itself, 2 in an
    adjacent one, 3 the only such unit of the state.  Of several in a tier the
    first (county, unit id) holds.  adjacency: a, b, both ways.
    """
    have = units.select(F.col("county_code").alias("uc"), "unit_id", "rate_per_100", normalise(F.col("name")).alias("k"))
    have = have.withColumn("alone", F.count("*").over(Window.partitionBy("k")) == 1)
    asked = pairs.withColumn("k", normalise(F.col("name")))
    near = adjacency.select(F.col("a").alias("county_code"), F.col("b").alias("uc"), F.lit(True).alias("near"))
    found = asked.join(have, "k").join(near, ["county_code", "uc"], "left")
    tier = F.when(F.col("uc") == F.col("county_code"), 1).when(F.col("near"), 2).when(F.col("alone"), 3)
    best = _best(found.withColumn("tier", tier).where("tier is not null"), ["county_code", "name"], [F.col("tier"), F.col("uc"), F.col("unit_id")])
    return pairs.join(best.select("county_code", "name", "tier", "unit_id", "rate_per_100"), ["county_code", "name"], "left")


def resolve_districts(pairs: DataFrame, units: DataFrame, base_units: DataFrame, normalise: Callable[[Column], Column]) -> DataFrame:
    """Distinct (county_code, name) -> unit_id, rate_per_100 of the unit whose normalised name is the same, else, without
    digits, the one unit of the county for which that holds; units already in the county's base are left out.

    Of units of one county and name the last (by unit id) holds.
    """
    have = units.where(LEVYING).select("county_code", "unit_id", "rate_per_100", normalise(F.col("name")).alias("k"))
    exact = have.groupBy("county_code", "k").agg(F.max_by(F.struct("unit_id", "rate_per_100"), "unit_id").alias("exact"))
    bare = have.withColumn("bare", F.regexp_replace("k", "[0-9]+", "")).groupBy("county_code", "bare").agg(F.count("*").alias("n"), F.min(F.struct("unit_id", "rate_per_100")).alias("one")).where("n = 1 and bare <> ''")
    asked = pairs.withColumn("k", normalise(F.col("name"))).withColumn("bare", F.regexp_replace("k", "[0-9]+", ""))
    both = asked.join(exact, ["county_code", "k"], "left").join(bare.drop("n"), ["county_code", "bare"], "left")
    unit = both.select("county_code", "name", F.coalesce("exact", "one").alias("u")).where("u is not null").select("county_code", "name", "u.unit_id", "u.rate_per_100")
    return unit.join(base_units.select("county_code", "unit_id").distinct(), ["county_code", "unit_id"], "left_anti").select("county_code", "name", "unit_id", "rate_per_100")


def similar_candidates(asked: DataFrame, have: DataFrame, least: float) -> DataFrame:
    """asked (uc, n, ..) beside have (uc, un, ..) for all pairs of one uc whose difflib ratio may reach `least`, and few others.

    A ratio of `least` leaves at most d = (1 - least) times both lengths
    unmatched.  Cut into d + 1 parts, n keeps one whole in what is matched, at a
    place of un that is off by no more than what is unmatched before it.  So
    pairs meet on a part and un's length, and no pair is lost.
    """
    la, lb = F.length("n"), F.col("lb")
    asked = asked.withColumn("__id", F.xxhash64(*asked.columns))
    low, high = F.ceil(la * (least / (2 - least)) - 1e-9).cast("int"), F.floor(la * ((2 - least) / least) + 1e-9).cast("int")
    sized = asked.select("__id", "uc", "n", F.explode(F.sequence(low, high)).alias("lb")).withColumn("d", F.floor((la + lb) * (1 - least) + 1e-9).cast("int"))
    cut = lambda i: F.floor(i * la / (F.col("d") + 1)).cast("int")
    parts = F.transform(F.sequence(F.lit(0), F.col("d")), lambda i: F.struct(F.substring(F.col("n"), cut(i) + 1, cut(i + 1) - cut(i)).alias("part"), cut(i).alias("at")))
    parts = sized.select("__id", "uc", "lb", (lb - la).alias("more"), "d", F.inline(parts)).where("part <> '' or lb = 0")
    longest = math.ceil(1 / ((1 - least) * (1 + least / (2 - least))))
    lu = F.length("un")
    of_size = lambda k: F.when(lu >= k, F.transform(F.sequence(F.lit(0), lu - k), lambda p: F.struct(F.substring(F.col("un"), p + 1, F.lit(k)).alias("part"), p.alias("place")))).otherwise(F.array().cast("array<struct<part:string,place:int>>"))
    empty = F.when(lu == 0, F.array(F.struct(F.lit("").alias("part"), F.lit(0).alias("place")))).otherwise(F.array().cast("array<struct<part:string,place:int>>"))
    texts = have.select("uc", "un").distinct()
    placed = texts.select("uc", "un", lu.alias("lb"), F.inline(F.concat(empty, *[of_size(k) for k in range(1, longest + 1)])))
    off = F.col("place") - F.col("at")
    near = parts.join(placed, ["uc", "lb", "part"]).where((off >= -F.floor((F.col("d") - F.col("more")) / 2)) & (off <= F.floor((F.col("d") + F.col("more")) / 2)))
    pairs = near.select("__id", "uc", "un").distinct()
    return pairs.join(asked, ["__id", "uc"]).drop("__id").join(have, ["uc", "un"])


def _entity_stages(asked: DataFrame, units: DataFrame, adjacency: DataFrame, with_ratio: bool) -> DataFrame:
    """(county_code, name, label) -> the best unit and its stage for label; label is what is compared."""
    have = units.where(LEVYING).select(F.col("county_code").alias("uc"), "unit_id", F.col("name").alias("unit_name"), "unit_type", "rate_per_100", norm_entity(F.col("name")).alias("un"), numbered_key(F.col("name")).alias("unum"))
    own = asked.select("county_code", "name", "label").withColumn("uc", F.col("county_code")).withColumn("pool", F.lit(1))
    near = asked.join(adjacency.select(F.col("a").alias("county_code"), F.col("b").alias("uc")), "county_code").select("county_code", "name", "label", "uc", F.lit(2).alias("pool"))
    pools = own.unionByName(near).withColumn("n", norm_entity(F.col("label"))).withColumn("num", numbered_key(F.col("label"))).withColumn("hint", type_hint(F.col("label"), ROLL_TYPE_RULES))
    keys, rest = ["county_code", "name", "pool"], ["unit_id", "unit_name", "unit_type", "rate_per_100"]
    same = pools.join(have.withColumnRenamed("un", "n"), ["uc", "n"])
    typed = F.coalesce(F.col("unit_type") == F.col("hint"), F.lit(False))
    group = Window.partitionBy(*keys)
    # the same text for a county and its city: a hint that no candidate meets rules the pool out
    trap = F.col("hint").isin("00", "03") & ~F.max(typed).over(group) & F.max(F.col("unit_type").isin("00", "03")).over(group)
    exact = materialize(_best(same.withColumn("trap", F.coalesce(trap, F.lit(False))), keys, [F.desc(typed), F.col("uc"), F.col("unit_id")]))
    stage1 = exact.where("not trap").select(*keys, F.lit(1).alias("stage"), *rest)
    free = pools.join(exact.select(*keys), keys, "left_anti")
    number = free.where("num is not null").join(have.withColumnRenamed("unum", "num"), ["uc", "num"])
    stage2 = materialize(_best(number, keys, [F.col("uc"), F.col("unit_id")]).select(*keys, F.lit(2).alias("stage"), *rest))
    out = stage1.unionByName(stage2)
    if with_ratio:
        left = free.join(stage2.select(*keys), keys, "left_anti")
        close = similar_candidates(left, have, RATIO)
        # one ratio a pair of texts, however many counties have it
        texts = close.select("n", "un").distinct().repartition("n").withColumn("r", ratio(F.col("n"), F.col("un"))).where(F.col("r") >= RATIO)
        scored = close.join(texts, ["n", "un"]).where(typed | (F.col("r") >= RATIO_OTHER_TYPE)).withColumn("score", F.col("r") + F.when(typed, TYPE_BONUS).otherwise(0.0))
        out = out.unionByName(_best(scored, keys, [F.desc("score"), F.col("uc"), F.col("unit_id")]).select(*keys, F.lit(3).alias("stage"), *rest))
    return _best(out, ["county_code", "name"], [F.col("pool"), F.col("stage")])


def match_entities(names: DataFrame, units: DataFrame, adjacency: DataFrame, counties: DataFrame, with_ratio: bool = True) -> DataFrame:
    """Distinct (county_code, name) of rolls -> pool, stage, retried, unit_id, unit_name, unit_type, rate_per_100; null where nothing fits.

    The county's own units come before adjacent counties' (pool 1, 2).  Stages:
    1 the same normalised text, of the hinted type first; 2 the same number of
    an emergency district; 3 a ratio that is high enough.  What finds nothing
    is tried once more with its county's name before it, if it lacks that.
    with_ratio=False leaves stage 3 out.
    """
    # small tables that every stage reads
    names, units, adjacency = (materialize(x) for x in (names, units, adjacency))
    first = materialize(_entity_stages(names.withColumn("label", F.col("name")), units, adjacency, with_ratio).withColumn("retried", F.lit(False)))
    missing = names.join(first.select("county_code", "name"), ["county_code", "name"], "left_anti").join(counties.select("county_code", "county"), "county_code")
    has_county = F.concat(F.lit(" "), F.regexp_replace(F.lower("name"), "[^a-z0-9_]+", " "), F.lit(" ")).contains(F.concat(F.lit(" "), F.regexp_replace(F.lower("county"), "[^a-z0-9_]+", " "), F.lit(" ")))
    again = missing.where(~has_county).withColumn("label", F.concat("county", F.lit(" County "), "name"))
    second = _entity_stages(materialize(again.select("county_code", "name", "label")), units, adjacency, with_ratio).withColumn("retried", F.lit(True))
    return names.join(first.unionByName(second), ["county_code", "name"], "left")


def _parts(c: Column) -> Column:
    """All parts of a text that are long enough for a prefix of a unit of the hinted type to be accepted."""
    n = F.length(c)
    least = F.greatest(F.lit(1), F.ceil(n * ((ACCEPT - HINT) / PREFIX) - 1e-9).cast("int"))
    of_size = lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(c, i, k))
    return F.array_distinct(F.flatten(F.transform(F.sequence(least, n), of_size)))


def match_labels(labels: DataFrame, units: DataFrame) -> DataFrame:
    """Distinct (county_code, label) of published sheets -> score, unit_id, unit_name, unit_type, rate_per_100 of the best unit of the county; null below ACCEPT.

    Equal names score highest, then one that begins the other, then one inside
    the other, each by the share of the longer that is explained; a hinted type
    adds or takes away.  The first unit id holds among equals.
    """
    have = units.select("county_code", "unit_id", F.col("name").alias("unit_name"), "unit_type", "rate_per_100", norm_label(F.col("name")).alias("pn")).where("pn <> ''")
    # units of one county, name and type score alike, so only the first can be the best
    have = materialize(have.groupBy("county_code", "pn", "unit_type").agg(F.min_by(F.struct("unit_id", "unit_name", "rate_per_100"), "unit_id").alias("u")).select("county_code", "pn", "unit_type", "u.*"))
    asked = materialize(labels.withColumn("cn", norm_label(F.col("label"))).withColumn("hint", type_hint(F.col("label"), SHEET_TYPE_RULES)).where("cn <> ''"))
    # one contains the other: the shorter is one of the longer's parts of at least the length that can reach ACCEPT;
    # parts are many times what Spark takes their table for, so they are never broadcast
    texts, names = asked.select("county_code", "cn").distinct(), have.select("county_code", "pn").distinct()
    longer = texts.select("county_code", "cn", F.explode(_parts(F.col("cn"))).alias("pn")).hint("merge").join(names, ["county_code", "pn"]).select("county_code", "cn", "pn")
    shorter = names.select("county_code", "pn", F.explode(_parts(F.col("pn"))).alias("cn")).hint("merge").join(texts, ["county_code", "cn"]).select("county_code", "cn", "pn")
    both = materialize(longer.unionByName(shorter).distinct()).hint("merge").join(asked, ["county_code", "cn"]).hint("merge").join(have, ["county_code", "pn"])
    share = F.least(F.length("cn"), F.length("pn")) / F.greatest(F.length("cn"), F.length("pn"))
    begins = F.col("cn").startswith(F.col("pn")) | F.col("pn").startswith(F.col("cn"))
    inside = F.col("cn").contains(F.col("pn")) | F.col("pn").contains(F.col("cn"))
    plain = F.when(F.col("cn") == F.col("pn"), EQUAL).when(begins, PREFIX * share).when(inside, PART * share)
    hinted = F.when(F.col("hint").isNull(), 0.0).when(F.col("hint") == F.col("unit_type"), HINT).otherwise(-HINT)
    scored = both.withColumn("score", plain + hinted).where(F.col("score") >= ACCEPT)
    best = _best(scored, ["county_code", "label"], [F.desc("score"), F.col("unit_id")])
    return labels.join(best.select("county_code", "label", "score", "unit_id", "unit_name", "unit_type", "rate_per_100"), ["county_code", "label"], "left")


# fixed values: which unit types cover a county whole if they bear its name, and which are worth a review if left out
NAMED_TYPES, COLLEGE_TYPE = ("06", "11", "23", "33"), "15"
REVIEWED_TYPES, REVIEWED_RATE = ("06", "11", "12", "15", "18", "23", "27", "28", "33"), 0.05


def _countywide(units: DataFrame, counties: DataFrame, curated: DataFrame, colleges: list[str], specials: list[str]) -> DataFrame:
    rows = units.join(counties.select("county_code", "county"), "county_code").join(curated.select("county_code").distinct(), "county_code", "left_anti")
    low = F.lower("name")
    listed = lambda names: F.coalesce(*[F.when(low.contains(n), True) for n in names], F.lit(False)) if names else F.lit(False)
    own = F.col("unit_type") == "00"
    named = F.col("unit_type").isin(*NAMED_TYPES) & norm_county(F.col("name")).startswith(norm_county(F.col("county")))
    return rows.withColumn("countywide", own | named | ((F.col("unit_type") == COLLEGE_TYPE) & listed(colleges)) | listed(specials))


def infer_countywide(units: DataFrame, counties: DataFrame, curated: DataFrame, colleges: list[str], specials: list[str]) -> DataFrame:
    """(county_code, unit_id) of units that cover their whole county; curated counties are left to their recipe."""
    return _countywide(units, counties, curated, colleges, specials).where("countywide").select("county_code", "unit_id")


def review_exclusions(units: DataFrame, counties: DataFrame, curated: DataFrame, colleges: list[str], specials: list[str]) -> DataFrame:
    """Units left out whose type and rate make a second look worth while."""
    rows = _countywide(units, counties, curated, colleges, specials)
    return rows.where(~F.col("countywide") & F.col("unit_type").isin(*REVIEWED_TYPES) & (F.col("rate_per_100") >= REVIEWED_RATE)).select("county_code", "unit_id", "unit_type", "name", "rate_per_100")
