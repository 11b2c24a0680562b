"""Audits of coverage, and published totals taken apart."""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Callable
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from levyframe.sources.tables import materialize

# fixed values: tolerances per $100, the trust that counts, plausible totals, how many special units enter the subsets
RATE_TOLERANCE, TOTAL_TOLERANCE, GAP_TOLERANCE, MIN_TRUST, MIN_SOLVED = 0.0005, 0.0002, 0.0006, 0.6, 0.6
TOTAL_LOW, TOTAL_HIGH, COMBO_RATE, MAX_EXTRAS = 0.4, 4.0, 1.15, 15
COMBO_WORDS = r"(?i)\b(in|out|outside|inside|within)\b.*\b(city|limits?)\b|/|\+|combined|total"
SCHOOL_WORDS = r"(?i)\bisd\b|school"
JOIN_LEAST, COMPLETE_LEAST, LOWER_MOST = 0.80, 0.85, 0.05
EMERGENCY = "40"
# ---- end of fixed values ----


def covered_units(base_units: DataFrame, attached: DataFrame) -> DataFrame:
    """(county_code, unit_id) of base units and of units attached to parcels by place."""
    return base_units.select("county_code", "unit_id").unionByName(attached.select("county_code", "unit_id")).distinct()


def missing_units(units: DataFrame, covered: DataFrame) -> DataFrame:
    """Levying units of each county that nothing covers."""
    return units.where("rate_per_100 > 0").join(covered.select("county_code", "unit_id"), ["county_code", "unit_id"], "left_anti")


def totals_by_type(units: DataFrame) -> DataFrame:
    return units.groupBy("unit_type").agg(F.count("*").alias("n"), F.sum("rate_per_100").cast("decimal(18,6)").alias("total"), F.round(F.avg(F.col("rate_per_100").cast("double")), 6).alias("mean"))


def coverage_audit(units: DataFrame, covered: DataFrame) -> DataFrame:
    """Per county: levying units, missing ones and their rates, and the missing emergency districts' one rate (null if they differ), least and largest."""
    levying = units.where("rate_per_100 > 0").groupBy("county_code").agg(F.count("*").alias("n_levying"))
    gone = missing_units(units, covered)
    emergency = F.when(F.col("unit_type") == EMERGENCY, F.col("rate_per_100"))
    zero = F.lit(0).cast("decimal(12,6)")
    missing = gone.groupBy("county_code").agg(F.count("*").alias("n_missing"), F.sum("rate_per_100").cast("decimal(18,6)").alias("missing_rate"), F.count(emergency).alias("n_emergency"), F.when(F.count_distinct(emergency) == 1, F.min(emergency)).alias("emergency_rate"), F.coalesce(F.min(emergency), zero).alias("emergency_least"), F.coalesce(F.max(emergency), zero).alias("emergency_largest"))
    return levying.join(missing, "county_code", "left").na.fill(0, ["n_missing", "n_emergency"])


def is_combo(label: Column, rate: Column, matched: Column) -> Column:
    """Whether a published row is a total for an area, not one unit's rate."""
    return F.coalesce(label.rlike(COMBO_WORDS), F.lit(False)) | (~matched & (rate >= COMBO_RATE) & ~label.rlike(SCHOOL_WORDS))


def score_tables(rows: DataFrame) -> DataFrame:
    """(county_code, table_id, label, rate, unit_id, rate_per_100; unit_id null if unmatched) -> n_units, agreement, duplicates, score a table.

    A unit that comes again and again marks a table of several years.
    """
    hit = rows.where("unit_id is not null")
    agrees = (F.abs(F.col("rate") - F.col("rate_per_100")) <= RATE_TOLERANCE).cast("double")
    t = hit.groupBy("county_code", "table_id").agg(F.count_distinct("unit_id").alias("n_units"), F.round(F.avg(agrees), 6).alias("agreement"), F.round(1 - F.count_distinct("unit_id") / F.count("*"), 6).alias("duplicates"))
    return t.withColumn("score", F.round(F.col("n_units") * F.col("agreement") * (1 - F.col("duplicates")), 6))


def best_tables(rows: DataFrame) -> DataFrame:
    """The best-scored table of each county, the first id of equals; trust is its agreement."""
    rank = F.row_number().over(Window.partitionBy("county_code").orderBy(F.desc("score"), "table_id"))
    return score_tables(rows).withColumn("rank", rank).where("rank = 1").select("county_code", "table_id", F.col("agreement").alias("trust"), "n_units")


def rate_mismatches(rows: DataFrame, best: DataFrame) -> DataFrame:
    """Single units of trusted tables whose published rate differs."""
    trusted = best.where(F.col("trust") >= MIN_TRUST).select("county_code", "table_id", "trust")
    single = rows.where("unit_id is not null").where(~is_combo(F.col("label"), F.col("rate"), F.lit(True)))
    d = (F.col("rate") - F.col("rate_per_100")).cast("decimal(12,6)")
    return single.join(trusted, ["county_code", "table_id"]).withColumn("delta", d).where(F.abs("delta") > RATE_TOLERANCE).select("county_code", "unit_id", "label", "rate", "rate_per_100", "delta")


def confirmed_missing(missing: DataFrame, rows: DataFrame) -> DataFrame:
    """Missing units, and whether a published sheet has them, at which rate."""
    seen = rows.where("unit_id is not null").groupBy("county_code", "unit_id").agg(F.count("*").alias("n_rows"), F.max("rate").alias("published"))
    return missing.join(seen, ["county_code", "unit_id"], "left").na.fill(0, ["n_rows"])


def top_extras(extras: DataFrame, most: int = MAX_EXTRAS) -> DataFrame:
    """(county_code, extras): each county's special units of largest rate, as an array of (unit_id, rate) in that order."""
    rank = F.row_number().over(Window.partitionBy("county_code").orderBy(F.desc("rate_per_100"), "unit_id"))
    rows = extras.withColumn("rank", rank).where(F.col("rank") <= most)
    return rows.groupBy("county_code").agg(F.array_sort(F.collect_list(F.struct("rank", "unit_id", F.col("rate_per_100").alias("rate")))).alias("extras"))


def subset_sums(extras: DataFrame) -> DataFrame:
    """(county_code, extras) -> a row for each subset: mask, need (its sum, 4 places), rates (sorted), units.  At most 2^MAX_EXTRAS rows a county; spread before they are made."""
    n = F.size("extras")
    masks = extras.select("county_code", "extras", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.greatest(n - 6, F.lit(0))).cast("int") - 1)).alias("high"))
    masks = masks.repartition(extras.sparkSession.sparkContext.defaultParallelism, "county_code", "high").withColumn("mask", F.explode(F.sequence(F.lit(0), F.pow(F.lit(2), F.least(n, F.lit(6))).cast("int") - 1)))
    masks = masks.withColumn("mask", F.col("high") * 64 + F.col("mask"))
    chosen = F.filter("extras", lambda x: F.expr("mask").bitwiseAND(F.pow(F.lit(2), x["rank"] - 1).cast("int")) != 0)
    rows = masks.withColumn("chosen", chosen)
    total = F.aggregate("chosen", F.lit(0).cast("decimal(18,6)"), lambda s, x: (s + x["rate"]).cast("decimal(18,6)"))
    return rows.select("county_code", "mask", F.round(total, 4).cast("decimal(12,4)").alias("need"), F.array_sort(F.transform("chosen", lambda x: x["rate"])).alias("rates"), F.transform("chosen", lambda x: x["unit_id"]).alias("units"))


def _asked(totals: DataFrame, county_rates: DataFrame, schools: DataFrame, cities: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, total, isd_unit, city_unit, need): what the county, each school district and at most one city leave of each total, 4 places."""
    none = totals.select(*keys).distinct().select(*keys, F.lit(None).cast("string").alias("city_unit"), F.lit(0).cast("decimal(12,6)").alias("city_rate"))
    city = cities.select(*keys, F.col("unit_id").alias("city_unit"), F.col("rate_per_100").alias("city_rate")).unionByName(none)
    school = schools.select(*keys, F.col("unit_id").alias("isd_unit"), F.col("rate_per_100").alias("isd_rate"))
    totals, school, city = totals.select(*keys, "total").distinct(), school.distinct(), city.distinct()
    base = totals.join(county_rates.select("county_code", F.col("base").alias("county_rate")), "county_code").join(school, keys).join(city, keys)
    need = F.round(F.col("total") - F.col("county_rate") - F.col("isd_rate") - F.col("city_rate"), 4).cast("decimal(12,4)")
    return base.withColumn("need", need).where("need >= 0").select(*keys, "total", "isd_unit", "city_unit", "need")


def solve_totals(totals: DataFrame, county_rates: DataFrame, schools: DataFrame, cities: DataFrame, subsets: DataFrame, area: tuple[str, ...] = ("county_code",)) -> DataFrame:
    """(county_code, total) -> the ways in which the county, one school district, at most one city and some special units add up to it.

    Ways that differ only in units of equal rates are one; n_ways tells how
    many are left.  area: columns that totals, schools and cities share, where
    a county publishes its totals in parts.
    """
    keys = list(area)
    # subsets of the same rates are one before they are met; of distinct totals and units each way comes once then
    subsets = subsets.groupBy("county_code", "need", "rates").agg(F.min_by("units", "mask").alias("units"))
    one = _asked(totals, county_rates, schools, cities, keys).join(subsets, ["county_code", "need"]).select(*keys, "total", "isd_unit", "city_unit", "rates", "units")
    return one.withColumn("n_ways", F.count("*").over(Window.partitionBy(*keys, "total")))


class Sums:
    """How many choices of rates (as multisets) there are of each sum up to `most`; rates: value (above 0) -> how many units have it.

    These are the coefficients of the product of 1 + x^r + ... + x^mr over all rates r that m units have.  They are kept as
    an array of 64 bits each, and where some may outgrow these, as fields of one long integer, so they are always exact.
    No choice is listed.
    """

    ARRAY_BITS = 64

    def __init__(self, rates: dict[int, int], most: int) -> None:
        self.rates, self.most = {r: m for r, m in rates.items() if r <= most}, most
        need = self._bits()
        if need <= self.ARRAY_BITS:
            self.counts = np.zeros(most + 1, np.uint64)
            self.counts[0] = 1
            for r, m in self.rates.items():
                term = self.counts.copy()
                for j in range(1, min(m, most // r) + 1):
                    self.counts[j * r :] += term[: most + 1 - j * r]
            return
        self.counts, self.width = None, need // 8 + 1
        bits, full = 8 * self.width, 8 * self.width * (most + 1)
        mask, product = (1 << full) - 1, 1
        for r, m in sorted(self.rates.items()):
            term = product
            for _ in range(min(m, most // r)):
                term <<= r * bits
                if term.bit_length() > full:
                    term &= mask
                product += term
        self.fields = product.to_bytes(full // 8, "little")

    def _bits(self) -> int:
        """Bits that no count outgrows: a coefficient is at most the product's value at x, divided by x^sum, for any x below 1."""
        r = np.array(list(self.rates), float)
        m = np.array(list(self.rates.values()), float)
        bound = np.log(m + 1).sum()
        for t in np.logspace(-8, 1, 200):
            bound = min(bound, t * self.most + np.log(np.expm1(-t * r * (m + 1)) / np.expm1(-t * r)).sum())
        return int(bound / np.log(2) + 0.01) + 1

    def at(self, total: int) -> int:
        if not 0 <= total <= self.most:
            return 0
        if self.counts is not None:
            return int(self.counts[total])
        return int.from_bytes(self.fields[total * self.width : (total + 1) * self.width], "little")

    def without(self, r: int, total: int) -> int:
        """The number of choices of a sum that do without a rate, by division of the product by the rate's term."""
        step = (self.rates[r] + 1) * r
        return sum(self.at(s) - self.at(s - r) for s in range(total, -1, -step))

    def only(self, total: int) -> Counter:
        """The one choice there is of a sum: rate -> how often."""
        out = Counter()
        for r in self.rates:
            n = next(j for j in range(self.rates[r] + 1) if self.without(r, total - j * r) == 1)
            if n:
                out[r] = n
        return out


WAYS = "county_code string, need decimal(12,4), ways decimal(38,0), much double, rates array<decimal(12,6)>, units array<string>"


def _count_ways(asked: pa.Table, extras: pa.Table) -> pa.Table:
    """(county_code, need) and (county_code, unit_id, rate_per_100) of one county -> the needs that some choice of units makes, and the choice where it is the only one."""
    units = defaultdict(list)
    for u, r in sorted(zip(extras["unit_id"].to_pylist(), (int(r * 1_000_000) for r in extras["rate_per_100"].to_pylist()), strict=True), key=lambda x: (x[1], x[0] or "")):
        units[r].append(u)
    needs, out = asked["need"].to_pylist(), []
    if needs:
        sums = Sums({r: len(u) for r, u in units.items()}, int(max(needs) * 1_000_000) + 49)
        for need in needs:
            middle = int(need * 1_000_000)
            counts = {s: n for s in range(middle - 50, middle + 50) if (n := sums.at(s))}  # sums that round to it
            ways, rates, chosen = sum(counts.values()), None, None
            if ways == 1:
                some = sorted(sums.only(*counts).items())
                rates, chosen = [Decimal(r).scaleb(-6) for r, n in some for _ in range(n)], [u for r, n in reversed(some) for u in units[r][:n]]
            if ways:
                # beyond 30 digits as a floating number alone
                out.append((asked["county_code"][0].as_py(), need, Decimal(ways) if ways < 10**30 else None, float(ways) if ways.bit_length() < 1024 else float("inf"), rates, chosen))
    kinds = (pa.string(), pa.decimal128(12, 4), pa.decimal128(38, 0), pa.float64(), pa.list_(pa.decimal128(12, 6)), pa.list_(pa.string()))
    columns = zip(*out, strict=True) if out else ((),) * len(kinds)
    return pa.table([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names=["county_code", "need", "ways", "much", "rates", "units"])


def count_ways(totals: DataFrame, county_rates: DataFrame, schools: DataFrame, cities: DataFrame, extras: DataFrame, area: tuple[str, ...] = ("county_code",)) -> DataFrame:
    """As solve_totals, of any number of special units (county_code, unit_id, rate_per_100 above 0): one row a total that has a way.

    n_ways is a double, as it may have hundreds of digits; isd_unit the least of
    all ways.  city_unit, rates and units are those of a single way, else null.
    A county's units are one task's; it keeps a count for each sum up to the
    largest that is asked for, so its memory grows with the counts' digits only,
    its time with units times that.
    """
    keys = list(area)
    asked = materialize(_asked(totals, county_rates, schools, cities, keys))
    extras = extras.select("county_code", "unit_id", "rate_per_100")
    found = asked.select("county_code", "need").distinct().groupBy("county_code").cogroup(extras.groupBy("county_code")).applyInArrow(_count_ways, WAYS)
    rows = asked.join(materialize(found), ["county_code", "need"])
    exact = F.when(F.count("*") == F.count("ways"), F.sum("ways").cast("double"))
    n_ways = F.coalesce(exact, F.aggregate(F.array_sort(F.collect_list("much")), F.lit(0.0), lambda a, b: a + b))
    out = rows.groupBy(*keys, "total").agg(n_ways.alias("n_ways"), *[F.min(c).alias(c) for c in ("isd_unit", "city_unit", "rates", "units")])
    return out.withColumns({c: F.when(F.col("n_ways") == 1, F.col(c)) for c in ("city_unit", "rates", "units")})


def reconcile(solved: DataFrame, area_modes: DataFrame) -> DataFrame:
    """Unique ways against the modal rate of their area (county_code, city_unit, isd_unit, rate): ok, and the gap that units would explain."""
    unique = solved.where("n_ways = 1")
    m = area_modes.select(F.col("county_code").alias("c"), F.col("city_unit").alias("cu"), F.col("isd_unit").alias("iu"), F.col("rate").alias("map_rate"), "n")
    both = unique.join(m, (unique["county_code"] == m["c"]) & unique["city_unit"].eqNullSafe(m["cu"]) & (unique["isd_unit"] == m["iu"]), "left").drop("c", "cu", "iu")
    gap = (F.col("total") - F.col("map_rate")).cast("decimal(12,6)")
    return both.withColumn("gap", gap).withColumn("ok", F.coalesce(F.abs("gap") <= TOTAL_TOLERANCE, F.lit(False)))


def _off(reconciled: DataFrame, trust: DataFrame) -> DataFrame:
    """Unique ways of trusted counties that miss their area's rate; n_totals tells how many unique totals the area has."""
    area = Window.partitionBy("county_code", "isd_unit", "city_unit")
    trusted = trust.where(F.col("trust") >= MIN_TRUST).select("county_code")
    return reconciled.join(trusted, "county_code", "left_semi").withColumn("n_totals", F.count("*").over(area)).where("not ok and gap is not null")


def area_corrections(reconciled: DataFrame, missing: DataFrame, trust: DataFrame) -> DataFrame:
    """Extra rates to apply: unique ways of trusted counties, one total an area, whose missing units make up the gap.

    alternatives: other missing units of the county with the rate and type of
    one of these, which would explain the total as well.
    """
    single = _off(reconciled, trust).where("n_totals = 1 and gap > 0")
    names = ["county_code", "isd_unit", "city_unit", "total", "gap"]
    unit = single.withColumn("unit_id", F.explode("units")).join(missing.select("county_code", "unit_id", "unit_type", F.col("rate_per_100").alias("unit_rate")), ["county_code", "unit_id"])
    out = unit.groupBy(*names).agg(F.sum("unit_rate").cast("decimal(12,6)").alias("extra_rate"), F.array_sort(F.collect_set("unit_id")).alias("extra_units"), F.collect_set(F.struct("unit_rate", "unit_type")).alias("kinds"))
    fits = out.where(F.abs(F.col("extra_rate") - F.col("gap")) <= GAP_TOLERANCE)
    kind = fits.select(*names, F.inline("kinds"), "extra_units")
    same = kind.join(missing.select("county_code", F.col("rate_per_100").alias("unit_rate"), "unit_type", F.col("unit_id").alias("other")), ["county_code", "unit_rate", "unit_type"]).where(~F.array_contains("extra_units", F.col("other")))
    others = same.groupBy("county_code", "total", "isd_unit", F.coalesce("city_unit", F.lit("")).alias("at")).agg(F.array_sort(F.collect_set("other")).alias("alternatives"))
    out = fits.drop("kinds").withColumn("at", F.coalesce("city_unit", F.lit(""))).join(others, ["county_code", "total", "isd_unit", "at"], "left").drop("at")
    return out.withColumn("alternatives", F.coalesce("alternatives", F.array().cast("array<string>")))


CORRECTION = "county_code string, isd_unit string, city_unit string, total decimal(12,4), gap decimal(12,6), extra_rate decimal(12,6), extra_units array<string>, alternatives array<string>, round int"


def correct_until_stable(solved: DataFrame, missing: DataFrame, trust: DataFrame, modes_of: Callable[[DataFrame], DataFrame], most: int = 20) -> DataFrame:
    """All corrections, with the round that found them: each round rates the areas with what is known, and looks for gaps again.

    modes_of(corrections) -> (county_code, city_unit, isd_unit, rate, n), the
    areas' modal rates with these corrections applied.  Ends when a round finds
    none.  Each round's corrections are written; one that finds the same as an
    earlier one did, by a hash of them, would go on for ever and is an error.
    """
    spark, seen = solved.sparkSession, set()
    known = spark.createDataFrame([], CORRECTION)
    for n in range(1, most + 1):
        found = area_corrections(reconcile(solved, modes_of(known)), missing, trust).withColumn("round", F.lit(n))
        found = materialize(found.select([F.col(f.name).cast(f.dataType) for f in known.schema.fields]))
        key = F.xxhash64("county_code", "isd_unit", "city_unit", "total", "extra_rate", "extra_units").cast("decimal(38,0)")
        state = tuple(found.agg(F.count("*"), F.sum(key)).first())
        if not state[0]:
            return known
        if state in seen:
            raise ValueError(f"round {n} finds what an earlier one has found: corrections don't take")
        seen.add(state)
        known = materialize(known.unionByName(found))
    raise ValueError(f"corrections don't settle in {most} rounds")


def correction_areas(corrections: DataFrame, names: DataFrame) -> DataFrame:
    """(county, city_names, isd_names, extra_rate, unit_id) as rates.area_extra takes them, one row a unit of a correction: the rate is the first one's.

    names: county_code, county, unit_id, name of boundaries that stand for a unit; a correction without a city is for land outside any.
    """
    of = names.groupBy("county_code", "county", "unit_id").agg(F.collect_set("name").alias("names"))
    isd = of.select("county_code", "county", F.col("unit_id").alias("isd_unit"), F.col("names").alias("isd_names"))
    city = of.select("county_code", F.col("unit_id").alias("city_unit"), F.col("names").alias("city_names"))
    rows = corrections.join(isd, ["county_code", "isd_unit"]).join(city, ["county_code", "city_unit"], "left")
    rows = rows.where("city_unit is null or city_names is not null").select("county", F.coalesce("city_names", F.array(F.lit(None).cast("string"))).alias("city_names"), "isd_names", "extra_rate", F.posexplode("extra_units").alias("at", "unit_id"))
    return rows.withColumn("extra_rate", F.when(F.col("at") == 0, F.col("extra_rate")).otherwise(0).cast("decimal(12,6)")).drop("at")


def ambiguous_areas(reconciled: DataFrame, trust: DataFrame) -> DataFrame:
    """(county_code, n_ambiguous): totals that are off in areas with several of them, which are not applied."""
    return _off(reconciled, trust).where("n_totals > 1").groupBy("county_code").agg(F.count("*").alias("n_ambiguous"))


def emergency_coverage(solved: DataFrame, units: DataFrame, trust: DataFrame, n_totals: DataFrame) -> DataFrame:
    """(county_code, coverage): none, unknown, countywide, partial or not in the published areas."""
    esd = units.where((F.col("unit_type") == EMERGENCY) & (F.col("rate_per_100") > 0)).groupBy("county_code").agg(F.count("*").alias("n_esd"), F.collect_set("unit_id").alias("esd"))
    has = F.coalesce(F.arrays_overlap("units", "esd"), F.lit(False))
    unique = solved.where("n_ways = 1").join(esd, "county_code", "left")
    seen = unique.groupBy("county_code").agg(F.count("*").alias("n_solved"), F.bool_and(has).alias("every"), F.bool_or(has).alias("some"))
    counties = units.select("county_code").distinct().join(esd.drop("esd"), "county_code", "left").join(trust.select("county_code", "trust"), "county_code", "left").join(seen, "county_code", "left").join(n_totals, "county_code", "left")
    sure = (F.coalesce("trust", F.lit(0.0)) >= MIN_TRUST) & (F.coalesce(F.col("n_solved") / F.col("n_totals"), F.lit(0.0)) >= MIN_SOLVED)
    kind = F.when(F.col("n_esd").isNull(), "none").when(~sure, "unknown").when(F.col("every"), "countywide").when(F.col("some"), "partial").otherwise("not in published areas")
    return counties.select("county_code", kind.alias("coverage"))


def fix_routes(gaps: DataFrame, corrections: DataFrame, rolls: DataFrame, layers: DataFrame) -> DataFrame:
    """(county_code, route) of counties with gaps: the first source there is of area, roll and layer."""
    flag = lambda df, name: df.select("county_code").distinct().withColumn(name, F.lit(True))
    out = gaps.select("county_code").distinct().join(flag(corrections, "area"), "county_code", "left").join(flag(rolls, "roll"), "county_code", "left").join(flag(layers, "layer"), "county_code", "left")
    return out.select("county_code", F.when(F.col("area"), "area").when(F.col("roll"), "roll").when(F.col("layer"), "layer").otherwise("none").alias("route"))


def validate_rolls(parcels: DataFrame, roll_ids: DataFrame, complete: DataFrame, spatial: DataFrame) -> DataFrame:
    """Per county: join rate of parcels with an id, share of roll properties with a complete stack, upper median of roll less place rate, share lower; passes, and why not.

    parcels and roll_ids: county_code, prop_id, real ids only.  complete: county_code, prop_id, roll_rate.  spatial: county_code, prop_id, rate.
    """
    roll_ids, complete = materialize(roll_ids.distinct()), materialize(complete.select("county_code", "prop_id", "roll_rate"))
    joined = parcels.distinct().join(roll_ids.withColumn("here", F.lit(True)), ["county_code", "prop_id"], "left")
    rates = joined.groupBy("county_code").agg(F.count("*").alias("n"), F.round(F.avg(F.col("here").isNotNull().cast("double")), 6).alias("join_rate"))
    whole = roll_ids.join(complete.select("county_code", "prop_id", F.lit(True).alias("whole")), ["county_code", "prop_id"], "left")
    shares = whole.groupBy("county_code").agg(F.round(F.avg(F.col("whole").isNotNull().cast("double")), 6).alias("complete_share"))
    d = complete.join(spatial, ["county_code", "prop_id"]).select("county_code", (F.col("roll_rate") - F.col("rate")).cast("decimal(12,6)").alias("d"))
    # equal deltas as one row with their number, so no task sorts a county's properties
    counted = d.groupBy("county_code", "d").agg(F.count("*").alias("c"))
    county = Window.partitionBy("county_code")
    ranked = counted.withColumn("upto", F.sum("c").over(county.orderBy("d"))).withColumn("m", F.sum("c").over(county))
    lower, known = F.col("d") < -RATE_TOLERANCE, F.sum(F.when(F.col("d").isNotNull(), F.col("c")))
    middle = F.floor(F.col("m") / 2) + 1
    deltas = ranked.groupBy("county_code").agg(F.max(F.when((F.col("upto") >= middle) & (F.col("upto") - F.col("c") < middle), F.col("d"))).alias("middle_delta"), F.round(F.sum(F.when(lower, F.col("c")).otherwise(0)) / known, 6).alias("share_lower"))
    out = rates.join(shares, "county_code", "left").join(deltas, "county_code", "left").na.fill(0.0, ["complete_share"])
    why = {"few parcels join": F.col("join_rate") < JOIN_LEAST, "few complete stacks": F.col("complete_share") < COMPLETE_LEAST, "many lower": F.coalesce(F.col("share_lower") >= LOWER_MOST, F.lit(False))}
    reasons = F.concat_ws("; ", *[F.when(c, F.lit(t)) for t, c in why.items()])
    return out.withColumn("reasons", reasons).withColumn("passes", F.col("reasons") == "")


def run_summary(audit: DataFrame, mismatches: DataFrame, solved: DataFrame) -> DataFrame:
    """One row of headline counts; totals count once a county (and part, if there are parts)."""
    a = audit.agg(F.count("*").alias("n_counties"), F.sum("n_missing").alias("n_missing"), F.sum("n_emergency").alias("n_emergency"))
    m = mismatches.agg(F.count("*").alias("n_mismatches"))
    s = solved.groupBy(*[c for c in solved.columns if c in ("county_code", "part", "total")]).agg(F.max("n_ways").alias("w")).agg(F.count("*").alias("n_solved"), F.count_if(F.col("w") == 1).alias("n_unique"))
    return a.join(F.broadcast(m)).join(F.broadcast(s))
