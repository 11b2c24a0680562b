"""Cleansing and normalising of names, numbers and rate stacks.

Every function takes a column and returns one.  Null in, null out, unless said
otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---- fixed values: abbreviations and spellings that published names use ----
CITY_PREFIX = r"^(city|town|village) of "
ISD_LONG_FORMS = (
    ("independent school district", "isd"),
    ("municipal school district", "msd"),
    ("consolidated common school district", "ccsd"),
    ("common school district", "csd"),
    ("consolidated isd", "cisd"),
    (" county isd", " isd"),
    (" collegiate ", " "),
)
ISD_ALIASES = {"culbersoncountyallamooreisd": "culbersoncountyallamoreisd", "lapoynerisd": "lapoynorisd"}
DISTRICT_LONG_FORMS = (
    ("municipal utility district", "mud"),
    ("water control and improvement district", "wcid"),
    ("water control & improvement district", "wcid"),
    ("fresh water supply district", "fwsd"),
    ("levee improvement district", "lid"),
    ("municipal management district", "mmd"),
    ("management district", "mmd"),
    ("conservation and improvement district", "sid"),
    ("special improvement district", "sid"),
    ("public improvement district", "pid"),
)
ENTITY_LONG_FORMS = (
    ("independent school district", "isd"), ("i.s.d.", "isd"), ("consolidated isd", "isd"), ("cisd", "isd"), ("school district", "isd"), ("school dist", "isd"),
    ("municipal utility district", "mud"), ("water control and improvement district", "wcid"), ("water improvement district", "wcid"), ("water district", "wcid"),
    ("emergency services district", "esd"), ("emergency service district", "esd"), ("public utility district", "pud"), ("p.u.d.", "pud"), ("hospital", "hosp"),
    ("u.c.", "universalcity"), ("universal city", "universalcity"),
)
ENTITY_STOP_WORDS = ("city", "of", "the", "county", "area", "number", "no", "district", "underground", "conservation", "co", "dist", "ranch")
ROLL_TYPE_RULES = (
    ("02", r"\bisd\b|\bcisd\b|school"),
    ("40", r"\besd\b|emerg\w*\s+serv"),
    ("04", r"\bmud\b|municipal\s+utility"),
    ("19", r"\bwcid\b|water\s+control"),
    ("13", r"\bfwsd\b|fresh\s*water|\bfwd\b"),
    ("11", r"\bhospital\b|memorial"),
    ("15", r"\bcollege\b"),
    ("09", r"\bpid\b|public\s+improve"),
    ("06", r"groundwater|ground\s+water|\bgcd\b|\bwcd\b"),
    ("03", r"^\s*(city|town|village)\s+of\b|\bcity\s+of\b"),
    ("00", r"\bcount(y|ies)\b|\bco\b"),
)
SHEET_TYPE_RULES = (
    ("02", r"\bisd\b|\bcisd\b|school"),
    ("40", r"\besd\b|emergency\s*serv"),
    ("04", r"\bmud\b|municipal\s*utility"),
    ("19", r"\bwcid\b|water\s*control"),
    ("13", r"\bfwsd\b|fresh\s*water"),
    ("11", r"\bhospital\b|memorial|medical"),
    ("15", r"\bcollege\b"),
    ("09", r"\bpid\b|\bsid\b|public\s*improvement"),
    ("08", r"\bdrainage\b"),
    ("18", r"\bnavigation\b|\bport\b"),
    ("06", r"groundwater|ground\s*water|\bgcd\b|\buwcd\b|\bwcd\b"),
    ("03", r"^\s*(city|town|village)\s+of\b|\bcity\s+of\b"),
    ("00", r"\bcounty\b"),
)
LABEL_NOISE = r"\b(20\d\d|tax year|adopted|rate|total)\b"
LABEL_ABBREVIATIONS = (
    (r"\bindependent school district\b", "isd"),
    (r"\bconsolidated independent school dist(rict)?\b", "isd"),
    (r"\bschool district\b", "isd"),
    (r"\bemergency services? district\b", "esd"),
    (r"\bemerg(ency)? serv(ice)?s? dist\b", "esd"),
    (r"\bmunicipal utility district\b", "mud"),
    (r"\bwater control (and|&) improvement district\b", "wcid"),
    (r"\bfresh water supply district\b", "fwsd"),
    (r"\bgroundwater conservation district\b", "gcd"),
    (r"\bground water conservation district\b", "gcd"),
    (r"\bunderground water conservation district\b", "uwcd"),
    (r"\bpublic improvement district\b", "pid"),
    (r"\bmanagement district\b", "mmd"),
    (r"\bhospital district\b", "hosp"),
    (r"\bjunior college( district)?\b", "college"),
    (r"\bcommunity college( district)?\b", "college"),
    (r"\bcounty\b", "co"),
    (r"\bcity of\b", ""),
    (r"\btown of\b", ""),
    (r"\bnumber\b", ""),
)
ISD_SHORT = (r"\bcisd\b", "isd")
DISTRICT_TAIL, DISTRICT_SPECIAL, DISTRICT_NUMBER = r"\bof\b.*$", (r"\bspecial id\b", "sid"), r"\bnumber\b|\bno\b"
ENTITY_CODE, ENTITY_QUALIFIER = r"\s+\d{4,}\s*$", r"\((?:fp|rp|pp|mn|bpp)\)"
ESD_NUMBER = r"esd\s*#?\s*(\d+)"
# ---- end of fixed values ----


def spelled(c: Column, pairs: Sequence[tuple[str, str]]) -> Column:
    """Each literal replaced in turn."""
    return reduce(lambda x, p: F.replace(x, F.lit(p[0]), F.lit(p[1])), pairs, c)


def clean_number(c: Column) -> Column:
    """Text such as "$ 117,596" as a double; null where digits and points make no number."""
    return F.regexp_replace(c, "[^0-9.]", "").try_cast("double")


def norm_city(c: Column) -> Column:
    bare = F.regexp_replace(F.lower(F.trim(c)), CITY_PREFIX, "")
    return F.regexp_replace(F.replace(bare, F.lit("-"), F.lit(" ")), r"\s+", " ")


def norm_isd(c: Column) -> Column:
    short = F.regexp_replace(spelled(F.lower(F.trim(c)), ISD_LONG_FORMS), *ISD_SHORT)
    key = F.regexp_replace(short, "[^a-z0-9]", "")
    aliases = F.create_map(*[F.lit(x) for pair in ISD_ALIASES.items() for x in pair])
    return F.coalesce(aliases[key], key)


def norm_county(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z]", "")


def norm_district(c: Column) -> Column:
    """Null counts as empty."""
    cut = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), DISTRICT_TAIL, "")
    short = F.regexp_replace(spelled(cut, DISTRICT_LONG_FORMS), *DISTRICT_SPECIAL)
    return F.regexp_replace(F.regexp_replace(short, DISTRICT_NUMBER, ""), "[^a-z0-9]", "")


def norm_entity(c: Column) -> Column:
    """Roll names without codes, qualifiers and stop words, in one piece.  Null counts as empty."""
    low = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), ENTITY_CODE, "")
    bare = F.regexp_replace(low, ENTITY_QUALIFIER, " ")
    words = F.split(F.regexp_replace(spelled(bare, ENTITY_LONG_FORMS), "[^a-z0-9 ]", " "), " ")
    return F.array_join(F.filter(words, lambda w: (w != "") & ~w.isin(*ENTITY_STOP_WORDS)), "")


def numbered_key(c: Column) -> Column:
    """"ESD #3" -> esd3; null without a numbered district."""
    number = F.regexp_extract(F.lower(c), ESD_NUMBER, 1)
    return F.when(number != "", F.concat(F.lit("esd"), number))


def type_hint(c: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The code of the first rule whose pattern the name has, else null."""
    return F.coalesce(*[F.when(c.rlike(f"(?i){pattern}"), F.lit(code)) for code, pattern in rules])


def norm_label(c: Column) -> Column:
    """Names of published rate sheets.  Null counts as empty."""
    low = F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), LABEL_NOISE, " ")
    short = reduce(lambda x, p: F.regexp_replace(x, p[0], p[1]), LABEL_ABBREVIATIONS, low)
    return F.regexp_replace(short, "[^a-z0-9]+", "")


def search_norm(c: Column) -> Column:
    return F.trim(F.regexp_replace(F.upper(c), "[^A-Z0-9]+", " "))


def scrub_control(c: Column) -> Column:
    return F.regexp_replace(c, r"[\t\r\n]+", " ")


def slug(c: Column) -> Column:
    """A county's name as its folder spells it; joins use the slug of both sides, which capitals can't break."""
    return F.regexp_replace(F.regexp_replace(F.lower(c), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def canonical_account(c: Column) -> Column:
    """Digits without leading zeros; blank is "0"."""
    bare = F.regexp_replace(F.trim(c), "^0+", "")
    return F.when(bare == "", "0").otherwise(bare)


def has_real_id(c: Column) -> Column:
    """False for null, blank and "0", which all mean: no id."""
    return F.coalesce((F.trim(c) != "") & (c != "0"), F.lit(False))


def fill_link_template(template: Column, prop_id: Column, fallback: Column) -> Column:
    """{id} filled in; the fallback where there is no template or no id."""
    return F.when(template.isNotNull() & has_real_id(prop_id), F.replace(template, F.lit("{id}"), F.url_encode(prop_id))).otherwise(fallback)


def parse_stack(c: Column, last: bool = False) -> Column:
    """"Name=rate; Name=rate" -> array of (name, rate DECIMAL); parts without a name or with a rate of 0 or less go.

    last: whether a part is split at its last = rather than its first.
    """
    pattern = r"^(.*)=([^=]*)$" if last else r"^([^=]*)=(.*)$"

    def part(x: Column) -> Column:
        return F.struct(F.trim(F.regexp_extract(x, pattern, 1)).alias("name"), F.trim(F.regexp_extract(x, pattern, 2)).try_cast("decimal(12,6)").alias("rate"))

    return F.filter(F.transform(F.split(c, ";"), part), lambda s: (s["name"] != "") & (s["rate"] > 0))


def render_stack(c: Column) -> Column:
    """The text form of an array of (name, rate)."""
    return F.array_join(F.transform(c, lambda s: F.concat(s["name"], F.lit("="), s["rate"].cast("string"))), "; ")
