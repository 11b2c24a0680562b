"""Inputs as DataFrames with fixed schemas; nothing is inferred."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.functions.text import canonical_account, clean_number

RATE = "decimal(12,6)"
POINTS = "array<struct<x: double, y: double>>"

#: Fields of the property-by-entity export: name, first and last column (from 1), type, and whether a short line may lack it.
EXPORT_LAYOUT = (
    ("prop_id", 1, 12, "id", False),
    ("tax_year", 13, 17, "int", False),
    ("entity_code", 54, 63, "string", False),
    ("entity_name", 64, 113, "string", False),
    ("assessed", 149, 163, "long", False),
    ("taxable", 164, 178, "long", False),
    ("hs_amt", 299, 313, "long", True),
    ("ov65_amt", 314, 328, "long", True),
    ("exemptions", 359, 373, "string", True),
)
EXPORT_LEAST = 178


def taxing_units(rows: DataFrame, year: int) -> DataFrame:
    """(name, unit_id, rate text) as the workbook has them -> tax_year, unit_id, name, county_code, serial, unit_type, rate_per_100.

    Blank ids go; names lose outer blanks and final stars; a missing rate is 0.
    """
    part = F.split("unit_id", "-")
    named = rows.where(F.trim("unit_id") != "").withColumn("unit_id", F.trim("unit_id"))
    rate = F.coalesce(clean_number(F.col("rate")).cast(RATE), F.lit(0).cast(RATE))
    return named.select(F.lit(year).alias("tax_year"), "unit_id", F.rtrim(F.regexp_replace(F.trim("name"), r"\*+$", "")).alias("name"), part[0].alias("county_code"), part[1].alias("serial"), part[2].alias("unit_type"), rate.alias("rate_per_100"))


def read_taxing_units(spark: SparkSession, path: str, year: int) -> DataFrame:
    """The workbook landed as CSV, three heading rows before the data."""
    rows = spark.read.schema("name string, unit_id string, rate string").csv(path)
    # headings have no unit id of the form CCC-NNN-TT
    return taxing_units(rows.where(F.col("unit_id").rlike(r"^\s*\d{3}-\d{3}-\d{2}\s*$")), year)


def county_names(units: DataFrame) -> DataFrame:
    """(county_code, county) from the counties' own units, serial 000."""
    return units.where("serial = '000'").select("county_code", F.col("name").alias("county"))


def features(collections: DataFrame) -> DataFrame:
    """One GeoJSON FeatureCollection of polygons a row (json string) -> name, type, rings; closing points dropped."""
    schema = "features array<struct<properties: struct<NAME: string, TYPE: string>, geometry: struct<type: string, coordinates: array<array<array<double>>>>>>"
    rows = collections.select(F.explode(F.from_json("json", schema)["features"]).alias("f"))
    ring = lambda r: F.transform(F.slice(r, F.lit(1), F.size(r) - 1), lambda p: F.struct(p[0].alias("x"), p[1].alias("y")))
    return rows.select(F.col("f.properties.NAME").alias("name"), F.col("f.properties.TYPE").alias("type"), F.transform("f.geometry.coordinates", ring).alias("rings"))


def read_feature_collection(spark: SparkSession, path: str) -> DataFrame:
    """One file of features; an absent file gives no rows."""
    empty = spark.createDataFrame([], "json string")
    try:
        text = spark.read.option("wholetext", True).text(path).withColumnRenamed("value", "json")
    except Exception as e:  # a path that Spark's reader doesn't find
        if "PATH_NOT_FOUND" not in str(e):
            raise
        text = empty
    return features(text)


def scan_parcels(parts: DataFrame, counties: DataFrame) -> DataFrame:
    """All parts of all counties at once, each row with its county and that county's base rate; counties without a recipe go.

    parts: fips and the parcels' columns.  counties: fips, county, base; one row a county.
    """
    return parts.join(counties.select("fips", "county", "base"), "fips").drop("fips")


def field(line: Column, first: int, last: int) -> Column:
    return F.trim(F.substring(line, first, last - first + 1))


def parse_fixed_width(lines: DataFrame, layout: Sequence[tuple[str, int, int, str, bool]] = EXPORT_LAYOUT, least: int = EXPORT_LEAST) -> DataFrame:
    """(county, line) -> the layout's fields; ok is False for lines that are too short or have no code, whose fields are null."""
    ok = (F.length("line") >= least) & (field(F.col("line"), 54, 63) != "")

    def value(first: int, last: int, kind: str, optional: bool) -> Column:
        text = field(F.col("line"), first, last)
        if kind == "id":
            made = canonical_account(text)
        elif kind == "string":
            made = text
        else:
            made = F.coalesce(F.regexp_replace(text, "[^0-9]", "").try_cast(kind), F.lit(0).cast(kind))
        return F.when(ok & (F.length("line") >= last), made) if optional else F.when(ok, made)

    return lines.select("county", ok.alias("ok"), *[value(a, b, kind, optional).alias(name) for name, a, b, kind, optional in layout])


def ingest_report(parsed: DataFrame) -> DataFrame:
    """Per county: rows, unparsed lines, properties, distinct codes, codes that look like emergency or fire districts."""
    fire = F.col("entity_name").rlike(r"(?i)\b(fire|esd|emergency)\b")
    return parsed.groupBy("county").agg(
        F.count_if("ok").alias("n_rows"), F.count_if(~F.col("ok")).alias("n_unparsed"), F.count_distinct("prop_id").alias("n_properties"), F.count_distinct("entity_code").alias("n_codes"), F.count_distinct(F.when(fire, F.col("entity_code"))).alias("n_fire_codes")
    )
