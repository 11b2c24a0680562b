from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from levyframe.functions import geometry as G
from levyframe.functions import text as T
from levyframe.functions.similarity import ratio


def one(spark, column, value, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(column(F.col("v")).alias("x")).first().x


@pytest.mark.parametrize(
    ("f", "value", "want"),
    [
        (T.clean_number, "$ 117,596", 117596.0), (T.clean_number, "1.2.3", None), (T.clean_number, None, None),
        (T.norm_city, " City of Little-River ", "little river"), (T.norm_city, "City of  X", " x"), (T.norm_city, "Town of X", "x"),
        (T.norm_isd, "Schleicher County Independent School District", "schleicherisd"), (T.norm_isd, "LaPoyner ISD", "lapoynorisd"), (T.norm_isd, "Clyde Consolidated ISD", "clydeisd"),
        (T.norm_district, "Cibolo Canyon Conservation and Improvement District 1", "cibolocanyonsid1"), (T.norm_district, "Meyer Ranch MUD of Comal County", "meyerranchmud"), (T.norm_district, None, ""),
        (T.norm_entity, "LUFKIN ISD (FP)", "lufkinisd"), (T.norm_entity, "Bells School District 12345", "bellsisd"),
        (T.numbered_key, "Wilson ESD # 3", "esd3"), (T.numbered_key, "none", None),
        (T.norm_label, "2025 Adopted Emergency Services District Number 4 Total Rate", "esd4"), (T.search_norm, " 12-b  Main st. ", "12 B MAIN ST"),
        (T.canonical_account, "000120", "120"), (T.canonical_account, "000", "0"), (T.slug, "De Witt", "de-witt"),
        (lambda c: T.type_hint(c, T.ROLL_TYPE_RULES), "KAUFMAN COUNTY", "00"), (lambda c: T.type_hint(c, T.ROLL_TYPE_RULES), "xyz", None),
    ],
)
def test_names_and_numbers(spark, f, value, want):
    assert one(spark, f, value) == want


def test_stacks_round_trip(spark):
    text = "A=0.5; B=x=0.25; =1; C=0; D=-1"
    first = one(spark, lambda c: T.parse_stack(c), text)
    assert [(s.name, s.rate) for s in first] == [("A", Decimal("0.500000"))]
    last = one(spark, lambda c: T.parse_stack(c, last=True), text)
    assert [(s.name, s.rate) for s in last] == [("A", Decimal("0.500000")), ("B=x", Decimal("0.250000"))]


def test_unknown_crs_stops(spark):
    with pytest.raises(Exception, match="unknown CRS"):
        one(spark, lambda c: G.to_wgs84(F.lit(1.0), F.lit(2.0), c)[0], "EPSG:9")


def ring(*points):
    return F.array(*[F.struct(F.lit(float(x)).alias("x"), F.lit(float(y)).alias("y")) for x, y in points])


def test_holes_and_parts(spark):
    rings = F.array(ring((0, 0), (4, 0), (4, 4), (0, 4)), ring((1, 1), (3, 1), (3, 3), (1, 3)), ring((10, 10), (11, 10), (11, 11), (10, 11)))
    at = lambda x, y: spark.range(1).select(G.contains(rings, F.lit(x), F.lit(y)).alias("c")).first().c
    assert [at(0.5, 0.5), at(2.0, 2.0), at(10.5, 10.5), at(5.0, 5.0)] == [True, False, True, False]
    p = spark.range(1).select(G.interior_point(rings).alias("p")).first().p
    assert at(p.x, p.y)


def test_ratio_is_difflibs(spark):
    df = spark.createDataFrame([("abcd", "bcde"), (None, "x"), ("same", "same")], "a string, b string")
    assert [r.r for r in df.select(ratio("a", "b").alias("r")).collect()] == [0.75, 0.0, 1.0]
