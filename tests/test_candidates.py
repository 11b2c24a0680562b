"""Candidates of the ratio stage: no pair that reaches the ratio is lost, and few others are met."""

import random
from difflib import SequenceMatcher

import pytest
from pyspark.sql import functions as F

from levyframe.operators.documents import named_in, parse_rate_lines
from levyframe.operators.resolve import similar_candidates


@pytest.mark.parametrize("least", [0.88, 0.7])
def test_no_pair_is_lost(spark, least):
    rng = random.Random(8)
    stems = ["".join(rng.choice("abcdef") for _ in range(rng.randint(0, 30))) for _ in range(25)]

    def near(s):
        s = list(s)
        for _ in range(rng.randint(0, 6)):
            i = rng.randint(0, len(s))
            s[i : i + rng.randint(0, 2)] = rng.choice(["", "x", "ab"])
        return "".join(s)

    a = sorted({near(s) for s in stems for _ in range(8)} | {"", "a", "ab"})
    b = sorted({near(s) for s in stems for _ in range(8)} | {"", "a", "abc"})
    asked = spark.createDataFrame([(u, n, "x") for n in a for u in ("001", "002")], "uc string, n string, label string")
    have = spark.createDataFrame([("001", n, k) for k, n in enumerate(b)], "uc string, un string, unit_id int")
    got = {(r["n"], r["un"]) for r in similar_candidates(asked, have, least).collect()}
    ratio = lambda x, y: SequenceMatcher(None, x, y).ratio()
    assert {(x, y) for x in a for y in b if ratio(x, y) >= least} <= got
    assert similar_candidates(asked, have, least).count() == len(got) and len(got) < len(a) * len(b) / 2


def test_rates_are_held_against_their_bounds_before_they_are_rounded(spark):
    lines = [(1, k, line) for k, line in enumerate(["City of Alpha 0.00009999 ", "City of Beta 3.5000004", "City of Gamma 0.0001", "City of Delta 3.5000", "City of Echo 0.1234564"])]
    got = {r["name"]: float(r["rate"]) for r in parse_rate_lines(spark.createDataFrame(lines, "doc int, line_no int, line string")).select("name", F.col("rate").cast("double").alias("rate")).collect()}
    assert got == {"City of Gamma": 0.0001, "City of Delta": 3.5, "City of Echo": 0.123456}


def test_names_in_texts_as_all_pairs(spark):
    rng = random.Random(4)
    texts = [(k, "".join(rng.choice("ab É") for _ in range(rng.randint(0, 60)))) for k in range(60)] + [(99, None), (98, "")]
    names = ["a", "B a", "abab", "ab ab ab", "é", "bbbbbbbbb", " ", "aÉb"]
    got = sorted(tuple(r) for r in named_in(spark.createDataFrame(texts, "id int, text string"), "id", "text", spark.createDataFrame([(n,) for n in names], "name string"), "name").collect())
    flat = lambda s: s.lower().replace(" ", "")
    assert got == sorted((k, n) for k, t in texts if t for n in names if flat(n) and flat(n) in flat(t))
