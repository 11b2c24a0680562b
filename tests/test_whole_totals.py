"""Totals taken apart by all special units of a county, held against choices that are listed."""

from collections import Counter
from decimal import Decimal
from itertools import combinations

import pyarrow as pa
import pytest

from levyframe.operators import reconcile as R


@pytest.mark.parametrize("bits", [64, 0])
def test_sums_are_counted_exactly(bits, monkeypatch):
    monkeypatch.setattr(R.Sums, "ARRAY_BITS", bits)
    assert R.Sums({i: 1 for i in range(1, 101)}, 100).at(100) == 444793  # partitions into distinct parts
    assert R.Sums({i: 100 for i in range(1, 101)}, 100).at(100) == 190569292
    many = R.Sums({1000 + i: 1 for i in range(200)}, 120_000)
    assert many.at(100 * 1000 + sum(range(50, 150))) > 2**128
    few = {3: 2, 5: 1, 7: 3, 40: 1}
    units = [r for r, m in few.items() for _ in range(m)]
    want = Counter(sum(c) for c in {tuple(sorted(c)) for n in range(len(units) + 1) for c in combinations(units, n)})
    sums = R.Sums(few, 50)
    assert {s: sums.at(s) for s in range(51)} == {s: want[s] for s in range(51)}
    assert sums.only(40) == {40: 1}
    assert sums.only(6) == {3: 2}
    assert R.Sums({}, 5).at(0) == 1 and R.Sums({9: 1}, 5).only(0) == {}


def test_totals_of_more_units_than_fifteen(spark):
    rate = "decimal(12,6)"
    values = [Decimal(30_000 + 7919 * i % 90_001).scaleb(-6) for i in range(17)]
    extras = [("001", f"e{i:02}", v) for i, v in enumerate([*values, values[0], Decimal("0.000100")])]
    one = lambda rows, cols: spark.createDataFrame(rows, f"county_code string, {cols}")
    schools = [("s1", Decimal("0.3")), ("s2", Decimal("0.312345"))]
    cities = [("c", Decimal("0.1"))]
    totals = [Decimal("0.8001"), Decimal("0.9000"), Decimal("1.1234"), Decimal("1.2000"), Decimal("9.0000"), Decimal("0.0001"), *[(Decimal("0.8") + values[k] + values[k + 1]).quantize(Decimal("0.0001")) for k in range(0, 14, 2)]]
    got = R.count_ways(one([("001", v) for v in totals], "total decimal(12,4)"), one([("001", Decimal("0.5"))], f"base {rate}"), one([("001", *s) for s in schools], f"unit_id string, rate_per_100 {rate}"), one([("001", *c) for c in cities], f"unit_id string, rate_per_100 {rate}"), one([*extras, ("002", "x", Decimal("0.1"))], f"unit_id string, rate_per_100 {rate}"))
    units = sorted(range(len(extras)), key=lambda i: (-extras[i][2], extras[i][1]))
    made = {}
    for n in range(12):  # twelve of the smallest are over what is asked for
        for chosen in combinations(units, n):
            total = sum((extras[i][2] for i in chosen), Decimal(0))
            if total < Decimal("0.5"):
                made.setdefault(total.quantize(Decimal("0.0001"), "ROUND_HALF_UP"), {}).setdefault(tuple(sorted(extras[i][2] for i in chosen)), [extras[i][1] for i in chosen])
    want = {}
    for total in set(totals):
        ways = [(s, c, rates, chosen) for s, sr in schools for c, cr in [*cities, (None, 0)] for rates, chosen in made.get((total - Decimal("0.5") - sr - cr).quantize(Decimal("0.0001"), "ROUND_HALF_UP"), {}).items()]
        if ways:
            want[total] = (len(ways), min(w[0] for w in ways), *((ways[0][1], list(ways[0][2]), ways[0][3]) if len(ways) == 1 else (None, None, None)))
    rows = {r.total: (r.n_ways, r.isd_unit, r.city_unit, r.rates, r.units) for r in got.collect()}
    assert rows == want
    assert max(w[0] for w in want.values()) > 1 and any(w[0] == 1 for w in want.values())


def test_a_county_without_extras_or_totals():
    extras = pa.table({"county_code": pa.array([], pa.string()), "unit_id": pa.array([], pa.string()), "rate_per_100": pa.array([], pa.decimal128(12, 6))})
    asked = pa.table({"county_code": ["001", "001"], "need": pa.array([Decimal("0.0000"), Decimal("0.1000")], pa.decimal128(12, 4))})
    assert R._count_ways(asked, extras).to_pylist() == [{"county_code": "001", "need": Decimal("0.0000"), "ways": Decimal(1), "much": 1.0, "rates": [], "units": []}]
    assert R._count_ways(asked.slice(0, 0), extras).num_rows == 0
