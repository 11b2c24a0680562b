"""Labels of published sheets where many units of a county share a name."""

from levyframe.operators import resolve


def test_units_of_one_name_are_compared_once(spark, monkeypatch):
    units = spark.sql("select '001' as county_code, lpad(cast(id as string), 4, '0') as unit_id, case when id % 2 = 0 then 'blue anvil ISD' else 'old plate MUD' end as name, case when id % 2 = 0 then '02' else '04' end as unit_type, cast(0.1 as decimal(12,6)) as rate_per_100 from range(100, 600)")
    labels = spark.createDataFrame([("001", "2025 Blue Anvil ISD"), ("001", "old plate MUD rate"), ("001", "nothing")], "county_code string, label string")
    sizes, write = [], resolve.materialize

    def counted(df):
        out = write(df)
        sizes.append(out.count())
        return out

    monkeypatch.setattr(resolve, "materialize", counted)
    got = {r.label: r.unit_id for r in resolve.match_labels(labels, units).collect()}
    assert got == {"2025 Blue Anvil ISD": "0100", "old plate MUD rate": "0101", "nothing": None}
    assert sizes == [2, 3, 2]
