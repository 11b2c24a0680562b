"""Numbers of rows and lines, packing, and what they are when work is split."""

import random

from pyspark.sql import functions as F

from levyframe.operators.rates import packed_groups
from levyframe.sources.numbering import number_rows, read_numbered_lines
from levyframe.sources.writers import add_row_id, split_interleaved


def test_lines_keep_the_numbers_of_their_files(spark, tmp_path):
    want = set()
    for name, n in (("a", 900), ("b", 0), ("c", 1), ("d", 57)):
        lines = [f"{name} {k} " + "x" * (k % 40) for k in range(n)]
        lines[3:5] = ["same", "same"] if n > 5 else lines[3:5]
        (tmp_path / f"{name}.txt").write_text("".join(x + "\n" for x in lines))
        want |= {(name, k + 1, x) for k, x in enumerate(lines)}
    kept = spark.conf.get("spark.sql.files.maxPartitionBytes"), spark.conf.get("spark.sql.files.openCostInBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "10")
    try:
        df = read_numbered_lines(spark, str(tmp_path))
        assert df.rdd.getNumPartitions() > 10  # splits of one file in several tasks
        got = [(r["file"].rsplit("/", 1)[1].removesuffix(".txt"), r["line_no"], r["value"]) for r in df.collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", kept[0])
        spark.conf.set("spark.sql.files.openCostInBytes", kept[1])
    assert len(got) == len(want) and set(got) == want


def test_rows_that_repeat_have_numbers_of_their_own(spark):
    df = spark.createDataFrame([("a", 1)] * 50 + [("b", None)] * 7, "k string, v int").repartition(5)
    ids = sorted(r["uid"] for r in add_row_id(df).collect())
    assert ids == list(range(1, 58))
    assert add_row_id(df.withColumnRenamed("v", "uid")).columns == ["k", "uid"]
    assert number_rows(df.limit(0), "n").count() == 0


def test_numbers_follow_an_order_and_parts_are_dealt_in_turn(spark):
    values = list(range(1000))
    random.Random(2).shuffle(values)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    assert all(r["n"] == r["v"] for r in number_rows(df, "n", [F.col("v")]).collect())
    parts = split_interleaved(df, 3, [F.col("v")]).collect()
    assert all(r["part"] == (r["v"] + 1) % 3 for r in parts)


def packed(sizes, budget):
    out, group, acc = [], 0, 0
    for n in sizes:
        if acc > 0 and acc + n > budget:
            group, acc = group + 1, 0
        acc += n
        out.append(group)
    return out


def test_groups_are_packed_as_one_by_one(spark):
    rng = random.Random(7)
    for sizes, budget in (([0, 0, 90, 5, 5, 0, 0, 200, 1, 9, 10, 0], 10), ([rng.randint(0, 30) for _ in range(120)], 50), ([3], 1), ([0, 0], 5), ([], 5), ([1] * 64, 1)):
        df = spark.createDataFrame(list(enumerate(sizes)), "at int, n int")
        got = [r["group"] for r in packed_groups(df, "at", "n", budget).orderBy("at").collect()]
        assert got == packed(sizes, budget)
