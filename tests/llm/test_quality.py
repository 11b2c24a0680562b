import re

from pyspark.sql import functions as F

from levyframe.llm.quality import MEASURES, host_verdicts, measure, quality_documents, quality_verdicts
from tests.llm.brute import WORD


def brute_measures(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    repeated = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(5)}
    lines, seen, dup = text.split("\n"), set(), 0
    for x in lines:
        if WORD.search(x):
            dup += x in seen
            seen.add(x)
    failed = len(words) < 10 or 100 * len(repeated) > 20 * len(words)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated), failed


TEXTS = [None, "", " \x0b\x0c\r\n", "one two", "a b c d e f g h i j", "a b c d e a b c d e x", "é ß\x1c日本 #*$ | <>\n\né ß\x1c日本 #*$ | <>\n", "w " * 3000, "a a a a a a", "x\x85y\xa0z", "\x00 \x7f"]


def test_measures_match_brute_force(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source").limit(40)
    docs = docs.unionByName(spark.createDataFrame([(500 + i, t, None) for i, t in enumerate(TEXTS)] + [(None, "x", "s"), (500, None, None)], docs.schema)).withColumn("KEPT", F.lit(1)).withColumn("n_words", F.lit("w"))
    want = [repr((r.doc_id, *brute_measures(r.text), not brute_measures(r.text)[-1])) for r in docs.collect()]
    got = quality_verdicts(docs)
    assert got.columns == ["doc_id", "source", *MEASURES, "base_failed", "kept"]
    assert sorted(repr((r.doc_id, *(r[m] for m in MEASURES), r.base_failed, r.kept)) for r in got.collect()) == sorted(want)


def test_hosts_are_shrunk_and_take_their_documents_along(spark):
    good = " ".join(f"word{i}" for i in range(30))
    rows = [(i, "bad.com", "x" if i % 10 else good) for i in range(100)] + [(100 + i, f"h{i % 20}.org", good) for i in range(400)] + [(900, "once.net", "x"), (901, "once.net", good), (902, None, good)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    kept = {r.doc_id for r in quality_verdicts(docs).where("kept").collect()}
    assert kept == {i for i, s, t in rows if t == good and s != "bad.com"}
    assert {r.doc_id for r in quality_documents(docs).collect()} == kept
    assert quality_documents(docs).columns == docs.columns
    rates = {r.host: r for r in host_verdicts(docs.select(F.col("source").alias("host"), (F.col("text") == "x").alias("base_failed"))).collect()}
    assert rates["once.net"].failed / rates["once.net"].n == 0.5
    assert rates["once.net"].rate < 0.5 < rates["bad.com"].rate < 0.9


def test_one_host_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "a", "x")], "doc_id long, source string, text string")
    assert [(r.base_failed, r.kept) for r in quality_verdicts(docs).collect()] == [(True, False)]
    assert quality_verdicts(docs.limit(0)).collect() == []
    assert quality_documents(docs.limit(0)).collect() == []


def test_long_text_is_measured_whole():
    assert measure(("a b c d e f " * 50_000).encode())[0] == 300_000


def test_query_equals_its_sql_with_planted_hosts(spark, tmp_path):
    """A host whose documents nearly all fail takes the others with it; a small one is drawn to the mean; null hosts pass no verdict."""
    import random

    import duckdb

    from levyframe.llm import quality

    rng = random.Random(3)
    good = lambda k: " ".join(f"word{k}x{rng.randrange(10**6)}" for _ in range(30))
    rows = [(k, f"src{k % 8}", good(k) if k % 20 else "short text") for k in range(400)]
    rows += [(1000 + k, "bad", good(k) if k % 10 == 0 else "too short") for k in range(60)]
    rows += [(2000, "small", "short"), (2001, "small", good(1)), (2002, "tiny", "short"), (3000, None, "short"), (3001, None, good(2)), (3002, None, None)]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame(rows, "doc_id long, source string, text string").write.parquet(path)
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{path}/*.parquet'")
    df = quality.op2_quality(spark, str(tmp_path))
    want = con.execute(f"select {', '.join(df.columns)} from ({quality.SQL['op2_quality']}) x").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
    kept = {r[0]: r[-1] for r in want}
    assert not any(kept[1000 + k] for k in range(60)) and kept[1] and kept[2001] and kept[3001] and not kept[3000]
