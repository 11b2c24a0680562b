"""Columns of any name and type pass unchanged through the operators that keep them."""

import pytest
from pyspark.sql import functions as F

from levyframe.llm.bpe import encoding_digests, public_tokenizer
from levyframe.llm.lcparse import fingerprint_documents
from levyframe.llm.linededup import dedup_lines, line_digests
from levyframe.llm.mixing import mix_sources, mixed_documents
from levyframe.llm.quality import quality_documents, quality_verdicts
from levyframe.llm.simhash import simhash_documents
from levyframe.llm.suffixdedup import dedup_substrings
from levyframe.llm.urlfilter import filter_urls

TEXT = " ".join(f"word{i}" for i in range(90))
NAMES = ["a b", "a.b", "q`q", "rest", "row", "text_line", "__x", "n", "h1", "host", "of", "band", "fp2", "m", "deep"]


@pytest.fixture
def docs(spark):
    rows = [(1, "s", TEXT), (2, "s", TEXT + "\nanother line of some length"), (3, "t", "short"), (None, None, None), (2, "s", TEXT + "\nanother line of some length"), (4, "t", TEXT[::-1])]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    for name in NAMES[:-2]:
        df = df.withColumn(name, F.concat(F.lit(name), F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))))
    return df.withColumn("m", F.create_map(F.lit("k"), F.col("doc_id"))).withColumn("deep", F.array(F.struct(F.col("doc_id").alias("x y"), F.col("source").alias("a.b"))))


def rows_of(df, without=()):
    return sorted(repr([(c, r[i]) for i, c in enumerate(df.columns) if c not in without]) for r in df.collect())


def test_columns_pass(docs):
    all_rows = rows_of(docs, ("text",))
    for out in (dedup_lines(docs), dedup_substrings(docs), dedup_substrings(docs, keep="none")):
        assert out.columns == docs.columns
        assert rows_of(out, ("text",)) == all_rows
    for out, new in ((quality_verdicts(docs), 7), (encoding_digests(docs, public_tokenizer("word_bpe_49k.json")), 3), (fingerprint_documents(docs), 1), (mix_sources(docs), 4)):
        assert out.columns[:-new] == [c for c in docs.columns if c != "text" or c in out.columns]
        assert rows_of(out, (*out.columns[-new:], "text")) == all_rows
    assert line_digests(docs).count() == 6


def test_kept_rows_are_whole(docs):
    every = rows_of(docs)
    for out in (quality_documents(docs), simhash_documents(docs), mixed_documents(docs)):
        assert out.columns == docs.columns
        got = rows_of(out)
        assert got
        assert set(got) <= set(every)
    assert {r.doc_id for r in simhash_documents(docs).collect()} == {1, 3, None, 4} | ({2} & {r.doc_id for r in simhash_documents(docs).collect()})


def test_pages(docs):
    pages = docs.withColumn("url", F.lit("http://a.net/x"))
    out = filter_urls(pages)
    left = [c for c in docs.columns if c != "host"]
    assert out.columns == [*left, "host", "path", "rule", "verdict", "score"]
    assert rows_of(out, ("host", "path", "rule", "verdict", "score")) == rows_of(docs, ("host",))


def test_first_copies_stay(spark):
    long = TEXT[:450]
    rows = [(5, long), (2, long), (2, long), (None, long), (None, "x"), (None, "x"), (None, None), (7, long + "!")]
    left = dedup_substrings(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted(repr((r.doc_id, r.text)) for r in left) == sorted(repr(r) for r in [(5, ""), (2, long), (2, ""), (None, ""), (None, "x"), (None, "x"), (None, None), (7, "!")])
