import hashlib

import pytest
from pyspark.sql import functions as F

from levyframe.llm.bpe import WordBPE, encode_documents, encoding_digests, public_tokenizer

TEXTS = [
    None, "", " \t\n", "Hello, World! It's 2024—they'll go; THE the The", "Éléphant naïve ŒUVRE straße İstanbul ΑΣ ΟΔΟΣ été",
    "a<|endoftext|>b <|startoftext|> <|ENDOFTEXT|> <|endoftext", "日本語テキスト 한국어 😀👩‍👩‍👧   x\x1cy\x85z", "x" * 5000, "ab" * 2000 + "!" * 3000,
    "don't I'm we've 'sabc''s '' ... 12345 ½ ² x1y2", "The and ttiontheanbleedre", "\x00\x01\x7f ﻿", "Ärger übermäßig ẞ ǅ ﬁ",
]


@pytest.fixture(scope="module")
def path():
    return public_tokenizer("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def test_encodes_and_decodes_as_the_library(path, library):
    bpe = WordBPE(path)
    for text in TEXTS:
        want = library.encode(text or "", add_special_tokens=False).ids
        assert bpe.encode(text or "") == want, text
        assert bpe.decode(want) == library.decode(want, skip_special_tokens=False)


def test_shared_prefixes_do_not_depend_on_each_other(path):
    bpe = WordBPE(path)
    words = ["the", "then", "thence", "there", "th", "t", "thermodynamics", "they"]
    together = dict(bpe.encode_words(words))
    assert together == {w: dict(bpe.encode_words([w]))[w] for w in words}


def test_documents(spark, path, library, sf_dir):
    docs = spark.createDataFrame([(i, t, "x", 7) for i, t in enumerate(TEXTS)] + [(None, "a b", None, None), (3, "twice", "y", 1), (3, "twice", "y", 1)], "doc_id long, text string, ids string, N_TOKENS int")
    docs = docs.unionByName(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").withColumn("ids", F.lit("k")).withColumn("N_TOKENS", F.lit(1)))
    rows = sorted(docs.select("doc_id", "text").collect(), key=repr)
    got = encoding_digests(docs, path)
    assert got.columns == ["doc_id", "ids", "n_tokens", "ids_sha256", "decoded_sha256"]
    want = []
    for r in rows:
        ids = library.encode(r.text or "", add_special_tokens=False).ids
        sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
        want.append((r.doc_id, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))))
    assert sorted(map(repr, want)) == sorted(repr((r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256)) for r in got.collect())
    one = encode_documents(docs.where("doc_id = 3").select("doc_id", "text", F.lit(1).alias("decoded")), path)
    assert one.columns == ["doc_id", "ids", "decoded"]
    assert one.count() == docs.where("doc_id = 3").count()


def test_empty_table(spark, path):
    assert encoding_digests(spark.createDataFrame([], "doc_id long, text string"), path).collect() == []
