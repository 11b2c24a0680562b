"""A corpus pipeline of five operators, each stage written as Parquet and read again by the next.

Quality rules drop documents, fuzzy lines are cut, one document of each group
of near copies stays, sources are mixed to their weights (some documents come
twice, some not at all), and what is left is encoded.

Null and empty texts, null ids and sources, repeated rows, empty tables and
further columns of any name and type are fine in each stage; what each makes of
them is said there, and more fully by the operator that it calls.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.bpe import encoding_digests, public_tokenizer
from levyframe.llm.common import materialize, read
from levyframe.llm.linededup import dedup_lines
from levyframe.llm.mixing import mixed_documents
from levyframe.llm.quality import quality_documents
from levyframe.llm.simhash import simhash_documents


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules on texts and on sources keep, unchanged; null and empty texts fail, a null source passes no verdict, repeated rows are judged row by row."""
    return quality_documents(docs)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without lines that came before (by id, null last); n_chars is that of the new text, null for null.  A repeated row keeps its lines once."""
    return dedup_lines(docs).withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def near(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group, that of the smallest id (null last), unchanged; texts without words are one group, repeated rows one row."""
    return simhash_documents(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's budget takes it; null and empty texts never, a null source is one like any other, ties are numbered."""
    return mixed_documents(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, source, n_tokens, ids_sha256, decoded_sha256 a row; a null text counts as empty."""
    return encoding_digests(docs.select("doc_id", "source", "text"), public_tokenizer("word_bpe_49k.json"))


STAGES = [("quality rules", quality), ("line dedup", lines), ("near dedup", near), ("mix", mix), ("encode", encode)]

#: MinHash, SimHash and BPE are beyond SQL; tests hold each stage and the whole against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
