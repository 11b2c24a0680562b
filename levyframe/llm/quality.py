"""Quality rules judged by document and by host.

Each text is measured and judged by fixed rules.  Failures are then summed by
host (here a document's source), the failure rate of each host is drawn towards
the rate of all hosts by an empirical beta prior, and a host whose rate stays
too high takes its other documents with it.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import broadcast_if_small, drop_columns, materialize, packed, quoted, read, result_schema, unpacked

SYMBOLS = b"#*$%&|<>"
WINDOW = 5
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
NOT_SYMBOLS = bytes(sorted(set(range(256)) - set(SYMBOLS)))
CONTINUES = bytes(range(0x80, 0xC0))  # UTF-8 bytes that start no code point


def repeated_words(words: list[bytes], size: int = WINDOW) -> int:
    """Words inside windows of `size` words that occur twice or more among these words."""
    windows = list(zip(*(words[k:] for k in range(size)), strict=False))
    if len(set(windows)) == len(windows):
        return 0
    first: dict[tuple[bytes, ...], int] = {}
    inside = bytearray(len(words))
    mark = b"\x01" * size
    for i, w in enumerate(windows):
        j = first.setdefault(w, i)
        if j != i:
            inside[i : i + size] = mark
            inside[j : j + size] = mark
    return sum(inside)


def measure(text: bytes | None) -> tuple[int, int, int, int, int]:
    """MEASURES of one text in UTF-8; bytes.split() splits at ASCII white space only."""
    if not text:
        return 0, 0, 0, 0, 0
    words = text.split()
    joined = b"".join(words)
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(words), len(joined.translate(None, CONTINUES)), len(text.translate(None, NOT_SYMBOLS)), len(lines) - len(set(lines)), repeated_words(words)


def _measure_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(batch.num_columns - 1).cast(pa.binary())
        columns = zip(*(measure(t.as_py()) for t in texts), strict=True) if len(texts) else [()] * len(MEASURES)
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *(pa.array(c, pa.int64()) for c in columns)], names=[*batch.schema.names[:-1], *MEASURES])


def measured(keys: DataFrame, text_col: str) -> DataFrame:
    """keys with the text column replaced by the MEASURES, which come last."""
    kept = [f for f in keys.schema.fields if f.name != text_col]
    schema = result_schema(kept, ", ".join(f"{m} long" for m in MEASURES))
    return keys.select(*[quoted(f.name) for f in kept], quoted(text_col)).mapInArrow(_measure_batches, schema)


def base_failed(min_words: int = 10, most_repeated: int = 20):
    """The rules on one document: too few words, or too many of them in repeated windows (percent)."""
    return (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > most_repeated * F.col("n_words"))


def host_verdicts(judged: DataFrame, most_failing: float = 0.5) -> DataFrame:
    """(host, base_failed) rows -> host, n, failed, rate, host_kept; one row a host, null hosts left out.

    The beta prior has the mean and the strength that the hosts' own rates
    suggest (method of moments over hosts), a strength of 1 at least.  With one host, or with rates that
    spread no more than chance does, the prior is as strong as the largest host
    allows: then every rate is the mean.
    """
    hosts = judged.where("host is not null").groupBy("host").agg(F.count("*").alias("n"), F.count_if("base_failed").alias("failed"))
    raw = F.col("failed") / F.col("n")
    prior = hosts.agg(
        (F.sum("failed") / F.sum("n")).alias("mean"), F.avg(raw).alias("m"), F.var_pop(raw).alias("spread"), F.avg(1 / F.col("n")).alias("chance"), F.sum("n").alias("all")
    )
    # spread of raw rates = prior's variance + m (1 - m) * mean of 1/n
    real = F.greatest(F.col("spread") - F.col("m") * (1 - F.col("m")) * F.col("chance"), F.lit(0.0))
    strength = F.when(real > 0, F.greatest(F.lit(1.0), F.col("m") * (1 - F.col("m")) / real - 1)).otherwise(F.col("all").cast("double"))
    prior = prior.select("mean", F.least(strength, F.col("all").cast("double")).alias("strength"))
    shrunk = (F.col("failed") + F.col("mean") * F.col("strength")) / (F.col("n") + F.col("strength"))
    return hosts.join(F.broadcast(prior)).withColumn("rate", shrunk).select("host", "n", "failed", "rate", (F.col("rate") <= most_failing).alias("host_kept"))


def quality_verdicts(docs: DataFrame, most_failing: float = 0.5, *, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """docs without the text, with the MEASURES, base_failed and kept.

    Null and empty texts have no words and fail; a null host passes no verdict
    on its documents.  Repeated rows are judged row by row.  An empty table
    gives an empty result.  Columns of docs with the results' names are replaced.
    """
    docs = drop_columns(docs, [*MEASURES, "base_failed", "kept"])
    rows = materialize(measured(packed(docs, [text_col], host=F.col(quoted(host_col)), text=F.col(quoted(text_col))), "text").withColumn("base_failed", base_failed()))
    bad = materialize(host_verdicts(rows.select("host", "base_failed"), most_failing).where("not host_kept").select(F.col("host").alias("bad")))
    rows = rows.join(broadcast_if_small(bad), F.col("host") == F.col("bad"), "left")
    kept = ~F.col("base_failed") & F.col("bad").isNull()
    return rows.select(*unpacked(rows, [c for c in docs.columns if c != text_col]), *MEASURES, "base_failed", kept.alias("kept"))


def quality_documents(docs: DataFrame, most_failing: float = 0.5, *, text_col: str = "text", host_col: str = "source") -> DataFrame:
    """The documents that are kept, in the columns of docs; edge cases as in quality_verdicts.

    The hosts are judged in a first pass over host and text alone; the second
    pass measures again instead of moving texts through a join.
    """
    text, host = F.col(quoted(text_col)), F.col(quoted(host_col))
    first = materialize(measured(docs.select(host.alias("host"), text.alias("text")), "text").select("host", base_failed().alias("base_failed")))
    bad = materialize(host_verdicts(first, most_failing).where("not host_kept").select(F.col("host").alias("bad")))
    rows = measured(packed(docs, host=host, text=text), "text").where(~base_failed()).join(broadcast_if_small(bad), F.col("host") == F.col("bad"), "left_anti")
    return rows.select(unpacked(rows, docs.columns))


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return quality_verdicts(docs).select("doc_id", *MEASURES, "base_failed", "kept")


QUERIES = {"op2_quality": op2_quality}
SQL = {
    "op2_quality": r"""
with d as (select row_number() over () as r, doc_id, source, coalesce(text, '') as text from documents),
w as (select r, doc_id, source, text, regexp_extract_all(text, '[^\x20\x09-\x0D]+') as ws from d),
pos as (select r, ws, unnest(range(1, len(ws) - 3)) as i from w where len(ws) >= 5),
win as (select r, i, ws[i : i + 4] as g from pos),
often as (select r, i from (select r, i, count(*) over (partition by r, g) as c from win) where c > 1),
rep as (select r, count(distinct i + k) as n from often, range(0, 5) t(k) group by r),
lines as (select r, unnest(string_split(text, chr(10))) as line from d),
dup as (select r, count(*) - count(distinct line) as n from lines where regexp_matches(line, '[^\x20\x09-\x0D]') group by r),
m as (
  select w.r, doc_id, source, cast(len(ws) as bigint) as n_words, cast(length(array_to_string(ws, '')) as bigint) as word_chars,
         cast(length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) as bigint) as n_symbols,
         cast(coalesce(dup.n, 0) as bigint) as n_dup_lines, cast(coalesce(rep.n, 0) as bigint) as n_repeat_words
  from w left join dup on w.r = dup.r left join rep on w.r = rep.r),
b as (select *, n_words < 10 or 100 * n_repeat_words > 20 * n_words as base_failed from m),
h as (select source, count(*) as n, count(*) filter (where base_failed) as failed from b where source is not null group by source),
p as (select sum(failed) / sum(n) as mean, avg(failed / n) as m, var_pop(failed / n) as spread, avg(1 / n) as chance, cast(sum(n) as double) as all_n from h),
q as (select mean, least(case when spread - m * (1 - m) * chance > 0 then greatest(1, m * (1 - m) / (spread - m * (1 - m) * chance) - 1) else all_n end, all_n) as strength from p),
bad as (select source from h, q where (failed + mean * strength) / (n + strength) > 0.5)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       not base_failed and (source is null or source not in (select source from bad)) as kept
from b
"""
}
