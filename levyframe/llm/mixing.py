"""Mixing sources to target weights by hash-threshold histograms.

Each source gets a budget of words.  Whole passes over a source are taken
first; for what is left, documents whose hash lies below a threshold are taken.
The threshold is found from histograms of words by source and hash bucket: only
the bucket in which the budget ends is refined, level by level, so no sort of
documents ever happens and every document is judged by its own hash alone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levyframe.llm.common import broadcast_if_small, drop_columns, materialize, n_words, packed, quoted, read, row_hash, unpacked

#: Bits of each histogram level; together the 60 bits of a hash.
LEVELS = (12, 12, 12, 12, 12)


def document_hash(doc_id: Column, text: Column) -> Column:
    """60 bits of an MD5; copies of a text under other ids differ."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", doc_id.cast("string"), text)), 1, 15), 16, 10).cast("long")


def source_targets(sizes: DataFrame, weights: Sequence[float], share: float, most: float) -> DataFrame:
    """(source, source_size) -> also target: share of all sizes dealt by weight, at most `most` times a source's size, the excess dealt anew among the others until none is above.

    The table has one row a source.  Each round is one aggregate; a round fixes
    at least one source at its bound, and in practice few rounds are needed.
    """
    rank = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last()))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), ((rank - 1) % len(weights) + 1).cast("int"))
    table = materialize(sizes.select("source", "source_size", weight.alias("weight")))
    total = share * float(table.agg(F.sum("source_size")).first()[0] or 0)
    level, bound = 0.0, F.col("source_size") * float(most)
    while True:
        at_bound = F.col("weight") * level > bound
        fixed, free = table.agg(F.sum(F.when(at_bound, bound)), F.sum(F.when(~at_bound, F.col("weight")))).first()
        # what the sources below their bounds share, for each unit of weight
        new = (total - (fixed or 0.0)) / free if free else level
        if new <= level * (1 + 1e-12):
            break
        level = new
    return table.select("source", "source_size", F.least(F.col("weight") * level, bound).alias("target"))


def thresholds(sized: DataFrame, targets: DataFrame) -> DataFrame:
    """(source, size, hash) rows and targets -> source, source_size, target, passes, cut, ties, ties_taken.

    A document of the source is taken `passes` times, once more if its hash is
    below `cut`.  Rows at `cut` itself (more than one only if rows repeat) are
    `ties`, of which `ties_taken` are taken once more.
    """
    passes = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    state = targets.withColumn("passes", passes).withColumn("left", F.greatest(F.lit(0.0), F.col("target") - F.col("passes") * F.col("source_size")))
    # prefix: the boundary bucket so far
    state = materialize(state.withColumn("prefix", F.lit(0).cast("long")))
    sized, below = sized.where("size > 0"), sum(LEVELS)
    for k, bits in enumerate(LEVELS):
        s = broadcast_if_small(state.select(F.col("source").alias("s"), "prefix", "left"))
        inside = sized.join(s, F.col("source").eqNullSafe(F.col("s")))
        if k:
            inside = inside.where(F.shiftright("hash", below) == F.col("prefix"))
        below -= bits
        hist = inside.groupBy("source", F.shiftright("hash", below).alias("bucket"), "left").agg(F.sum("size").alias("words"), F.count("*").alias("rows"), F.min("size").alias("each"), F.min("hash").alias("lo"), F.max("hash").alias("hi"))
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bucket"))
        # the first bucket that reaches the budget; its source has one bucket at most for which this holds
        edge = hist.withColumn("upto", upto).where("upto >= left and upto - words < left")
        edge = edge.select(F.col("source").alias("s"), F.col("bucket").alias("b"), (F.col("left") - F.col("upto") + F.col("words")).alias("l"), "rows", "each", "lo", "hi")
        keep = ["source", "source_size", "target", "passes"]
        state = materialize(state.select(*keep).join(edge, F.col("source").eqNullSafe(F.col("s")), "left").select(*keep, F.coalesce("b", F.lit(-1)).cast("long").alias("prefix"), F.coalesce("l", F.lit(0.0)).alias("left"), "rows", "each", "lo", "hi"))
        if not state.where("lo < hi").limit(1).count():
            break
    # equal rows at the cut share one hash and so one size; take as many as come nearest to the budget
    taken = F.when(F.col("each") > 0, F.round(F.col("left") / F.col("each"))).otherwise(0).cast("long")
    return state.select("source", "source_size", "target", "passes", F.coalesce("lo", F.lit(0)).cast("long").alias("cut"), F.coalesce("rows", F.lit(0)).cast("long").alias("ties"), F.coalesce(taken, F.lit(0)).cast("long").alias("ties_taken"))


def _taken(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, *, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source") -> DataFrame:
    """rest (docs' columns) with size, source_size, target and taken."""
    text = F.col(quoted(text_col))
    mine = {"of": F.col(quoted(source_col)), "size": n_words(text), "hash": document_hash(F.col(quoted(id_col)), text)}
    sized = materialize(docs.select([v.alias(k) for k, v in mine.items()]).withColumnRenamed("of", "source"))
    by_source = sized.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    cuts = materialize(thresholds(sized, source_targets(by_source, weights, share, most)))
    tied = cuts.where("ties > 1 and ties_taken > 0 and ties_taken < ties").limit(1).count() > 0
    rows = packed(docs, **mine, **({"row": row_hash(docs)} if tied else {})).join(broadcast_if_small(cuts), F.col("of").eqNullSafe(F.col("source")))
    at_cut = (F.col("hash") == F.col("cut")) & (F.col("size") > 0) & (F.col("ties") > 0)
    if tied:
        rows = rows.where(~at_cut).withColumn("n", F.lit(0).cast("long")).unionByName(numbered(materialize(rows.where(at_cut).withColumn("part", F.spark_partition_id()))))
        more = F.when(at_cut, F.col("n") <= F.col("ties_taken")).otherwise(F.col("hash") < F.col("cut"))
    else:
        more = F.when(at_cut, F.col("ties_taken") > 0).otherwise(F.col("hash") < F.col("cut"))
    taken = F.col("size") * (F.col("passes") + more.cast("long"))
    return rows.select("rest", "size", "source_size", "target", taken.cast("long").alias("taken"))


def mix_sources(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, **columns: str) -> DataFrame:
    """docs with size, source_size, target and taken (words the mix takes of the document, repeats counted).

    Sources in code point order, null last, weigh `weights` in turn.  Null and
    empty texts have size 0 and are never taken.  Null ids, repeated rows and
    ties are fine: rows of one hash at a threshold are numbered, in the order of
    a hash of all their columns, and as many are taken as the budget asks for.
    An empty table gives an empty result.  Columns of docs with the names of the
    four results are replaced.  columns: id_col, text_col, source_col.
    """
    docs = drop_columns(docs, ["size", "source_size", "target", "taken"])
    rows = _taken(docs, weights, share, most, **columns)
    return rows.select(*unpacked(rows, docs.columns), "size", "source_size", "target", "taken")


def numbered(ties: DataFrame) -> DataFrame:
    """Rows with of, row (a hash) and part (where they were written) -> n from 1 for each `of`, by row, then part; without part.

    Rows of one hash are alike, so any order of them gives the same result;
    they are numbered part by part, so no task gets all of a source.
    """
    counts = ties.groupBy("of", "row", "part").agg(F.count("*").alias("k"))
    before = F.sum("k").over(Window.partitionBy("of").orderBy("row", "part").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select(F.col("of").alias("o"), F.col("row").alias("r"), F.col("part").alias("p"), F.coalesce(before, F.lit(0)).alias("start"))
    own = F.row_number().over(Window.partitionBy("of", "row", "part").orderBy("hash"))
    rows = ties.withColumn("own", own).join(starts, F.col("of").eqNullSafe(F.col("o")) & (F.col("row") == F.col("r")) & (F.col("part") == F.col("p")))
    return rows.withColumn("n", F.col("own") + F.col("start")).drop("own", "start", "o", "r", "p", "part")


def mixed_documents(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: each document as often as it is taken, in the columns of docs; edge cases and options as in mix_sources."""
    times = F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0).cast("int")
    taken = _taken(docs, **options).where("taken > 0").select("rest", F.explode(F.sequence(F.lit(1), times)))
    return taken.select(unpacked(taken, docs.columns))


def op1_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix_sources(docs).select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {"op1_mix": op1_mix}
SQL = {
    "op1_mix": r"""
with sized as (
  select doc_id, source, cast(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) as bigint) as size,
         cast('0x' || substr(md5(concat_ws('|', cast(doc_id as varchar), text)), 1, 15) as bigint) as h
  from documents),
sources as (
  select source, cast(sum(size) as bigint) as source_size from sized group by source),
weighed as (
  select source, source_size, 2e0 * source_size as bound,
         case (row_number() over (order by source nulls last) - 1) % 3 when 0 then 5e0 when 1 then 2e0 else 1e0 end as w
  from sources),
ranked as (
  select *, bound / w as full_at,
         coalesce(sum(bound) over (order by bound / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as fixed,
         sum(w) over () - coalesce(sum(w) over (order by bound / w, source nulls last rows between unbounded preceding and 1 preceding), 0) as free,
         1.5e0 * sum(source_size) over () as total
  from weighed),
level as (select (total - fixed) / free as level from ranked where full_at >= (total - fixed) / free order by full_at limit 1),
targets as (
  select source, source_size, least(w * level, bound) as target from weighed, level),
budget as (
  select *, case when source_size > 0 then floor(target / source_size) else 0 end as passes from targets),
upto as (
  select s.doc_id, s.size, b.source_size, b.target, b.passes, b.target - b.passes * b.source_size as remains,
         sum(s.size) over (partition by s.source order by s.h rows unbounded preceding) as upto
  from sized s join budget b on s.source is not distinct from b.source)
select doc_id, size, source_size, target,
       cast(size * (passes + case when size = 0 then 0 when upto < remains then 1
            when upto - size < remains and round((remains - (upto - size)) / size) >= 1 then 1 else 0 end) as bigint) as taken
from upto
"""
}
