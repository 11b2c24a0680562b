"""A prefix-sharded search index, and lookups in it.

Lookups by words meet the index in posting lists: of all the parts of a query's
words that are indexed, the one with the fewest keys in the query's shard is
joined, so the work follows the hits and not the shard.  A key stands in the
lists once, however many rows bear it; rows are met once a query's keys are known.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levyframe.functions.text import has_real_id, scrub_control, search_norm
from levyframe.sources.tables import materialize

OWNER_ROWS, ADDR_ROWS, ID_ROWS = 500, 300, 50  # how many hits a lookup shows
#: Lengths of the parts of words that posting lists are kept for; words of one or two letters are a part themselves.
GRAMS = (1, 2, 3, 6, 9)
#: A posting list of more rows than this is dealt out to several tasks.
LIST_ROWS = 50_000


def search_base(parcels: DataFrame, attrs: DataFrame) -> DataFrame:
    """One row for each county, id and address, with the least owner and a point of 5 places; owners only for real ids."""
    owned = parcels.withColumn("own_id", F.when(has_real_id(F.col("prop_id")), F.col("prop_id"))).join(attrs.select("county", F.col("prop_id").alias("own_id"), "owner"), ["county", "own_id"], "left")
    point = lambda c: F.round(F.min(c), 5).alias(c)
    # own_id follows from prop_id; named here, the rows stay as the join dealt them
    return owned.groupBy("county", "own_id", "prop_id", "addr").agg(F.min(scrub_control(F.col("owner"))).alias("owner"), point("x"), point("y")).drop("own_id")


def _line() -> Column:
    return F.concat_ws("\t", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("county", "prop_id", "addr", "owner", "x", "y")])


def owner_index(base: DataFrame) -> DataFrame:
    """(shard, k, line) by the first three of the owner's name."""
    rows = base.withColumn("k", search_norm(F.col("owner"))).where("k <> ''")
    return rows.select(F.substring("k", 1, 3).alias("shard"), "k", _line().alias("line"))


def addr_index(base: DataFrame) -> DataFrame:
    """By the first three digits of the house number, else t_ and the first three."""
    rows = base.withColumn("k", search_norm(F.col("addr"))).where("k <> ''")
    number = F.split_part("k", F.lit(" "), F.lit(1))
    shard = F.when(number.rlike("^[0-9]+$"), F.substring(number, 1, 3)).otherwise(F.concat(F.lit("t_"), F.substring("k", 1, 3)))
    return rows.select(shard.alias("shard"), "k", _line().alias("line"))


def id_index(base: DataFrame) -> DataFrame:
    """By the first three letters and digits of the id; ids that are none are left out."""
    rows = base.where("prop_id <> '0'").withColumn("k", F.regexp_replace(F.upper("prop_id"), "[^A-Z0-9]", "")).where("k <> ''")
    return rows.select(F.substring("k", 1, 3).alias("shard"), "k", _line().alias("line"))


def shard_manifest(index: DataFrame) -> DataFrame:
    return index.groupBy("shard").agg(F.count("*").alias("n"))


def write_index_table(index: DataFrame, table: str, path: str, buckets: int = 64) -> None:
    """The index as a table whose files are dealt by shard and sorted by key.

    A lookup of one shard reads one bucket; a join on the shard reads the table
    where it lies, without an exchange.  Rows are not dealt anew before they are written, so a shard that holds
    most of them is no single task's; each task adds a file to the buckets it has rows of.
    """
    index.write.format("parquet").bucketBy(buckets, "shard").sortBy("shard", "k").option("path", path).option("compression", "zstd").saveAsTable(table)


def look_up(spark: SparkSession, table: str, begins: str) -> DataFrame:
    """The lines of an index table whose keys begin so; three characters or more, which name the shard."""
    return spark.table(table).where((F.col("shard") == begins[:3]) & F.col("k").startswith(begins))


def look_up_all(spark: SparkSession, table: str, queries: DataFrame) -> DataFrame:
    """(q, k, line) for ids q of three characters or more and the keys that begin with them; only the queries are moved."""
    asked = queries.select("q").distinct().where(F.length("q") >= 3).withColumn("shard", F.substring("q", 1, 3))
    return spark.table(table).join(asked, "shard").where(F.col("k").startswith(F.col("q"))).select("q", "k", "line")


def hit_fields(line: Column) -> dict[str, Column]:
    parts = F.split(line, "\t")
    return {n: F.get(parts, i) for i, n in enumerate(("county", "prop_id", "addr", "owner", "x", "y"))}


def _tokens(query: Column) -> Column:
    return F.filter(F.split(search_norm(query), " "), lambda x: x != "")


def _parts(word: Column, sizes) -> Column:
    """All parts of a word that have one of these lengths."""
    each = lambda n: F.when(F.length(word) >= n, F.transform(F.sequence(F.lit(1), F.length(word) - (n - 1)), lambda i: F.substring(word, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))
    return F.concat(*[each(n) for n in sizes])


def posting_lists(index: DataFrame) -> DataFrame:
    """(shard, gram, id) of an index (shard, k, line): each part of its words once a key.  May be written once and handed to lookups."""
    words = F.array_distinct(F.split("k", " "))
    grams = F.array_distinct(F.flatten(F.transform(words, lambda w: _parts(w, GRAMS))))
    return index.select("shard", "k").distinct().select("shard", _key_id(), F.explode(grams).alias("gram")).where("gram <> ''")


def _key_id() -> Column:
    return F.xxhash64("shard", "k").alias("id")


def _asked_parts(tokens: Column) -> Column:
    """Parts that every hit has: the longest kinds that a word has, and words of one or two letters whole."""

    def of(word: Column) -> Column:
        n = F.length(word)
        return F.when(n >= 9, _parts(word, (9, 6))).when(n >= 6, _parts(word, (6, 3))).when(n >= 3, _parts(word, (3,))).otherwise(F.array(word))

    return F.array_distinct(F.flatten(F.transform(tokens, of)))


def _hits(index: DataFrame, asked: DataFrame, postings: DataFrame | None, fits: Column) -> DataFrame:
    """Rows of the index beside the queries (q, shard, tokens, ..) that their keys fit; only keys that have a query's rarest part are tried.

    Only lists that some query names are kept, and counted.  A list of many keys
    is dealt out by key, and meets its queries once a share.
    """
    asked, keys = materialize(asked), materialize(index.select("shard", "k").distinct())
    parts = materialize(asked.select("q", "shard", F.explode(_asked_parts(F.col("tokens"))).alias("gram")))
    lists = posting_lists(keys) if postings is None else postings
    lists = materialize(lists.join(parts.select("shard", "gram").distinct(), ["shard", "gram"], "left_semi"))
    sizes = lists.groupBy("shard", "gram").agg(F.count("*").alias("n"))
    found = parts.join(sizes, ["shard", "gram"], "left").groupBy("q", "shard").agg(F.min(F.struct("n", "gram")).alias("least"), F.bool_and(F.col("n").isNotNull()).alias("all"))
    shares = F.ceil(F.col("least.n") / LIST_ROWS).cast("int").alias("shares")
    rarest = materialize(found.where("all").select("q", "shard", F.col("least.gram").alias("gram"), shares))
    share = F.pmod(F.xxhash64("id", F.lit(1)), F.col("shares")).cast("int").alias("share")
    dealt = lists.join(rarest.select("shard", "gram", "shares").distinct(), ["shard", "gram"]).select("shard", "gram", "id", share)
    each = rarest.select("q", "shard", "gram", F.explode(F.sequence(F.lit(0), F.col("shares") - 1)).alias("share"))
    met = dealt.join(each, ["shard", "gram", "share"]).select("q", "shard", "id").distinct()
    fitting = met.join(keys.withColumn("id", _key_id()), ["shard", "id"]).join(asked, ["q", "shard"]).where(fits)
    return index.join(materialize(fitting.select("q", "shard", "k", "n")), ["shard", "k"])


def _whole_hits(hit: DataFrame) -> DataFrame:
    hit = hit.withColumns({k: v for k, v in hit_fields(F.col("line")).items() if k in ("county", "prop_id", "addr")})
    return hit.groupBy("q", "n", "county", "prop_id", "addr").agg(F.min("k").alias("k"))


def search_owner(index: DataFrame, queries: DataFrame, postings: DataFrame | None = None, most: int | None = OWNER_ROWS) -> DataFrame:
    """(q) of three letters or more -> q and hits that have every token; those that begin with the query first, then by name; all if most is None.

    A query reads the shards of its first and its last token.
    """
    asked = queries.select("q").distinct().withColumn("n", search_norm(F.col("q"))).where(F.length("n") >= 3).withColumn("tokens", _tokens(F.col("q")))
    asked = asked.withColumn("shard", F.explode(F.array_distinct(F.array(F.substring("n", 1, 3), F.substring(F.element_at("tokens", -1), 1, 3)))))
    hit = _hits(index, asked, postings, F.forall("tokens", lambda t: F.contains(F.col("k"), t)))
    return _shown(_whole_hits(hit), [F.when(F.col("k").startswith(F.col("n")), 0).otherwise(1), F.col("k"), F.col("county"), F.col("prop_id"), F.col("addr")], most)


def search_addr(index: DataFrame, queries: DataFrame, postings: DataFrame | None = None) -> DataFrame:
    """Number first, then street words: hits whose number begins with the query's and that have every other word; without a
    number, hits that have every word.  Beginnings first, then the shorter."""
    asked = queries.select("q").distinct().withColumn("n", search_norm(F.col("q"))).where(F.length("n") >= 3).withColumn("tokens", _tokens(F.col("q"))).withColumn("number", F.get("tokens", 0))
    numbered = F.col("number").rlike("^[0-9]+$")
    asked = asked.withColumn("shard", F.when(numbered, F.substring("number", 1, 3)).otherwise(F.concat(F.lit("t_"), F.substring("n", 1, 3))))
    hit = _hits(index, asked, postings, (~numbered | F.col("k").startswith(F.col("number"))) & F.forall("tokens", lambda t: F.contains(F.col("k"), t)))
    return _shown(_whole_hits(hit), [F.when(F.col("k").startswith(F.col("n")), 0).otherwise(1), F.length("k"), F.col("k"), F.col("county"), F.col("prop_id")], ADDR_ROWS)


def search_id(index: DataFrame, queries: DataFrame) -> DataFrame:
    """Ids that begin with the query's letters and digits: an id meets queries by its own beginnings."""
    asked = queries.select("q").distinct().withColumn("n", F.regexp_replace(F.upper("q"), "[^A-Z0-9]", "")).where(F.length("n") >= 3)
    begins = F.explode(F.transform(F.sequence(F.lit(3), F.length("k")), lambda i: F.substring(F.col("k"), F.lit(1), i))).alias("n")
    hit = index.where(F.length("k") >= 3).select("k", "line", begins).join(asked, "n")
    hit = hit.withColumns({k: v for k, v in hit_fields(F.col("line")).items() if k in ("county", "prop_id", "addr")})
    return _shown(hit.select("q", "n", "county", "prop_id", "addr", "k").distinct(), [F.col("k"), F.col("county"), F.col("addr")], ID_ROWS)


def _shown(hits: DataFrame, order: list[Column], most: int | None) -> DataFrame:
    """The first hits of each query, numbered; what a reader sees, so the rest isn't wanted.  All of them if most is None."""
    rank = F.row_number().over(Window.partitionBy("q").orderBy(*order))
    hits = hits.withColumn("rank", rank)
    return (hits if most is None else hits.where(F.col("rank") <= most)).select("q", "rank", "county", "prop_id", "addr", "k")


def render_hits(rows: DataFrame) -> DataFrame:
    """A label for each hit; addresses without a letter or digit count as none."""
    addr = F.when(F.coalesce(F.col("addr"), F.lit("")).rlike("[A-Za-z0-9]"), F.col("addr")).otherwise("(no situs address)")
    return rows.withColumn("label", F.concat_ws(" · ", F.nullif("owner", F.lit("")), addr, "county", F.when(has_real_id(F.col("prop_id")), F.concat(F.lit("#"), "prop_id"))))
