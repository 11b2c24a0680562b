"""Spelling variants grouped around their commonest form, by Bloom-guided neighbourhoods.

Words of the whole corpus are counted.  Each word then generates its edits:
with one letter taken out, and with one letter replaced by a later one of the
corpus's alphabet (a pair of near words is so met once, from the longer or the
smaller side).  Edits are never built as strings: their hash follows from the
word's by one addition.  It is looked up in broadcast blocked Bloom filters, one
shard a length; only edits that pass are spelled out and meet the vocabulary in
an exact join, which removes what passed by chance.

The filters have a fixed size.  A vocabulary that outgrows them is cut by hash
into slices that are probed one after another, so nothing that is broadcast
grows with the data and no filter fills up.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import columns_of, materialize, partitions, quoted, read

#: Letters of a word, as bytes of Latin-1; a run is as long as it can be.
LEAST = 7
RUN = re.compile(rb"[A-Za-z\xC0-\xFF]{%d,}" % LEAST)
#: One run in so many loses a letter.
SLIPS = 31
#: 64-bit blocks of all filters of one slice (32 MB), bits for each of its words, bits that a word sets in its block.
BLOCKS, BITS_A_WORD, SET_BITS = 1 << 22, 24, 5
#: Words of this length and more share a shard of the filter.
LONGEST_SHARD = 64
#: Words that a task counts before it hands them on, and edits that are hashed at once.
COUNTED, AT_ONCE = 300_000, 1 << 20


def slipped(word: bytes, start: int) -> bytes:
    """The word, or what a slip leaves of it; start: the crc32 of what comes before the word."""
    h = zlib.crc32(word if word.isascii() else word.decode("latin-1").encode(), start)
    if h % SLIPS:
        return word
    i = h % len(word)
    return word[:i] + word[i + 1 :]


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter[bytes] = Counter()

    def flush() -> pa.RecordBatch:
        words = [w.decode("latin-1") for w in counts]
        out = pa.RecordBatch.from_arrays([pa.array(words, pa.string()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
        counts.clear()
        return out

    for batch in batches:
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            runs = Counter(RUN.findall((text.as_py() or "").encode("latin-1", "replace").lower()))  # lower() knows A-Z alone
            start = zlib.crc32(f"{'' if doc is None else doc}:".encode())
            for run, n in runs.items():
                word = slipped(run, start)
                if len(word) >= LEAST:
                    counts[word] += n
            if len(counts) >= COUNTED:
                yield flush()
    yield flush()


def vocabulary(docs: DataFrame, least_n: int = 2, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): words of LEAST code points or more that come `least_n` times or more in all texts, slips made."""
    words = docs.select(quoted(id_col), quoted(text_col)).mapInArrow(_count_words, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_n)


def _values() -> tuple[np.ndarray, int]:
    """A random value for each letter, and an odd base."""
    rng = np.random.default_rng(1913)
    return rng.integers(1 << 63, size=256, dtype=np.uint64) * np.uint64(2) + np.uint64(1), int(rng.integers(1 << 62)) * 2 + 1


def _powers(n: int) -> np.ndarray:
    return np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(n, _values()[1], np.uint64))))


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def _by_length(words: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(rows, letters): a matrix of letters, a row a word, for the words of each length."""
    raw = [w.encode("latin-1") for w in words.to_pylist()]
    sizes = np.fromiter(map(len, raw), np.int64, len(raw))
    for size in np.unique(sizes):
        rows = np.flatnonzero(sizes == size)
        for part in np.array_split(rows, -(-len(rows) * int(size) // AT_ONCE)):
            yield part, np.frombuffer(b"".join(raw[r] for r in part), np.uint8).reshape(len(part), int(size))


def _sums(letters: np.ndarray) -> np.ndarray:
    """Running sums of each row's hash: column i has that of the first i letters."""
    out = np.zeros((len(letters), letters.shape[1] + 1), np.uint64)
    np.cumsum(_values()[0][letters] * _powers(letters.shape[1])[:-1], axis=1, out=out[:, 1:])
    return out


class Shards:
    """Where each length's blocks lie within one slice's filter."""

    def __init__(self, counts: dict[int, int], slices: int) -> None:
        self.slices, self.at, total = slices, {}, 0
        for size, n in sorted(counts.items()):
            blocks = max(1, math.ceil(n / slices * BITS_A_WORD / 64))
            self.at[size], total = (total, blocks), total + blocks
        self.blocks = total

    def place(self, h: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slice, block, bits) of hashes of words of this length."""
        at, blocks = self.at[min(size, LONGEST_SHARD)]
        block = at + (((h >> np.uint64(32)) * np.uint64(blocks)) >> np.uint64(32)).astype(np.int64)
        bits = np.zeros(len(h), np.uint64)
        for k in range(SET_BITS):
            bits |= np.uint64(1) << ((h >> np.uint64(6 * k)) & np.uint64(63))
        part = _mix(h) % np.uint64(self.slices) if self.slices > 1 else np.zeros(len(h), np.uint64)
        return part, block, bits


def _set_bits(shards: Shards):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, letters in _by_length(batch.column(0)):
                part, block, bits = shards.place(_mix(_sums(letters)[:, -1]), letters.shape[1])
                yield pa.RecordBatch.from_arrays([pa.array(part.view(np.int64)), pa.array(block), pa.array(bits.view(np.int64))], names=["slice", "block", "bits"])

    return run


def filters(vocab: DataFrame, blocks: int = BLOCKS) -> tuple[Shards, Iterator[np.ndarray]]:
    """The shards, and each slice's filter in turn; a filter has about `blocks` blocks at most, whatever the vocabulary."""
    size = F.least(F.char_length("word"), F.lit(LONGEST_SHARD)).alias("size")
    counts = {r["size"]: r["n"] for r in vocab.groupBy(size).agg(F.count("*").alias("n")).collect()}
    shards = Shards(counts, max(1, math.ceil(sum(counts.values()) * BITS_A_WORD / 64 / blocks)))
    placed = vocab.select("word").mapInArrow(_set_bits(shards), "slice long, block long, bits long")
    placed = placed.groupBy("slice", "block").agg(F.bit_or("bits").alias("bits"))
    if shards.slices > 1:
        placed = materialize(placed)

    def one(k: int) -> np.ndarray:
        block, bits = columns_of(placed.where(F.col("slice") == k).select("block", "bits"))
        filled = np.zeros(shards.blocks, np.uint64)
        filled[block] = bits.view(np.uint64)
        return filled

    return shards, map(one, range(shards.slices))


def _spelled(letters: np.ndarray) -> list[str]:
    return [w.decode("latin-1") for w in letters.copy().view(f"S{letters.shape[1]}").ravel().tolist()]


def near_candidates(letters: np.ndarray, alphabet: np.ndarray, shards: Shards, known: np.ndarray, part: int) -> Iterator[tuple[np.ndarray, list[str]]]:
    """(row, word) for edits of words of one length that the filter of a slice lets through."""
    values, size = _values()[0], letters.shape[1]
    powers, sums = _powers(size), _sums(letters)
    back = np.uint64(pow(_values()[1], -1, 1 << 64))

    def passed(h: np.ndarray, length: int) -> np.ndarray:
        h = _mix(h)
        of, block, bits = shards.place(h, length)
        return np.flatnonzero((known[block] & bits == bits) & (of == part))

    if size > LEAST and min(size - 1, LONGEST_SHARD) in shards.at:
        for i in range(size):
            # of equal letters in a row, only the last is taken out
            rows = np.flatnonzero(letters[:, i] != letters[:, i + 1]) if i + 1 < size else np.arange(len(letters))
            rows = rows[passed(sums[rows, i] + (sums[rows, -1] - sums[rows, i + 1]) * back, size - 1)]
            if len(rows):
                yield rows, _spelled(np.delete(letters[rows], i, axis=1))
    for i in range(size):
        rows, new = np.nonzero(alphabet[None, :] > letters[:, i, None])
        h = sums[rows, -1] + (values[alphabet[new]] - values[letters[rows, i]]) * powers[i]
        some = passed(h, size)
        if len(some):
            words = letters[rows[some]]
            words[:, i] = alphabet[new[some]]
            yield rows[some], _spelled(words)


def _probe(shards: Shards, known, alphabet: np.ndarray, part: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for of, letters in _by_length(batch.column(0)):
                # a few rows at once: edits of a word are many
                for rows in np.array_split(np.arange(len(of)), -(-len(of) * max(1, len(alphabet)) // AT_ONCE)):
                    for hit, words in near_candidates(letters[rows], alphabet, shards, known.value, part):
                        take = pa.array(of[rows][hit])
                        yield pa.RecordBatch.from_arrays([pa.array(words, pa.string()), batch.column(0).take(take), batch.column(1).take(take)], names=["b", "a", "a_n"])

    return run


def near_pairs(vocab: DataFrame, blocks: int = BLOCKS) -> DataFrame:
    """(a, a_n, b, b_n): each pair of words (word, n) once that differ by one letter put in, taken out or replaced."""
    spark = vocab.sparkSession
    letters = vocab.select(F.explode(F.split("word", "")).alias("l")).where("l <> ''").distinct()
    alphabet = np.array(sorted(ord(r["l"]) for r in letters.collect()), np.uint8)  # 90 letters at most
    shards, every = filters(vocab, blocks)
    dealt = vocab.select("word", "n").repartition(partitions(spark))
    found = []
    for part, filled in enumerate(every):
        known = spark.sparkContext.broadcast(filled)
        found.append(dealt.mapInArrow(_probe(shards, known, alphabet, part), "b string, a string, a_n long"))
        if shards.slices > 1:  # one filter at a time
            found[-1] = materialize(found[-1])
            known.destroy()
    found = reduce(DataFrame.unionByName, found)
    return found.join(vocab.select(F.col("word").alias("b"), F.col("n").alias("b_n")), "b").select("a", "a_n", "b", "b_n")


def spelling_variants(docs: DataFrame, least_n: int = 2, factor: int = 10, blocks: int = BLOCKS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) for each word of LEAST letters or more that comes `least_n` times.

    n_near counts the near words; form is the one of largest n (ties: the
    smallest in code-point order) if that is at least `factor` times the word's
    own, else null; root is where forms lead in the end, or the word.  Null and
    empty texts have no words; a null id counts as an empty one; repeated rows
    count each; an empty table, or one without such words, gives an empty
    result; other columns are not read.
    """
    vocab = materialize(vocabulary(docs, least_n, id_col=id_col, text_col=text_col))
    pairs = materialize(near_pairs(vocab, blocks))
    both = pairs.select(F.col("a").alias("word"), F.col("b").alias("near"), F.col("b_n").alias("near_n"))
    both = both.unionByName(pairs.select(F.col("b").alias("word"), F.col("a").alias("near"), F.col("a_n").alias("near_n")))
    best = both.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    form_n = -F.col("best.less")
    good = form_n >= factor * F.col("n")
    rows = vocab.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(good, F.col("best.near")).alias("form"), F.when(good, form_n).alias("form_n")
    )
    rows = materialize(rows)
    # n grows by the factor with each step, so forms lead on only so often; each round doubles the steps that are known
    steps = math.log(max(rows.agg(F.max("form_n")).first()[0] or 1, 1), max(2, factor))
    roots = rows.where("form is not null").select("word", F.col("form").alias("root"))
    for _ in range(math.ceil(math.log2(max(steps, 1))) + 1):
        further = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = materialize(roots.join(further, "root", "left").select("word", F.coalesce("next", "root").alias("root")))
    return rows.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))


def op11_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(read(spark, sf_dir, "documents")).select("word", "form", "root", "n", "n_near", "form_n")


QUERIES = {"op11_spelling": op11_spelling}
SQL = {
    "op11_spelling": r"""
with recursive
byte_crc as (select list(c order by b) as t from (
  select b, list_reduce(list_prepend(b, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) as c from (select unnest(range(256)) as b) x) y),
run as (select doc_id, unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\x{C0}-\x{FF}]+')) as w from documents),
low as (select doc_id, translate(w, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as w, count(*) as n from run where length(w) >= 7 group by 1, 2),
bytes as (select *, flatten(list_transform(string_split(coalesce(cast(doc_id as varchar), '') || ':' || w, ''),
  lambda x: case when unicode(x) < 128 then [cast(unicode(x) as bigint)] else [cast(192 | (unicode(x) >> 6) as bigint), cast(128 | (unicode(x) & 63) as bigint)] end)) as b from low),
crc as (select w, n, xor(list_reduce(list_prepend(cast(4294967295 as bigint), b), lambda c, x: xor(c >> 8, t[xor(c & 255, x) + 1])), 4294967295) as h from bytes, byte_crc),
slip as (select case when h % 31 = 0 then w[: h % length(w)] || w[h % length(w) + 2 :] else w end as word, n from crc),
v as (select word, cast(sum(n) as bigint) as n from slip where length(word) >= 7 group by 1 having sum(n) >= 2),
cut as (select distinct word, n, w from (select word, n, word[: i - 1] || word[i + 1 :] as w from v, range(1, length(word) + 1) r(i)) x),
gap as (select word, n, i, word[: i - 1] || word[i + 1 :] as w from v, range(1, length(word) + 1) r(i)),
pair as (
  select cut.word, v.word as near, v.n as near_n from cut join v on cut.w = v.word
  union all select v.word, cut.word, cut.n from cut join v on cut.w = v.word
  union all select a.word, b.word, b.n from gap a join gap b on a.w = b.w and a.i = b.i and a.word <> b.word),
best as (select word, count(*) as n_near, max(near_n) as top from pair group by 1),
form as (select word, min(near) as form, any_value(top) as form_n, any_value(n_near) as n_near from pair join best using (word) where near_n = top group by 1),
r as (select v.word, v.n, coalesce(n_near, 0) as n_near, case when form_n >= 10 * v.n then form end as form, case when form_n >= 10 * v.n then form_n end as form_n from v left join form using (word)),
walk as (select word, word as root, 0 as step from r union all select walk.word, r.form, step + 1 from walk join r on walk.root = r.word where r.form is not null),
root as (select word, arg_max(root, step) as root from walk group by 1)
select r.word, form, root, n, n_near, form_n from r join root using (word)
"""
}
