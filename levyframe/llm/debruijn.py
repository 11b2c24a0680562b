"""Substring dedup by compaction of the de Bruijn graph of words.

A window of `window` (20) words is an edge of the graph, from the node of its
first words to that of its last.  Edges that follow each other in a text and
share their minimizer (the least hash of their k-grams of words) are one piece
of a path; equal windows always share it, so pieces of one minimizer are all
that must be compared.

1. Minimizers that occur once in all texts have no repeated edge; a filter of
   fixed size leaves them out.
2. Equal pieces are counted, with their first place in the sources.
3. A piece that always goes on to the same piece, which always comes from it, is
   no branching: both occur equally often, at places that move along together.
   Such pieces compact to paths by pointer doubling, one join a round.  A path's
   later occurrences go whole, as spans from where its head occurs.
4. Where the pieces of one minimizer differ, or one winds back to its own edges,
   their first occurrences give up their single edges, and an edge's first place
   is found among these.

Places in the sources (id, text, word) say what comes first, and are what spans
are made of.  Pieces, and edges, are told apart by two 64-bit hashes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from levyframe.llm.common import columns_of, materialize, packed, quoted, read, result_schema, unpacked

#: Words of a window, and of the k-grams of which the least is its minimizer.
WINDOW, GRAM = 20, 8
#: Words of a text, and bytes of several, that are hashed at once; texts that a task remembers so as not to send one twice.
WORDS, BYTES, REMEMBERED = 1 << 17, 1 << 18, 200_000
#: Bits of the filters that say which minimizers and texts are needed; 16 MB whatever the input.
FILTER_BITS = 1 << 27
NO_ID = (1 << 63) - 1
WHITE = b" \t\n\x0b\x0c\r"


@lru_cache(maxsize=1)
def _powers() -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64."""
    base = int(np.random.default_rng(4242).integers(1 << 62)) * 2 + 1
    powers = lambda b: np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(2 * max(WORDS, BYTES), b, np.uint64))))
    return powers(base), powers(pow(base, -1, 1 << 64))


@lru_cache(maxsize=1)
def _values() -> np.ndarray:
    """A random value for each byte, 0 for white space."""
    values = np.random.default_rng(977).integers(1, 1 << 63, size=256, dtype=np.uint64)
    values[list(WHITE)] = 0
    return values


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def slices(raw: bytes, at_once: int) -> Iterator[bytes]:
    """A text in parts of `at_once` bytes at most, cut before white space; a longer part is a single word."""
    lo, n = 0, len(raw)
    while n - lo > at_once:
        cut = max(raw.rfind(WHITE[k : k + 1], lo + 1, lo + at_once + 1) for k in range(len(WHITE)))
        if cut < 0:
            cut = min((x for k in range(len(WHITE)) if (x := raw.find(WHITE[k : k + 1], lo + 1)) >= 0), default=n)
        yield raw[lo:cut]
        lo = cut
    yield raw[lo:]


def word_hashes(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """(start, hash) of the words of some text."""
    powers, inverse = _powers()
    values = _values()
    if len(raw) > BYTES:  # a word longer than the tables: the same sum, part by part
        word, total = raw.strip(WHITE), 0
        for lo in range(0, len(word), BYTES):
            part = np.frombuffer(word[lo : lo + BYTES], np.uint8)
            total += int((values[part] * powers[: len(part)]).sum()) * pow(int(powers[1]), lo, 1 << 64)
        return np.zeros(1, np.int64), _mix(np.array([total & 0xFFFFFFFFFFFFFFFF], np.uint64))
    data = np.frombuffer(raw, np.uint8)
    white = np.ones(len(data) + 2, bool)
    white[1:-1] = values[data] == 0
    ends = np.flatnonzero(white[1:] != white[:-1])
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(values[data] * powers[: len(data)])))
    return ends[::2], _mix((sums[ends[1::2]] - sums[ends[::2]]) * inverse[ends[::2]])


def long_text(raw: bytes, window: int) -> Iterator[tuple[int, np.ndarray]]:
    """(place of the first, hashes of words) so that each window of a text lies in exactly one such block."""
    base, held = 0, np.zeros(0, np.uint64)
    for part in slices(raw, BYTES):
        held = np.concatenate((held, word_hashes(part)[1]))
        while len(held) >= WORDS + window:
            yield base, held[:WORDS]
            base, held = base + WORDS - window + 1, held[WORDS - window + 1 :]
    yield base, held


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours."""
    have = 1
    while have < width:
        step = min(have, width - have)
        x, have = np.minimum(x[:-step], x[step:]), have + step
    return x


class Pieces:
    """The pieces of some stretches of words (id, text's hash, place of the first, number of words), whose words' hashes
    follow each other: runs of windows of one stretch that have one minimizer."""

    def __init__(self, stretches: list[tuple[int, int, int, int]], words: np.ndarray, window: int, gram: int) -> None:
        ids, keys, bases, sizes = (np.array(x, np.int64) for x in zip(*stretches, strict=True))
        of = np.repeat(np.arange(len(sizes)), sizes)
        powers, self.inverse = _powers()
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * powers[: len(words)])))
        grams, width = self.hashes(np.arange(max(0, len(words) - gram + 1)), gram), window - gram + 1
        least = _least(grams, width)
        inside = np.flatnonzero(of[: len(least)] == of[window - 1 :])  # windows that lie in one stretch
        least, of = least[inside], of[inside]
        first = np.flatnonzero(np.concatenate((np.ones(min(1, len(least)), bool), (least[1:] != least[:-1]) | (of[1:] != of[:-1]))))
        self.lo, self.n = inside[first], np.diff(np.append(first, len(least)))
        # a piece that has its minimizer at several places may repeat edges within itself
        last, of = inside[first + self.n - 1] if len(first) else self.lo, of[first]
        same = lambda lo: grams[lo[:, None] + np.arange(width)] == least[first][:, None]
        self.winds = self.lo + same(self.lo).argmax(axis=1) != last + width - 1 - same(last)[:, ::-1].argmax(axis=1)
        self.minimizer = least[first].view(np.int64)
        self.id, self.key, self.at = ids[of], keys[of], self.lo - (np.cumsum(sizes) - sizes)[of] + bases[of]
        content = _mix((self.sums[self.lo + self.n + window - 1] - self.sums[self.lo]) * self.inverse[self.lo])
        self.content = (_mix(content ^ self.n.astype(np.uint64)) | np.uint64(1)).view(np.int64)  # never 0
        goes_on = of[1:] == of[:-1]
        self.next, self.prev = np.zeros_like(self.content), np.zeros_like(self.content)
        self.next[:-1][goes_on], self.prev[1:][goes_on] = self.content[1:][goes_on], self.content[:-1][goes_on]

    def hashes(self, starts: np.ndarray, n: int) -> np.ndarray:
        return _mix((self.sums[starts + n] - self.sums[starts]) * self.inverse[starts])

    def edges(self, some: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number of the piece, windows before it in the piece) of each window of some pieces."""
        n = self.n[some]
        ends = np.cumsum(n)
        return np.repeat(some, n), np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - n, n)


def _blocks(batches: Iterator[pa.RecordBatch], window: int, gram: int) -> Iterator[Pieces]:
    """The pieces of all texts, some texts at a time; one that comes again under a larger id adds nothing."""
    seen: dict[int, int] = {}
    some, n = [], 0

    def together() -> Pieces:
        starts, words = word_hashes(b"\n".join(x[2] for x in some))
        sizes = np.diff(np.searchsorted(starts, np.cumsum([0, *(len(x[2]) + 1 for x in some)])))
        return Pieces([(of, key, 0, size) for (of, key, _), size in zip(some, sizes.tolist(), strict=True)], words, window, gram)

    for batch in batches:
        for of, key, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
            if seen.get(key, of + 1) <= of:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen[key] = of
            raw = text.as_py() or b""
            if len(raw) >= BYTES:
                for base, words in long_text(raw, window):
                    yield Pieces([(of, key, base, len(words))], words, window, gram)
                continue
            if n + len(raw) >= BYTES:
                yield together()
                some, n = [], 0
            some.append((of, key, raw))
            n += len(raw) + 1
    if some:
        yield together()


def _in_filter(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    low = keys & (FILTER_BITS - 1)
    return (bits[low >> 3] >> (low & 7).astype(np.uint8)) & 1 > 0


def bit_filter(keys: DataFrame, column: str) -> np.ndarray:
    """A set of bits, one for the low end of each key: FILTER_BITS bits whatever the number of keys, which only makes it less selective."""
    low = F.col(column).bitwiseAND(FILTER_BITS - 1)
    at, bits = columns_of(keys.groupBy(F.shiftright(low, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast(`{column}` & 63 as int))")).alias("bits")))
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    filled[at] = bits
    return filled.view(np.uint8)


def _batch(columns: list[list[np.ndarray]], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c) if c else np.zeros(0, np.int64)) for c in columns], names=names)


def _rows(made: Iterator[list[np.ndarray]], names: list[str], at_once: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Columns of some rows after others, handed on some thousand rows at once."""
    columns, n = [[] for _ in names], 0
    for part in made:
        for to, x in zip(columns, part, strict=True):
            to.append(x)
        n += len(part[0])
        if n >= at_once:
            yield _batch(columns, names)
            columns, n = [[] for _ in names], 0
    yield _batch(columns, names)


def _send_minimizers(window: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # a piece that may repeat itself counts twice
        yield from _rows(([np.concatenate((p.minimizer, p.minimizer[p.winds])) & ((1 << 31) - 1)] for p in _blocks(batches, window, gram)), ["m"])

    return run


#: n is negative for pieces that may repeat themselves.
PIECE = "m long, c long, id long, h long, at long, n long, next long, prev long"
EDGE = "m long, e long, id long, h long, at long"


def _send_pieces(window: int, gram: int, known: np.ndarray):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for p in _blocks(batches, window, gram):
            some = np.flatnonzero(_in_filter(known, p.minimizer & ((1 << 31) - 1)))
            yield [x[some] for x in (p.minimizer, p.content, p.id, p.key, p.at, np.where(p.winds, -p.n, p.n), p.next, p.prev)]

    return lambda batches: _rows(made(batches), ["m", "c", "id", "h", "at", "n", "next", "prev"])


def _send_edges(window: int, gram: int, wanted: np.ndarray):
    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
        for p in _blocks(batches, window, gram):
            piece, further = p.edges(np.flatnonzero(_in_filter(wanted, _place_key(p.content, p.id, p.key, p.at))))
            yield [p.minimizer[piece], p.hashes(p.lo[piece] + further, window).view(np.int64), p.id[piece], p.key[piece], p.at[piece] + further]

    return lambda batches: _rows(made(batches), ["m", "e", "id", "h", "at"])


def _place_key(content, of, key, at):
    """A key of a piece at its place, for a filter; the same in NumPy and, column by column, in Spark."""
    return content ^ key ^ at ^ (of << 13)


def _texts(docs: DataFrame) -> DataFrame:
    """(id, h, text): what is told apart; null ids come last, null texts have no words."""
    text = F.col("text")
    return docs.select(F.coalesce(F.col("id"), F.lit(NO_ID)).alias("id"), F.xxhash64(F.coalesce(text, F.lit(""))).alias("h"), text)


def compacted(pieces: DataFrame) -> DataFrame:
    """Pieces that repeat (c, n, next, prev: what always comes next and before, 0 if that differs) -> (c, steps): the head of
    each path, and how many edges the path has.  c tells pieces apart.

    Pointers to the piece before are doubled until each leads to its path's head.
    """
    a, b = pieces.select(F.col("c").alias("up"), F.col("next").alias("c"), F.col("n").alias("steps")).where("c <> 0"), pieces.select("c", F.col("prev").alias("up")).where("up <> 0")
    pointers, moved = materialize(a.join(b, ["c", "up"])), True
    while moved:
        # who points at a piece that points on, points where that does
        further = pointers.select(F.col("c").alias("up"), F.col("up").alias("over"), F.col("steps").alias("more"))
        joined = pointers.join(further, "up", "left")
        pointers = materialize(joined.select("c", F.coalesce("over", "up").alias("up"), (F.col("steps") + F.coalesce("more", F.lit(0))).alias("steps"), F.col("over").isNotNull().alias("moved")))
        moved = pointers.where("moved").limit(1).count() > 0
        pointers = pointers.drop("moved")
    length = pointers.join(pieces.select("c", "n"), "c").groupBy("up").agg(F.max(F.col("steps") + F.col("n")).alias("far"))
    heads = pieces.join(pointers.select("c"), "c", "left_anti")
    return heads.join(length, heads["c"] == length["up"], "left").select("c", F.coalesce("far", "n").alias("steps"))


def repeated_spans(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(id, h, lo, hi): for documents (id, text), words [lo, hi) that later occurrences of windows cover; spans may overlap.

    An occurrence is later than another if its id is larger (null last), at the
    same id its text's hash, in one text its place.  Rows of the same id and text are one here.
    """
    texts = _texts(docs)
    counted = texts.mapInArrow(_send_minimizers(window, gram), "m long").groupBy(F.col("m").cast("int").alias("m")).agg(F.count("*").alias("k"))
    twice = bit_filter(counted.where("k > 1").select(F.col("m").cast("long").alias("m")), "m")
    pieces = materialize(texts.mapInArrow(_send_pieces(window, gram, twice), PIECE))

    place, seen = F.struct("id", "h", "at"), F.xxhash64("id", "h", "at")
    only = lambda c: F.when(F.min(c) == F.max(c), F.min(c)).otherwise(F.lit(0)).alias(c)
    kinds = pieces.groupBy("m", "c").agg(
        F.min(place).alias("first"), (F.min(seen) != F.max(seen)).alias("again"), F.abs(F.max("n")).alias("n"), (F.max("n") < 0).alias("winds"), only("next"), only("prev")
    )
    kinds = materialize(kinds)
    several = kinds.groupBy("m").agg(F.count("*").alias("k"), F.max("winds").alias("winds")).where("k > 1 or winds").select("m")

    # paths without branching, and where they come again
    heads = compacted(kinds.where("again").select("c", "n", "next", "prev"))
    heads = materialize(kinds.where("again").select("m", "c", "first").join(heads, "c"))
    later = pieces.select("m", "c", "id", "h", "at").mapInArrow(_only_known(bit_filter(heads, "c")), "m long, c long, id long, h long, at long")
    later = later.join(heads, ["m", "c"]).where(place != F.col("first"))
    spans = later.select("id", "h", F.col("at").alias("lo"), (F.col("at") + F.col("steps") + (window - 1)).alias("hi"))

    # single edges, where pieces of one minimizer differ
    differing = kinds.join(several, "m").select(_place_key_column().alias("key"))
    edges = materialize(texts.mapInArrow(_send_edges(window, gram, bit_filter(differing, "key")), EDGE))
    firsts = edges.groupBy("m", "e").agg(F.min(place).alias("first"), F.count("*").alias("k")).where("k > 1").drop("k")
    alone = edges.join(materialize(firsts), ["m", "e"]).where(place != F.col("first"))
    return spans.unionByName(alone.select("id", "h", F.col("at").alias("lo"), (F.col("at") + window).alias("hi")))


def _place_key_column():
    return F.expr("c ^ first.h ^ first.at ^ shiftleft(first.id, 13)")


def _only_known(bits: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield batch.filter(pa.array(_in_filter(bits, batch.column(1).to_numpy())))

    return run


def kept_runs(n: int, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """What spans leave of n words, as maximal runs."""
    out, at = [], 0
    for lo, hi in sorted(spans):
        if lo > at:
            out.append((at, lo))
        at = max(at, hi)
    return [*out, (at, n)] if at < n else out


def _kept_words(words: list[bytes], lists: pa.Array, row: int) -> list[bytes]:
    lo, hi = lists.offsets[row].as_py(), lists.offsets[row + 1].as_py()
    spans = zip(lists.values.field("lo").slice(lo, hi - lo).to_pylist(), lists.values.field("hi").slice(lo, hi - lo).to_pylist(), strict=True)
    return [w for a, b in kept_runs(len(words), list(spans)) for w in words[a:b]]


def _gathered(spans: DataFrame) -> DataFrame:
    """One row a text, its spans together; there are no more of them than words in it."""
    return spans.groupBy("id", "h").agg(F.collect_set(F.struct("lo", "hi")).alias("spans"))


def _copied(rows: DataFrame, window: int) -> DataFrame:
    """(w1, w2, copies, first_id, alike): sequences of `window` words or more that come more than once, with the smallest id and how often it has them."""
    per_id = rows.where(F.col("n_words") >= window).groupBy("w1", "w2", "id").agg(F.count("*").alias("alike"))
    first = F.min(F.struct("id", "alike")).alias("f")
    return per_id.groupBy("w1", "w2").agg(F.sum("alike").alias("copies"), first).where("copies > 1").select("w1", "w2", "copies", F.col("f.id").alias("first_id"), F.col("f.alike").alias("alike"))


def _whole(rows: DataFrame):
    """Which rows are later copies of a whole sequence; of rows alike in id and words one stays, and only such rows are numbered."""
    several = F.coalesce(F.col("alike") > 1, F.lit(False))
    number = F.row_number().over(W.partitionBy("w1", "w2", "id", F.when(~several, F.col("rand"))).orderBy("h"))
    return F.col("copies").isNotNull() & ((F.col("id") != F.col("first_id")) | (several & (number > 1)))


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows whose last column is a text -> with n_words, hashes of its words and the digest of all of them instead."""
    for batch in batches:
        made = []
        for text in batch.column(batch.num_columns - 1).cast(pa.binary()):
            words = (text.as_py() or b"").split()
            joined = b" ".join(words)
            w = xxhash.xxh3_128_digest(joined)
            made.append((len(words), int.from_bytes(w[:8], signed=True), int.from_bytes(w[8:], signed=True), hashlib.sha256(joined).hexdigest()))
        columns = list(zip(*made, strict=True)) or [()] * 4
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], *(pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True))],
            names=[*batch.schema.names[:-1], "n_words", "w1", "w2", "sha256"],
        )


MEASURED = "n_words long, w1 long, w2 long, sha256 string"


def _needed(bits: np.ndarray):
    """(id, h, text) -> the texts that the filter lets through, compressed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=1).compress
        for batch in batches:
            some = batch.filter(pa.array(_in_filter(bits, batch.column(0).to_numpy() ^ batch.column(1).to_numpy())))
            yield pa.RecordBatch.from_arrays([some.column(0), some.column(1), pa.array([pack(t.as_py() or b"") for t in some.column(2).cast(pa.binary())], pa.binary())], names=["id", "h", "text"])

    return run


def _cut_digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpack = zstandard.ZstdDecompressor().decompress
    for batch in batches:
        made = []
        for row, text in enumerate(batch.column(3)):
            words = unpack(text.as_py()).split()
            kept = _kept_words(words, batch.column(2), row)
            made.append((len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
        gone, sha = list(zip(*made, strict=True)) or ((), ())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(gone, pa.int64()), pa.array(sha, pa.string())], names=["id", "h", "cut_removed", "cut_sha256"])


def window_digests(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 a document, without the words that later occurrences of windows cover.

    Null and empty texts have no words, texts shorter than a window stay whole.
    Null ids come last.  Rows of one id are ordered by their texts' hashes; of
    rows alike in id and words, one is the first.  An empty table gives an empty
    result; other columns are not read.  Only texts that lose a part are moved.
    """
    docs = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"))
    texts = _texts(docs)
    sized = materialize(docs.select("id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"), "text").mapInArrow(_measure, f"id long, h long, {MEASURED}"))
    sized = sized.select(F.col("id").alias("doc_id"), F.coalesce("id", F.lit(NO_ID)).alias("id"), "h", *(c.split()[0] for c in MEASURED.split(", ")))
    spans = materialize(_gathered(repeated_spans(docs, window)))
    needed = bit_filter(spans.select(F.expr("id ^ h").alias("key")), "key")
    cuts = texts.mapInArrow(_needed(needed), "id long, h long, text binary").dropDuplicates(["id", "h"]).join(spans, ["id", "h"])
    cuts = cuts.select("id", "h", "spans", "text").mapInArrow(_cut_digests, "id long, h long, cut_removed long, cut_sha256 string")
    rows = sized.join(materialize(cuts), ["id", "h"], "left").join(materialize(_copied(sized, window)), ["w1", "w2"], "left").withColumn("rand", F.rand(7))
    rows = rows.withColumn("whole", _whole(rows))
    pick = lambda whole, cut, none: F.when(F.col("whole"), whole).otherwise(F.coalesce(F.col(cut), none))
    return rows.select("doc_id", "n_words", pick(F.col("n_words"), "cut_removed", F.lit(0)).cast("long").alias("n_removed"), pick(F.sha2(F.lit(""), 256), "cut_sha256", F.col("sha256")).alias("kept_sha256"))


def dedup_windows(docs: DataFrame, window: int = WINDOW, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, each text without the words that later occurrences of windows cover; what is left of a text that loses some is
    joined by spaces, other texts stay as they are.  Null texts stay null; the order of rows is that of window_digests.
    """
    own = docs.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(text_col)).alias("text"))
    spans = materialize(_gathered(repeated_spans(own, window)))
    text = F.col(quoted(text_col))
    rows = packed(docs, [text_col], id=F.coalesce(F.col(quoted(id_col)).cast("long"), F.lit(NO_ID)), h=F.xxhash64(F.coalesce(text, F.lit(""))), text=text, again=text)
    rows = rows.mapInArrow(_measure, result_schema(rows.schema.fields[:-1], MEASURED))
    rows = rows.join(materialize(_copied(rows, window)), ["w1", "w2"], "left").join(spans, ["id", "h"], "left").withColumn("rand", F.rand(7))
    rows = rows.select("rest", "spans", _whole(rows).alias("whole"), "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left = []
            for row, (whole, text) in enumerate(zip(batch.column(2).to_pylist(), batch.column(3).cast(pa.binary()), strict=True)):
                raw = text.as_py()
                if whole:
                    raw = b""
                elif batch.column(1)[row].is_valid:
                    raw = b" ".join(_kept_words(raw.split(), batch.column(1), row))
                left.append(None if raw is None else raw.decode())
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(left, pa.string())], names=["rest", "text"])

    out = rows.mapInArrow(run, result_schema([rows.schema["rest"]], "text string"))
    return out.select(unpacked(out, docs.columns, **{text_col: F.col("text")}))


def op13_debruijn(spark: SparkSession, sf_dir: str) -> DataFrame:
    return window_digests(read(spark, sf_dir, "documents"))


QUERIES = {"op13_debruijn": op13_debruijn}
SQL = {
    "op13_debruijn": r"""
with d as (select row_number() over (order by doc_id, text) as r, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as ws from documents),
w as (select r, i, array_to_string(ws[i : i + 19], ' ') as g from (select r, ws, unnest(range(1, len(ws) - 18)) as i from d where len(ws) >= 20) x),
later as (select r, i from (select r, i, row_number() over (partition by g order by r, i) as k from w) x where k > 1),
gone as (select distinct r, i + k as p from later, range(0, 20) t(k)),
word as (select r, unnest(range(1, len(ws) + 1)) as p, unnest(ws) as x from d),
kept as (select r, string_agg(x, ' ' order by p) as left_over, count(*) as n from word anti join gone using (r, p) group by r)
select doc_id, cast(len(ws) as bigint) as n_words, cast(len(ws) - coalesce(n, 0) as bigint) as n_removed, sha256(coalesce(left_over, '')) as kept_sha256
from d left join kept using (r)
"""
}
