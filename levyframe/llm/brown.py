"""Language-model scoring with Brown classes.

Words are counted over all training texts.  The most frequent words, and the
forms (first and last bytes) of all others, are the units that exchange
clustering assigns to classes first, so that the classes' transitions predict
the training texts best.  Then every word of the training texts, however rare,
is exchanged: it goes to the class that its own neighbours' classes speak for,
all words at once, as in distributed exchange clustering.  The transitions are
counted anew from all words' classes.  A token's probability is that of its
class after the class before it, times that of the word in the class, mixed
with its smoothed frequency.  Words that were never seen have the class of
their form.

Texts are tokenised by Arrow, a slice at a time, and words are known by the
64-bit hash of their lower-cased bytes.  What goes to all tasks is bounded:
WORDS hashes with their counts and classes, UNITS forms and CLASSES^2 numbers.
The counts and classes of words beyond WORDS are joined to the pairs of tokens
that have them, so every word's class and count in the corpus counts.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, DoubleType, LongType, StructField, StructType

from levyframe.llm.common import columns_of, materialize, partitions, quoted, read

#: At most so many frequent words are known to all tasks (14 bytes each), so many words and as many forms are clustered first, and so many classes (127 at most).
WORDS, UNITS, CLASSES = 200_000, 480, 40
#: Frequent words whose neighbours a task sums up in one table; those of others are handed on slice by slice.
DENSE = 100_000
#: Weight of the class model in the mix; smoothing of class transitions.
WEIGHT, ALPHA = 0.95, 0.1
#: Words that a task counts before it hands on what it has; bytes of texts that are tokenised at once (a longer text alone).
COUNTED, SLICE = 300_000, 2 << 20
#: Rounds of exchanges of the first units at most.
ROUNDS = 8
#: Occurrences of its form that a word's own contexts are smoothed with.
SMOOTH = 0.5
#: Rows handed on at once.
HANDED = 20_000


def held_out(doc_id: Column, of: int = 7, fold: int = 2) -> Column:
    """crc32 of the id as text; a null id is never held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(of)) == fold, F.lit(False))


def form_codes(words: pa.Array) -> np.ndarray:
    """A number for the form of each word: its first byte and its last two, or its only one."""
    ends = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = np.frombuffer(words.buffers()[2] or b"\0", np.uint8).astype(np.int64)
    at = lambda i: data[np.clip(i, 0, len(data) - 1)]
    first, last = at(ends[:-1]) << 16, at(ends[1:] - 1)
    return np.where(np.diff(ends) > 1, first | at(ends[1:] - 2) << 8 | last, 1 << 24 | first | last)


def word_hashes(words: list[bytes]) -> np.ndarray:
    digest = xxhash.xxh64_intdigest
    return np.array([digest(w, 42) for w in words], np.uint64).view(np.int64)


def find(sorted_hashes: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Where each hash is among the sorted ones; -1 where it isn't."""
    if not len(sorted_hashes):
        return np.full(len(hashes), -1, np.int64)
    at = np.minimum(np.searchsorted(sorted_hashes, hashes), len(sorted_hashes) - 1)
    return np.where(sorted_hashes[at] == hashes, at, -1)


@dataclass
class Slice:
    """Tokens of some texts: distinct words, the words' numbers in order of the texts, and how many each text has."""

    column: pa.Array
    words: list[bytes]
    tokens: np.ndarray
    lengths: np.ndarray

    def hashes(self) -> np.ndarray:
        return word_hashes(self.words)

    def chain(self) -> np.ndarray:
        """Words' numbers, with -1 for the end before the first text and after each."""
        out = np.full(len(self.tokens) + len(self.lengths) + 1, -1, np.int64)
        out[np.arange(len(self.tokens)) + np.repeat(np.arange(len(self.lengths)), self.lengths) + 1] = self.tokens
        return out


def slices(texts: pa.Array) -> Iterator[Slice]:
    """Lower-cased (A-Z) runs of anything but ASCII white space; a null text has none."""
    upto = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy())
    lo = 0
    while lo < len(texts):
        hi = max(lo + 1, int(np.searchsorted(upto, (upto[lo - 1] if lo else 0) + SLICE, side="right")))
        lists = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts.slice(lo, hi - lo), "")))
        coded = lists.flatten().dictionary_encode()
        column = coded.dictionary.cast(pa.binary())
        words = column.to_pylist()
        number = coded.indices.to_numpy()
        row = np.repeat(np.arange(hi - lo), pc.list_value_length(lists).to_numpy())
        if b"" in words:  # what white space at the ends leaves
            some = number != words.index(b"")
            number, row = number[some], row[some]
        yield Slice(column, words, number, np.bincount(row, minlength=hi - lo))
        lo = hi


def _strings(column: pa.Array) -> pa.Array:
    return column if pa.types.is_string(column.type) else column.cast(pa.string())


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    seen: Counter = Counter()

    def flush() -> pa.RecordBatch:
        out = pa.RecordBatch.from_arrays([pa.array(list(seen), pa.binary()), pa.array(list(seen.values()), pa.int64())], names=["word", "n"])
        seen.clear()
        return out

    for batch in batches:
        for s in slices(_strings(batch.column(0))):
            n = np.bincount(s.tokens, minlength=len(s.words)).tolist()
            seen.update({w: k for w, k in zip(s.words, n, strict=True) if k})
            if len(seen) > COUNTED:
                yield flush()
    yield flush()


def word_counts(texts: DataFrame) -> DataFrame:
    """(text) -> (word binary, n), the end token left out."""
    return texts.mapInArrow(_count, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


def most_frequent(counts: DataFrame, most: int) -> Column:
    """Which rows of counts have the largest n, at most so many, whole classes of nearly equal n: found from a histogram, without a sort."""
    step = F.floor(F.log2("n") * 16)
    total, least = 0, None
    for r in sorted(counts.groupBy(step.alias("s")).count().collect(), key=lambda r: -r.s):  # some 16 rows for each doubling of n
        total += r["count"]
        if total > most:
            break
        least = r.s
    return F.lit(False) if least is None else step >= least


def _gain(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def exchange_classes(pairs: np.ndarray, classes: int, fixed: int) -> np.ndarray:
    """pairs[u, v]: how often unit v follows u; unit `fixed` has a class of its own, the last one -> each unit's class.

    Units go, most frequent first, to the class where the mutual information of
    neighbouring classes is largest; then each is taken out and put where it is
    best, round by round, until none moves.
    """
    n = len(pairs)
    sizes = pairs.sum(axis=1) + pairs.sum(axis=0)
    out = np.full(n, -1)
    out[fixed] = classes
    table = np.zeros((classes + 1, classes + 1))
    table[classes, classes] = pairs[fixed, fixed]
    order = [u for u in np.argsort(-sizes, kind="stable") if u != fixed]
    member = np.zeros((n, classes + 1))
    member[fixed, classes] = 1
    for turn in range(ROUNDS + 1):
        moved = 0
        for k, u in enumerate(order):
            old = out[u]
            if old >= 0:
                member[u, old] = 0
            after, before = pairs[u] @ member, pairs[:, u] @ member  # to and from each class, without u itself
            own = pairs[u, u]
            if old >= 0:
                table[old] -= after
                table[:, old] -= before
                table[old, old] -= own
            if turn == 0 and k < classes:
                new = k
            else:
                rows = _gain(table + after) - _gain(table)
                columns = _gain(table + before[:, None]) - _gain(table)
                diagonal = np.diag(table)
                gain = rows.sum(axis=1) + columns.sum(axis=0) - (_gain(diagonal + after) + _gain(diagonal + before) - 2 * _gain(diagonal))
                gain += _gain(diagonal + after + before + own) - _gain(diagonal)
                left, right = table.sum(axis=1), table.sum(axis=0)
                gain -= _gain(left + after.sum() + own + before) - _gain(left)
                gain -= _gain(right + before.sum() + own + after) - _gain(right)
                new = int(np.argmax(gain[:classes]))
            table[new] += after
            table[:, new] += before
            table[new, new] += own
            member[u, new] = 1
            out[u] = new
            moved += new != old
        if not moved:
            break
    return out


@dataclass
class Units:
    """What a word is before it has a class of its own: one of the most frequent, else its form, else other."""

    top: list[bytes]
    forms: list[bytes]  # first byte, ~, last two

    def __post_init__(self) -> None:
        sort = lambda keys, first: (np.sort(keys), first + np.argsort(keys))
        self.top_hashes, self.top_units = sort(word_hashes(self.top), 0)
        # a form's bytes without its mark have its own number
        self.form_codes, self.form_units = sort(form_codes(pa.array([f[:1] + f[2:] if len(f) > 3 else f[:1] for f in self.forms], pa.binary())), len(self.top))

    @property
    def other(self) -> int:
        return len(self.top) + len(self.forms)

    @property
    def end(self) -> int:
        return self.other + 1

    def form_of(self, words: pa.Array) -> np.ndarray:
        at = find(self.form_codes, form_codes(words))
        return np.where(at < 0, self.other, np.append(self.form_units, self.other)[at])

    def of(self, s: Slice, hashes: np.ndarray) -> np.ndarray:
        at = find(self.top_hashes, hashes)
        return np.where(at < 0, self.form_of(s.column), np.append(self.top_units, 0)[at])


def choose_units(counts: DataFrame) -> Units:
    """The most frequent words, and the most frequent forms of all others; counts should be materialized."""
    top = [bytes(r.word) for r in counts.orderBy(F.desc("n"), "word").limit(UNITS).collect()]
    shape = F.expr("concat(substring(word, 1, 1), X'7E', substring(word, -2, 2))")
    rest = counts.where(~F.col("word").isin([bytearray(w) for w in top])) if top else counts
    forms = rest.groupBy(shape.alias("form")).agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "form").limit(UNITS).collect()
    return Units(top, [bytes(r.form) for r in forms])


def _cells(table: np.ndarray, k: int) -> Iterator[pa.RecordBatch]:
    at = np.flatnonzero(table)
    yield pa.RecordBatch.from_arrays([pa.array((at // k).astype(np.int32)), pa.array((at % k).astype(np.int32)), pa.array(table[at])], names=["u", "v", "n"])


def _table(rows: DataFrame, k: int) -> np.ndarray:
    """(u, v, n) rows summed up by Spark; at most k * k of them come here."""
    out = np.zeros((k, k))
    u, v, n = columns_of(rows.groupBy("u", "v").agg(F.sum("n").alias("n")))
    out[u, v] = n
    return out


def unit_pairs(texts: DataFrame, units: Units) -> np.ndarray:
    """How often each unit follows each other in texts; a text begins after an end and ends with one."""
    n = units.end + 1
    shared = texts.sparkSession.sparkContext.broadcast(units)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value, np.zeros(n * n, np.int64)
        for batch in batches:
            for s in slices(_strings(batch.column(0))):
                unit = np.append(known.of(s, s.hashes()), known.end)[s.chain()]
                np.add.at(table, unit[:-1] * n + unit[1:], 1)
        yield from _cells(table, n)

    return _table(texts.mapInArrow(run, "u int, v int, n long"), n)


def _log_likelihoods(after: np.ndarray, before: np.ndarray, table: np.ndarray) -> np.ndarray:
    """How often classes come after and before something -> log-likelihood of these for each class but the last, the end's."""
    to = np.log(table / table.sum(axis=1, keepdims=True))
    back = np.log(table / table.sum(axis=0))
    return (after @ to.T + before @ back)[:, :-1]


NEAR = "h long, form int, codes binary, counts binary"


def _neighbours(batches: Iterator[pa.RecordBatch], units: Units, classes: np.ndarray, dense: tuple[np.ndarray, np.ndarray]) -> Iterator[pa.RecordBatch]:
    """Texts -> for each word its form and which classes are beside it: codes are classes before it, or after it (the number of
    classes added); counts say how often, where they are not all one."""
    k = int(classes.max()) + 1
    of_dense, forms = dense
    table = np.zeros(len(of_dense) * 2 * k, np.int32)

    def rows(h: np.ndarray, form: np.ndarray, starts: np.ndarray, codes: np.ndarray, counts: np.ndarray | None) -> pa.RecordBatch:
        offsets = np.append(starts, len(codes)).astype(np.int32)
        packed = lambda x, size: pa.Array.from_buffers(pa.binary(), len(h), [None, pa.py_buffer(offsets * np.int32(size)), pa.py_buffer(np.ascontiguousarray(x))])
        many = pa.nulls(len(h), pa.binary()) if counts is None else packed(counts.astype(np.uint32), 4)
        return pa.RecordBatch.from_arrays([pa.array(h), pa.array(form.astype(np.int32)), packed(codes.astype(np.uint8), 1), many], names=["h", "form", "codes", "counts"])

    for batch in batches:
        for s in slices(_strings(batch.column(0))):
            h, chain = s.hashes(), s.chain()
            c = np.append(classes[units.of(s, h)], classes[units.end])[chain]
            at = np.flatnonzero(chain >= 0)
            word, left, right = chain[at], c[at - 1], k + c[at + 1]
            number = find(of_dense, h)[word]
            some = number >= 0
            np.add.at(table, number[some] * 2 * k + left[some], 1)
            np.add.at(table, number[some] * 2 * k + right[some], 1)
            word, left, right = word[~some], left[~some], right[~some]
            order = np.argsort(word, kind="stable")
            word = word[order]
            starts = np.flatnonzero(np.diff(word, prepend=-1))
            if len(starts):
                own = word[starts]
                form = units.form_of(s.column)[own]
                yield rows(h[own], form, 2 * starts, np.column_stack((left[order], right[order])).ravel(), None)
    found = np.flatnonzero(table)
    for i in range(0, len(found), 10 * HANDED):
        codes = found[i : i + 10 * HANDED]
        number, starts = np.unique(codes // (2 * k), return_index=True)
        yield rows(of_dense[number], forms[number], starts, codes % (2 * k), table[codes])


def word_classes(texts: DataFrame, units: Units, classes: np.ndarray, pairs: np.ndarray, counts: DataFrame) -> DataFrame:
    """(text) -> (h, n, cls) of every word: the class its neighbours speak for, smoothed by its form's; words that are units keep theirs."""
    k = int(classes.max()) + 1
    member = np.zeros((len(pairs), k))
    member[np.arange(len(pairs)), classes] = 1
    table = member.T @ pairs @ member + ALPHA
    size = np.maximum(pairs.sum(axis=1, keepdims=True), 1)
    prior = SMOOTH * _log_likelihoods(pairs @ member / size, pairs.T @ member / size, table)
    weights = _log_likelihoods(np.eye(2 * k)[:, k:], np.eye(2 * k)[:, :k], table)
    frequent = counts.where(most_frequent(counts, DENSE)).select(F.xxhash64("word").alias("h"), "word").toArrow().sort_by("h")  # at most DENSE rows
    dense = frequent["h"].to_numpy(), units.form_of(frequent["word"].combine_chunks() if len(frequent) else pa.array([], pa.binary()))
    fixed, fixed_cls = units.top_hashes, classes[units.top_units]
    shared = texts.sparkSession.sparkContext.broadcast((units, classes, dense))

    def neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _neighbours(batches, *shared.value)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows sorted by word; the last word of a batch may go on in the next."""
        last: tuple[int, int, np.ndarray] | None = None

        def judged(h: np.ndarray, form: np.ndarray, seen: np.ndarray) -> pa.RecordBatch:
            best = np.argmax(seen @ weights + prior[form], axis=1)
            at = find(fixed, h)
            best[at >= 0] = fixed_cls[at[at >= 0]]
            return pa.RecordBatch.from_arrays([pa.array(h), pa.array(seen[:, :k].sum(axis=1).astype(np.int64)), pa.array(best.astype(np.int32))], names=["h", "n", "cls"])

        for batch in batches:
            h, form = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            if not len(h):
                continue
            codes, counts = batch.column(2), batch.column(3)
            length = pc.binary_length(codes).to_numpy()
            times = np.ones(int(length.sum()))
            times[np.repeat(counts.is_valid().to_numpy(zero_copy_only=False), length)] = np.frombuffer(b"".join(counts.drop_null().to_pylist()), np.uint32)
            new = np.append(True, h[1:] != h[:-1])
            group = np.cumsum(new) - 1
            seen = np.bincount(np.repeat(group, length) * 2 * k + np.frombuffer(b"".join(codes.to_pylist()), np.uint8), weights=times, minlength=(group[-1] + 1) * 2 * k).reshape(-1, 2 * k)
            h, form = h[new], form[new]
            if last and last[0] == h[0]:
                seen[0] += last[2]
            elif last:
                yield judged(np.array([last[0]]), np.array([last[1]]), last[2][None, :])
            last = (h[-1], form[-1], seen[-1])
            if len(h) > 1:
                yield judged(h[:-1], form[:-1], seen[:-1])
        if last:
            yield judged(np.array([last[0]]), np.array([last[1]]), last[2][None, :])

    near = texts.mapInArrow(neighbours, NEAR).repartition(partitions(texts.sparkSession), "h").sortWithinPartitions("h")
    return materialize(near.mapInArrow(assign, "h long, n long, cls int"))


def with_classes(pairs: DataFrame, rare: DataFrame) -> DataFrame:
    """pairs (last_h, last_cls, h, cls, more; read more than once) with the classes of rare (h, n, cls) for the words that are named, without these; found is the count of the second, named says that it was."""
    known = rare.select(F.col("h").alias("k_h"), F.col("n").alias("k_n"), F.col("cls").alias("k_cls"))
    rest = [c for c in pairs.columns if c not in ("last_h", "last_cls", "h", "cls")]
    first, second, none = F.col("last_h").isNotNull(), F.col("h").isNotNull(), F.lit(None).cast("long")
    neither = pairs.where(~first & ~second).select("last_cls", "cls", second.alias("named"), none.alias("found"), *rest)
    # most pairs have one such word, and are dealt once
    one = pairs.where(first != second).select(F.coalesce("last_h", "h").alias("of"), "last_cls", "cls", second.alias("named"), *rest).join(known, F.col("of") == F.col("k_h"), "left")
    one = one.select(F.when(F.col("named"), F.col("last_cls")).otherwise(F.coalesce("k_cls", "last_cls")).alias("last_cls"), F.when(F.col("named"), F.coalesce("k_cls", "cls")).otherwise(F.col("cls")).alias("cls"), "named", F.when(F.col("named"), F.col("k_n")).alias("found"), *rest)
    both = pairs.where(first & second).join(known, F.col("last_h") == F.col("k_h"), "left").select(F.coalesce("k_cls", "last_cls").alias("last_cls"), "h", "cls", *rest)
    both = both.join(known, F.col("h") == F.col("k_h"), "left").select("last_cls", F.coalesce("k_cls", "cls").alias("cls"), F.lit(True).alias("named"), F.col("k_n").alias("found"), *rest)
    return neither.unionByName(one).unionByName(both)


@dataclass
class Lexicon:
    """Frequent words with their classes and counts, and the classes of forms for all others."""

    hashes: np.ndarray  # sorted
    count: np.ndarray
    cls: np.ndarray
    units: Units
    form_cls: np.ndarray  # of each unit; only those of forms, other and end are used

    def of(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Hash, number (-1 for other words) and class of a slice's words."""
        h = s.hashes()
        number = find(self.hashes, h)
        cls = self.cls[number].astype(np.int64) if len(self.cls) else np.zeros(len(h), np.int64)
        others = np.flatnonzero(number < 0)
        cls[others] = self.form_cls[self.units.form_of(s.column)[others]]
        return h, number, cls

    @property
    def end_cls(self) -> int:
        return int(self.form_cls[self.units.end])


def _named(h: np.ndarray, word: np.ndarray, rare: np.ndarray) -> pa.Array:
    """The hashes of rare words, null for others."""
    return pa.array(h[np.where(rare, word, 0)] if len(h) else np.zeros(len(word), np.int64), mask=~rare)


def class_pairs(texts: DataFrame, lexicon: Lexicon, k: int, rare: DataFrame) -> np.ndarray:
    """How often each class follows each other in texts, by the words' own classes."""
    shared = texts.sparkSession.sparkContext.broadcast(lexicon)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, table = shared.value, np.zeros(k * k, np.int64)

        def rows(last, last_cls, word, cls, n) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([last, pa.array(last_cls.astype(np.int32)), word, pa.array(cls.astype(np.int32)), pa.array(n)], names=["last_h", "last_cls", "h", "cls", "n"])

        for batch in batches:
            for s in slices(_strings(batch.column(0))):
                h, number, cls = known.of(s)
                chain = s.chain()
                c = np.append(cls, known.end_cls)[chain]
                other = np.append(number < 0, False)[chain]
                some = other[1:] | other[:-1]
                np.add.at(table, (c[:-1] * k + c[1:])[~some], 1)
                for at in np.array_split(np.flatnonzero(some), 1 + int(some.sum()) // HANDED):
                    if len(at):
                        yield rows(_named(h, chain[at], other[at]), c[at], _named(h, chain[at + 1], other[at + 1]), c[at + 1], np.ones(len(at), np.int64))
        at = np.flatnonzero(table)
        none = pa.nulls(len(at), pa.int64())
        yield rows(none, at // k, none, at % k, table[at])

    pairs = materialize(texts.mapInArrow(run, "last_h long, last_cls int, h long, cls int, n long"))
    return _table(with_classes(pairs, rare).select(F.col("last_cls").alias("u"), F.col("cls").alias("v"), "n"), k)


@dataclass
class BrownModel:
    lexicon: Lexicon
    move: np.ndarray  # probability of a class after a class
    sizes: np.ndarray  # of each class: occurrences, half of one more for each word, form, other and the end
    train_tokens: int
    train_words: int
    train_texts: int

    def parts(self, s: Slice) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, pa.Array]:
        """For each text of a slice: n_tokens, known tokens, base score and score without words that aren't in the lexicon, and the
        pairs with these: words, classes, share and count of the second."""
        h, number, cls = self.lexicon.of(s)
        chain, end = s.chain(), self.lexicon.end_cls
        rows = np.repeat(np.arange(len(s.lengths)), s.lengths + 1)
        n = np.append(self.lexicon.count[number].astype(np.float64) if len(self.lexicon.count) else np.zeros(len(h)), self.train_texts)
        n[:-1][number < 0] = 0
        every = np.append(cls, end)
        share, base = (n + 0.5) / self.sizes[every], (n + 1) / (self.train_tokens + self.train_words + 1)
        other = np.append(number < 0, False)[chain]
        word, c, rare = chain[1:], every[chain], other[1:]
        pair = rare | other[:-1]
        score = np.log10(WEIGHT * self.move[c[:-1], c[1:]] * share[word] + (1 - WEIGHT) * base[word])
        total = lambda values: np.bincount(rows, weights=values, minlength=len(s.lengths))
        n_known = s.lengths - total(rare).astype(np.int64) + (self.train_texts > 0)
        at = np.flatnonzero(pair)
        flat = [_named(h, chain[at], other[at]), pa.array(c[at].astype(np.int32)), _named(h, word[at], rare[at]), pa.array(c[at + 1].astype(np.int32)), pa.array(share[word[at]]), pa.array(n[word[at]] + 1)]
        offsets = np.append(0, np.cumsum(np.bincount(rows[at], minlength=len(s.lengths))))
        near = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(flat, names=["last_h", "last_cls", "h", "cls", "share", "count"]))
        return s.lengths + 1, n_known, total(np.where(rare, 0.0, np.log10(base)[word])), total(np.where(pair, 0.0, score)), near


def fit_brown(train: DataFrame) -> tuple[BrownModel, DataFrame]:
    """(text) rows -> the model, and the hash, count and class of all words (h, n, cls; rare for those beyond the lexicon)."""
    counts = materialize(word_counts(train))
    totals = counts.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    texts = train.count()
    units = choose_units(counts)
    pairs = unit_pairs(train, units)
    classes = exchange_classes(pairs, min(CLASSES, max(1, len(pairs) - 1)), units.end)
    classes = np.unique(classes, return_inverse=True)[1]  # classes that no unit is in have no number
    k = int(classes.max()) + 1
    words = word_classes(train, units, classes, pairs, counts)
    words = words.withColumn("rare", ~most_frequent(words, WORDS))
    known = [F.col("n").cast("int") if (totals.n or 0) < 1 << 31 else F.col("n"), F.col("cls").cast("short")]
    h, n, cls = columns_of(words.where("not rare").select("h", *known))  # at most WORDS rows
    order = np.argsort(h)
    lexicon = Lexicon(h[order], n[order], cls[order], units, classes)
    table = class_pairs(train, lexicon, k, words.where("rare")) + ALPHA
    sizes = np.bincount(classes[len(units.top) :], minlength=k) * 0.5  # so that no form is impossible
    sizes[classes[units.end]] += texts
    for r in words.groupBy("cls").agg(F.sum(F.col("n") + 0.5).alias("size")).collect():  # at most k rows
        sizes[r.cls] += float(r.size)
    return BrownModel(lexicon, table / table.sum(axis=1, keepdims=True), sizes, int(totals.n or 0) + texts, int(totals.v) + (texts > 0), texts), words


def score_documents(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score a document.

    Learns from the documents that are not held out.  Null texts count as
    empty: one token, the end.  Without training documents all words are
    unknown and the scores still finite.  Rows with a null id are learned from;
    repeated rows count as often as they come and are scored alike; an empty
    table gives an empty result.  Other columns are left out.
    """
    docs = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    model, words = fit_brown(docs.where(~held_out(F.col("doc_id"))).select("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by WORDS, UNITS and CLASSES

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, key = shared.value, TaskContext.get().partitionId() << 33
        for batch in batches:
            lo = 0
            for s in slices(_strings(batch.column(2))):
                n = len(s.lengths)
                tokens, yes, base, score, near = known.parts(s)
                keys = pa.array(np.arange(key, key + n))
                yield pa.RecordBatch.from_arrays([keys, batch.column(0).slice(lo, n), batch.column(1).slice(lo, n), *(pa.array(x) for x in (tokens, yes, base, score)), near], names=["key", "doc_id", "held_out", "n_tokens", "n_known", "base", "score", "near"])
                key, lo = key + n, lo + n

    rows = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    near = StructType.fromDDL("near array<struct<last_h: long, last_cls: int, h: long, cls: int, share: double, count: double>>")
    made = StructType([StructField("key", LongType()), docs.schema["doc_id"], StructField("held_out", BooleanType()), *(StructField(c, LongType()) for c in ("n_tokens", "n_known")), *(StructField(c, DoubleType()) for c in ("base", "score")), *near])
    rows = materialize(rows.mapInArrow(run, made))
    # pairs with words that aren't in the lexicon: these words' classes and counts are joined; what isn't found has its form's class
    pairs = with_classes(rows.select("key", F.inline("near")), words.where("rare").select("h", "n", "cls"))
    k = len(model.move)
    at = lambda values, i: F.element_at(F.array(*[F.lit(float(v)) for v in values]), i + 1)
    count = F.coalesce(F.col("found") + F.lit(1.0), F.col("count"))
    share = F.coalesce((F.col("found") + F.lit(0.5)) / at(model.sizes, F.col("cls")), F.col("share"))
    base = count / F.lit(float(model.train_tokens + model.train_words + 1))
    chance = F.lit(WEIGHT) * at(model.move.ravel(), F.col("last_cls") * k + F.col("cls")) * share + F.lit(1 - WEIGHT) * base
    more = pairs.groupBy("key").agg(F.sum(F.when(F.col("named"), F.log10(base))).alias("more_base"), F.sum(F.log10(chance)).alias("more"), F.count("found").alias("found"))
    zero = F.lit(0.0)
    return rows.drop("near").join(more, "key", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("found", F.lit(0))).alias("n_known"), F.lit(model.train_tokens).cast("long").alias("train_tokens"), (F.col("base") + F.coalesce("more_base", zero)).alias("base_score"), (F.col("score") + F.coalesce("more", zero)).alias("score")
    )


def op8_brown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_documents(read(spark, sf_dir, "documents"))


QUERIES = {"op8_brown": op8_brown}
SQL: dict[str, str] = {}
