"""Document fingerprints by locally consistent parsing.

A text's bytes are cut into short phrases where deterministic coin tossing says
so, each phrase gets a name that depends on its content alone, and the names
are parsed in the same way, level by level, up to one name.  A cut depends only
on a few symbols around it, so equal substrings have equal phrases inside,
whatever stands before them and wherever they begin.

The fingerprint is a MinHash sketch of the names from the third level on
(phrases of some 20 bytes and more); equal positions estimate how much two
texts' sets of phrases have in common.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import drop_columns, packed, partitions, quoted, read, result_schema, unpacked

#: Values of a sketch, 16 bits each.
SKETCH = 64
#: The level from which on names count.
LEVEL = 3
#: Bytes of text that are parsed together; a longer text is parsed alone.
TOGETHER = 1 << 20

_rng = np.random.default_rng(41)
_BYTE_NAMES = _rng.integers(1 << 63, size=256, dtype=np.uint64)
_TIMES = _rng.integers(1 << 62, size=SKETCH, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = np.uint64(int(_rng.integers(1 << 62)) * 2 + 1)
_RUN = np.uint64(int(_rng.integers(1 << 62)) * 2 + 1)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def toss_coins(symbols: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Labels 0 to 5, unlike their neighbours, of symbols that are unlike their neighbours; `first` marks where a text begins.

    Each round replaces a symbol by the lowest bit in which it differs from the
    one before it (its place and value), which keeps neighbours unlike.
    """
    labels, top = symbols, 8 * symbols.itemsize
    while True:
        one = labels.dtype.type(1)
        before = np.concatenate((labels[:1], labels[:-1]))
        differ = labels ^ before
        low = np.bitwise_count((differ & (~differ + one)) - one)
        new = (2 * low + ((labels >> low.astype(labels.dtype)) & one).astype(np.uint8)).astype(np.uint8)
        labels = np.where(first, (labels & one).astype(np.uint8), new)
        if top == 3:
            return labels
        top = max(3, (2 * top - 1).bit_length())


def parse_level(symbols: np.ndarray, names: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """One level: symbols and their names -> names of the phrases, and where texts begin among these."""
    run = first.copy()
    run[1:] |= symbols[1:] != symbols[:-1]
    at = np.flatnonzero(run)
    lengths = np.diff(np.append(at, len(symbols))).astype(np.uint64)
    symbols, first = symbols[at], first[at]
    # a run of equal symbols is one symbol
    names = np.where(lengths > 1, _mix(names[at] + lengths * _RUN), names[at])
    labels = toss_coins(symbols, first)
    n = len(labels)
    cut = first.copy()
    if n > 2:
        lowest = (labels[1:-1] < labels[:-2]) & (labels[1:-1] < labels[2:])
        # the last symbol of a text begins no phrase
        cut[1:-1] |= lowest & ~first[2:]
    starts = np.flatnonzero(cut)
    length = np.diff(np.append(starts, n))
    # a name's place in its phrase counts
    place = np.arange(n) - np.repeat(starts, length)
    powers = np.cumprod(np.concatenate((np.ones(1, np.uint64), np.full(int(place.max()), _PLACE, np.uint64))))
    return _mix(np.add.reduceat(names * powers[place], starts) + length.astype(np.uint64)), first[starts]


def sketches(texts: list[bytes]) -> np.ndarray:
    """(texts, SKETCH) values; an empty text has the largest value everywhere."""
    out = np.full((len(texts), SKETCH), np.iinfo(np.uint64).max, np.uint64)
    some = [i for i, t in enumerate(texts) if t]
    if not some:
        return out
    symbols = np.frombuffer(b"".join(texts[i] for i in some), np.uint8)
    first = np.zeros(len(symbols), bool)
    first[np.concatenate(([0], np.cumsum([len(texts[i]) for i in some])[:-1])).astype(np.int64)] = True
    names, level = _BYTE_NAMES[symbols], 0
    rows = np.array(some)
    while True:
        names, first = parse_level(symbols, names, first)
        level += 1
        if level >= LEVEL:
            starts = np.flatnonzero(first)
            for k in range(SKETCH):
                out[rows, k] = np.minimum(out[rows, k], np.minimum.reduceat(_mix(names * _TIMES[k]), starts))
            # texts of one name are done
            count = np.diff(np.append(starts, len(names)))
            more = np.repeat(count > 1, count)
            names, first, rows = names[more], first[more], rows[count > 1]
            if not len(rows):
                return out
        symbols = names


def likeness(a: str, b: str) -> float:
    """Share of equal values of two fingerprints."""
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, len(a), 4)) / SKETCH


def _groups(texts: list[bytes]) -> Iterator[list[bytes]]:
    group, size = [], 0
    for t in texts:
        if group and size + len(t) > TOGETHER:
            yield group
            group, size = [], 0
        group.append(t)
        size += len(t)
    if group:
        yield group


def fingerprint_texts(texts: list[bytes]) -> np.ndarray:
    """The low 16 bits of each value of the texts' sketches; the high bits of a long text's minima are all zero."""
    parts = [sketches(g).astype(np.uint16) for g in _groups(texts)]
    return np.concatenate(parts) if parts else np.zeros((0, SKETCH), np.uint16)


def fingerprint_documents(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """docs with the text replaced by fingerprint, a string of hex digits.

    Null and empty texts share one fingerprint.  Equal texts have equal ones.
    Texts are parsed whole.  Repeated rows and other columns pass unchanged; a
    column named fingerprint is replaced; an empty table gives an empty result.
    """
    docs = drop_columns(docs, ["fingerprint"])
    rows = packed(docs, [text_col], text=F.col(quoted(text_col)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [t.as_py() or b"" for t in batch.column(batch.num_columns - 1).cast(pa.binary())]
            made = [r.tobytes().hex() for r in fingerprint_texts(texts).astype(">u2")]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made, pa.string())], names=[*batch.schema.names[:-1], "fingerprint"])

    out = rows.mapInArrow(run, result_schema([rows.schema["rest"]], "fingerprint string"))
    return out.select(*unpacked(out, [c for c in docs.columns if c != text_col]), "fingerprint")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id long, text) -> (bucket, tail, nil, doc_id, h, text), dealt to partitions by bucket and sorted.

    Buckets are ranges of ids (null last, equal ids by the text's hash), so the
    document after a row is the row below it.  A bucket's last row is followed
    by a copy (tail) of the next bucket's first row; the first follows the last.
    Only the buckets' first keys, one a partition, come to the driver.
    """
    spark = docs.sparkSession
    n = partitions(spark)
    keyed = docs.select(F.col("doc_id").isNull().alias("nil"), F.coalesce("doc_id", F.lit(0)).alias("id"), F.coalesce(F.xxhash64("text"), F.lit(0)).alias("h"), "doc_id", "text")
    ranges = keyed.select("nil", "id", "h").repartitionByRange(n, "nil", "id", "h")
    heads = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min(F.struct("nil", "id", "h")).alias("k")).collect()
    starts = sorted((r.k.nil, r.k.id, r.k.h) for r in heads)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            take, bucket, tail = [], [], []
            for i, key in enumerate(zip(*(batch.column(c).to_pylist() for c in range(3)), strict=True)):
                b = bisect_right(starts, key) - 1
                take.append(i)
                bucket.append(b)
                tail.append(False)
                if key == starts[b]:
                    take.append(i)
                    bucket.append((b - 1) % len(starts))
                    tail.append(True)
            rows = batch.take(pa.array(take, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(bucket, pa.int32()), pa.array(tail, pa.bool_()), *rows.columns], names=["bucket", "tail", *rows.schema.names])

    dealt = keyed.mapInArrow(deal, "bucket int, tail boolean, nil boolean, id long, h long, doc_id long, text string")
    return dealt.repartitionById(max(1, len(starts)), "bucket").sortWithinPartitions("bucket", "tail", "nil", "id", "h")


def edited_text(text: str, following: str) -> str:
    """The last half of the code points replaced by as many, or all, of the following text's first."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int | None, str, str]]:
    """(doc_id, text, next text) from with_next's rows."""
    last, closed = None, None
    for batch in batches:
        for bucket, tail, doc_id, text in zip(*(batch.column(batch.schema.names.index(c)).to_pylist() for c in ("bucket", "tail", "doc_id", "text")), strict=True):
            text = text or ""
            if bucket == closed:
                continue  # the tail's copies
            if last is not None:
                yield last[0], last[1], text
            last = None if tail else (doc_id, text)
            closed = bucket if tail else None


def edited_fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next a document.

    The edited text ends in the beginning of the next document (ascending ids,
    null last; equal ids by the text's hash); the last is followed by the
    first, and a single document by itself.  Null texts count as empty.
    Repeated rows follow each other.  An empty table gives an empty result.
    """
    rows = with_next(docs.select(F.col(quoted(id_col)).cast("long").alias("doc_id"), F.col(quoted(text_col)).alias("text")))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        waiting: list[tuple[int | None, str, str]] = []

        def flush() -> pa.RecordBatch:
            texts = [t for _, t, _ in waiting] + [waiting[-1][2]]  # in a bucket, the next text is the next row's
            edited = [edited_text(t, x).encode() for _, t, x in waiting]
            own = fingerprint_texts([t.encode() for t in texts])
            new = fingerprint_texts(edited)
            n = len(waiting)
            near_edited = (own[:n] == new).mean(axis=1)
            near_next = (own[:n] == own[1:]).mean(axis=1)
            digits = lambda x: pa.array([r.tobytes().hex() for r in x.astype(">u2")], pa.string())
            return pa.RecordBatch.from_arrays([pa.array([i for i, _, _ in waiting], pa.int64()), pa.array([len(t) for _, t, _ in waiting], pa.int64()), pa.array([hashlib.sha256(e).hexdigest() for e in edited], pa.string()), digits(own[:n]), digits(new), pa.array(near_edited), pa.array(near_next)], names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])

        size = 0
        for pair in _pairs(batches):
            if waiting and (waiting[-1][2] != pair[1] or size > TOGETHER):
                yield flush()
                waiting, size = [], 0
            waiting.append(pair)
            size += len(pair[1])
        if waiting:
            yield flush()

    return rows.mapInArrow(run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double")


def op7_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(read(spark, sf_dir, "documents"))


QUERIES = {"op7_parse": op7_parse}
SQL: dict[str, str] = {}
