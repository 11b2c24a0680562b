"""Fuzzy line dedup: MinHash of character shingles, banding, exact Jaccard, union-find.

Lines are known by the 64-bit hash of their text.  A line's MinHash signature is
cut into bands; lines that share a band are candidates.  In each band's group
all lines are compared with the group's smallest line, exactly, on their sets of
shingles.  Only where such a comparison fails can a link between two others be
missed, so those groups are compared in full, in blocks, across components; in a
block, pairs that share none of their rarest shingles can't reach the threshold.
Of each component the first line stays.

At a similarity of 0.8 a pair shares a band with probability 0.998, at 0.85
with 0.9999 and at 0.9 with more than 0.999999; equal lines always meet.
Two different lines have the same hash with probability 5e-20.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from levyframe.llm.common import columns_of, materialize, packed, partitions, quoted, read, result_schema, unpacked
from levyframe.llm.components import connected_components

#: Characters of a shingle; signature = BANDS * ROWS minima.
SHINGLE, BANDS, ROWS = 8, 12, 4
#: Bits of the filter that says which lines' texts are needed; 2 MB whatever the input, too many lines only make it less selective.
FILTER_BITS = 1 << 24
#: Line hashes that a task remembers so as not to send a line twice.
REMEMBERED = 500_000
#: Lines of a group that are compared with each other in one block; candidate pairs of a block above which their shingles are counted for all pairs at once.
BLOCK, CANDIDATES = 512, 50_000
#: Lines whose pairs are all taken, one by one; pairs of lines that are marked at once.
FEW, PAIRS = 24, 2_000_000
#: Characters of lines whose shingles are hashed at once.
TOGETHER = 500_000


def line_hash(line: bytes) -> int:
    h = xxhash.xxh64_intdigest(line, 42)
    return h - (1 << 64) if h >> 63 else h


def nonblank(text: bytes | None) -> Iterator[tuple[int, bytes]]:
    for i, line in enumerate((text or b"").split(b"\n")):
        if line.strip():
            yield i, line


def shingles(line: str, size: int = SHINGLE) -> set[str]:
    return {line[i : i + size] for i in range(max(1, len(line) - size + 1))}


def jaccard(a: set[str], b: set[str]) -> float:
    both = len(a & b)
    return both / (len(a) + len(b) - both)


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(32))


def band_keys(lines: list[str], size: int = SHINGLE, bands: int = BANDS, rows: int = ROWS) -> np.ndarray:
    """(lines, bands) keys of lines of at least `size` characters."""
    rng = np.random.default_rng(20240229)
    power = rng.integers(1 << 62, size=size, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    times = rng.integers(1 << 31, size=bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    plus = rng.integers(1 << 32, size=bands * rows, dtype=np.uint32)
    points = np.frombuffer("".join(lines).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    counts = np.fromiter(map(len, lines), np.int64, len(lines))
    ends = np.cumsum(counts)
    total = len(points) - size + 1
    h = np.zeros(total, np.uint64)
    for j in range(size):
        h += points[j : j + total] * power[j]
    h = (_mix(h) >> np.uint64(32)).astype(np.uint32)
    # windows that begin in one line and end in the next are none
    inside = np.ones(total, bool)
    for j in range(1, size):
        cut = ends[:-1] - j
        inside[cut] = False
    h = h[inside]
    starts = np.concatenate(([0], np.cumsum(counts - size + 1)[:-1]))
    keys = np.empty((len(lines), bands), np.uint64)
    for b in range(bands):
        key = np.full(len(lines), b + 1, np.uint64)
        for r in range(b * rows, (b + 1) * rows):
            key = _mix(key + np.minimum.reduceat(h * times[r] + plus[r], starts))
        keys[:, b] = key
    return keys


def _occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, id, text) -> a row for each line that isn't blank."""
    for batch in batches:
        at, number, hashes = [], [], []
        for k, text in enumerate(batch.column(2).cast(pa.binary())):
            for i, line in nonblank(text.as_py()):
                at.append(k)
                number.append(i)
                hashes.append(line_hash(line))
        take = pa.array(at, pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(hashes, pa.int64()), batch.column(0).take(take), batch.column(1).take(take), pa.array(number, pa.int32())], names=["line", "row", "id", "number"])


def _new_lines(batches: Iterator[pa.RecordBatch], wanted=None) -> Iterator[tuple[int, str]]:
    """Lines of a task, most of them once."""
    seen: set[int] = set()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            for _, line in nonblank(text.as_py()):
                h = line_hash(line)
                if h not in seen and (wanted is None or wanted(h)):
                    if len(seen) >= REMEMBERED:
                        seen.clear()
                    seen.add(h)
                    yield h, line.decode("utf-8", "replace")


def _bands(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    hashes: list[int] = []
    lines: list[str] = []

    def flush() -> pa.RecordBatch:
        keys = band_keys(lines)
        out = pa.RecordBatch.from_arrays([pa.array(keys.ravel().view(np.int64)), pa.array(np.repeat(np.array(hashes, np.int64), keys.shape[1]))], names=["band", "line"])
        hashes.clear()
        lines.clear()
        return out

    size = 0
    for h, line in _new_lines(batches):
        if len(line) > SHINGLE:  # shorter lines are only like themselves
            hashes.append(h)
            lines.append(line)
            size += len(line)
            if size >= 200_000:
                yield flush()
                size = 0
    if lines:
        yield flush()


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by band and line -> (band, leader, line) for each other line of a band."""
    last = None
    for batch in batches:
        band, line = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(2))
        if not len(band):
            continue
        new = np.concatenate(([True], band[1:] != band[:-1]))
        leader = line[np.maximum.accumulate(np.where(new, np.arange(len(band)), 0))]
        before = np.concatenate((line[:1], line[:-1]))
        if last and last[0] == band[0]:
            same = band == band[0]
            leader = np.where(same, last[1], leader)
            before[0] = last[2]
            new[0] = False
        some = (line != leader) & (new | (line != before))
        last = (band[-1], leader[-1], line[-1])
        if some.any():
            yield pa.RecordBatch.from_arrays([pa.array(band[some]), pa.array(leader[some]), pa.array(line[some])], names=["band", "leader", "line"])


def shingle_sets(lines: list[str], size: int = SHINGLE) -> list[np.ndarray]:
    """The distinct 64-bit hashes of each line's shingles, sorted; a shorter line is one shingle."""
    padded = [x if len(x) >= size else x + "\x00" * (size - len(x)) for x in lines]
    points = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
    short = [i for i, x in enumerate(lines) if len(x) < size]
    counts = np.fromiter(map(len, padded), np.int64, len(padded))
    starts = np.concatenate(([0], np.cumsum(counts)[:-1]))
    for i in short:  # no character is as large
        points[starts[i] + len(lines[i]) : starts[i] + size] = 0x110000
    total = len(points) - size + 1
    h = np.zeros(total, np.uint64)
    for j in range(size):
        h = (h + points[j : j + total] + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
    h = _mix(h)
    sets = []
    for a, n in zip(starts, counts, strict=True):
        x = np.sort(h[a : a + n - size + 1])
        sets.append(x[np.append(True, x[1:] != x[:-1])])
    return sets


def set_jaccard(a: np.ndarray, b: np.ndarray) -> float:
    every = np.concatenate((a, b))
    every.sort()
    both = int(np.count_nonzero(every[1:] == every[:-1]))  # neither has a hash twice
    return both / (len(a) + len(b) - both)


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(leader, line, their texts), rows of one leader side by side -> which are alike."""
        for batch in batches:
            alike: list[bool] = []
            texts: list[str] = []
            pairs: list[tuple[int, int]] = []
            kept, size = None, 0

            def flush() -> None:
                sets = shingle_sets(texts) if texts else []
                alike.extend(set_jaccard(sets[i], sets[j]) >= similarity for i, j in pairs)
                texts.clear()
                pairs.clear()

            for a, b in zip(batch.column(2), batch.column(3), strict=True):
                a, b = a.as_py(), b.as_py()
                if not texts or a != kept:
                    kept, at = a, len(texts)
                    texts.append(a)
                    size += len(a)
                pairs.append((at, len(texts)))
                texts.append(b)
                size += len(b)
                if size > TOGETHER:
                    flush()
                    size = 0
            flush()
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(alike, pa.bool_())], names=["leader", "line", "alike"])

    return run


def alike_pairs(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """(lines, lines) booleans: which pairs' Jaccard similarity reaches the threshold.

    Only shingles that two lines or more have make columns, so lines that differ in many places cost little.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets])
    _, number, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    of, often = np.repeat(np.arange(n), sizes), times[number] > 1
    column = (np.cumsum(times > 1) - 1)[number[often]]
    row = of[often]
    shared, columns = np.zeros((n, n), np.float32), int((times > 1).sum())
    for lo in range(0, columns, 4096):
        table = np.zeros((n, min(4096, columns - lo)), np.float32)
        some = (column >= lo) & (column < lo + 4096)
        table[row[some], column[some] - lo] = 1
        shared += table @ table.T
    both = shared.astype(np.float64)
    np.fill_diagonal(both, sizes)
    return both / (sizes[:, None] + sizes[None, :] - both) >= similarity


def candidate_pairs(sets: list[np.ndarray], similarity: float, label: np.ndarray | None = None) -> np.ndarray:
    """(lines, lines) booleans, none lost of lines with unequal labels: pairs that share one of their rarest shingles.

    Of two lines that reach the threshold each has all but a part 1 - similarity
    of its shingles from the other, so they meet in the first so many of any
    common order, here the rarest first; and neither is much larger.
    """
    n, sizes = len(sets), np.array([len(x) for x in sets])
    _, token, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(n), sizes)
    order = np.lexsort((token, times[token], row))
    position = np.arange(len(token)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    first = sizes - np.ceil(similarity * sizes - 1e-9).astype(np.int64) + 1
    picked = order[position < np.repeat(first, sizes)]
    picked = picked[times[token[picked]] > 1]
    picked = picked[np.argsort(token[picked], kind="stable")]
    near, picked_token, rows = np.zeros((n, n), bool), token[picked], row[picked]
    begin = np.flatnonzero(np.diff(picked_token, prepend=-1))
    size = np.diff(np.append(begin, len(rows)))
    if label is not None and len(begin):  # a shingle of one component's lines joins nothing
        apart = np.minimum.reduceat(label[rows], begin) < np.maximum.reduceat(label[rows], begin)
        begin, size = begin[apart], size[apart]
    for i in np.flatnonzero(size > FEW):
        some = rows[begin[i] : begin[i] + size[i]]
        near[np.ix_(some, some)] = True
    begin, size = begin[size <= FEW], size[size <= FEW]
    for some in np.array_split(np.arange(len(size)), 1 + int((size**2).sum()) // PAIRS):
        each = np.repeat(size[some], size[some])  # an element's partners
        first_of = np.repeat(begin[some], size[some])
        own = first_of + np.arange(len(each)) - np.repeat(np.cumsum(size[some]) - size[some], size[some])
        place = np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each)
        near[np.repeat(rows[own], each), rows[np.repeat(first_of, each) + place]] = True
    return near & (np.minimum.outer(sizes, sizes) >= similarity * np.maximum.outer(sizes, sizes) - 1e-9)


def block_links(components: list[int], texts: list[str], similarity: float) -> list[tuple[int, int]]:
    """Links between components, as few as join those that some pair of alike lines joins."""
    first: dict[int, int] = {}
    label = np.array([first.setdefault(c, i) for i, c in enumerate(components)])
    sets = shingle_sets(texts)
    sizes = [len(x) for x in sets]
    near = label[:, None] != label[None, :]
    if len(sets) > FEW:
        near &= candidate_pairs(sets, similarity, label)
    if near.sum() > 2 * CANDIDATES:
        near &= alike_pairs(sets, similarity)
        alike = lambda i, j: True
    else:
        alike = lambda i, j: min(sizes[i], sizes[j]) >= similarity * max(sizes[i], sizes[j]) - 1e-9 and set_jaccard(sets[i], sets[j]) >= similarity
    parent = list(label)
    links = []

    def root(i: int) -> int:
        while parent[i] != i:
            parent[i] = i = parent[parent[i]]
        return i

    for i, j in np.argwhere(np.triu(near)).tolist():
        a, b = root(i), root(j)
        if a != b and alike(i, j):
            parent[max(a, b)] = min(a, b)
            links.append((components[a], components[b]))
    return links


def _compare_blocks(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """(band, i, j, component, text) sorted by band and block -> links of components."""
        current, rows = None, []
        found: list[tuple[int, int]] = []

        def close() -> None:
            if len({c for c, _ in rows}) > 1:
                found.extend(block_links(*map(list, zip(*rows, strict=True)), similarity))

        for batch in batches:
            band, i, j, component, text = (c.to_pylist() for c in batch.columns)
            for k in range(len(band)):
                key = (band[k], i[k], j[k])
                if key != current:
                    close()
                    current, rows = key, []
                rows.append((component[k], text[k]))
        close()
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in found], pa.int64()), pa.array([b for _, b in found], pa.int64())], names=["a", "b"])

    return run


def line_links(texts: DataFrame, similarity: float = 0.8) -> DataFrame:
    """(text) rows -> components of unequal lines that are alike: (line, component), one row a line in such a component."""
    spark = texts.sparkSession
    bands = texts.mapInArrow(_bands, "band long, line long")
    sorted_bands = bands.repartition(partitions(spark), "band").sortWithinPartitions("band", "line")
    groups = materialize(sorted_bands.mapInArrow(_groups, "band long, leader long, line long"))
    pairs = groups.select("leader", "line").distinct()
    ends = groups.select("leader").unionByName(groups.select(F.col("line").alias("leader")))
    bit = F.col("leader").bitwiseAND(FILTER_BITS - 1)
    at, bits = columns_of(ends.groupBy(F.shiftright(bit, 6).alias("at")).agg(F.bit_or(F.expr(f"shiftleft(1L, cast((leader & {FILTER_BITS - 1}) & 63 as int))")).alias("bits")))
    filled = np.zeros(FILTER_BITS // 64, np.int64)
    filled[at] = bits

    def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = filled.view(np.uint8)
        wanted = lambda h: bits[(h & (FILTER_BITS - 1)) >> 3] >> (h & 7) & 1
        found: list[tuple[int, str]] = []
        for x in _new_lines(batches, wanted):
            found.append(x)
            if len(found) >= 2000:
                yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())], names=["line", "text"])
                found = []
        yield pa.RecordBatch.from_arrays([pa.array([h for h, _ in found], pa.int64()), pa.array([t for _, t in found], pa.string())], names=["line", "text"])

    bodies = materialize(texts.mapInArrow(pick, "line long, text string").dropDuplicates(["line"]))
    both = pairs.join(bodies, "line").withColumnRenamed("text", "text_line").join(bodies.select(F.col("line").alias("leader"), F.col("text").alias("text_leader")), "leader")
    judged = materialize(both.select("leader", "line", "text_leader", "text_line").mapInArrow(_verify(similarity), "leader long, line long, alike boolean"))
    links = judged.where("alike").select(F.col("leader").alias("a"), F.col("line").alias("b"))
    components = connected_components(links)
    failed = judged.where("not alike").select("leader", "line")
    if failed.limit(1).count():
        components = materialize(components)
        open_bands = groups.join(failed, ["leader", "line"], "left_semi").select("band").distinct()
        members = groups.join(open_bands, "band", "left_semi")
        members = members.select("band", "line").unionByName(members.select("band", F.col("leader").alias("line"))).distinct()
        members = members.join(components.withColumnRenamed("node", "line"), "line", "left").withColumn("component", F.coalesce("component", "line"))
        # of two lines both have been compared; bands with the same lines are one
        apart = members.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("lo"), F.max("component").alias("hi"), F.bit_xor(F.xxhash64("line")).alias("lines")).where("lo < hi and n > 2")
        apart = apart.groupBy("n", "lines").agg(F.min("band").alias("band"))
        members = members.join(apart.select("band", F.ceil(F.col("n") / BLOCK).cast("int").alias("blocks")), "band")
        # each pair of blocks once: a member goes to all pairs that its block is in
        own = F.pmod(F.xxhash64("line"), F.col("blocks")).cast("int")
        members = members.withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        members = members.select("band", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "line", "component").join(bodies, "line")
        blocks = members.select("band", "i", "j", "component", "text").repartition(partitions(spark), "band", "i", "j").sortWithinPartitions("band", "i", "j")
        more = materialize(blocks.mapInArrow(_compare_blocks(similarity), "a long, b long"))
        if more.limit(1).count():
            # these link components, among them lines that were alone
            joined = materialize(connected_components(more).select(F.col("node").alias("component"), F.col("component").alias("whole")))
            alone = joined.join(components.select("component").distinct(), "component", "left_anti").select(F.col("component").alias("node"), F.col("whole").alias("component"))
            components = components.join(joined, "component", "left").select("node", F.coalesce("whole", "component").alias("component")).unionByName(alone)
    return components.select(F.col("node").alias("line"), "component")


def _row_key(id_col: str, text_col: str):
    return F.xxhash64(quoted(id_col), quoted(text_col))


def repeated_lines(docs: DataFrame, similarity: float = 0.8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(row, numbers): for each row key the numbers of its lines (from 0) that go."""
    occur = materialize(docs.select(_row_key(id_col, text_col).alias("row"), F.col(quoted(id_col)).alias("id"), F.col(quoted(text_col)).alias("text")).mapInArrow(_occurrences, StructType.fromDDL("line long, row long").add("id", docs.schema[id_col].dataType).add("number", "integer")))
    components = line_links(docs.select(F.col(quoted(text_col)).alias("text")), similarity)
    counts = occur.groupBy("line").agg(F.count("*").alias("n"))
    lines = counts.join(components, "line", "left").where("n > 1 or component is not null")
    lines = materialize(lines.select("line", "n", F.coalesce("component", "line").alias("component")))
    hits = materialize(join_hot(occur, lines, "line").select("component", "row", "id", "number"))
    place = F.struct(F.col("id").isNull().alias("no_id"), "id", "row", "number")
    keep = materialize(hits.groupBy("component").agg(F.count("*").alias("n"), F.min(place).alias("keep")).select("component", "n", F.col("keep.row").alias("keep_row"), F.col("keep.number").alias("keep_number")))
    gone = join_hot(hits, keep, "component").where("row <> keep_row or number <> keep_number").select("row", "number")
    return gone.groupBy("row").agg(F.collect_set("number").alias("numbers"))


def join_hot(rows: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """rows joined with keys, one row a key with the number n of its rows (both materialized): keys that have over a thousandth
    of these rows, fewer than a thousand, are broadcast, so that no task gets all rows of one."""
    hot = F.col("n") * 1000 > (keys.agg(F.sum("n").alias("n")).first().n or 0)
    frequent = F.broadcast(keys.where(hot))
    rest = rows.join(frequent.select(key), key, "left_anti").join(keys.where(~hot), key)
    return rows.join(frequent, key).unionByName(rest)


def _without(text: str | None, gone: set[int] | None, first: bool) -> tuple[str | None, int, int]:
    """The text that is left, its lines before, and how many of them went; a repeated row loses all lines that aren't blank."""
    if text is None:
        return None, 0, 0
    lines = text.split("\n")
    if first and not gone:
        return text, len(lines), 0
    left = [x for i, x in enumerate(lines) if i not in gone] if first else [x for x in lines if not x.encode().strip()]
    return "\n".join(left), len(lines), len(lines) - len(left)


def _deduped(docs: DataFrame, similarity: float, id_col: str, text_col: str) -> DataFrame:
    """rest (docs' other columns), numbers (of the lines that go), first (False for what repeats a row) and text."""
    gone = repeated_lines(docs, similarity, id_col=id_col, text_col=text_col)
    rows = packed(docs, [text_col], row=_row_key(id_col, text_col), text=F.col(quoted(text_col))).join(gone, "row", "left")
    return rows.select("rest", "numbers", (F.row_number().over(W.partitionBy("row").orderBy("row")) == 1).alias("first"), "text")


def dedup_lines(docs: DataFrame, similarity: float = 0.8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs, each text without the lines whose component has an earlier line.

    Lines end at newlines; blank lines are left alone and count for nothing.
    Earlier is by id (null last), then row, then line.  A row that is repeated
    whole (same id, same text) keeps its lines once.  Null texts stay null, and
    a text may become empty.  Long lines are compared whole; lines of up to
    eight characters are only like themselves.  An empty table gives an empty
    result, and other columns pass unchanged.
    """
    rows = _deduped(docs, similarity, id_col, text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_without(t.as_py(), g.as_py() and set(g.as_py()), f.as_py())[0] for g, f, t in zip(batch.column(1), batch.column(2), batch.column(3), strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(made, pa.string())], names=["rest", "text"])

    out = rows.mapInArrow(run, result_schema([rows.schema["rest"]], "text string"))
    return out.select(unpacked(out, docs.columns, **{text_col: F.col("text")}))


def line_digests(docs: DataFrame, similarity: float = 0.8, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_lines, n_removed, kept_sha256 (of the text that is left; null counts as empty) a document; edge cases as in dedup_lines."""
    docs = docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))
    rows = _deduped(docs, similarity, "doc_id", "text").select("rest.doc_id", "numbers", "first", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [_without(t.as_py(), g.as_py() and set(g.as_py()), f.as_py()) for g, f, t in zip(batch.column(1), batch.column(2), batch.column(3), strict=True)]
            sha = [hashlib.sha256((t or "").encode()).hexdigest() for t, _, _ in made]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array([n for _, n, _ in made], pa.int64()), pa.array([n for _, _, n in made], pa.int64()), pa.array(sha, pa.string())], names=["doc_id", "n_lines", "n_removed", "kept_sha256"])

    return rows.mapInArrow(run, result_schema([rows.schema["doc_id"]], "n_lines long, n_removed long, kept_sha256 string"))


def op3_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_digests(read(spark, sf_dir, "documents"))


QUERIES = {"op3_lines": op3_lines}
SQL: dict[str, str] = {}
