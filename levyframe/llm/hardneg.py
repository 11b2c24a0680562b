"""Hard negatives by full exact scores, looked up in subset-sum tables (Four Russians).

Vectors become integers.  An anchor's eight components of a group have 256
subset sums; a candidate's eight components of that group are, bit plane by bit
plane, bytes that index them.  So a score is the sum over planes, shifted by
the plane, of one lookup a group: no multiplication, and no score is left out
or estimated.

Anchors are dealt into blocks of bounded size.  Each candidate goes to each
block, where its row comes after the anchors'; a task streams candidates past the
tables of one block, and keeps only the best hits of each anchor.  A first round
finds each anchor's positives, a second one, with the windows that these open, its
negatives.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from levyframe.llm.common import materialize, partitions, quoted, read

#: Components of a group, and the values of a byte.
GROUP, SUMS = 8, 256
#: Components become floor(SCALE * x), held within +-LARGEST so that a hundred times the scores of up to 1,000 dimensions fit into 64 bits.
SCALE, LARGEST = 256, (1 << 23) - 1
#: Bytes of the tables of a block of anchors, and anchors a block, both on average; candidates that are scored at once.
TABLE_BYTES, BLOCK_ANCHORS, AT_ONCE = 16 << 20, 1024, 512
NO_ID = (1 << 63) - 1


def bit_planes(codes: np.ndarray) -> tuple[int, int, np.ndarray]:
    """(planes, groups, bytes) of rows of integers: per row, plane after plane from the sign's (two's complement), a byte a group."""
    groups = -(-codes.shape[1] // GROUP)
    wide = np.zeros((len(codes), groups * GROUP), np.int64)
    wide[:, : codes.shape[1]] = codes
    planes = int(max(int(wide.max(initial=0)), -int(wide.min(initial=0)) - 1)).bit_length() + 1
    bits = (wide[:, None, :] >> np.arange(planes - 1, -1, -1)[None, :, None]) & 1
    return planes, groups, np.packbits(bits.astype(np.uint8), axis=2, bitorder="little").reshape(len(codes), planes * groups)


def from_planes(planes: int, packed: np.ndarray) -> np.ndarray:
    """Rows of integers out of (rows, planes, groups) bytes."""
    bits = np.unpackbits(packed, axis=2, bitorder="little").astype(np.int64)
    weights = 1 << np.arange(planes - 1, -1, -1, dtype=np.int64)
    weights[0] = -weights[0]
    return np.tensordot(bits, weights, axes=(1, 0))


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(groups, 256, anchors): what the components of each subset of a group add up to."""
    groups = -(-anchors.shape[1] // GROUP)
    wide = np.zeros((len(anchors), groups * GROUP), np.int64)
    wide[:, : anchors.shape[1]] = anchors
    out = np.zeros((groups, SUMS, len(anchors)), np.int64)
    for k in range(GROUP):
        out[:, 1 << k : 2 << k] = out[:, : 1 << k] + wide[:, k::GROUP].T[:, None, :]
    return out


def scores(tables: np.ndarray, planes: int, packed: np.ndarray) -> np.ndarray:
    """(candidates, anchors) exact inner products; packed: (candidates, planes, groups) bytes."""
    groups = min(tables.shape[0], packed.shape[2])
    out = np.zeros((len(packed), tables.shape[2]), tables.dtype)
    row = np.empty_like(out)
    for plane in range(planes):
        out = -out if plane == 1 else out  # the sign's plane counts below zero
        out += out
        for g in range(groups):
            np.take(tables[g], packed[:, plane, g], axis=0, out=row)
            out += row
    return -out if planes == 1 else out


def _codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, label, vector of doubles) -> (id, label, planes, groups, bytes)."""
    for batch in batches:
        vectors = batch.column(2)
        flat = np.clip(np.floor(SCALE * vectors.flatten().to_numpy(zero_copy_only=False)), -LARGEST, LARGEST).astype(np.int64)
        ends = np.cumsum([0, *(len(v) for v in vectors)])
        wide = np.zeros((batch.num_rows, max(1, int(np.diff(ends).max(initial=1)))), np.int64)
        for i in range(batch.num_rows):
            wide[i, : ends[i + 1] - ends[i]] = flat[ends[i] : ends[i + 1]]
        for part in np.array_split(np.arange(batch.num_rows), -(-batch.num_rows // AT_ONCE) or 1):
            planes, groups, raw = bit_planes(wide[part])
            take, n = pa.array(part), len(part)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), pa.array(np.full(n, planes, np.int32)), pa.array(np.full(n, groups, np.int32)), pa.array([r.tobytes() for r in raw], pa.binary())],
                names=["id", "label", "planes", "groups", "raw"],
            )


ROW = "id long, label long, planes int, groups int, raw binary"


def usable_rows(vectors: DataFrame, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(row, id, label, planes, groups, raw): rows with a label and a vector of finite numbers, as bit planes; a number for each row, as rows may repeat."""
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("id"), F.col(quoted(label_col)).cast("long").alias("label"), F.col(quoted(vector_col)).cast("array<double>").alias("v"))
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    coded = rows.where(F.col("label").isNotNull() & F.col("v").isNotNull() & ~bad).mapInArrow(_codes, ROW)
    return materialize(coded.select(F.monotonically_increasing_id().alias("row"), "*"))


class Best:
    """The best `most` (score, id, row, label) of each of some anchors' windows: higher scores first, then smaller ids."""

    def __init__(self, most: int) -> None:
        self.most, self.kept = most, {}

    def least(self, key) -> int | None:
        kept = self.kept.get(key)
        return kept[0][-1] if kept is not None and len(kept[0]) == self.most else None

    def add(self, key, score: np.ndarray, ids: np.ndarray, rows: np.ndarray) -> None:
        if key in self.kept:
            score, ids, rows = (np.concatenate(x) for x in zip(self.kept[key], (score, ids, rows), strict=True))
        order = np.lexsort((rows, ids, -score))[: self.most]
        self.kept[key] = (score[order], ids[order], rows[order])


class Block:
    """Anchors of one block, their tables, and the best hits so far."""

    def __init__(self, most: int) -> None:
        self.parts, self.best, self.tables, self.narrow = [], Best(most), None, {}

    def add(self, rows: np.ndarray, labels: np.ndarray, codes: list[np.ndarray], windows: list[np.ndarray]) -> None:
        self.parts.append((rows, labels, codes, windows))

    def tables_for(self, planes: int) -> np.ndarray:
        if self.tables is None:
            rows, labels, codes, windows = zip(*self.parts, strict=True)
            codes = [c for part in codes for c in part]
            wide = np.zeros((len(codes), max(len(c) for c in codes)), np.int64)
            for i, c in enumerate(codes):
                wide[i, : len(c)] = c
            self.rows, self.labels, self.windows = np.concatenate(rows), np.concatenate(labels), [w for part in windows for w in part]
            self.tables = subset_sums(wide)
        if planes not in self.narrow:
            self.narrow[planes] = _narrow(self.tables, planes)
        return self.narrow[planes]

    def meet(self, planes: int, packed: np.ndarray, rows: np.ndarray, ids: np.ndarray, labels: np.ndarray, negatives: bool) -> None:
        """Score some candidates against all anchors, and keep what is best."""
        if not self.parts:
            return
        found = scores(self.tables_for(planes), planes, packed).T.astype(np.int64)
        for anchor, label, windows, mine in zip(self.rows.tolist(), self.labels.tolist(), self.windows, found, strict=True):
            fits = labels != label if negatives else (labels == label) & (rows != anchor)
            for w in windows.tolist():
                least = self.best.least((anchor, w))
                hit = fits if least is None else fits & (mine >= least)
                if negatives:
                    hit = hit & (100 * mine >= 30 * w) & (100 * mine <= 90 * w)
                hit = np.flatnonzero(hit)
                if len(hit):
                    self.best.add((anchor, w), mine[hit], ids[hit], rows[hit])

    def hits(self) -> pa.RecordBatch:
        parts = [(np.full(len(s), a), np.full(len(s), w), s, i, r) for (a, w), (s, i, r) in self.best.kept.items()]
        columns = [np.concatenate(x).astype(np.int64) for x in zip(*parts, strict=True)] if parts else [np.zeros(0, np.int64)] * 5
        return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["anchor", "window", "score", "id", "row"])


def _narrow(tables: np.ndarray, planes: int) -> np.ndarray:
    """The tables in 32 bits, where all scores surely fit."""
    most = int(np.abs(tables).max(initial=0)) * tables.shape[0] << planes
    return tables.astype(np.int32) if most < 1 << 31 else tables


def _raw(column: pa.Array, planes: int, groups: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), planes, groups)


def _meet(most: int, negatives: bool):
    """Rows sorted by key, each key's anchors first, then its candidates -> (anchor row, window, score, id, row): the best of
    each window among the key's candidates; with negatives=False the window is all other rows of the anchor's label."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, block = None, Block(most)
        for batch in batches:
            key, kind = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            planes, groups = batch.column(5).to_numpy(), batch.column(6).to_numpy()
            kinds = np.stack([key, kind, planes, groups])
            cuts = [0, *(np.flatnonzero((kinds[:, 1:] != kinds[:, :-1]).any(axis=0)) + 1).tolist(), batch.num_rows]
            for lo, hi in zip(cuts, cuts[1:], strict=False):
                if key[lo] != current:
                    yield block.hits()
                    current, block = key[lo], Block(most)
                for at in range(lo, hi, AT_ONCE):
                    some = batch.slice(at, min(AT_ONCE, hi - at))
                    rows, ids, labels = (some.column(c).to_numpy() for c in (2, 3, 4))
                    packed = _raw(some.column(7), int(planes[lo]), int(groups[lo]))
                    if kind[lo]:
                        block.meet(int(planes[lo]), packed, rows, ids, labels, negatives)
                    else:
                        block.add(rows, labels, list(from_planes(int(planes[lo]), packed)), [np.array(w, np.int64) for w in some.column(8).to_pylist()])
        yield block.hits()

    return run


HIT = "anchor long, window long, score long, id long, row long"


def _best_hits(rows: DataFrame, asking: DataFrame, n_blocks: int, most: int, negatives: bool) -> DataFrame:
    """HIT with a rank: the best of each anchor's windows among all rows.

    Anchors are dealt into blocks.  Each candidate goes once to each block, and
    each block's candidates are dealt to as many keys as there are tasks to spare.
    """
    spark = rows.sparkSession
    shares = max(1, -(-3 * partitions(spark) // n_blocks))
    deal = lambda seed, n: F.pmod(F.xxhash64("row", F.lit(seed)), F.lit(n))
    key = lambda block, share: (block * shares + share).cast("long").alias("key")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    ids = F.coalesce("id", F.lit(NO_ID)).alias("id")
    anchors = asking.select("*", every(shares).alias("s")).select(key(deal(1, n_blocks), F.col("s")), F.lit(0).alias("kind"), "row", ids, "label", "planes", "groups", "raw", "windows")
    others = rows.select("*", every(n_blocks).alias("b")).select(
        key(F.col("b"), deal(2, shares)), F.lit(1).alias("kind"), "row", ids, "label", "planes", "groups", "raw", F.lit(None).cast("array<bigint>").alias("windows")
    )
    met = anchors.unionByName(others).repartition(partitions(spark), "key").sortWithinPartitions("key", "kind", "planes", "groups")
    rank = F.row_number().over(W.partitionBy("anchor", "window").orderBy(F.desc("score"), "id", "row"))
    return met.mapInArrow(_meet(most, negatives), HIT).withColumn("rank", rank).where(F.col("rank") <= most)


def hard_negatives(vectors: DataFrame, anchors, positives: int = 5, negatives: int = 10, *, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label") -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): hard negatives for each anchor and positive.

    anchors: a condition on a column `id`.  An anchor's positives are its best
    `positives` other rows of the same label; a positive's negatives are the
    best `negatives` rows of another label that score from 0.3 to 0.9 times what
    the positive does.  Scores are inner products of floor(256 * x), which
    are held within 23 bits; higher come first, ties by smaller id.

    Rows without a label, without a vector or with a component that is null or
    not finite take no part.  Shorter vectors count as ended by zeros, empty
    ones as zeros.  A null id is no anchor, and comes after all others where
    scores tie.  A repeated row is one more row, also beside itself.  An empty
    table, or one without anchors, gives an empty result; other columns are not read.
    """
    rows = usable_rows(vectors, id_col=id_col, vector_col=vector_col, label_col=label_col)
    asking = rows.where(F.coalesce(anchors, F.lit(False)))
    size = asking.agg(F.count("*").alias("n"), F.max("groups").alias("groups")).first()
    a_block = max(1, min(BLOCK_ANCHORS, TABLE_BYTES // (SUMS * 8 * (size["groups"] or 1))))
    n_blocks = max(1, -(-size["n"] // a_block))
    near = materialize(_best_hits(rows, asking.withColumn("windows", F.array(F.lit(0).cast("long"))), n_blocks, positives, False))
    near = near.select("anchor", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    opened = near.groupBy("anchor").agg(F.collect_set("positive_score").alias("windows"))
    far = _best_hits(rows, asking.join(opened, asking["row"] == opened["anchor"]).drop("anchor"), n_blocks, negatives, True)
    far = far.select("anchor", F.col("window").alias("positive_score"), "rank", F.col("id").alias("negative_id"), F.col("score").alias("negative_score"))
    names = asking.select(F.col("row").alias("anchor"), F.col("id").alias("anchor_id"))
    known = lambda c: F.when(F.col(c) != NO_ID, F.col(c)).alias(c)
    return near.join(far, ["anchor", "positive_score"]).join(names, "anchor").select(
        "anchor_id", known("positive_id"), F.col("rank").cast("int").alias("rank"), known("negative_id"), "positive_score", "negative_score"
    )


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read(spark, sf_dir, "embeddings")
    moved = rows.withColumn("label", F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")))
    return hard_negatives(moved, F.col("id") % 100 == 0)


QUERIES = {"op12_hard_negatives": op12_hard_negatives}
SQL = {
    "op12_hard_negatives": """
with r as (
  select row_number() over () as k, vec_id, case when vec_id % 7 = 0 then (label + 1) % 10 else label end as label, list_transform(embedding, lambda x: floor(256 * cast(x as double))) as v
  from embeddings where label is not null and embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
s as (
  select a.k as a, a.vec_id as anchor_id, b.vec_id as id, a.label = b.label as same, cast(list_inner_product(a.v, b.v) as bigint) as score, b.k
  from r a join r b on a.vec_id % 100 = 0 and a.k <> b.k),
p as (select * from s where same qualify row_number() over (partition by a order by score desc, id, k) <= 5)
select p.anchor_id, p.id as positive_id, cast(row_number() over (partition by p.a, p.k order by s.score desc, s.id, s.k) as integer) as rank, s.id as negative_id, p.score as positive_score, s.score as negative_score
from p join s on p.a = s.a and not s.same and 30 * p.score <= 100 * s.score and 100 * s.score <= 90 * p.score
qualify rank <= 10
"""
}
