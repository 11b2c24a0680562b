"""SimHash near-duplicates by anchor-point covering.

A text's fingerprint has 64 bits.  Two fingerprints within the threshold meet
at an anchor: anchors are the codewords of a covering code, each fingerprint
has a home anchor within the covering radius, and it is also sent to each
anchor within the radius plus the threshold, so it meets there all that are at
home there and near enough.  Anchors compare what came to them.

To keep the copies few, the 64 bits are cut into parts.  Of two fingerprints
within the threshold t, some part differs in at most t // parts bits, so each
part has a covering code of its own and only has to cover that.  A part's code
is a perfect Hamming code (radius one) on its first 2^r - 1 bits, with the bits
after it taken as they are (radius nought), so the distances add up.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from levyframe.llm.common import materialize, packed, partitions, quoted, read, result_schema, row_hash, unpacked
from levyframe.llm.components import connected_components

#: Fingerprints at home at one anchor that are compared in one group; more are split.
HOMES = 2048


def fingerprint(text: bytes | None, shingle: int = 4, seed: int = 42) -> int:
    """Lower-cases A-Z; a bit is 1 if it is set in over half of the shingles' hashes."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    n = max(1, len(words) - shingle + 1)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.concatenate(([0], ends[: n - 1]))
    stops = (ends[shingle - 1 :] if len(words) >= shingle else ends[-1:]) - 1
    h = xxhash.xxh64_intdigest
    hashes = np.fromiter([h(joined[a:b], seed) for a, b in zip(starts.tolist(), stops.tolist(), strict=True)], np.uint64, n)
    ones = np.zeros(64, np.int64)
    for at in range(0, n, 65536):
        ones += np.unpackbits(hashes[at : at + 65536].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n).tobytes(), "big")


@dataclass(frozen=True)
class Part:
    """Bits low to low + hamming + plain - 1, the first `hamming` of them (2^r - 1, or 0) coded."""

    low: int
    hamming: int
    plain: int


#: Parts that send 42 copies of a fingerprint, for up to some 50 million distinct ones, and parts that send some 340, whose
#: groups stay small for more.  Links are the same with either; which to take is the caller's choice.
PARTS = (Part(0, 15, 6), Part(21, 15, 6), Part(42, 15, 7))
MANY_PARTS = (Part(0, 31, 1), Part(32, 31, 1))


def syndrome(x: np.ndarray, bits: int) -> np.ndarray:
    """XOR of the positions (from 1) of the set bits: 0 for codewords, else the bit that is off."""
    out = np.zeros_like(x)
    for i in range(bits):
        out ^= np.where((x >> np.uint64(i)) & np.uint64(1), np.uint64(i + 1), np.uint64(0))
    return out


def flip(x: np.ndarray, s: np.ndarray) -> np.ndarray:
    """x with the bit at position s (from 1) flipped; position 0 flips nothing."""
    return np.where(s > 0, x ^ (np.uint64(1) << np.maximum(s, np.uint64(1)) - np.uint64(1)), x)


def anchors(prints: np.ndarray, parts: tuple[Part, ...], threshold: int, home_only: bool = False) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, anchor, at home) for each anchor that a fingerprint goes to."""
    slack = 0 if home_only else threshold // len(parts)
    if slack > 2:
        raise ValueError("more parts are needed for this threshold")
    rows = np.arange(len(prints))
    for p, part in enumerate(parts):
        width = part.hamming + part.plain
        bits = (prints >> np.uint64(part.low)) & np.uint64((1 << width) - 1)
        code = bits & np.uint64((1 << part.hamming) - 1)
        s = syndrome(code, part.hamming)
        home = flip(code, s)
        # codewords at distance beyond the radius, by how far beyond
        ring: list[list[np.ndarray]] = [[home], [], []]
        if slack >= 1:
            for i in range(1, part.hamming + 1):
                j = s ^ np.uint64(i)  # flipping i and j gives a codeword; each pair once, and none from a codeword
                ring[1].append(np.where((s > 0) & (j > i), flip(flip(code, j), np.full_like(s, i)), home))
        if slack >= 2:
            for i in range(1, part.hamming + 1):
                for j in range(i + 1, part.hamming + 1):
                    k = s ^ np.uint64(i ^ j)
                    ring[2].append(np.where(k > j, flip(flip(flip(code, k), np.full_like(s, i)), np.full_like(s, j)), home))
        flips = [[0], [1 << (part.hamming + i) for i in range(part.plain)], [(1 << (part.hamming + i)) | (1 << (part.hamming + j)) for i in range(part.plain) for j in range(i)]]
        rest = bits & ~np.uint64((1 << part.hamming) - 1)
        for beyond in range(slack + 1):
            for word in ring[beyond]:
                for more in range(slack - beyond + 1):
                    for f in flips[more]:
                        at_home = beyond == 0 and more == 0
                        some = slice(None) if beyond == 0 else word != home
                        key = (np.uint64(p) << np.uint64(60)) | (word[some] | rest[some]) ^ np.uint64(f)
                        yield rows[some], key, np.full(len(key), at_home)


def _links_at(homes: np.ndarray, members: Iterator[np.ndarray], threshold: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links between a group's homes and its members, as few as keep all that are linked together.

    A member is linked to one home; homes that a member joins are linked to one of them.
    """
    label = np.arange(len(homes))
    for part in members:
        step = max(1, 2_000_000 // len(homes))
        for at in range(0, len(part), step):
            some = part[at : at + step]
            near = np.bitwise_count(homes[:, None] ^ some[None, :]) <= threshold
            hit = near.any(axis=0)
            if not hit.any():
                continue
            near, some = near[:, hit], some[hit]
            while True:  # homes that share a member get the smallest label among them
                least = np.where(near, label[:, None], len(homes)).min(axis=0)
                new = np.minimum(label, np.where(near, least[None, :], len(homes)).min(axis=1))
                new = new[new]
                if (new == label).all():
                    break
                label = new
            to = homes[label[near.argmax(axis=0)]]
            other = some != to
            yield some[other], to[other]
    moved = label != np.arange(len(homes))
    yield homes[moved], homes[label[moved]]


def _compare(threshold: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by anchor, homes first."""
        current, homes, waiting = None, [], []
        found: list[tuple[np.ndarray, np.ndarray]] = []

        def close() -> None:
            nonlocal waiting
            if homes and waiting:
                found.extend(_links_at(np.concatenate(homes), iter([np.concatenate(waiting)]), threshold))
            waiting = []

        def flush() -> Iterator[pa.RecordBatch]:
            if found:
                a, b = (np.concatenate(x).view(np.int64) for x in zip(*found, strict=True))
                found.clear()
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

        for batch in batches:
            key, salt, member, prints = (batch.column(i).to_numpy(zero_copy_only=False) for i in range(4))
            prints = prints.view(np.uint64)
            if not len(key):
                continue
            cut = np.flatnonzero((key[1:] != key[:-1]) | (salt[1:] != salt[:-1])) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(key)], strict=True):
                if (key[a], salt[a]) != current:
                    close()
                    current, homes = (key[a], salt[a]), []
                split = a + int(np.searchsorted(member[a:b], 1))
                if split > a:
                    homes.append(prints[a:split])
                if homes:
                    waiting.append(prints[a:b])
                    # the homes of a group are few and come first; its other members are compared as they come
                    if split < b and sum(map(len, waiting)) > 100_000:
                        close()
            yield from flush()
        close()
        yield from flush()

    return run


def near_links(prints: DataFrame, threshold: int = 4, parts: tuple[Part, ...] = PARTS) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) that join all that are within the threshold, by chains of such."""
    spark = prints.sparkSession

    def send(home_only: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                values = batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
                for at in range(0, len(values), 50_000):
                    some = values[at : at + 50_000]
                    rows, keys, home = (np.concatenate(x) for x in zip(*anchors(some, parts, threshold, home_only), strict=True))
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array((~home).astype(np.int8)), pa.array(some[rows].view(np.int64))], names=["anchor", "member", "fp"])

        return run

    sent = prints.mapInArrow(send(False), "anchor long, member byte, fp long")
    homes = prints.mapInArrow(send(True), "anchor long, member byte, fp long")
    # anchors that are home to very many are split: a share of their homes each, and all members to every share
    crowded = materialize(homes.groupBy("anchor").agg(F.count("*").alias("n")).where(F.col("n") > HOMES).select("anchor", F.ceil(F.col("n") / HOMES).cast("int").alias("shares")))
    if crowded.limit(1).count():
        sent = sent.join(crowded, "anchor", "left").withColumn("shares", F.coalesce("shares", F.lit(1)))
        share = F.when(F.col("member") == 0, F.array(F.pmod(F.xxhash64("fp"), F.col("shares")).cast("int"))).otherwise(F.sequence(F.lit(0), F.col("shares") - 1))
        own = sent.withColumn("salt", F.explode(share))
        # a home is a member of the other shares
        others = sent.where((F.col("member") == 0) & (F.col("shares") > 1)).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("shares") - 1))).where(F.col("salt") != F.pmod(F.xxhash64("fp"), F.col("shares"))).withColumn("member", F.lit(1).cast("byte"))
        sent = own.unionByName(others)
    else:
        sent = sent.withColumn("salt", F.lit(0))
    sent = sent.select("anchor", "salt", "member", "fp").repartition(partitions(spark), "anchor", "salt").sortWithinPartitions("anchor", "salt", "member")
    return sent.mapInArrow(_compare(threshold), "a long, b long").distinct()


def fingerprints(docs: DataFrame, *, text_col: str = "text") -> DataFrame:
    """docs with the text, which may be null, replaced by fp (long)."""
    kept = [f for f in docs.schema.fields if f.name != text_col]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(batch.num_columns - 1).cast(pa.binary())
            made = np.fromiter((fingerprint(t.as_py()) for t in texts), np.uint64, len(texts)).view(np.int64)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(made)], names=[*batch.schema.names[:-1], "fp"])

    return docs.select(*[quoted(f.name) for f in kept], quoted(text_col)).mapInArrow(run, result_schema(kept, "fp long"))


def near_groups(printed: DataFrame, threshold: int = 4, parts: tuple[Part, ...] = PARTS, *, id_col: str = "doc_id") -> DataFrame:
    """Rows with an id and fp -> fp, label, component_id for the distinct fingerprints.

    label is the group's smallest fingerprint; component_id the smallest id in
    the group, null only if all its ids are.
    """
    distinct = materialize(printed.groupBy("fp").agg(F.min(id_col).alias("least_id")))
    joined = connected_components(near_links(distinct.select("fp"), threshold, parts))
    labelled = distinct.join(joined.select(F.col("node").alias("fp"), F.col("component").alias("label")), "fp", "left").withColumn("label", F.coalesce("label", "fp"))
    labelled = materialize(labelled)
    ids = labelled.groupBy("label").agg(F.min("least_id").alias("component_id"))
    return labelled.select("fp", "label").join(ids, "label").select("fp", "label", "component_id")


def simhash_components(docs: DataFrame, threshold: int = 4, parts: tuple[Part, ...] = PARTS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id (smallest doc_id of the group) a document.

    Null and wordless texts have fingerprint zero and link like any other.
    Null ids are ignored for component_id, unless a group has no others.
    Repeated rows stay repeated; an empty table gives an empty result.
    parts: MANY_PARTS for tables of far more than 50 million distinct
    fingerprints; the result is the same.
    """
    printed = materialize(fingerprints(docs.select(F.col(quoted(id_col)).alias("doc_id"), F.col(quoted(text_col)).alias("text"))))
    groups = near_groups(printed, threshold, parts)
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0"))
    return printed.join(groups, "fp").select("doc_id", hexed.alias("fingerprint"), "component_id")


def simhash_documents(docs: DataFrame, threshold: int = 4, parts: tuple[Part, ...] = PARTS, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs with one document of each group: that with the smallest id (null last), then the smallest hash of the row.

    Null and wordless texts are a group; of repeated rows one stays; columns
    of any name and type pass unchanged; an empty table gives an empty result.
    """
    keys = {"id": F.col(quoted(id_col)), "row": row_hash(docs)}
    printed = materialize(fingerprints(docs.select(*[v.alias(k) for k, v in keys.items()], F.col(quoted(text_col)).alias("text"))))
    groups = near_groups(printed, threshold, parts, id_col="id")
    first = F.min(F.struct(F.col("id").isNull().alias("n"), "id", "row")).alias("first")
    chosen = printed.join(groups.select("fp", "label"), "fp").groupBy("label").agg(first).select(F.col("first.id").alias("k"), F.col("first.row").alias("r"))
    rows = packed(docs, **keys)
    # equal rows are one group; the join has put them together already
    kept = rows.join(chosen, F.col("id").eqNullSafe(F.col("k")) & (F.col("row") == F.col("r")), "left_semi").dropDuplicates(["row", "id"])
    return kept.select(unpacked(kept, docs.columns))


def op6_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_components(read(spark, sf_dir, "documents"))


QUERIES = {"op6_simhash": op6_simhash}
SQL: dict[str, str] = {}
