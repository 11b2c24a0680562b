import hashlib
import random

import pytest
from pyspark.sql import functions as F

from levyframe.llm import linededup
from levyframe.llm.linededup import band_keys, dedup_lines, jaccard, line_digests, line_links, shingles
from tests.llm import brute


def brute_force(rows, similarity=0.8):
    """rows: (id, text), unique -> texts without later lines of each component."""
    lines = sorted({x for _, t in rows for x in (t or "").split("\n") if x.encode().strip()})
    sets = {x: shingles(x) for x in lines}

    def alike(a, b):
        small, large = sorted((len(sets[a]), len(sets[b])))
        return small >= similarity * large and jaccard(sets[a], sets[b]) >= similarity

    comp = brute.components(lines, alike)
    seen, out = set(), {}
    for key, text in sorted(rows, key=lambda r: (r[0] is None, r[0])):
        if text is None:
            out[key] = None
            continue
        left = []
        for x in text.split("\n"):
            if x.encode().strip():
                if comp[x] in seen:
                    continue
                seen.add(comp[x])
            left.append(x)
        out[key] = "\n".join(left)
    return out


def edited(rng, line):
    at = rng.randrange(len(line))
    return line[:at] + rng.choice(["", "zz", "É"]) + line[at + 1 :]


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(3)
    base = ["".join(rng.choice("abcdef ghié") for _ in range(rng.randint(3, 150))) for _ in range(40)]
    texts = []
    for _ in range(60):
        texts.append("\n".join(rng.choice([x, edited(rng, x), ""]) for x in rng.sample(base, 5)))
    return [(i, t) for i, t in enumerate(texts)] + [(100, None), (101, ""), (102, " \n\t\n"), (103, "short\nshort\nshort"), (104, "x" * 100_000 + "\n" + "x" * 100_000), (None, "no id here, none at all")]


def test_matches_brute_force(spark, rows):
    docs = spark.createDataFrame([(i, t, 1, "y") for i, t in rows], "doc_id long, text string, number int, `__x` string")
    want = brute_force(rows)
    got = dedup_lines(docs)
    assert got.columns == docs.columns
    assert {r.doc_id: r.text for r in got.collect()} == want
    sha = lambda t: hashlib.sha256((t or "").encode()).hexdigest()
    assert {r.doc_id: r.kept_sha256 for r in line_digests(docs).collect()} == {i: sha(t) for i, t in want.items()}


def test_groups_with_failed_comparisons_are_compared_in_full(spark, monkeypatch):
    # a chain: neighbours alike, the ends not; one band for all lines
    monkeypatch.setattr(linededup, "BLOCK", 3)
    base = "".join(random.Random(8).choice("abcdefghijklmnop") for _ in range(200))
    lines = [base[12 * k :] + "".join(random.Random(k).choice("qrstuvw") for _ in range(12 * k)) for k in range(8)]
    bands = linededup._bands

    def one_band(batches):
        import pyarrow as pa

        for b in bands(batches):
            yield pa.RecordBatch.from_arrays([pa.array([7] * b.num_rows, pa.int64()), b.column(1)], names=["band", "line"])

    monkeypatch.setattr(linededup, "_bands", one_band)
    want = brute.components(lines, lambda a, b: jaccard(shingles(a), shingles(b)) >= 0.8)
    got = {r.line: r.component for r in line_links(spark.createDataFrame([(x,) for x in lines], "text string")).collect()}
    groups = {}
    for x in lines:
        groups.setdefault(want[x], set()).add(got.get(linededup.line_hash(x.encode()), x))
    assert all(len(g) == 1 for g in groups.values())
    assert len({next(iter(g)) for g in groups.values()}) == len(groups)
    assert any(sum(want[y] == want[x] for y in lines) > 2 for x in lines)


def test_recall_of_bands_at_the_threshold():
    rng, met, n = random.Random(1), 0, 0
    for _ in range(300):
        a = "".join(rng.choice("abcdefghij") for _ in range(300))
        b = a
        while (s := jaccard(shingles(a), shingles(b))) > 0.83:
            b = edited(rng, b)
        if s >= 0.8:
            n += 1
            ka, kb = band_keys([a, b])
            met += bool((ka == kb).any())
    assert n > 100
    assert met >= 0.98 * n


def test_repeated_rows_keep_their_lines_once(spark):
    docs = spark.createDataFrame([(1, "some line of text\n\nanother one")] * 3 + [(0, "another one")], "doc_id long, text string")
    got = sorted((r.doc_id, r.text) for r in dedup_lines(docs).collect())
    assert got == [(0, "another one"), (1, ""), (1, ""), (1, "some line of text\n")]


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert dedup_lines(docs).collect() == []
    assert line_digests(docs.withColumn("k", F.lit(1))).collect() == []


def test_candidates_lose_no_pair():
    rng = random.Random(12)
    base = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(100, 250))) for _ in range(6)]
    lines = list({edited(rng, edited(rng, rng.choice(base))) for _ in range(120)} | {"abc", "abd", "x" * 40, "x" * 50})
    sets = linededup.shingle_sets(lines)
    assert [len(x) for x in sets] == [len(shingles(x)) for x in lines]
    for similarity in (0.8, 0.5):
        near, alike = linededup.candidate_pairs(sets, similarity), linededup.alike_pairs(sets, similarity)
        n = 0
        for i, a in enumerate(lines):
            for j, b in enumerate(lines[:i]):
                want = jaccard(shingles(a), shingles(b)) >= similarity
                assert alike[i, j] == want == (linededup.set_jaccard(sets[i], sets[j]) >= similarity)
                assert near[i, j] or not want
                n += want
        assert n > 20
