"""Repeated windows against brute force over all windows, and compaction against chains walked one by one."""

import hashlib
import random
import re

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from levyframe.llm import debruijn

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SCHEMA = "doc_id long, text string, n_words string, rest string"


def brute(rows, window=20):
    """[(doc_id, n_words, n_removed, sha)]; rows of one id may come in any order, so tests give them equal texts."""
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0, k))
    seen, out = set(), []
    for k in order:
        words = WORD.findall(rows[k][1] or "")
        gone = set()
        for i in range(len(words) - window + 1):
            g = tuple(words[i : i + window])
            if g in seen:
                gone.update(range(i, i + window))
            seen.add(g)
        kept = " ".join(w for i, w in enumerate(words) if i not in gone)
        out.append((rows[k][0], len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return sorted(out, key=repr)


def frame(spark, rows):
    return spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], SCHEMA)


def got(spark, rows, **how):
    return sorted((tuple(r) for r in debruijn.window_digests(frame(spark, rows), **how).collect()), key=repr)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(13)
    words = [f"w{k}é" for k in range(400)]
    say = lambda n, of=400: " ".join(rng.choice(words[:of]) for _ in range(n))
    passages = [say(n) for n in (20, 21, 35, 60, 300)]
    texts = []
    for _ in range(60):
        parts = [rng.choice([say(rng.randint(0, 40)), rng.choice(passages), rng.choice(passages)]) for _ in range(rng.randint(1, 6))]
        texts.append(rng.choice([" ", "\n", " \t "]).join(parts))
    copy = texts[7]
    for k in range(12):  # near copies that differ in one word each
        w = copy.split()
        w[rng.randrange(len(w))] = f"new{k}"
        texts.append(" ".join(w))
    texts += [texts[3], texts[3], texts[20].replace(" ", "\n"), say(500, 2), say(800, 2), "a " * 90, "a " * 120, "a b " * 70, "x", "", None]
    rows = [(k * 3 % 101 + 1000 * (k > 100), t) for k, t in enumerate(texts)]
    return [*rows, (None, texts[5]), (None, texts[5]), rows[0], rows[9], rows[9]]


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert got(spark, rows) == want
    assert sum(r[2] > 0 for r in want) > 40 and any(0 < r[2] < r[1] for r in want)


def edges_of(rows):
    """{(doc, place): (minimizer, edge)} of all windows, as tasks see them."""
    batch = pa.RecordBatch.from_arrays([pa.array(range(len(rows)), pa.int64()), pa.array(range(len(rows)), pa.int64()), pa.array([t for _, t in rows], pa.string())], names=["id", "h", "text"])
    out = {}
    for p in debruijn._blocks(iter([batch]), 20, 8):
        piece, further = p.edges(np.arange(len(p.lo)))
        places = zip(p.id[piece].tolist(), (p.at[piece] + further).tolist(), strict=True)
        values = zip(p.minimizer[piece].tolist(), p.hashes(p.lo[piece] + further, 20).tolist(), strict=True)
        for k, v in zip(places, values, strict=True):
            assert k not in out
            out[k] = v
    return out


def test_small_blocks_have_the_same_edges(rows, monkeypatch):
    whole = edges_of(rows)
    words = {k: WORD.findall(t or "") for k, (_, t) in enumerate(rows)}
    assert set(whole) == {(k, i) for k, w in words.items() for i in range(len(w) - 19)}
    by_words = {}
    for (k, i), v in whole.items():
        by_words.setdefault(tuple(words[k][i : i + 20]), set()).add(v)
    assert all(len(v) == 1 for v in by_words.values()) and len({e for v in by_words.values() for e in v}) == len(by_words)
    monkeypatch.setattr(debruijn, "WORDS", 64)
    monkeypatch.setattr(debruijn, "BYTES", 700)
    assert edges_of(rows) == whole


def test_other_windows_and_empty_tables(spark, rows):
    assert got(spark, rows[:40], window=30) == brute(rows[:40], 30)
    assert got(spark, []) == []
    assert got(spark, [(1, None), (2, " "), (3, "a b")]) == brute([(1, None), (2, " "), (3, "a b")])


def test_one_id_for_all_takes_each_window_once(spark):
    """Rows of one id are ordered by their texts' hashes: whichever is first, a passage stays once."""
    rng = random.Random(5)
    passage = " ".join(f"p{k}" for k in range(50))
    rows = [(None, " ".join([*(f"u{rng.random()}" for _ in range(5)), passage])) for _ in range(9)]
    found = got(spark, rows)
    assert sorted(r[2] for r in found) == [0] + [50] * 8


def test_texts_without_repeats(spark, rows):
    out = debruijn.dedup_windows(frame(spark, rows))
    assert out.columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")
    sha = lambda t: hashlib.sha256(" ".join(WORD.findall(t or "")).encode()).hexdigest()
    assert sorted(((r["doc_id"], sha(r["text"])) for r in out.collect()), key=repr) == sorted(((r[0], r[3]) for r in brute(rows)), key=repr)
    assert out.where("text is null").count() == 1 and out.where("n_words = 'clash'").count() == len(rows)


def test_compaction_walks_chains_of_any_length(spark):
    rng = random.Random(3)
    nodes = rng.sample(range(1, 10**6), 700)
    chains = [nodes[:500], nodes[500:503], nodes[503:504], nodes[504:700]]
    rows = []
    for chain in chains:
        for k, c in enumerate(chain):
            rows.append((c, c % 7 + 1, chain[k + 1] if k + 1 < len(chain) else 0, chain[k - 1] if k else 0))
    rows.append((10**7, 1, chains[0][3], 0))  # goes on to a piece that comes from elsewhere
    found = {r["c"]: r["steps"] for r in debruijn.compacted(spark.createDataFrame(rows, "c long, n int, next long, prev long")).collect()}
    assert found == {**{chain[0]: sum(c % 7 + 1 for c in chain) for chain in chains}, 10**7: 1}


def test_words_and_parts_of_texts():
    rng = random.Random(1)
    texts = [bytes(rng.choice(b"ab \n\t") for _ in range(300)) for _ in range(50)] + [b"a" * 500 + b" b", b"a" * 500, b"", b" " * 300]
    for t in texts:
        assert sum((p.split() for p in debruijn.slices(t, 50)), []) == t.split()
        starts, hashes = debruijn.word_hashes(t)
        assert len(set(hashes.tolist())) == len(set(t.split())) and [t[s:].split()[0] for s in starts] == t.split()


def test_a_word_longer_than_the_tables_has_one_hash(monkeypatch):
    word = bytes(np.random.default_rng(1).integers(97, 123, 5000, dtype=np.uint8))
    whole = debruijn.word_hashes(word)[1]
    monkeypatch.setattr(debruijn, "BYTES", 600)
    assert debruijn.word_hashes(b"\n" + word)[1] == whole


def test_query_equals_its_sql(spark, sf_dir):
    con = duckdb.connect()
    con.execute(f"create view documents as select * from '{sf_dir}/documents.parquet'")
    df = debruijn.op13_debruijn(spark, sf_dir)
    want = con.execute(f"select {', '.join(df.columns)} from ({debruijn.SQL['op13_debruijn']}) x").fetchall()
    assert sorted(map(tuple, df.collect())) == sorted(want)
