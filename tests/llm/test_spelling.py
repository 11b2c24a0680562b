"""Spelling variants against brute force over all pairs of words."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from levyframe.llm import spelling

SCHEMA = "doc_id long, text string, word string"


def brute(rows, least_n=2, factor=10):
    counts = Counter()
    for doc, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    n = {w: c for w, c in counts.items() if c >= least_n}

    def near(a, b):
        if len(a) > len(b):
            a, b = b, a
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b, strict=True)) == 1
        return len(b) == len(a) + 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))

    out, form = {}, {}
    for w in n:
        others = [v for v in n if near(w, v)]
        best = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = best if best is not None and n[best] >= factor * n[w] else None
        out[w] = (n[w], len(others), form[w], n.get(form[w]))
    root = lambda w: w if form[w] is None else root(form[w])
    return {(w, *v, root(w)) for w, v in out.items()}


def got(spark, rows, **how):
    docs = spark.createDataFrame([(d, t, "clash") for d, t in rows], SCHEMA)
    found = spelling.spelling_variants(docs, **how).select("word", "n", "n_near", "form", "form_n", "root").collect()
    assert len({r["word"] for r in found}) == len(found)
    return {tuple(r) for r in found}


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    stems = ["".join(rng.choice("abcdéÿ") for _ in range(rng.randint(7, 10))) for _ in range(12)]
    rows = []
    for k in range(120):
        words = []
        for _ in range(60):
            w = list(stems[min(int(rng.expovariate(0.5)), len(stems) - 1)])
            for _ in range(rng.choice([0] * 12 + [1, 1, 2])):
                i = rng.randrange(len(w))
                w[i : i + rng.randint(0, 1)] = rng.choice(["", "a", "é", "aa", "B"])
            words.append("".join(w))
        rows.append((k if k % 9 else None, " ".join(words)))
    return [*rows, *rows[:5], (500, None), (501, ""), (502, "short Ābc 12345678 ABCDEFGH×IJKLMNO" * 3)]


def test_equals_brute_force(spark, rows):
    want = brute(rows)
    assert got(spark, rows) == want
    assert any(r[3] for r in want) and any(r[5] != (r[3] or r[0]) for r in want)  # forms, and forms of forms


def test_a_vocabulary_larger_than_a_filter_is_cut_into_slices(spark, rows):
    assert got(spark, rows, blocks=30) == brute(rows)


def test_very_long_words_ties_and_none(spark):
    long = "ab" * 3000
    rows = [(1, f"{long} {long} {long}x {long}x")] + [(k, "abcdefgh " * 15 + "abcdefgi " * 15 + "abcdefg") for k in (2, 3)]
    assert got(spark, rows) == brute(rows)
    assert got(spark, [(1, None), (2, ""), (3, "few short words")]) == set()
    assert got(spark, []) == set()


def test_equal_letters_in_a_row_give_a_pair_once():
    letters = np.frombuffer(b"aabbbbcd", np.uint8).reshape(1, 8)
    shards = spelling.Shards({7: 1, 8: 1}, 1)
    every = np.full(shards.blocks, 2**64 - 1, np.uint64)
    words = [w for _, found in spelling.near_candidates(letters, np.frombuffer(b"abcd", np.uint8), shards, every, 0) for w in found]
    assert len(set(words)) == len(words) and "abbbbcd" in words and "aabbbcd" in words and "aabbbbdd" in words
