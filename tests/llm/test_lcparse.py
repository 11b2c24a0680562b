import hashlib
import random

import numpy as np
from pyspark.sql import functions as F

from levyframe.llm import lcparse
from levyframe.llm.lcparse import edited_fingerprints, fingerprint_documents, fingerprint_texts, likeness, parse_level, toss_coins


def text_of(seed, n):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice("abcdefghijklmnop") for _ in range(rng.randint(1, 9))) for _ in range(n))


def test_coins_keep_neighbours_unlike_and_few():
    rng = np.random.default_rng(3)
    for kind in (np.uint8, np.uint64):
        x = rng.integers(256, size=5000).astype(kind)
        x = x[np.concatenate(([True], x[1:] != x[:-1]))]
        first = np.zeros(len(x), bool)
        first[[0, 100, 101, 2000]] = True
        labels = toss_coins(x, first)
        assert labels.max() <= 5
        assert ((labels[1:] != labels[:-1]) | first[1:]).all()


def phrases(text):
    """Strings of the first level's phrases, by a plain reading of the rules."""
    runs = []
    for b in text:
        if runs and runs[-1][0] == b:
            runs[-1].append(b)
        else:
            runs.append([b])
    labels = [r[0] for r in runs]
    for _ in range(3):
        new = [labels[0] & 1]
        for a, b in zip(labels, labels[1:]):
            low = next(k for k in range(8) if (a ^ b) >> k & 1)
            new.append(2 * low + (b >> low & 1))
        labels = new
    cuts = [0] + [i for i in range(1, len(labels) - 1) if labels[i] < labels[i - 1] and labels[i] < labels[i + 1]]
    return [bytes(x for r in runs[a:b] for x in r) for a, b in zip(cuts, [*cuts[1:], len(runs)])]


def test_phrases_are_those_of_the_plain_rules():
    for seed in range(20):
        text = (text_of(seed, 40) + "aaaa  bb").encode()
        symbols = np.frombuffer(text, np.uint8)
        first = np.zeros(len(symbols), bool)
        first[0] = True
        names, _ = parse_level(symbols, lcparse._BYTE_NAMES[symbols], first)
        want = phrases(text)
        assert len(names) == len(want)
        # equal phrases, equal names; unlike phrases, unlike names
        assert len(set(zip(names.tolist(), want))) == len(set(names.tolist())) == len(set(want))


def test_equal_substrings_share_phrases_at_any_offset():
    shared = text_of(1, 400)
    a, b, c = (fingerprint_texts([t.encode()])[0] for t in (text_of(2, 31) + shared, text_of(3, 90) + "x" + shared, text_of(4, 400)))
    assert (a == b).mean() > 0.5
    assert (a == c).mean() < 0.1


def test_batches_do_not_change_fingerprints():
    texts = [text_of(i, n).encode() for i, n in enumerate((1, 2, 3, 50, 700, 0, 20))] + [b"", b"a", b"aa", b"ab", b"a" * 5000]
    together = fingerprint_texts(texts)
    for t, row in zip(texts, together, strict=True):
        assert (fingerprint_texts([t])[0] == row).all()


def test_unrelated_long_texts_are_unlike():
    def long_text(seed, n):
        return np.random.default_rng(seed).integers(97, 123, size=n, dtype=np.uint8).tobytes()

    for n in (150_000, 1_200_000, 3_000_000):
        a, b = fingerprint_texts([long_text(1, n), long_text(2, n)])
        assert (a == b).mean() < 0.05
        c = fingerprint_texts([long_text(1, n)[: n // 2] + long_text(2, n)[: n // 2]])[0]
        assert 0.1 < (a == c).mean() < 0.6


def test_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    extra = [(None, "no id"), (None, None), (5000, "é" * 30001), (5000, "é" * 30001), (4999, ""), (4998, "x")]
    docs = docs.unionByName(spark.createDataFrame(extra, "doc_id long, text string")).withColumn("h", F.lit("clash")).withColumn("tail", F.lit(1))
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is None, r.doc_id or 0))
    got = edited_fingerprints(docs).collect()
    assert len(got) == len(rows)
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, r in enumerate(rows):
        if r.doc_id is None or rows[(i + 1) % len(rows)].doc_id is None:
            continue
        text, following = r.text or "", rows[i + 1].text or ""
        edited = text[: len(text) - len(text) // 2] + following[: len(text) // 2]
        g = by_id[r.doc_id][-1 if len(by_id[r.doc_id]) == 1 else 0]
        if len(by_id[r.doc_id]) == 1:
            own, new, nxt = (x.tobytes().hex() for x in fingerprint_texts([edited.encode(), text.encode(), following.encode()]).astype(">u2"))
            own, new = new, own
            assert (g.n_chars, g.edited_sha256, g.fingerprint, g.edited_fingerprint) == (len(text), hashlib.sha256(edited.encode()).hexdigest(), own, new)
            assert g.near_edited == likeness(own, new)
            assert g.near_next == likeness(own, nxt)
    long = [r for r in got if r.n_chars > 300]
    assert sum(r.near_edited > r.near_next for r in long) > 0.9 * len(long)
    one = fingerprint_documents(docs.where("doc_id = 4998").withColumn("fingerprint", F.lit(1)))
    assert one.columns == ["doc_id", "h", "tail", "fingerprint"]
    assert one.first().fingerprint == by_id[4998][0].fingerprint


def test_single_document_follows_itself_and_empty_table(spark):
    one = edited_fingerprints(spark.createDataFrame([(3, "abcdef")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abcabc").hexdigest()
    assert one.near_next == 1.0
    assert edited_fingerprints(spark.createDataFrame([], "doc_id long, text string")).collect() == []
