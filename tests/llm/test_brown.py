import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from levyframe.llm import brown
from levyframe.llm.brown import exchange_classes, fit_brown, most_frequent, score_documents
from tests.llm.brute import WORD


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 7 == 2


def check(spark, docs):
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    counts, n_texts = Counter(), 0
    for i, t in rows:
        if not is_held_out(i):
            counts.update(words_of(t))
            n_texts += 1
    n, v = sum(counts.values()) + n_texts, len(counts) + (n_texts > 0)
    want = []
    for i, t in rows:
        known = [counts[w] for w in words_of(t)] + [n_texts]
        want.append((repr(i), is_held_out(i), len(known), sum(c > 0 for c in known), n, sum(math.log10((c + 1) / (n + v + 1)) for c in known)))
    got = score_documents(docs).collect()
    key = lambda r: (r[0], r[2], r[3], round(r[5], 6))
    mine = sorted(((repr(r.doc_id), r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in got), key=key)
    for a, b in zip(mine, sorted(want, key=key), strict=True):
        assert a[:5] == b[:5]
        assert math.isclose(a[5], b[5], rel_tol=1e-9)
    assert all(math.isfinite(r.score) and r.score < 0 for r in got)
    return got


@pytest.mark.parametrize(("bound", "ratio"), [((150_000, 480), 0.9), ((40, 10), 1.0)])  # with next to no units, classes need only not hurt
def test_base_matches_brute_force_and_classes_help(spark, sf_dir, monkeypatch, bound, ratio):
    monkeypatch.setattr(brown, "WORDS", bound[0])
    monkeypatch.setattr(brown, "UNITS", bound[1])
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    docs = docs.unionByName(spark.createDataFrame([(None, "the THE Été"), (7000, None), (7001, ""), (7001, ""), (7002, "unheardofword " * 3000)], "doc_id long, text string")).withColumn("key", F.lit(1)).withColumn("word", F.lit("x"))
    got = [r for r in check(spark, docs) if r.held_out]
    tokens = sum(r.n_tokens for r in got)
    # perplexity of the texts that nothing was learned from
    assert 10 ** (-sum(r.score for r in got) / tokens) < ratio * 10 ** (-sum(r.base_score for r in got) / tokens)


def digest(word):
    h = xxhash.xxh64_intdigest(word.encode(), 42)
    return h - (1 << 64) if h >> 63 else h


def form_class(model, word):
    return int(model.lexicon.form_cls[model.lexicon.units.form_of(pa.array([word.encode()]))[0]])


def by_hand(train, model, words):
    """text -> log10 probability, from the words' classes alone: transitions, sizes and counts are counted here."""
    own, end = {r.h: r.cls for r in words.collect()}, model.lexicon.end_cls
    cls = lambda w: own.get(digest(w), form_class(model, w))
    chain = lambda t: [end, *map(cls, words_of(t)), end]
    moves, counts = Counter(), Counter()
    for t in train:
        counts.update(words_of(t))
        moves.update(zip(chain(t), chain(t)[1:], strict=False))
    k, n = end + 1, sum(counts.values()) + len(train)
    sizes = [0.0] * k
    for w, c in counts.items():
        sizes[cls(w)] += c + 0.5
    sizes[end] += len(train)
    units = model.lexicon.units
    for u in range(len(units.top), units.end + 1):
        sizes[model.lexicon.form_cls[u]] += 0.5
    left = Counter()
    for (a, _), c in moves.items():
        left[a] += c

    def score(text):
        total, last = 0.0, end
        for w in [*words_of(text), None]:
            c, count = (end, len(train)) if w is None else (cls(w), counts[w])
            move = (moves[last, c] + brown.ALPHA) / (left[last] + k * brown.ALPHA)
            total += math.log10(brown.WEIGHT * move * (count + 0.5) / sizes[c] + (1 - brown.WEIGHT) * (count + 1) / (n + len(counts) + (len(train) > 0) + 1))
            last = c
        return total

    return score


@pytest.mark.parametrize("most", [150_000, 60])  # all words known to all tasks, or most of them joined
def test_scores_are_those_by_hand(spark, monkeypatch, most):
    monkeypatch.setattr(brown, "WORDS", most)
    monkeypatch.setattr(brown, "UNITS", 12)
    monkeypatch.setattr(brown, "DENSE", 20)
    monkeypatch.setattr(brown, "SLICE", 300)
    rng = random.Random(9)
    word = lambda: rng.choice("the a of to The cat dog".split()) if rng.random() < 0.5 else f"{rng.choice('bdé')}{rng.randrange(60)}{rng.choice(['ing', 'ed'])}"
    texts = [" ".join(word() for _ in range(rng.randrange(30))) for _ in range(150)] + [None, "", " \n ", "the THE \x1c\x85 the"]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    train = [t for i, t in enumerate(texts) if not is_held_out(i)]
    model, words = fit_brown(spark.createDataFrame([(t,) for t in train], "text string"))
    assert words.where("rare").count() > 50 or most > 60
    score = by_hand(train, model, words)
    got = {r.doc_id: r.score for r in check(spark, docs)}
    for i, t in enumerate(texts):
        assert math.isclose(got[i], score(t), rel_tol=1e-9)


def test_probabilities_sum_to_one(spark):
    texts = ["a b a c a b. the cat", "a c the dog; the cat", "", "zeta zeros aero"]
    model, words = fit_brown(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows, units, k = words.collect(), model.lexicon.units, len(model.move)
    assert {(r.h, r.n) for r in rows} == {(digest(w), n) for w, n in Counter(" ".join(texts).split()).items()}
    for before in range(k):
        total = sum(model.move[before, r.cls] * (r.n + 0.5) / model.sizes[r.cls] for r in rows)
        end = model.lexicon.end_cls
        total += model.move[before, end] * (len(texts) + 0.5) / model.sizes[end]
        # each form leaves room for words that were never seen
        room = sum(model.move[before, model.lexicon.form_cls[u]] * 0.5 / model.sizes[model.lexicon.form_cls[u]] for u in range(len(units.top), units.end))
        assert math.isclose(total + room, 1.0, rel_tol=1e-9)
    base_of = lambda c: (c + 1) / (model.train_tokens + model.train_words + 1)
    assert math.isclose(sum(base_of(r.n) for r in rows) + base_of(len(texts)) + base_of(0), 1.0)


def test_tokens_are_runs_of_anything_but_ascii_white_space(monkeypatch):
    texts = ["A b\x1cB\u00a0c  É\t\n", None, "", " ", "x" * 500 + " Y", "\x0b\x0cz\r"]
    for size in (1, 10, 1 << 20):
        monkeypatch.setattr(brown, "SLICE", size)
        made = list(brown.slices(pa.array(texts)))
        assert [s.words[i].decode() for s in made for i in s.tokens] == [w for t in texts for w in words_of(t)]
        assert [n for s in made for n in s.lengths] == [len(words_of(t)) for t in texts]


def test_forms_are_first_and_last_bytes():
    words = [b"a", b"ab", b"abc", b"a~c", b"xyzc", b"b", b"aab", "é".encode(), "éa".encode()]
    form = lambda w: w[:1] + b"~" + w[-2:]
    forms = sorted({form(w) for w in words[:-2]})
    units = brown.Units([b"t"], forms)
    want = [1 + forms.index(form(w)) if form(w) in forms else units.other for w in words]
    assert units.form_of(pa.array(words)).tolist() == want
    assert len(set(brown.form_codes(pa.array(words)).tolist())) == len({form(w) for w in words})


def test_exchange_finds_planted_classes():
    rng = random.Random(5)
    chain = [0]
    for _ in range(20000):
        chain.append(1 + (chain[-1] % 3 + 1) % 3 + 3 * rng.randrange(5))
    pairs = np.zeros((17, 17))
    for a, b in zip(chain, chain[1:]):
        pairs[a, b] += 1
    got = exchange_classes(pairs, 3, 0)
    assert got[0] == 3
    assert len({(got[u], u % 3) for u in range(1, 16)}) == 3


def test_every_word_gets_the_class_of_its_contexts(spark, monkeypatch):
    # rare words of one form come in two contexts, those of cat and of run; neither the units nor the table of frequent words have them
    monkeypatch.setattr(brown, "WORDS", 40)
    monkeypatch.setattr(brown, "UNITS", 6)
    monkeypatch.setattr(brown, "CLASSES", 7)
    rng = random.Random(7)
    a, b = [f"xa{i:03d}zz" for i in range(150)], [f"xb{i:03d}zz" for i in range(150)]
    one = lambda words, frequent: frequent if rng.random() < 0.4 else rng.choice(words)
    texts = [" ".join(f"the {one(a, 'cat')} sees" if rng.random() < 0.5 else f"to {one(b, 'run')} now" for _ in range(4)) for _ in range(1500)]
    model, words = fit_brown(spark.createDataFrame([(t,) for t in texts], "text string"))
    rows = {r.h: r for r in words.collect()}
    counts = Counter(w for t in texts for w in t.split())
    of = {w: rows[digest(w)] for w in counts}
    assert {w: r.n for w, r in of.items()} == counts
    assert sum(r.rare for r in of.values()) > 200
    x, y = of["cat"].cls, of["run"].cls
    assert x != y
    # a word of very few occurrences may stay with its form
    assert all(of[w].cls == x for w in a if w in of and of[w].n > 5)
    assert all(of[w].cls == y for w in b if w in of and of[w].n > 5)
    # transitions and sizes are of these classes
    assert model.move[of["the"].cls, x] > 0.5 > 0.1 > model.move[of["the"].cls, y]
    assert math.isclose(model.sizes.sum(), sum(counts.values()) + 0.5 * len(counts) + len(texts) + 0.5 + 0.5 * (len(model.lexicon.units.forms) + 1))


def test_most_frequent_is_bounded(spark):
    counts = spark.createDataFrame([(i, 1 + i // 10) for i in range(1000)], "word long, n long")
    for most in (0, 5, 100, 1000):
        got = counts.where(most_frequent(counts, most)).collect()
        assert len(got) <= most
        assert not got or min(r.n for r in got) > max([r.n for r in counts.collect() if r.word not in {g.word for g in got}], default=0)


def test_empty_table_and_no_training_documents(spark):
    assert score_documents(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    only = next(i for i in range(100) if is_held_out(i))
    check(spark, spark.createDataFrame([(only, "nothing was learned")], "doc_id long, text string"))
