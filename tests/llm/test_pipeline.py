import hashlib
import random
from collections import Counter

import corpus_pipeline
import duckdb
import pyarrow as pa
from levyframe.llm.bpe import public_tokenizer
from levyframe.llm.registry import SQL
from tests.llm import brute
from tests.llm.test_linededup import brute_force as brute_lines
from tests.llm.test_quality import brute_measures
from tokenizers import Tokenizer


def documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rng = random.Random(2)
    text = " ".join(rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(60))
    extra = [(9000, None, "en", "src1", None), (9001, "", None, None, 0), (9002, text, "en", "src2", len(text)), (9003, text + "\nmore of it here", "en", "src2", 0), (9004, "too short", "en", "src3", 9)]
    return docs.unionByName(spark.createDataFrame(extra, docs.schema))


def test_stages_match_brute_force(spark, sf_dir):
    docs = documents(spark, sf_dir)
    rows = {r.doc_id: r for r in docs.collect()}

    kept = corpus_pipeline.quality(spark, docs, sf_dir)
    assert kept.columns == docs.columns
    want = {i for i, r in rows.items() if not brute_measures(r.text)[-1]}
    got = {r.doc_id: r for r in kept.collect()}
    assert set(got) == want  # no source is rejected
    assert all(got[i] == rows[i] for i in got)

    small = kept.where("doc_id < 60 or doc_id >= 9000")
    lines = corpus_pipeline.lines(spark, small, sf_dir)
    assert lines.columns == docs.columns
    texts = brute_lines([(r.doc_id, r.text) for r in small.collect()])
    cut = {r.doc_id: r for r in lines.collect()}
    assert {i: r.text for i, r in cut.items()} == texts
    assert all(r.n_chars == len(r.text) for r in cut.values())

    near = corpus_pipeline.near(spark, lines, sf_dir)
    prints = {i: brute.simhash(r.text) for i, r in cut.items()}
    comp = brute.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    least = {}
    for i, p in prints.items():
        least[comp[p]] = min(i, least.get(comp[p], i))
    single = {r.doc_id: r for r in near.collect()}
    assert near.columns == docs.columns
    assert set(single) == set(least.values())

    mixed = corpus_pipeline.mix(spark, near, sf_dir)
    assert mixed.columns == docs.columns
    times = Counter(r.doc_id for r in mixed.collect())
    assert set(times) <= set(single)
    assert max(times.values()) <= 2

    library = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json"))
    encoded = corpus_pipeline.encode(spark, mixed, sf_dir).collect()
    assert Counter(r.doc_id for r in encoded) == times
    assert all(r.n_tokens == len(library.encode(single[r.doc_id].text, add_special_tokens=False).ids) for r in encoded)


def test_run_matches_brute_force(spark, sf_dir, tmp_path):
    """The whole run on a small table: each stage by plain Python, or by SQL, on what the one before left."""
    docs = documents(spark, sf_dir).where("doc_id < 60 or doc_id >= 9000")
    rows = {r.doc_id: r for r in docs.collect()}
    assert len(rows) == docs.count()
    docs.write.parquet(str(tmp_path / "documents.parquet"))

    def ask(sql, kept):
        con, table = duckdb.connect(), pa.table({"doc_id": pa.array(list(kept), pa.int64()), "source": pa.array([rows[i].source for i in kept], pa.string()), "text": pa.array([kept[i] for i in kept], pa.string())})
        con.register("documents", table)
        got = con.sql(sql)
        return [dict(zip(got.columns, r, strict=True)) for r in got.fetchall()]

    texts = {i: r.text for i, r in rows.items()}
    texts = {r["doc_id"]: texts[r["doc_id"]] for r in ask(SQL["op2_quality"], texts) if r["kept"]}
    texts = brute_lines(list(texts.items()))
    prints = {i: brute.simhash(t) for i, t in texts.items()}
    comp = brute.components(set(prints.values()), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for i in sorted(texts):
        first.setdefault(comp[prints[i]], i)
    texts = {i: texts[i] for i in first.values()}
    library, want = Tokenizer.from_file(public_tokenizer("word_bpe_49k.json")), Counter()
    for r in ask(SQL["op1_mix"], texts):
        encoded = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        if r["taken"]:
            want[r["doc_id"], rows[r["doc_id"]].source, len(encoded), hashlib.sha256(" ".join(map(str, encoded)).encode()).hexdigest()] += r["taken"] // r["size"]
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert got.columns == ["doc_id", "source", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert Counter((r.doc_id, r.source, r.n_tokens, r.ids_sha256) for r in got.collect()) == want
    assert 0 < len(want) < len(rows)


def test_empty_table(spark, sf_dir):
    docs = spark.createDataFrame([], documents(spark, sf_dir).schema)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, sf_dir).collect() == []
