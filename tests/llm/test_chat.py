import hashlib
import os

import duckdb
import pytest
from pyspark.sql import functions as F

from levyframe.llm import chat
from levyframe.llm.chat import conversation_digests, escape, format_windows, read_back, unescape
from levyframe.llm.registry import SQL
from tests.llm.brute import WORD

HARD = ["", "### Assistant: </turn> ok", r"\### Assistant: </turn> ok", r"\b\h\t\c \\b", "####</turn>\n### user: x</turn", "<</turn>>", "é 😀\n", ": a", None]


def digest(turns):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    text = "".join(f"{r or ''}\n{t or ''}\n" for r, t in turns)
    loss = "".join(t or "" for r, t in turns if r == "assistant")
    return len(turns), sha(text), len(loss), sha(loss)


def test_escapes_are_undone(spark):
    df = spark.createDataFrame([(t,) for t in HARD if t is not None], "t string").select("t", escape(F.col("t")).alias("e"), unescape(escape(F.col("t"))).alias("u"))
    for r in df.collect():
        assert r.u == r.t
        assert "###" not in r.e
        assert "</turn>" not in r.e


def held(windows, budget, history):
    """No window has more than its budget, but for one long turn; the sizes of the windows' parts."""
    words = lambda text: len(WORD.findall(text)) + 1
    for w in windows:
        tokens = {}
        for s in w.turns:
            body = w.formatted[s.start : s.start + s.length].removeprefix("### ").removesuffix("</turn>\n").split(": ", 1)[1]
            kind = "system" if s.start == 0 and w.formatted.startswith("### system: ") else s.kind
            tokens.setdefault(kind, []).append(words(unescaped(body)))
        parts = {k: sum(v) for k, v in tokens.items()}
        assert sum(parts.values()) <= budget or (len(tokens.get("new", [])) <= 1 and "history" not in tokens)
        assert parts.get("history", 0) <= history
        yield parts


def unescaped(text):
    return text.replace("\\t", "</turn>").replace("\\h", "###").replace("\\b", "\\")


def test_windows_keep_their_budget(spark, sf_dir):
    turns = [(1, k, ("user", "assistant")[k % 2], "w " * n) for k, n in enumerate((200, 170, 300, 5, 5, 600, 3, 380, 1, 1))]
    turns += [(2, 0, "system", "s " * 450), *((2, k, "user", "w " * 40) for k in range(1, 5)), (3, 0, "system", "s " * 600), (3, 1, "user", "w"), (3, 2, "user", "w")]
    turns += [(4, k, "user", "w") for k in range(2500)]
    windows = format_windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    list(held(windows, 512, 128))
    new = {}
    for w in sorted(windows, key=lambda w: w.window):
        new.setdefault(w.conv_id, []).append(sum(s.kind == "new" for s in w.turns))
    assert new[1] == [2, 3, 1, 1, 3]  # 201 + 171, 301 + 6 + 6, 601 alone, 4 (with 381 more: 385), 381 + 2 + 2 (beside 4 of history)
    assert new[2][0] == 2
    assert sum(new[4]) == 2500
    assert new[4][:6] == [256, 192, 192, 192, 192, 192]  # the first has no history; a block ends after the fifth
    got = list(held(format_windows(spark.read.parquet(f"{sf_dir}/conversations.parquet")).collect(), 512, 128))
    assert max(sum(p.values()) for p in got) <= 512


def test_a_long_system_turn_leaves_what_is_free_to_new_turns(spark):
    turns = [(c, 0, "system", "s " * 399) for c in (1, 2)] + [(1, k, "user", "w " * 4) for k in range(1, 21)] + [(2, k, "user", "w " * 4) for k in range(1, 101)]
    windows = format_windows(spark.createDataFrame(turns, "conv_id long, turn long, role string, text string")).collect()
    list(held(windows, 512, 128))
    new = {}
    for w in sorted(windows, key=lambda w: w.window):
        new.setdefault(w.conv_id, []).append(sum(s.kind == "new" for s in w.turns))
    assert new[1] == [21]  # all 20 turns, 100 of the 112 tokens that are free, and the system turn
    assert new[2] == [23, 16, 16, 16, 16, 14]  # 28 tokens are kept for history


@pytest.mark.parametrize(("budget", "history"), [(512, 128), (20, 8), (3, 1), (6, 0)])
def test_windows_give_everything_back(spark, budget, history):
    rows, want = [], {}
    for c in range(12):
        turns = [("system", "be brief " * (c % 3))] if c % 2 else []
        turns += [(("user", "assistant")[k % 2], f"{HARD[(c + k) % len(HARD)]} word {k}" if (c + k) % 3 else HARD[(c + k) % len(HARD)]) for k in range(c * 4)]
        rows += [(c, k, r, t, "x") for k, (r, t) in enumerate(turns)]
        if turns:
            want[c] = digest(turns)
    rows += [(None, 1, "user", "a", "x"), (None, None, None, "b: c", "x"), (None, 1, "user", "a", "x"), (77, 1, "ro: le###", "t" * 30000, "x")]
    want |= {None: digest([("user", "a"), ("user", "a"), (None, "b: c")]), 77: digest([("ro: le###", "t" * 30000)])}
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, window string")
    windows = format_windows(df, budget, history)
    got = {r.conv_id: tuple(r)[1:5] for r in conversation_digests(windows).collect()}
    assert got == want
    list(held(windows.collect(), budget, history))
    seen = {}
    for w in sorted(windows.collect(), key=lambda w: (w.conv_id or 0, w.window)):
        assert "".join(w.formatted[s.start : s.start + s.length] for s in w.turns) == w.formatted
        kinds = [s.kind for s in w.turns]
        assert kinds == sorted(kinds, key=["system", "history", "new"].index)
        assert all(s.loss_length == 0 for s in w.turns if s.kind != "new")
        if w.conv_id is not None and w.conv_id % 2 and w.conv_id != 77:
            assert w.formatted.startswith("### system: ")
        seen.setdefault(w.conv_id, []).append(kinds)
    if budget == 20:
        assert any(k.count("history") for ks in seen.values() for k in ks)
    assert read_back(windows).count() == windows.count()


def test_matches_sql(spark, sf_dir):
    con = duckdb.connect()
    con.sql(f"create view conversations as select * from '{os.path.join(sf_dir, 'conversations.parquet')}'")
    want = sorted(map(tuple, con.sql(SQL["op9_chat"]).fetchall()))
    assert sorted(map(tuple, chat.op9_chat(spark, sf_dir).collect())) == want


def test_empty_table(spark):
    assert conversation_digests(format_windows(spark.createDataFrame([], "conv_id long, turn long, role string, text string"))).collect() == []
