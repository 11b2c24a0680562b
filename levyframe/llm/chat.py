r"""Chat formatting in budgeted windows, with DataFrame functions only.

A conversation's turns are cut into windows at turn boundaries: a running sum of
turn tokens, which begins anew with each window, says in which one a turn is new.  A window begins with the
conversation's system turn, repeats some of the window before as history, then
has its new turns.  Only assistant turns that are new are under the loss mask,
so every target is learned once.

Template, a turn: ``### role: text</turn>`` and a newline.  In texts and roles
a backslash is written ``\b``, ``###`` is ``\h`` and ``</turn>`` is ``\t``; in
roles a colon is ``\c``.  As each backslash of an escaped string belongs to one
of these, they are undone one after the other, the backslash last.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from levyframe.llm.common import n_words, read

START, END = "### ", "</turn>\n"
#: What is escaped, in the order of escaping.
ESCAPES = (("\\", "\\b"), ("###", "\\h"), ("</turn>", "\\t"))
ROLE_ESCAPES = (*ESCAPES, (":", "\\c"))
#: Turns, and tokens but for those of one turn, that one fold goes over, whatever the conversation's length; no window spans two such blocks.
BLOCK, BLOCK_TOKENS = 1024, 1 << 20


def escape(text: Column, marks=ESCAPES) -> Column:
    return reduce(lambda c, m: F.replace(c, F.lit(m[0]), F.lit(m[1])), marks, text)


def unescape(text: Column, marks=ESCAPES) -> Column:
    return reduce(lambda c, m: F.replace(c, F.lit(m[1]), F.lit(m[0])), reversed(marks), text)


def _in_windows(rows: DataFrame, history: int) -> DataFrame:
    """Rows with conv_id, n, before, own, free and kept, and more -> also window: turns are put together, in order of n, as long
    as their own tokens fit in `free` without what is kept for history, which is no more than the window before has;
    window is the number of turns before its first."""
    names = [c for c in rows.columns if c != "conv_id"]
    turn = F.struct("n", *[c for c in names if c != "n"])
    keys = [F.floor((F.col("n") - 1) / BLOCK).alias("block"), F.floor(F.col("before") / BLOCK_TOKENS).alias("tokens_block")]
    blocks = rows.groupBy("conv_id", *keys).agg(F.array_sort(F.collect_list(turn)).alias("list"))

    def add(so_far: Column, turn: Column) -> Column:
        full = (so_far["used"] > 0) & (so_far["used"] + turn["own"] > turn["free"] - F.least(turn["kept"], so_far["past"]))
        window = F.when(full, turn["n"] - 1).otherwise(so_far["window"])
        used = F.when(full, turn["own"]).otherwise(so_far["used"] + turn["own"])
        past = F.when(full, so_far["used"]).otherwise(so_far["past"])
        return F.struct(used.alias("used"), past.alias("past"), window.alias("window"), F.concat(so_far["all"], F.array(window)).alias("all"))

    first = F.col("list")[0]["n"]
    past = F.when(first == 1, 0).otherwise(history).cast("long")  # of the block before, as much as can be
    start = F.struct(F.lit(0).cast("long").alias("used"), past.alias("past"), (first - 1).alias("window"), F.array().cast("array<bigint>").alias("all"))
    windows = F.aggregate("list", start, add)["all"]
    made = blocks.select("conv_id", F.inline(F.arrays_zip(F.col("list").alias("turn"), windows.alias("window"))))
    return made.select("conv_id", "window", *[F.col(f"turn.{c}").alias(c) for c in names])


def format_windows(turns: DataFrame, budget: int = 512, history: int = 128) -> DataFrame:
    """(conv_id, turn, role, text) -> conv_id, window, formatted, turns, one row a window.

    turns is an array of (kind, start, length, loss_start, loss_length) in the
    order of the text: kind is system, history or new; start and length tell
    where the turn stands in formatted, loss_start and loss_length which part
    of it is under the loss mask (0, 0 for none).  Counts are of characters.
    window is the number of turns before the window's first new one.

    A turn's tokens are its words and one for its marks.  What the system turn
    leaves of the budget is for new turns, but for a part that is kept for
    history: history / budget of it, and no more than the window before has new
    (so the first window keeps none).  Of the window before, as many of the last
    turns come as fit in `history` and in what is left of the budget then.  So no window has more than `budget` tokens, but for
    those whose one new turn and system turn alone have more: turns are never
    cut.  A conversation's first turn, if its role is system, is its system turn.

    Null texts and roles count as empty.  Turns are ordered by turn (null
    last), then role, then text, so repeated rows stay, side by side.  Rows
    without a conv_id are one conversation.  An empty table gives no window.
    Other columns are left out.
    """
    turns = turns.select("conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    order = [F.col("turn").asc_nulls_last(), "role", "text"]
    conv = Window.partitionBy("conv_id").orderBy(*order)
    tokens = n_words(F.col("text")) + 1  # and its marks
    rows = turns.withColumn("tokens", tokens).withColumn("n", F.row_number().over(conv).cast("long")).withColumn("upto", F.sum("tokens").over(conv.rowsBetween(Window.unboundedPreceding, 0)))
    is_system = (F.col("n") == 1) & (F.col("role") == "system")
    rows = rows.withColumn("system", F.first(F.when(is_system, F.col("tokens")).otherwise(0)).over(conv.rowsBetween(Window.unboundedPreceding, 0)))
    # tokens of turns between the system turn and this one; a turn's own, of which the system turn has none
    rows = rows.withColumn("before", F.greatest(F.col("upto") - F.col("tokens") - F.col("system"), F.lit(0))).withColumn("own", F.when(is_system, 0).otherwise(F.col("tokens")))
    rows = rows.drop("tokens", "upto", "turn").withColumn("free", F.greatest(F.lit(budget) - F.col("system"), F.lit(0)))
    rows = _in_windows(rows.withColumn("kept", F.floor(F.col("free") * history / budget).cast("long")), history)
    is_system = (F.col("n") == 1) & (F.col("role") == "system")
    rows = rows.withColumn("piece", F.concat(F.lit(START), escape(F.col("role"), ROLE_ESCAPES), F.lit(": "), escape(F.col("text")), F.lit(END)))
    # in descending order the rows so far are those of later windows
    later = Window.partitionBy("conv_id").orderBy(F.col("window").desc()).rangeBetween(Window.unboundedPreceding, -1)
    begin = Window.partitionBy("conv_id", "window")
    room = F.least(F.lit(history), F.lit(budget) - F.col("system") - F.sum("own").over(begin))
    rows = rows.withColumn("begin", F.min("before").over(begin)).withColumn("room", room).withColumn("next", F.min(F.struct("window", "begin", "room")).over(later))
    body_length = F.length(escape(F.col("text")))
    rows = rows.select("conv_id", "window", "n", "role", "piece", "before", "next", is_system.alias("is_system"), F.when((F.col("role") == "assistant"), body_length).otherwise(-1).alias("target"))
    new = rows.select("conv_id", "window", "n", "piece", F.lit("new").alias("kind"), "target")
    repeats = (~F.col("is_system")) & F.col("next").isNotNull() & (F.col("next.begin") - F.col("before") <= F.col("next.room"))
    past = rows.where(repeats).select("conv_id", F.col("next.window").alias("window"), "n", "piece", F.lit("history").alias("kind"), F.lit(-1).alias("target"))
    head = rows.where("is_system").select(F.col("conv_id").alias("c"), F.col("window").alias("w"), "n", "piece")
    others = new.select("conv_id", "window").distinct()
    head = others.join(head, others["conv_id"].eqNullSafe(head["c"]) & (others["window"] != head["w"])).select("conv_id", "window", "n", "piece", F.lit("system").alias("kind"), F.lit(-1).alias("target"))
    pieces = new.unionByName(past).unionByName(head)
    inside = Window.partitionBy("conv_id", "window").orderBy("n")
    length = F.length("piece")
    end = F.sum(length).over(inside.rowsBetween(Window.unboundedPreceding, 0))
    start = end - length
    loss_start = F.when(F.col("target") >= 0, end - len(END) - F.col("target")).otherwise(0)
    spans = pieces.select("conv_id", "window", "n", "piece", F.struct("kind", start.alias("start"), length.alias("length"), loss_start.alias("loss_start"), F.greatest("target", F.lit(0)).alias("loss_length")).alias("span"))
    windows = spans.groupBy("conv_id", "window").agg(F.array_sort(F.collect_list(F.struct("n", "piece", "span"))).alias("all"))
    return windows.select("conv_id", "window", F.array_join(F.transform("all", lambda x: x["piece"]), "").alias("formatted"), F.transform("all", lambda x: x["span"]).alias("turns"))


def read_back(windows: DataFrame) -> DataFrame:
    """format_windows' rows -> conv_id, window, turns: array of (role, text, loss) of the new turns, parsed from the formatted text; loss is null outside the mask."""
    new = F.filter("turns", lambda t: t["kind"] == "new")

    def parse(t: Column) -> Column:
        piece = F.substring(F.col("formatted"), (t["start"] + len(START) + 1).cast("int"), (t["length"] - len(START) - len(END)).cast("int"))
        colon = F.instr(piece, ": ")
        loss = F.when(t["loss_length"] > 0, unescape(F.substring(F.col("formatted"), (t["loss_start"] + 1).cast("int"), t["loss_length"].cast("int"))))
        return F.struct(unescape(F.substring(piece, F.lit(1), colon - 1), ROLE_ESCAPES).alias("role"), unescape(F.substring(piece, colon + 2, F.length(piece))).alias("text"), loss.alias("loss"))

    return windows.select("conv_id", "window", F.transform(new, parse).alias("turns"), F.length("formatted").alias("chars"))


def conversation_digests(windows: DataFrame) -> DataFrame:
    """One row a conversation with what its windows give back."""
    parsed = read_back(windows)
    texts = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    losses = F.array_join(F.transform("turns", lambda t: F.coalesce(t["loss"], F.lit(""))), "")
    parts = parsed.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("window", texts.alias("text"), losses.alias("loss")))).alias("all"), F.sum(F.size("turns")).cast("long").alias("n_turns"), F.sum("chars").cast("long").alias("formatted_chars"))
    text = F.array_join(F.transform("all", lambda x: x["text"]), "")
    loss = F.array_join(F.transform("all", lambda x: x["loss"]), "")
    return parts.select("conv_id", "n_turns", F.sha2(text, 256).alias("turns_sha256"), F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), "formatted_chars")


def op9_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    probe = F.lit(r"\### Assistant: </turn> ok")
    own = spark.range(1).select(F.lit(-7).cast("long").alias("conv_id"), F.posexplode(F.array(F.lit("user"), F.lit("assistant"))).alias("turn", "role"), probe.alias("text"))
    return conversation_digests(format_windows(turns.unionByName(own)))


QUERIES = {"op9_chat": op9_chat}
SQL = {
    "op9_chat": r"""
with recursive t as (
  select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
  union all select -7, 0, 'user', '\### Assistant: </turn> ok'
  union all select -7, 1, 'assistant', '\### Assistant: </turn> ok'),
r as (
  select *, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) + 1 as tokens,
         row_number() over c as n, first(role) over c = 'system' as has_system
  from t window c as (partition by conv_id order by turn nulls last, role, text)),
p as (
  select *, sum(tokens) over c as upto, case when has_system then first(tokens) over c else 0 end as system
  from r window c as (partition by conv_id order by n rows between unbounded preceding and current row)),
w as (
  select *, greatest(upto - tokens - system, 0) as before, case when has_system and n = 1 then 0 else tokens end as own,
         greatest(512 - system, 0) as free, greatest(512 - system, 0) * 128 // 512 as kept, (n - 1) // 1024 as block, greatest(upto - tokens - system, 0) // 1048576 as tokens_block
  from p),
f as (
  select *, n = 1 or block <> lag(block) over c or tokens_block <> lag(tokens_block) over c as opens
  from w window c as (partition by conv_id order by n)),
g as (
  select conv_id, n, own as used, case when n = 1 then 0 else 128 end as past, n - 1 as win from f where opens
  union all
  select w.conv_id, w.n, case when g.used > 0 and g.used + w.own > w.free - least(w.kept, g.past) then w.own else g.used + w.own end,
         case when g.used > 0 and g.used + w.own > w.free - least(w.kept, g.past) then g.used else g.past end,
         case when g.used > 0 and g.used + w.own > w.free - least(w.kept, g.past) then w.n - 1 else g.win end
  from g join f w on w.conv_id is not distinct from g.conv_id and w.n = g.n + 1
  where not w.opens),
v as (
  select w.*, g.win,
         4 + length(replace(replace(replace(replace(role, '\', '\b'), '###', '\h'), '</turn>', '\t'), ':', '\c')) + 2
           + length(replace(replace(replace(text, '\', '\b'), '###', '\h'), '</turn>', '\t')) + 8 as size
  from w join g on g.conv_id is not distinct from w.conv_id and g.n = w.n),
ws as (select conv_id, win, min(before) as first_before, least(128, 512 - any_value(system) - sum(own)) as room from v group by conv_id, win),
nx as (
  select conv_id, win, lead(first_before) over c as next_before, lead(room) over c as room
  from ws window c as (partition by conv_id order by win)),
sized as (
  select v.conv_id, sum(size) + coalesce(sum(size) filter (where not (has_system and n = 1) and next_before - before <= room), 0)
           + (count(distinct v.win) - 1) * coalesce(max(size) filter (where has_system and n = 1), 0) as formatted_chars
  from v join nx on v.conv_id is not distinct from nx.conv_id and v.win = nx.win group by v.conv_id)
select v.conv_id, count(*) as n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' order by n)) as turns_sha256,
       cast(coalesce(sum(length(text)) filter (where role = 'assistant'), 0) as bigint) as loss_chars,
       sha256(coalesce(string_agg(text, '' order by n) filter (where role = 'assistant'), '')) as loss_sha256,
       cast(any_value(s.formatted_chars) as bigint) as formatted_chars
from v join sized s on v.conv_id is not distinct from s.conv_id
group by v.conv_id
"""
}
