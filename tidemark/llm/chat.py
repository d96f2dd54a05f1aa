"""Conversations as training windows: a budget, turn-aligned spans, limited history, a loss mask.

Turns are written as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Control strings inside a role or
text, of this template and of other common ones, get one backslash after their first character
and lose it again on reading, so every text comes back as it was (a role's line ends too).

Prefix sums of the turns' tokens (words and ``overhead`` a turn) choose the spans: a window takes
turns while system turn, repeated history and new turns stay within ``budget`` tokens, one new
turn at least.  Every window but the first starts with the conversation's system turn and up to
``history`` of the last turns, as far as ``history_tokens`` go.  The loss covers the text of every
assistant turn in the window where it is new; where it is history it is masked.

Conversations are cut into parts of ``part_turns`` consecutive turn numbers before any list is
built, so a list is bounded by a part, not by a conversation.  A window ends with its part; the first one of
the next part starts like any other, with the system turn and history from the part before (of that
part alone).  DataFrame functions only.

Defined cases: a null text or role is empty; turns are ordered by number, role and text, nulls
first; repeated rows are turns each; a null ``conv_id`` is a conversation; an empty table gives
no window.  A turn longer than the budget is a window of its own, whole.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import BROADCAST_ROWS, WORD, join_null_safe, stage

# What marks turns, and the control strings (after their first character) to escape.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>\n"
_TAILS = r"(?:\|im_start\|>|\|im_end\|>|\|endoftext\|>|/?s>|<SYS>>|</SYS>>|/?INST\])"
_ESCAPE = rf"([<\[])(\\*{_TAILS})"
_UNESCAPE = rf"([<\[])\\(\\*{_TAILS})"


@dataclass(frozen=True)
class Format:
    budget: int = 512
    overhead: int = 4
    history: int = 2
    history_tokens: int = 128
    part_turns: int = 1024


def escaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_ESCAPE), F.lit(r"$1\\$2"))


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, F.lit(_UNESCAPE), F.lit("$1$2"))


def escaped_role(role: Column) -> Column:
    """Roles end at the line end, so theirs are written as ``\\n`` and backslashes doubled."""
    return escaped(F.replace(F.replace(role, F.lit("\\"), F.lit("\\\\")), F.lit("\n"), F.lit("\\n")))


def unescaped_role(role: Column) -> Column:
    plain = F.regexp_replace(unescaped(role), F.lit(r"(?<!\\)((?:\\\\)*)\\n"), F.lit("$1\n"))
    return F.replace(plain, F.lit("\\\\"), F.lit("\\"))


def windows(turns: DataFrame, form: Format = Format()) -> DataFrame:
    """``conv_id, part, window, text, n_repeated, loss array<(start, end)>``.

    ``text`` is the formatted window, its first ``n_repeated`` turns are system turn or history
    from before; ``loss`` are code-point spans of it, the end exclusive.
    """
    rows = turns.select(
        "conv_id", F.floor(F.coalesce(F.col("turn"), F.lit(0)) / form.part_turns).alias("part"), "turn",
        F.coalesce(F.col("role").cast("string"), F.lit("")).alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    turn = F.struct("turn", "role", "text", (F.regexp_count("text", F.lit(WORD)) + form.overhead).alias("n"))
    parts = rows.groupBy("conv_id", "part").agg(F.sort_array(F.collect_list(turn)).alias("_t"))
    # a conversation's system turn is its very first, if that is one
    first = rows.groupBy("conv_id").agg(F.min("part").alias("_first"))
    heads = join_null_safe(parts, first, ["conv_id"]).where(F.col("part") == F.col("_first"))
    system = heads.select("conv_id", F.when(F.col("_t")[0]["role"] == "system", F.struct(F.col("_t")[0]["role"].alias("role"), F.col("_t")[0]["text"].alias("text"), F.col("_t")[0]["n"].alias("n"))).alias("_sys"), F.col("_first"))
    work = join_null_safe(join_null_safe(parts, system, ["conv_id"]), _ends(rows, turn, form), ["conv_id", "part"], "left")
    # every window has the system turn anyway, so it is no history
    only_system = (F.col("_before") == F.col("_first")) & F.col("_sys").isNotNull() & (F.col("_m") <= form.history)
    old = F.when(F.col("_old").isNull(), F.slice("_t", 1, 0)).when(only_system, F.slice("_old", 2, form.history)).otherwise(F.col("_old"))
    begun = work.select("conv_id", "part", "_t", "_sys", (F.col("part") == F.col("_first")).alias("_head"), old.alias("_old"))
    plan = begun.select("conv_id", "part", "_sys", "_head", F.concat("_old", "_t").alias("_t"), _cuts(form).alias("_cuts"))
    each = plan.select("conv_id", "part", "_t", "_sys", "_head", F.posexplode("_cuts").alias("window", "_c"))
    return _formatted(each)


def _ends(rows: DataFrame, turn: Column, form: Format) -> DataFrame:
    """``conv_id, part, _before, _m, _old``: by part but the first, the part before, its turns and the last of them."""
    ordered = Window.partitionBy("conv_id").orderBy("part")
    spread = stage(rows.select("conv_id", "part").distinct().withColumn("_next", F.lead("part").over(ordered)).where(F.col("_next").isNotNull()))
    small = spread.count() <= BROADCAST_ROWS
    followed = join_null_safe(rows, F.broadcast(spread) if small else spread, ["conv_id", "part"])
    lists = followed.groupBy("conv_id", "part", "_next").agg(F.sort_array(F.collect_list(turn)).alias("_a"))
    last = F.slice("_a", F.greatest(F.size("_a") - form.history, F.lit(0)) + 1, form.history)
    return lists.select("conv_id", F.col("_next").alias("part"), F.col("part").alias("_before"), F.size("_a").alias("_m"), last.alias("_old"))


def _cuts(form: Format) -> Column:
    """Windows of a part as (first repeated turn, first new turn, last new turn), from 1, in ``_old`` and ``_t`` together.

    The state walks over the turns' prefix sums once: the open window's tokens, and the sizes of
    the last turns, which are the history of the next one.
    """
    start = F.struct(
        F.size("_old").alias("i"), F.lit(0).cast("long").alias("used"),
        F.array().cast("array<struct<back:int,first:int,last:int>>").alias("cuts"),
        F.transform("_old", lambda t: t["n"].cast("long")).alias("tail"))
    system = F.coalesce(F.col("_sys.n").cast("long"), F.lit(0).cast("long"))

    def step(acc: Column, turn: Column) -> Column:
        n = turn["n"].cast("long")
        count = F.size(acc["cuts"])
        full = (count == 0) | (acc["used"] + n > form.budget)
        # how many of the last turns fit the history's tokens, beside the system turn
        sums = [F.aggregate(F.slice(acc["tail"], F.size(acc["tail"]) - k + 1, k), F.lit(0).cast("long"), lambda a, x: a + x) for k in range(1, form.history + 1)]
        back, tokens = F.lit(0), F.lit(0).cast("long")
        for k in range(1, form.history + 1):
            fits = F.coalesce((F.size(acc["tail"]) >= k) & (sums[k - 1] <= form.history_tokens) & (sums[k - 1] + system + n <= form.budget), F.lit(False))
            back, tokens = F.when(fits, F.lit(k)).otherwise(back), F.when(fits, sums[k - 1]).otherwise(tokens)
        i = acc["i"] + 1
        opened = F.struct((i - back).alias("back"), i.alias("first"), i.alias("last"))
        open_cut = F.element_at(acc["cuts"], -1)
        grown = F.concat(F.slice(acc["cuts"], F.lit(1), count - 1), F.array(F.struct(open_cut["back"].alias("back"), open_cut["first"].alias("first"), i.alias("last"))))
        cuts = F.when(full, F.concat(acc["cuts"], F.array(opened))).otherwise(grown)
        used = F.when((count == 0) & F.col("_head"), n).when(full, system + tokens + n).otherwise(acc["used"] + n)
        # the system turn itself is no history: every window has it anyway
        is_system = F.col("_head") & F.col("_sys").isNotNull() & (i == 1)
        tail = F.when(is_system, acc["tail"]).otherwise(F.slice(F.concat(acc["tail"], F.array(n)), -F.least(F.size(acc["tail"]) + 1, F.lit(form.history)), form.history))
        return F.struct(i.alias("i"), used.alias("used"), cuts.alias("cuts"), tail.alias("tail"))

    return F.aggregate("_t", start, step)["cuts"]


def _formatted(each: DataFrame) -> DataFrame:
    """Writes the turns of every window and finds the loss spans by the lengths of the pieces."""
    repeats_system = F.col("_sys").isNotNull() & ~(F.col("_head") & (F.col("_c.first") == 1))
    taken = F.transform(
        F.slice("_t", F.col("_c.back"), F.col("_c.last") - F.col("_c.back") + 1),
        lambda t, i: F.struct(t["role"].alias("role"), t["text"].alias("text"), (i + F.col("_c.back") < F.col("_c.first")).alias("old")))
    system = F.when(repeats_system, F.array(F.struct(F.col("_sys.role").alias("role"), F.col("_sys.text").alias("text"), F.lit(True).alias("old"))))
    turns = F.concat(F.coalesce(system, F.array().cast("array<struct<role:string,text:string,old:boolean>>")), taken)
    pieces = F.transform(turns, lambda t: F.struct(
        F.concat(F.lit(OPEN), escaped_role(t["role"]), F.lit("\n")).alias("head"), escaped(t["text"]).alias("body"),
        ((t["role"] == "assistant") & ~t["old"]).alias("loss"), t["old"].alias("old")))
    written = each.select("conv_id", "part", "window", pieces.alias("_p"))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,end:int>>").alias("out"))
    walked = F.aggregate("_p", start, lambda acc, p: F.struct(
        (acc["at"] + F.length(p["head"]) + F.length(p["body"]) + len(CLOSE)).alias("at"),
        F.when(p["loss"], F.concat(acc["out"], F.array(F.struct(
            (acc["at"] + F.length(p["head"])).alias("start"), (acc["at"] + F.length(p["head"]) + F.length(p["body"])).alias("end")))))
        .otherwise(acc["out"]).alias("out")))
    return written.select(
        "conv_id", "part", "window",
        F.array_join(F.transform("_p", lambda p: F.concat(p["head"], p["body"], F.lit(CLOSE))), "").alias("text"),
        F.size(F.filter("_p", lambda p: p["old"])).alias("n_repeated"),
        walked["out"].alias("loss"))


def read_turns(formatted: DataFrame) -> DataFrame:
    """Adds ``turns array<(role, text)>``, parsed from the text alone, and ``loss_texts``, cut by the mask."""
    raw = F.filter(F.split("text", r"<\|im_end\|>\n", -1), lambda x: x != "")
    split = formatted.withColumn("_raw", F.transform(raw, lambda x: F.substr(x, F.lit(len(OPEN) + 1))))
    turns = F.transform("_raw", lambda x: F.struct(
        unescaped_role(F.substring_index(x, "\n", 1)).alias("role"),
        unescaped(F.regexp_replace(x, r"^[^\n]*\n", "")).alias("text")))
    cut = F.transform("loss", lambda s: unescaped(F.substr(F.col("text"), s["start"] + 1, s["end"] - s["start"])))
    return split.select(*formatted.columns, turns.alias("turns"), cut.alias("loss_texts"))


def digest(formatted: DataFrame) -> DataFrame:
    """By conversation, read back from the windows: turns, their digest, and what the loss covers."""
    new = F.slice("turns", F.col("n_repeated") + 1, F.size("turns"))
    line = F.array_join(F.transform(new, lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    parts = read_turns(formatted).select("conv_id", F.struct(
        "part", "window", F.size(new).alias("n"), line.alias("lines"), F.array_join("loss_texts", "").alias("loss"), F.length("text").alias("chars")).alias("w"))
    whole = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("w")).alias("w"))
    total = lambda field: F.aggregate(f"w.{field}", F.lit(0).cast("long"), lambda a, x: a + x)
    loss = F.array_join("w.loss", "")
    return whole.select(
        "conv_id", total("n").alias("n_turns"), F.sha2(F.array_join("w.lines", ""), 256).alias("turns_sha256"),
        F.length(loss).cast("long").alias("loss_chars"), F.sha2(loss, 256).alias("loss_sha256"), total("chars").alias("formatted_chars"))
