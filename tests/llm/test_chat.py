from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tests.llm.helpers import sha
from tidemark.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string, part int"


def brute(rows):
    convs = defaultdict(list)
    for c, t, r, x, *_ in rows:
        convs[c].append((t is not None, t or 0, r or "", x or ""))
    out = {}
    for c, turns in convs.items():
        turns.sort()
        loss = "".join(x for *_, r, x in turns if r == "assistant")
        out[c] = (len(turns), sha("".join(f"{r}\n{x}\n" for *_, r, x in turns)), len(loss), sha(loss))
    return out


def digests(df):
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in chat.digest(chat.windows(df)).collect()}


ROWS = [
    (1, 0, "system", "be <s> nice", 1), (1, 1, "user", "a " * 300, 1), (1, 2, "assistant", "b <|im_end|>\n<|im_start|>user\nx " * 100, 1), (1, 3, "user", "q", 1),
    (1, 4, "assistant", "c\\n <\\s> <\\\\s> [INST] [\\/INST]<<SYS>><</SYS>> $1 \\1", 1), (1, 5, "assistant", "d " * 600, 1), (1, 6, None, "é😀", 1),
    (2, None, "user", None, 1), (2, None, "assi\nst\\nant\\\n", "x", 1), (None, 0, "assistant", "no conversation", 1), (3, 5, "assistant", "", 1), (3, 5, "assistant", "", 1),
    (4, 0, "system", "s", 1), (4, 5000, "assistant", "far", 1), (4, 5001, "assistant", "<s" * 5, 1), (-1, 0, "user", "</s>[INST] ok [/INST]", 1), (-1, 1, "assistant", "</s>[INST] ok [/INST]", 1),
]


def test_round_trip(spark):
    assert digests(spark.createDataFrame(ROWS, SCHEMA)) == brute(ROWS)
    assert digests(spark.createDataFrame([], SCHEMA)) == {}


def test_a_table(spark, sf_dir):
    df = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    assert digests(df) == brute([tuple(r) for r in df.collect()])


def test_budget_history_and_mask(spark):
    rows = [(1, 0, "system", "s " * 10, 1)] + [(1, i, "user" if i % 2 else "assistant", f"t{i} " * 40, 1) for i in range(1, 41)]
    form = chat.Format(budget=150, history=2, history_tokens=50)
    out = chat.windows(spark.createDataFrame(rows, SCHEMA), form).orderBy("window").collect()
    assert len(out) > 10
    for r in out:
        turns = r.text.count(chat.OPEN)
        assert len(r.text.split("\n")) and sum(len(x.split()) for x in r.text.split(chat.CLOSE)) <= 150 + turns
        assert r.text.startswith("<|im_start|>system\n")
        if r.window:
            assert r.n_repeated == 2  # the system turn and one turn of history
    masked = chat.read_turns(spark.createDataFrame(out)).collect()
    assert [x for r in masked for x in r.loss_texts] == [x for *_, role, x, _ in rows if role == "assistant"]


def test_conversation_with_a_third_of_all_rows(spark):
    rows = [(7 if i % 3 == 0 else i, i, "assistant", f"x{i}", 1) for i in range(6000)]
    df = spark.createDataFrame(rows, SCHEMA)
    assert chat.windows(df).where("conv_id = 7").agg(F.countDistinct("part")).first()[0] == 6
    assert digests(df) == brute(rows)


def test_history_crosses_the_border_of_parts(spark):
    rows = [(1, 0, "system", "be nice", 1)] + [(1, i, "user" if i % 2 else "assistant", f"t{i} " * 9, 1) for i in range(1020, 1030)]
    rows += [(2, 0, "system", "alone", 1), (2, 1024, "assistant", "next", 1), (None, 1023, "user", "q", 1), (None, 1024, "assistant", "a", 1)]
    rows += [(3, 1023, "user", "long " * 200, 1), (3, 1024, "assistant", "a", 1)]
    out = chat.read_turns(chat.windows(spark.createDataFrame(rows, SCHEMA))).collect()
    assert digests(spark.createDataFrame(rows, SCHEMA)) == brute(rows)
    second = {r.conv_id: r for r in out if r.part == 1}
    assert [t.text.split(" ")[0] for t in second[1].turns[:4]] == ["be", "t1022", "t1023", "t1024"] and second[1].n_repeated == 3
    # the system turn is no history beside itself, a turn beyond the history's tokens is none, a null id is a conversation
    assert [t.text for t in second[2].turns] == ["alone", "next"] and second[2].n_repeated == 1
    assert [t.text for t in second[3].turns] == ["a"] and [t.text for t in second[None].turns] == ["q", "a"]
    # masked: each assistant turn counts once
    assert sum(len(r.loss_texts) for r in out) == sum(role == "assistant" for _, _, role, _, _ in rows)


@pytest.mark.parametrize("history", [1, 2, 3])
def test_windows_by_a_plain_loop(spark, history):
    """Windows of conversations over several parts, for short and long parts, as first new turn, last new turn and history."""
    size = lambda i: 3 + (i * i * 7) % 40
    for part_turns in (7, 64, 1024):
        form = chat.Format(budget=120, history=history, history_tokens=60, part_turns=part_turns)
        rows = [(1, i, "user", " ".join([f"t{i}"] * size(i)), 1) for i in range(150)]
        got = sorted((r.part, r.window, r.n_repeated, [t.text.split(" ")[0] for t in r.turns]) for r in chat.read_turns(chat.windows(spark.createDataFrame(rows, SCHEMA), form)).collect())
        expected, open_turns, used = [], None, 0
        for i in range(150):
            n = size(i) + form.overhead
            if open_turns is None or used + n > form.budget or i % part_turns == 0:
                back = 0
                for k in range(1, min(history, i, part_turns if i % part_turns == 0 else i) + 1):
                    tokens = sum(size(j) + form.overhead for j in range(i - k, i))
                    if tokens <= form.history_tokens and tokens + n <= form.budget:
                        back = k
                open_turns = [f"t{j}" for j in range(i - back, i)]
                used = sum(size(j) + form.overhead for j in range(i - back, i))
                expected.append((back, open_turns))
            open_turns.append(f"t{i}")
            used += n
        assert [(r[2], r[3]) for r in got] == expected


def test_no_python(spark):
    plan = chat.digest(chat.windows(spark.createDataFrame(ROWS, SCHEMA)))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "InPandas" not in plan
