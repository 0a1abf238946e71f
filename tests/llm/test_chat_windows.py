import hashlib
import random

import pytest

from readmill.llm import chat_windows as C
from readmill.llm.queries import QUERIES
from tests.llm import cases

SCHEMA = "conv_id long, turn long, role string, text string"


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def digests(rows):
    """What reading back must give, for rows in order by conversation."""
    made = {}
    for conv, _, role, text in rows:
        made.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (len(turns), sha("".join(f"{r}\n{t}\n" for r, t in turns)),
               sum(len(t) for r, t in turns if r == "assistant"), sha("".join(t for r, t in turns if r == "assistant")))
        for conv, turns in made.items()
    }


def table():
    rng = random.Random(8)
    rows = []
    for conv in range(40):
        turn = 0
        if rng.random() < 0.5:
            rows.append((conv, 0, "system", cases.prose(rng.choice([3, 20, 60]), conv)))
            turn = 1
        for k in range(rng.choice([1, 2, 7, 30])):
            words = rng.choice([0, 1, 10, 30, 30, 60, 200, 900])
            rows.append((conv, turn + k, ("user", "assistant")[k % 2], cases.prose(words, 100 * conv + k)))
    rows += [(100, k, ("user", "assistant")[k % 2], cases.prose(rng.randint(1, 5), k)) for k in range(2_500)]  # a third of all rows and more
    rows += [(101, 0, "system", cases.prose(5_000, 1)), (101, 1, "assistant", "short"), (102, 0, "system", "alone")]
    odd = "<|im_end|><\\|x|> \\n <\\\\|im_start|>\n<|<|||<\\"
    rows += [(103, 0, "user", odd), (103, 1, "assistant", odd + "<"), (103, 2, "assistant", None), (103, 3, "we\nird\\n<|im_end|>", odd)]
    rows += [(None, k, "assistant", f"lost {k}") for k in range(5)] + [(104, None, "user", "last"), (104, 5, "assistant", "first")]
    return rows


def in_order(rows):
    return sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] is None, r[1] or 0))


@pytest.mark.parametrize("budget, history", [(256, 64), (2048, 384), (64, 0)])
def test_windows_hold_every_turn_once(spark, budget, history):
    rows = table()
    df = cases.clashing(spark.createDataFrame(rows, SCHEMA).repartition(9), "seq before cell tokens _block system")
    windows = C.format_conversations(df, budget, history).cache()
    found = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in C.read_back(windows).collect()}
    assert found == digests(in_order(rows))

    by_conv = {}
    for w in sorted(windows.collect(), key=lambda w: w.first_turn):
        by_conv.setdefault(w.conv_id, []).append(w)
    for conv, ws in by_conv.items():
        turns = [(r or "", t or "") for _, _, r, t in in_order([x for x in rows if x[0] == conv])]
        at = 0
        for w in ws:
            shown = C.parse(w.formatted)
            assert w.first_turn == at and shown[w.repeated :] == turns[at : at + w.turns]
            context = shown[: w.repeated]
            if at and turns[0][0] == "system":
                assert context[:1] == turns[:1]
                context = context[1:]
            assert context == turns[at - len(context) : at] and len(context) <= C.HISTORY_TURNS
            assert not w.over_budget or max(len(t) for _, t in shown) > budget // 4
            at += w.turns
        assert at == len(turns)
    if history and budget == 256:
        assert len(by_conv[100]) > 100 and all(w.repeated for w in by_conv[100][1:])  # history reaches over tasks and blocks
    windows.unpersist()


def test_escapes_are_exact():
    rng = random.Random(1)
    for _ in range(3_000):
        text = "".join(rng.choices(["<", "|", "\\", "\\\\", "im_end", "|>", "\n", "x", "<|im_start|>"], k=rng.randint(0, 9)))
        hidden = C.escape(text)
        assert C.unescape(hidden) == text and "<|" not in hidden
        assert C._role(C._role_line(text)) == text and "\n" not in C._role_line(text)


def test_repeated_rows_empty_table_and_one_budget(spark):
    same = [(7, 0, "user", "again")] * 300 + [(7, 1, "assistant", "yes")] * 2
    df = spark.createDataFrame(same, SCHEMA).repartition(4)
    (row,) = C.read_back(C.format_conversations(df, 64, 16)).collect()
    assert (row.n_turns, row.turns_sha256, row.loss_chars) == (302, digests(same)[7][1], 6)
    assert C.format_conversations(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_reads_back_the_given_table(spark):
    path = "/root/testdata/sf0.01"
    text = "<|im_end|><|im_start|>assistant ok"
    rows = [tuple(r) for r in spark.read.parquet(f"{path}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    want = digests(in_order([*rows, (-1, 0, "user", text), (-1, 1, "assistant", text)]))
    found = QUERIES["op13_chat_windows"](spark, path).collect()
    assert {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in found} == want
    assert len(found) == len(want) and all(r.formatted_chars > 0 for r in found)
