"""Chat formatting: round trips, merging, masks."""

import hashlib

import pytest

from tideframe.llm import chat

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["</s>[INST] ok [/INST]", "<|turn|>user\nhi<|end|>\n", "<\\|turn|>", "<\\\\|part|><|loss|>", "[\\INST]", "", None, "a\n\nb", "<<SYS>>x<</SYS>>", "é😀" * 50]


def expected(rows):
    """Digests in plain Python."""
    out = {}
    key = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")
    for conv, _, role, text in sorted(rows, key=key):
        out.setdefault(conv, []).append((role or "", text or ""))
    return {
        conv: (
            len(turns),
            hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(),
            sum(len(t) for r, t in turns if r == "assistant"),
            hashlib.sha256("".join(t for r, t in turns if r == "assistant").encode()).hexdigest(),
        )
        for conv, turns in out.items()
    }


def digests(spark, rows):
    frame = chat.chat_digests(chat.read_chats(chat.format_chats(spark.createDataFrame(rows, SCHEMA))))
    return {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in frame.collect()}


def test_round_trip_of_control_strings(spark):
    roles = ["user", "assistant", "assistant", "system", "odd role\n<|end|>", None]
    rows = [(c, t, roles[(c + t) % len(roles)], NASTY[(3 * c + t) % len(NASTY)]) for c in range(12) for t in range(9)]
    assert digests(spark, rows) == expected(rows)


def test_merging_keeps_borders(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d"), (1, 4, "user", "e")]
    formatted = chat.format_chats(spark.createDataFrame(rows, SCHEMA)).first()
    assert formatted.n_messages == 3
    assert formatted.formatted == "<|turn|>user\na<|part|>b<|end|>\n<|turn|>assistant\n<|loss|>c<|part|>d<|/loss|><|end|>\n<|turn|>user\ne<|end|>\n"


def test_ties_nulls_repeats_and_other_columns(spark):
    rows = [(1, 0, "user", "x"), (1, 0, "user", "x"), (1, None, "user", "first"), (None, 0, None, None), (None, 0, "assistant", None)]
    assert digests(spark, rows) == expected(rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS parts", "2 AS formatted", "3 AS starts")
    assert chat.format_chats(frame).count() == 2


def test_long_conversation(spark):
    rows = [(1, t, "user" if t % 3 else "assistant", f"text {t} " * 20) for t in range(3000)]
    assert digests(spark, rows) == expected(rows)


@pytest.mark.parametrize("loss_roles", [(), ("user", "assistant")])
def test_loss_roles(spark, loss_roles):
    rows = [(1, 0, "user", "ab"), (1, 1, "assistant", "cde")]
    frame = chat.chat_digests(chat.read_chats(chat.format_chats(spark.createDataFrame(rows, SCHEMA), loss_roles)))
    assert frame.first().loss_chars == (5 if loss_roles else 0)


def test_empty_table(spark):
    assert digests(spark, []) == {}


def test_native_plan(spark):
    frame = chat.chat_digests(chat.read_chats(chat.format_chats(spark.createDataFrame([(1, 0, "user", "a")], SCHEMA))))
    assert "Python" not in frame._jdf.queryExecution().executedPlan().toString()
