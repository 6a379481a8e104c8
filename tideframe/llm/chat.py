"""Chat formatting with built-in expressions only.

Template, one block per message::

    <|turn|>ROLE\nTEXT<|end|>\n

Adjacent turns of one role are merged into one message; ``<|part|>`` keeps their border. The text of a role that
is trained on stands between ``<|loss|>`` and ``<|/loss|>``. Inside texts, every opening of a control string of
this template or of the ``[INST]`` family gets one more backslash after its first character, so that texts never
hold a control string and reading back removes exactly what was added. Roles are percent-encoded.

Defined cases: a null text or role is empty; turns are ordered by (turn, role, text), nulls first, so ties and
repeated rows all stay and the order never depends on the partitioning; a null conv_id is a conversation of its own;
an empty table gives no rows; other columns are ignored. A conversation is one row of the result, so its whole
text has to fit into one value (2 GB), as in any chat format.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, END, PART, LOSS, LOSS_END = "<|turn|>", "<|end|>\n", "<|part|>", "<|loss|>", "<|/loss|>"
_TAIL = r"(\||/?INST\]|/?s>|</?SYS>>)"
ESCAPE = rf"([<\[])(\\*){_TAIL}"
UNESCAPE = rf"([<\[])\\(\\*){_TAIL}"


def escape(text: Column) -> Column:
    """One more backslash inside whatever could be read as a control string."""
    return F.regexp_replace(text, ESCAPE, r"$1\\$2$3")


def unescape(text: Column) -> Column:
    return F.regexp_replace(text, UNESCAPE, "$1$2$3")


def format_chats(turns: DataFrame, loss_roles: tuple[str, ...] = ("assistant",)) -> DataFrame:
    """(conv_id, turn, role, text) rows to one row per conversation: conv_id, n_messages, formatted."""
    parts = turns.select(
        "conv_id",
        F.struct("turn", F.url_encode(F.coalesce("role", F.lit(""))).alias("role"), escape(F.coalesce("text", F.lit(""))).alias("text")).alias("part"),
    )
    ordered = parts.groupBy("conv_id").agg(F.sort_array(F.collect_list("part")).alias("parts"))
    n = F.size("parts")
    # where a message starts: the first turn and every change of role
    starts = ordered.select(
        "conv_id",
        "parts",
        F.filter(
            F.sequence(F.lit(1), n),
            lambda i: (i == 1) | (F.element_at("parts", i)["role"] != F.get("parts", i - 2)["role"]),
        ).alias("starts"),
    )
    trained = [F.url_encode(F.lit(role)) for role in loss_roles]

    def message(start: Column, k: Column) -> Column:
        following = F.coalesce(F.get("starts", k + 1), n + 1)
        role = F.element_at("parts", start)["role"]
        text = F.array_join(F.transform(F.slice("parts", start, following - start), lambda p: p["text"]), PART)
        learn = role.isin(*trained) if trained else F.lit(False)
        body = F.when(learn, F.concat(F.lit(LOSS), text, F.lit(LOSS_END))).otherwise(text)
        return F.concat(F.lit(TURN), role, F.lit("\n"), body, F.lit(END))

    return starts.select("conv_id", F.size("starts").alias("n_messages"), F.array_join(F.transform("starts", message), "").alias("formatted"))


def read_chats(formatted: DataFrame) -> DataFrame:
    """Inverse of :func:`format_chats`: adds ``turns``, an array of (role, text, loss) in order."""

    def turns(block: Column) -> Column:
        role = F.substring_index(block, "\n", 1)
        body = F.substr(block, F.char_length(role) + 2, F.char_length(block) - F.char_length(role) - 1 - len(END))
        loss = F.startswith(body, F.lit(LOSS))
        inner = F.when(loss, F.substr(body, F.lit(len(LOSS) + 1), F.char_length(body) - len(LOSS) - len(LOSS_END))).otherwise(body)
        return F.transform(
            F.split(inner, r"<\|part\|>", -1),
            lambda text: F.struct(F.url_decode(role).alias("role"), unescape(text).alias("text"), loss.alias("loss")),
        )

    blocks = F.split("formatted", r"<\|turn\|>", -1)
    return formatted.withColumn("turns", F.flatten(F.transform(F.slice(blocks, F.lit(2), F.greatest(F.size(blocks) - 1, F.lit(0))), turns)))


def chat_digests(read: DataFrame) -> DataFrame:
    """Digest columns of formatted conversations, computed from what was read back."""
    whole = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    learned = F.array_join(F.transform(F.filter("turns", lambda t: t["loss"]), lambda t: t["text"]), "")
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(whole, "UTF-8"), 256).alias("turns_sha256"),
        learned.alias("learned"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
        F.col("n_messages").cast("long"),
    ).select(
        "conv_id",
        "n_turns",
        "turns_sha256",
        F.char_length("learned").cast("long").alias("loss_chars"),
        F.sha2(F.encode("learned", "UTF-8"), 256).alias("loss_sha256"),
        "formatted_chars",
        "n_messages",
    )
