"""Render message lists into one training / inference string with a generation marker.

The template is a parameter (the reference takes it from the model's tokenizer). Messages held as rows
``(conversation, turn, role, text)`` are rendered in place and gathered per conversation in two levels
(turn chunks, then conversations); messages already held as an
``array<struct<role, content>>`` column are rendered in place without any shuffle.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """``begin`` holds a ``{role}`` hole and opens every message; ``end`` closes it; ``generation`` is
    appended after the last message when a reply is to be generated."""

    begin: str = "<|{role}|>\n"
    end: str = "\n"
    generation: str = "<|assistant|>\n"

    def message(self, role: Column, content: Column) -> Column:
        """A message without content (or role) is rendered with an empty one; no message is dropped."""
        pre, post = self.begin.split("{role}", 1)
        return F.concat(F.lit(pre), F.coalesce(role, F.lit("")), F.lit(post), F.coalesce(content, F.lit("")), F.lit(self.end))


DEFAULT_TEMPLATE = ChatTemplate()


def render_messages(messages, template: ChatTemplate = DEFAULT_TEMPLATE, add_generation: bool = True) -> Column:
    """Render an ``array<struct<role, content>>`` column (row-local)."""
    m = F.col(messages) if isinstance(messages, str) else messages
    body = F.array_join(F.transform(m, lambda x: template.message(x["role"], x["content"])), "")
    return F.concat(body, F.lit(template.generation)) if add_generation else body


# Turns rendered together in the first gather; a conversation of any length is cut into groups of at
# most this many turns, so a hot conversation is spread over many aggregation groups and tasks.
CHUNK_TURNS = 256


def _joined(parts: Column) -> Column:
    """Concatenate the ``_s`` strings of an ``array<struct<order key, _s>>`` in key order."""
    return F.array_join(F.transform(F.array_sort(parts), lambda x: x["_s"]), "")


def render_chat(
    df: DataFrame,
    conv: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    template: ChatTemplate = DEFAULT_TEMPLATE,
    add_generation: bool = True,
    out: str = "rendered",
    chunk_turns: int = CHUNK_TURNS,
) -> DataFrame:
    """One row per conversation: its messages ordered by turn and rendered with ``template``.

    Each message is rendered row-locally in the scan stage. The first gather joins the messages of one
    ``(conversation, turn // chunk_turns)`` group, so no group holds more than ``chunk_turns`` turns
    (for distinct turn numbers) however long the conversation is. The second gather joins one string
    per chunk; what it holds is the rendered conversation itself, i.e. the output row. Messages without a
    turn number come first and messages that share one stand together, in the order of their rendered text.
    """
    msgs = df.select(
        conv,
        F.col(turn).alias("_t"),
        template.message(F.col(role), F.col(text)).alias("_s"),
    )
    chunks = msgs.groupBy(conv, F.floor(F.col("_t") / F.lit(chunk_turns)).alias("_c")).agg(
        _joined(F.collect_list(F.struct("_t", "_s"))).alias("_s"),
        F.count("*").alias("_n"),
    )
    convs = chunks.groupBy(conv).agg(
        _joined(F.collect_list(F.struct("_c", "_s"))).alias("_body"),
        F.sum("_n").alias("turns"),
    )
    body = F.concat(F.col("_body"), F.lit(template.generation)) if add_generation else F.col("_body")
    return convs.select(conv, "turns", body.alias(out))
