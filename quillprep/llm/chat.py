r"""Chat formatting by prefix-target expansion.

Each assistant turn becomes an example of its own: all earlier turns as context, then the reply, and
only the reply under the loss mask. Turns after the last reply, or a conversation without one, give a
closing example with nothing under the mask, so every turn is formatted.

A turn reads ``### role: text</turn>`` and a line feed. Inside roles and texts a backslash goes before
each backslash and before what would start a control string; in roles before colons too. Reading
drops one backslash of each pair, so any text comes back as it was.

Defined results: a null text or role is an empty one; turns are ordered by number, null first, then
role and text; repeated rows are turns like any other; rows with a null conversation id are one
conversation. An empty table gives an empty result. Columns beside the four are not read.

A context is one string, so the output of one conversation grows with the square of its turns, and
its last example must fit a task: that is what the expansion is. Turns are rendered before they
are dealt out by conversation, and digests are taken from each example where it lies.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import sha256

from pyspark.sql import Column, DataFrame, Window, functions as F

from quillprep.llm.arrow import Lists, map_lists


@dataclass(frozen=True)
class ChatTemplate:
    """Fixed pieces; escaping is made for their first characters ``#`` and ``<``."""

    opening: str = "### "
    after_role: str = ": "
    closing: str = "</turn>"
    between: str = "\n"
    assistant: str = "assistant"


TEMPLATE = ChatTemplate()


def escaped(value: Column) -> Column:
    """Backslashes first, then each ``#`` that two others follow and each closing mark."""
    value = F.replace(F.coalesce(value, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    value = F.regexp_replace(value, r"#(?=##)", r"\\#")
    return F.replace(value, F.lit(TEMPLATE.closing), F.lit("\\" + TEMPLATE.closing))


def unescaped(value: str) -> str:
    if "\\" not in value:
        return value
    out, at = [], 0
    while (hit := value.find("\\", at)) >= 0:
        out += [value[at:hit], value[hit + 1 : hit + 2]]
        at = hit + 2
    return "".join(out) + value[at:]


def _unescaped_at(text: str, mark: str, at: int) -> int:
    """Where ``mark`` next stands with an even number of backslashes before it."""
    while (hit := text.find(mark, at)) >= 0:
        slashes = hit
        while slashes > at and text[slashes - 1] == "\\":
            slashes -= 1
        if (hit - slashes) % 2 == 0:
            return hit
        at = hit + 1
    return -1


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """``(role, text)`` of each turn of a formatted example."""
    turns, at = [], 0
    t = TEMPLATE
    while at < len(formatted):
        if not formatted.startswith(t.opening, at):
            raise ValueError(f"no turn at {at}")
        at += len(t.opening)
        colon = _unescaped_at(formatted, t.after_role, at)
        end = _unescaped_at(formatted, t.closing, colon + len(t.after_role))
        if colon < 0 or end < 0:
            raise ValueError(f"turn at {at} is not closed")
        turns.append((unescaped(formatted[at:colon]), unescaped(formatted[colon + len(t.after_role) : end])))
        at = end + len(t.closing) + len(t.between)
    return turns


def examples(conversations: DataFrame) -> DataFrame:
    """``conv_id, turn, closing, formatted, loss_start, loss_end`` for each example.

    ``turn`` is the example's place among the conversation's turns, from 1, so the number of turns in
    it; offsets are code points.
    """
    t = TEMPLATE
    role = F.replace(escaped(F.col("role")), F.lit(":"), F.lit("\\:"))
    text = escaped(F.col("text"))
    head = F.concat(F.lit(t.opening), role, F.lit(t.after_role))
    rendered = conversations.select(
        "conv_id",
        F.struct("turn", "role", "text").alias("_order"),
        (F.coalesce("role", F.lit("")) == t.assistant).alias("_reply"),
        F.concat(head, text, F.lit(t.closing + t.between)).alias("_turn"),
        F.char_length(text).alias("_length"),
    )
    ordered = Window.partitionBy("conv_id").orderBy("_order")
    upto = ordered.rowsBetween(Window.unboundedPreceding, 0)
    placed = (
        rendered.withColumn("turn", F.row_number().over(ordered))
        .withColumn("_last", F.lead("_reply").over(ordered).isNull())
        .withColumn("_turns", F.when(F.col("_reply") | F.col("_last"), F.collect_list("_turn").over(upto)))
        .filter(F.col("_reply") | F.col("_last"))
    )
    formatted = F.array_join("_turns", "")
    end = F.char_length("formatted") - len(t.closing + t.between)
    return placed.withColumn("formatted", formatted).select(
        "conv_id",
        "turn",
        (~F.col("_reply")).alias("closing"),
        F.col("_last").alias("whole"),
        "formatted",
        F.when(F.col("_reply"), end - F.col("_length")).alias("loss_start"),
        F.when(F.col("_reply"), end).alias("loss_end"),
    )


def read_back(rows: DataFrame) -> DataFrame:
    """What formatted examples hold, read from their text and mask: a row per conversation.

    ``n_turns, turns_sha256`` come from the example that has all turns, ``loss_chars, loss_sha256`` from
    the masked text of all examples in order, ``formatted_chars`` from all examples.
    """
    id_type = rows.schema["conv_id"].dataType.simpleString()
    schema = f"conv_id {id_type}, turn int, n_turns long, turns_sha256 string, loss string, chars long"

    def read(batches: Iterator[Lists]) -> Iterator[Lists]:
        for b in batches:
            out: Lists = {"conv_id": b["conv_id"], "turn": b["turn"], "n_turns": [], "turns_sha256": [], "loss": [], "chars": []}
            for formatted, whole, start, end in zip(b["formatted"], b["whole"], b["loss_start"], b["loss_end"], strict=True):
                count = digest = None
                if whole:
                    turns = read_turns(formatted)
                    joined = "".join(f"{role}\n{text}\n" for role, text in turns)
                    count, digest = len(turns), sha256(joined.encode("utf-8", "surrogatepass")).hexdigest()
                out["n_turns"].append(count)
                out["turns_sha256"].append(digest)
                out["loss"].append(None if start is None else unescaped(formatted[start:end]))
                out["chars"].append(len(formatted))
            yield out

    loss = F.array_join(F.transform(F.sort_array(F.collect_list(F.when(F.col("loss").isNotNull(), F.struct("turn", "loss")))), lambda x: x["loss"]), "")
    return (
        map_lists(rows, read, schema)
        .groupBy("conv_id")
        .agg(
            F.max("n_turns").alias("n_turns"),
            F.max("turns_sha256").alias("turns_sha256"),
            loss.alias("_loss"),
            F.sum("chars").alias("formatted_chars"),
        )
        .select(
            "conv_id",
            "n_turns",
            "turns_sha256",
            F.char_length("_loss").cast("long").alias("loss_chars"),
            F.sha2(F.encode("_loss", "UTF-8"), 256).alias("loss_sha256"),
            "formatted_chars",
        )
    )
