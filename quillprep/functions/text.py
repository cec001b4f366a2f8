"""Column expressions on text: whitespace cleanup, prompt template, chat rendering, tokens."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillprep.params import ChatFormat, template_parts

# The code points that count as whitespace. Plain \s covers fewer.
WS_LATIN = r"\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0"
WS_WIDE = r"\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
WS_NOT_SPACE = WS_LATIN + WS_WIDE
WS = rf"[\x20{WS_NOT_SPACE}]"

# The same set for Java: listed characters are one table lookup, and the range in front of the
# wide ones settles every other character with one test.
_WS_FAST = rf"[\x20{WS_LATIN}[\x{{1680}}-\x{{3000}}&&[{WS_WIDE}]]]"

# Only runs that change: those that start with another member than the space, or go on.
_RUN_TO_COLLAPSE = rf"{_WS_FAST}(?:(?<!\x20){_WS_FAST}*|{_WS_FAST}+)"
# Each inner run is tried once, at its start, and never backtracked into.
_EDGES = rf"^{_WS_FAST}+|(?<!{_WS_FAST}){_WS_FAST}++\z"

# A turn marker, a word, or one punctuation character.
MARKER_PATTERN = r"<\|[a-z_]+\|>"
TOKEN_PATTERN = rf"{MARKER_PATTERN}|[\p{{L}}\p{{N}}]+|[^\p{{L}}\p{{N}}{WS_NOT_SPACE}\x20]"


def clean_whitespace(text: Column) -> Column:
    """Each whitespace run becomes one space; ends trimmed; no length cut."""
    return F.trim(F.regexp_replace(text, _RUN_TO_COLLAPSE, " "))


def strip_edges(text: Column) -> Column:
    """Drop whitespace at both ends; inner newlines stay."""
    return F.regexp_replace(text, _EDGES, "")


def fill_template(template: str, article: Column) -> Column:
    """Insert the article into the instruction template, byte for byte."""
    parts = template_parts(template)
    return F.concat(*[article if p is None else F.lit(p) for p in parts])


def article_of(prompt: Column, template: str) -> Column:
    """The article a prompt was filled with; the template must use it once."""
    parts = template_parts(template)
    if parts.count(None) != 1:
        raise ValueError("the template must hold {article} once")
    at = parts.index(None)
    before, after = (len("".join(p)) for p in (parts[:at], parts[at + 1 :]))
    return F.substring(prompt, F.lit(before + 1), F.length(prompt) - before - after)


def message(role: str | Column, content: str | Column) -> Column:
    """One chat message as ``struct<role, content>``."""
    as_col = lambda v: v if isinstance(v, Column) else F.lit(v)
    return F.struct(as_col(role).alias("role"), as_col(content).alias("content"))


def render_chat(messages: Column, chat: ChatFormat, open_assistant: bool = True) -> Column:
    """Render an array of messages; optionally open the assistant turn at the end."""
    turns = F.transform(
        messages,
        lambda m: F.concat(
            F.lit(chat.open_left),
            m["role"],
            F.lit(chat.open_right),
            m["content"],
            F.lit(chat.close),
        ),
    )
    header = chat.open_left + chat.assistant_role + chat.open_right if open_assistant else ""
    return F.concat(F.array_join(turns, ""), F.lit(header))


def render_prompt(system_prompt: str, prompt: Column, chat: ChatFormat) -> Column:
    """System turn, user turn, opened assistant turn."""
    return render_chat(F.array(message("system", system_prompt), message("user", prompt)), chat)


def token_strings(text: Column) -> Column:
    """Split a text into the strings the vocabulary is made of."""
    return F.regexp_extract_all(text, F.lit(TOKEN_PATTERN), F.lit(0))


