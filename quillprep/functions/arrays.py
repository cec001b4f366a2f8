"""Column expressions on token-id arrays: budgets, padding, masks, labels."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from quillprep.params import IGNORE_LABEL


def resolve_pad(pad_id: int | None, eos_id: int) -> int:
    """A tokenizer without a padding token pads with its end token."""
    return eos_id if pad_id is None else pad_id


def cut_prompt(ids: Column, max_len: int, max_target: int) -> Column:
    """Keep the head of the prompt, leaving the target's reserved budget."""
    return F.slice(ids, 1, max_len - max_target)


def cut_target(ids: Column, prompt_ids: Column, eos_id: int, max_len: int) -> Column:
    """Append the end token, then cut to the room the prompt left."""
    with_eos = F.concat(ids, F.array(F.lit(eos_id)))
    return F.slice(with_eos, F.lit(1), F.lit(max_len) - F.size(prompt_ids))


def _room(prompt_ids: Column, target_ids: Column, max_len: int) -> Column:
    return F.lit(max_len) - F.size(prompt_ids) - F.size(target_ids)


def pack_ids(prompt_ids: Column, target_ids: Column, pad_id: int, max_len: int) -> Column:
    """Prompt, target, right padding."""
    padding = F.array_repeat(F.lit(pad_id), _room(prompt_ids, target_ids, max_len))
    return F.concat(prompt_ids, target_ids, padding)


def attention_mask(prompt_ids: Column, target_ids: Column, max_len: int) -> Column:
    """1 on tokens, 0 on padding."""
    used = F.size(prompt_ids) + F.size(target_ids)
    return F.concat(
        F.array_repeat(F.lit(1), used),
        F.array_repeat(F.lit(0), _room(prompt_ids, target_ids, max_len)),
    )


def label_ids(prompt_ids: Column, target_ids: Column, max_len: int) -> Column:
    """The target's ids; prompt and padding ignored, by position and never by id."""
    ignore = F.lit(IGNORE_LABEL)
    return F.concat(
        F.array_repeat(ignore, F.size(prompt_ids)),
        target_ids,
        F.array_repeat(ignore, _room(prompt_ids, target_ids, max_len)),
    )


def fully_masked(labels: Column) -> Column:
    """True where no label carries a learning signal."""
    return F.forall(labels, lambda x: x == IGNORE_LABEL)


def drop_prefix(ids: Column, prefix_len: Column) -> Column:
    """The generated part of a sequence that starts with its prompt."""
    return F.slice(ids, prefix_len + 1, F.size(ids))
