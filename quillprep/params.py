"""Job parameters: frozen dataclasses, validated once and passed explicitly."""

from __future__ import annotations

import string
from dataclasses import dataclass, field

SPLITS = ("train", "validation", "test")

# Texts and numbers a run must share with earlier runs to give equal results.
SYSTEM_PROMPT = (
    "You are a helpful assistant that writes concise, accurate summaries of news articles."
)
INSTRUCTION_TEMPLATE = "Summarize the following news article.\n\nArticle:\n{article}"
SEED = 42
SPLIT_SIZES = {"train": 10_000, "validation": 500, "test": 500}
MAX_SEQ_LENGTH = 512
MAX_TARGET_LENGTH = 256
IGNORE_LABEL = -100
BATCH_SIZE = 1
ACCUMULATION_STEPS = 16
EVAL_NUM_SAMPLES = 500
SPOT_CHECK_SAMPLES = 30
MAX_NEW_TOKENS = 128
ROUGE_TYPES = ("rouge1", "rouge2", "rougeL")


@dataclass(frozen=True)
class ChatFormat:
    """Turn markers. The defaults are neutral; pass the markers of your own model."""

    open_left: str = "<|"
    open_right: str = "|>\n"
    close: str = "<|end|>\n"
    assistant_role: str = "assistant"


def template_parts(template: str) -> list[str | None]:
    """Split a format string at its ``{article}`` fields; ``None`` stands for the article.

    ``{{`` and ``}}`` are read as literal braces.
    """
    parts: list[str | None] = []
    for literal, name, spec, conversion in string.Formatter().parse(template):
        if literal:
            parts.append(literal)
        if name is None:
            continue
        if name != "article" or spec or conversion:
            raise ValueError(f"instruction template may only use {{article}}, found {name!r}")
        parts.append(None)
    if None not in parts:
        raise ValueError("instruction template has no {article} field")
    return parts


@dataclass(frozen=True)
class PrepParams:
    """Parameters of loading, sampling, rendering and encoding."""

    key_col: str = "id"
    article_col: str = "article"
    summary_col: str = "highlights"
    seed: int = SEED
    split_sizes: dict[str, int | None] = field(default_factory=lambda: dict(SPLIT_SIZES))
    on_null: str = "fail"
    null_tokens: tuple[str, ...] = ()
    system_prompt: str = SYSTEM_PROMPT
    instruction_template: str = INSTRUCTION_TEMPLATE
    chat: ChatFormat = field(default_factory=ChatFormat)
    vocab_size: int = 5_000
    max_len: int = MAX_SEQ_LENGTH
    max_target: int = MAX_TARGET_LENGTH
    eos_id: int = 2
    pad_id: int | None = None
    cut: str = "prompt"
    batch_size: int = BATCH_SIZE
    accumulation: int = ACCUMULATION_STEPS

    def __post_init__(self) -> None:
        if self.on_null not in ("fail", "drop"):
            raise ValueError("on_null must be 'fail' or 'drop'")
        if self.cut not in ("prompt", "article"):
            raise ValueError("cut must be 'prompt' or 'article'")
        if not 1 <= self.max_target <= self.max_len:
            raise ValueError("need 1 <= max_target <= max_len")
        if self.vocab_size < 1:
            raise ValueError("vocab_size must be positive")
        if self.batch_size < 1 or self.accumulation < 1:
            raise ValueError("batch_size and accumulation must be positive")
        if any(n is not None and n < 0 for n in self.split_sizes.values()):
            raise ValueError("split sizes must not be negative")
        template_parts(self.instruction_template)


# Token patterns for scoring.
SCORE_PATTERNS = {"english": "[a-z0-9]+", "unicode": r"[\p{L}\p{N}]+"}


@dataclass(frozen=True)
class EvalParams:
    """Parameters of generation and scoring."""

    num_samples: int = EVAL_NUM_SAMPLES
    max_new_tokens: int = MAX_NEW_TOKENS
    rouge_types: tuple[str, ...] = ROUGE_TYPES
    use_stemmer: bool = True
    pattern: str = "english"
    rows_per_commit: int = 100_000

    def __post_init__(self) -> None:
        unknown = [r for r in self.rouge_types if r not in ROUGE_TYPES]
        if unknown or not self.rouge_types:
            raise ValueError(f"rouge_types must be a non-empty subset of {ROUGE_TYPES}")
        if self.pattern not in SCORE_PATTERNS:
            raise ValueError(f"pattern must be one of {sorted(SCORE_PATTERNS)}")
        if self.num_samples < 0 or self.max_new_tokens < 0 or self.rows_per_commit < 1:
            raise ValueError("num_samples, max_new_tokens must be >= 0, rows_per_commit >= 1")
