"""Quality rules as a ledger of failure bits.

``ledger`` measures each text once and evaluates every rule once: measurements and one bit per failed
rule. Policies are masks over those bits, so a new version, or what a rule would change, is bit
arithmetic on the narrow ledger; texts are not read again.

Built-in functions only, no shuffle. A null or empty text has no words, lines or symbols and fails
``few_words`` alone. Null and repeated ids are rows like any other; an empty table gives an empty
result. Input columns beside id and text are not read, so clashing names do no harm.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from quillprep.llm.columns import text_or_empty, words

WINDOW = 5
SYMBOLS = r"[#*$%&|<>]"


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value computed once for a row, however often the body names it."""
    return F.element_at(F.transform(F.array(value), body), 1)


def repeated_words(found: Column, width: int = WINDOW) -> Column:
    """Words inside windows of ``width`` words that occur twice or more, the first one included.

    Equal windows meet by sorting (hash, position); a text whose windows all differ is settled by a
    hash set before that.
    """

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twins(s: Column) -> Column:
            same = lambda p, k: F.coalesce(p["h"] == F.get(s, k)["h"], F.lit(False))
            return F.filter(s, lambda p, k: same(p, k - 1) | same(p, k + 1))

        starts = F.sort_array(F.transform(bind(pairs, twins), lambda p: p["i"]))
        return F.aggregate(
            starts,
            F.struct(F.lit(-width).alias("last"), F.lit(0).alias("total")),
            lambda acc, at: F.struct(
                at.alias("last"), (acc["total"] + F.least(F.lit(width), at - acc["last"])).alias("total")
            ),
            lambda acc: acc["total"],
        )

    def windows(w: Column) -> Column:
        hashes = F.transform(
            F.sequence(F.lit(0), F.size(w) - width), lambda i: F.xxhash64(*[w[i + k] for k in range(width)])
        )
        return bind(hashes, lambda h: F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(h)))

    return bind(found, lambda w: F.when(F.size(w) < width, 0).otherwise(windows(w))).cast("long")


@dataclass(frozen=True)
class Rule:
    """``fails`` is SQL over the measurements; ``bit`` never changes once a ledger is stored."""

    name: str
    bit: int
    fails: str


RULES = (
    Rule("few_words", 0, "n_words < 10"),
    Rule("repeated_words", 1, "100 * n_repeat_words > 20 * n_words"),
    Rule("symbols", 2, "5 * n_symbols > n_words"),
    Rule("repeated_lines", 3, "2 * n_dup_lines > n_lines"),
    Rule("word_length", 4, "word_chars > 15 * n_words"),
    Rule("shouting", 5, "10 * n_exclaim > 3 * n_words"),
    Rule("short_words", 6, "word_chars < 2 * n_words"),
)
BASE = ("few_words", "repeated_words")
# Versions stay as they were published; a change is a new version.
POLICIES = {
    "base": BASE,
    "v1": ("few_words", "repeated_words", "symbols", "repeated_lines", "shouting"),
    "strict": tuple(r.name for r in RULES),
}


def policy_mask(names: tuple[str, ...], rules: tuple[Rule, ...] = RULES) -> int:
    bits = {r.name: r.bit for r in rules}
    return sum(1 << bits[name] for name in set(names))


def measurements(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id`` and the measurements of each text, all as long."""
    text = text_or_empty(text_col)
    return docs.select(F.col(id_col).alias("doc_id"), text.alias("_text"), words(text_col).alias("_words")).select(
        "doc_id",
        bind(
            F.col("_words"),
            lambda w: F.struct(
                F.size(w).cast("long").alias("n_words"),
                F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"),
                repeated_words(w).alias("n_repeat_words"),
            ),
        ).alias("_w"),
        bind(
            F.filter(
                F.split(F.col("_text"), "\n"),
                lambda line: F.regexp_like(line, F.lit(r"[^\x20\x09-\x0D]")),
            ),
            lambda x: F.struct(
                F.size(x).cast("long").alias("n_lines"),
                (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines"),
            ),
        ).alias("_l"),
        F.regexp_count("_text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        F.regexp_count("_text", F.lit("!!")).cast("long").alias("n_exclaim"),
    ).select("doc_id", "_w.*", "_l.*", "n_symbols", "n_exclaim")


def ledger(
    docs: DataFrame, rules: tuple[Rule, ...] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Measurements and ``failed``: bit ``r.bit`` is set where rule ``r`` fails."""
    if len({r.bit for r in rules}) != len(rules) or any(not 0 <= r.bit < 63 for r in rules):
        raise ValueError("rules need different bits from 0 to 62")
    failed = F.lit(0).cast("long")
    for rule in rules:
        failed = failed.bitwiseOR(F.when(F.expr(rule.fails), F.lit(1 << rule.bit)).otherwise(0).cast("long"))
    return measurements(docs, id_col, text_col).withColumn("failed", failed)


def apply_policy(rows: DataFrame, policy: str = "v1", name: str = "kept") -> DataFrame:
    """Add whether a row passes every rule of a policy."""
    mask = F.lit(policy_mask(POLICIES[policy])).cast("long")
    return rows.withColumn(name, F.col("failed").bitwiseAND(mask) == 0)


def ablations(rows: DataFrame, policy: str = "v1", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """For each rule of a policy: rows that fail it, that fail it alone, and that pass without it.

    One pass combines rows by their bits, at most a row per combination; the rest is arithmetic on
    those counts.
    """
    mask = policy_mask(POLICIES[policy], rules)
    by_bits = rows.groupBy(F.col("failed").bitwiseAND(F.lit(mask).cast("long")).alias("bits")).agg(
        F.count("*").alias("n")
    )
    wanted = [r for r in rules if mask >> r.bit & 1]
    each = F.explode(F.array(*[F.struct(F.lit(r.name).alias("rule"), F.lit(1 << r.bit).cast("long").alias("b")) for r in wanted]))
    count = lambda condition, name: F.coalesce(F.sum(F.when(condition, F.col("n"))), F.lit(0)).alias(name)
    return (
        by_bits.withColumn("_r", each)
        .select("bits", "n", "_r.*")
        .groupBy("rule")
        .agg(
            count(F.col("bits").bitwiseAND(F.col("b")) != 0, "failed"),
            count(F.col("bits") == F.col("b"), "failed_alone"),
            count(F.col("bits").bitwiseAND(F.bitwise_not("b")) == 0, "kept_without"),
        )
    )
