"""Toxicity scores of text restored by a noisy-channel decoder.

Writers hide words by leetspeak, spacing and repeated letters. A token that looks so is read as a
lattice: each character may stand for itself, for the letters it imitates, for a gap or for nothing.
Viterbi search finds the reading that a character trigram model of the corpus and the channel's
costs together make likeliest. The restored words, and their beginnings, are the features of a
logistic regression.

The language model counts trigrams over all documents; its size is bounded by the alphabet. The
regression is fitted to at most ``sample`` labelled rows, chosen by a hash of their ids; labels of
held-out rows are never read. Scoring is map-only.

Defined results: null and empty texts score as a text without features. Rows with a null id are
scored and never trained on. A label row with a null id or label is left out; of repeated label rows
the largest label counts. Without any usable label every score is 0. Repeated rows are scored like any
other; of rows with the same id the smallest text is learned from. An empty table gives an empty
result, and columns beside id and text are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field
from zlib import crc32

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from quillprep.llm.arrow import Lists, filter_rows, map_lists
from quillprep.session import cut_lineage

# Which letters a character may imitate.
IMITATES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "il", "|": "il", "+": "t", "(": "c", "€": "e", "£": "l",
}
# Letters with a class of their own beside a to z; all others share one.
ACCENTED = "àáâãäåæçèéêëìíîïñòóôõöøœùúûüýÿß"
_LETTERS = "abcdefghijklmnopqrstuvwxyz" + ACCENTED
_CLASS = {c: k + 1 for k, c in enumerate(_LETTERS)}
OTHER = len(_LETTERS) + 1
SIZE = OTHER + 1
_TABLE = np.array([_CLASS.get(chr(c), OTHER if chr(c).isalpha() else 0) for c in range(0x10000)], np.int64)

# Costs of the channel, as log probabilities.
IMITATED, DROPPED_REPEAT, DROPPED_GAP, KEPT_GAP, KEPT_OTHER = -1.5, -1.0, -0.5, -1.5, -8.0
# A sign that may be a letter is not passed over as lightly as a dot.
DROPPED_SIGN = -5.0

_EDGE = re.compile(r"^[^\w$@]+|[^\w$@]+$|^([$@])\1{2,}|([$@])\2{2,}$")
_LONG_RUN = re.compile(r"(.)\1\1")
_RUN = re.compile(r"(.)\1+")
# \S apart, with its neighbours: "s t u p i d"
_SPACED = re.compile(r"(?<!\S)\S(?:\s{1,3}\S){3,}(?!\S)")
_CACHED = 1 << 17
# Characters that are counted at once: numbers of several bytes for each are held.
_COUNTED_AT_ONCE = 1 << 20


def letter_class(c: str) -> int:
    return _CLASS.get(c) or (OTHER if c.isalpha() else 0)


def trigram_counts(texts: list[str | None]) -> np.ndarray:
    """Counts of letter-class trigrams in lower-cased texts; class 0 is whatever is no letter."""
    flat = "  ".join(t.lower() for t in texts if t).encode("utf-32-le", "surrogatepass")
    points = np.frombuffer(flat, np.uint32)
    c = np.where(points < 0x10000, _TABLE[np.minimum(points, 0xFFFF)], OTHER)
    return np.bincount((c[:-2] * SIZE + c[1:-1]) * SIZE + c[2:], minlength=SIZE**3) if len(c) > 2 else np.zeros(SIZE**3, np.int64)


def corpus_trigrams(docs: DataFrame, text_col: str = "text") -> np.ndarray:
    """Trigram counts of all texts: added up in each task, then over tasks; at most SIZE^3 numbers."""

    def count(batches: Iterator[Lists]) -> Iterator[Lists]:
        total = np.zeros(SIZE**3, np.int64)
        for b in batches:
            part, held = [], 0
            for text in b["text"]:
                part.append(text)
                held += len(text or "")
                if held >= _COUNTED_AT_ONCE:
                    total += trigram_counts(part)
                    part, held = [], 0
            total += trigram_counts(part)
        at = np.flatnonzero(total)
        yield {"gram": at, "n": total[at]}

    parts = map_lists(docs.select(F.col(text_col).alias("text")), count, "gram int, n long")
    found = parts.groupBy("gram").agg(F.sum("n").alias("n")).toArrow()
    counts = np.zeros(SIZE**3, np.int64)
    counts[found["gram"].to_numpy()] = found["n"].to_numpy()
    return counts


class Decoder:
    """Viterbi search over the lattice of a token, under an interpolated trigram model."""

    def __init__(self, counts: np.ndarray, weight: float = 5.0) -> None:
        three = counts.reshape(SIZE, SIZE, SIZE).astype(np.float64)
        two, one = three.sum(axis=0), three.sum(axis=(0, 1))
        p1 = (one + 1.0) / (one.sum() + SIZE)
        p2 = (two + weight * p1) / (two.sum(axis=1, keepdims=True) + weight)
        p3 = (three + weight * p2) / (three.sum(axis=2, keepdims=True) + weight)
        self.log = np.log(p3).ravel().tolist()

    def restore(self, token: str) -> str:
        """The likeliest reading of a lower-cased token, which may hold spaces; words joined by one space.

        A state is the last two letter classes. It keeps its score and a chain of back pointers, a pair of what came
        before and a character, which is read once at the end. Where a single state is left, all readings agree so far:
        the chain is read and begins anew, so it stays short except over stretches of doubt.
        """
        log = self.log
        settled: list[str] = []
        # a chain without a before is settled; its character is the last one of the text
        states: dict[tuple[int, int], tuple[float, _Chain]] = {(0, 0): (0.0, (None, ""))}
        for c in token:
            letter = c.isalpha()
            if len(states) == 1:
                (((a, b), (score, chain)),) = states.items()
                if chain[0] is not None:
                    settled.append(_read(chain))
                    chain = (None, chain[1])
                    states = {(a, b): (score, chain)}
                if letter and chain[1] != c:
                    k = letter_class(c)
                    settled.append(c)
                    states = {(b, k): (score + 0.0 + log[(a * SIZE + b) * SIZE + k], (None, c))}
                    continue
            following: dict[tuple[int, int], tuple[float, _Chain]] = {}

            def offer(state: tuple[int, int], score: float, chain: _Chain, following=following) -> None:
                held = following.get(state)
                if held is None or score > held[0]:
                    following[state] = score, chain

            emits = [(c, 0.0)] if letter else [(x, IMITATED) for x in IMITATES.get(c, "")]
            for (a, b), (score, chain) in states.items():
                for x, cost in emits:
                    k = letter_class(x)
                    offer((b, k), score + cost + log[(a * SIZE + b) * SIZE + k], (chain, x))
                    if b == k and chain[1] == x:
                        offer((a, b), score + cost + DROPPED_REPEAT, chain)
                if not letter:
                    if not c.isdigit():
                        offer((a, b), score + (DROPPED_SIGN if emits else DROPPED_GAP), chain)
                    gap = KEPT_OTHER if c.isdigit() else DROPPED_SIGN if emits else KEPT_GAP
                    if b:
                        offer((b, 0), score + gap + log[(a * SIZE + b) * SIZE], (chain, " "))
                    else:
                        offer((a, b), score + gap, chain)
            states = following
        ended = [(score + (log[(a * SIZE + b) * SIZE] if b else 0.0), chain) for (a, b), (score, chain) in states.items()]
        if not ended:
            return ""
        best = max(score for score, _ in ended)
        settled.append(max(_read(chain) for score, chain in ended if score == best))
        return " ".join("".join(settled).split())


_Chain = tuple["_Chain | None", str]


def _read(chain: _Chain) -> str:
    """The characters of a chain that are not settled yet."""
    out = []
    while chain[0] is not None:
        out.append(chain[1])
        chain = chain[0]
    return "".join(reversed(out))


def collapse(word: str) -> str:
    """Runs of a letter as one, so doubled letters do not hide a word."""
    return _RUN.sub(r"\1", word)


class Reader:
    """Features of texts. Tokens are read once and remembered up to a number of them."""

    def __init__(self, decoder: Decoder, prefixes: tuple[int, ...], bits: int, wanted: dict[int, int] | None = None) -> None:
        self.decoder, self.prefixes, self.mask, self.wanted = decoder, prefixes, (1 << bits) - 1, wanted
        self.seen: dict[str, tuple[int, ...]] = {}

    def restored(self, token: str) -> str:
        """A lower-cased token as words; clean ones come back as they are, without outer punctuation."""
        core = _EDGE.sub("", token)
        if core.isalpha() and not _LONG_RUN.search(core):
            return core
        if not any(map(str.isalpha, core)):
            return ""
        return self.decoder.restore(core)

    def features_of(self, words: str) -> tuple[int, ...]:
        out = set()
        for word in map(collapse, words.split()):
            out.add(crc32(word.encode("utf-8", "surrogatepass")) & self.mask)
            for n in self.prefixes:
                if len(word) > n:
                    out.add(crc32(f"^{word[:n]}".encode("utf-8", "surrogatepass")) & self.mask)
        if self.wanted is not None:
            return tuple(self.wanted[f] for f in out if f in self.wanted)
        return tuple(out)

    def features(self, text: str | None) -> set[int]:
        lowered = (text or "").lower()
        found: set[int] = set()
        seen = self.seen
        for token in set(lowered.split()):
            known = seen.get(token)
            if known is None:
                if len(seen) >= _CACHED:
                    seen.clear()
                known = seen[token] = self.features_of(self.restored(token))
            if known:
                found.update(known)
        for run in _SPACED.finditer(lowered):
            found.update(self.features_of(self.decoder.restore(" ".join(run[0].split()))))
        return found


@dataclass(frozen=True)
class ToxicityParams:
    """``sample`` bounds the labelled rows that are fitted; features are hashed to ``bits`` bits.

    A feature is used if at least ``min_toxic`` toxic sample rows have it and their share among its
    rows is, with a margin of two standard errors, ``lift`` times the overall one.
    """

    sample: int = 20_000
    bits: int = 20
    prefixes: tuple[int, ...] = (4, 5)
    min_toxic: int = 3
    lift: float = 2.0
    penalty: float = 0.02
    rounds: int = 1_000
    threshold: float = 0.3
    held_out: tuple[int, int] = field(default=(4, 2))


def is_held_out(doc_id: Column, params: ToxicityParams) -> Column:
    modulus, rest = params.held_out
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % modulus == rest, F.lit(False))


class Model:
    """Decoder, features in use, their weights and the intercept."""

    def __init__(self, decoder: Decoder, params: ToxicityParams, wanted: dict[int, int], weights: np.ndarray, bias: float) -> None:
        self.decoder, self.params, self.wanted, self.weights, self.bias = decoder, params, wanted, weights, bias

    def reader(self) -> Reader:
        return Reader(self.decoder, self.params.prefixes, self.params.bits, self.wanted)

    def score(self, reader: Reader, text: str | None) -> float:
        total = self.bias + float(self.weights[sorted(reader.features(text))].sum())
        return float(1.0 / (1.0 + np.exp(-np.clip(total, -500, 500))))


def fit_weights(labels: np.ndarray, rows: np.ndarray, columns: np.ndarray, width: int, params: ToxicityParams) -> tuple[np.ndarray, float]:
    """Logistic regression with a quadratic penalty on binary features.

    Accelerated gradient steps; each weight's step follows from a bound on its curvature: the
    intercept and the other features that its rows have.
    """
    n = len(labels)
    rate = labels.mean()
    if rate in (0.0, 1.0):
        return np.zeros(width), -500.0 if rate == 0 else 500.0
    weights = momentum = np.zeros(width)
    bias = ahead = float(np.log(rate / (1 - rate)))
    per_row = np.bincount(rows, minlength=n) + 1.0
    step = 1.0 / (0.25 * np.bincount(columns, per_row[rows], minlength=width) + params.penalty)
    bias_step = 1.0 / (0.25 * per_row.sum())
    for t in range(params.rounds):
        z = ahead + np.bincount(rows, momentum[columns], minlength=n)
        wrong = 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500))) - labels
        grad = np.bincount(columns, wrong[rows], minlength=width) + params.penalty * momentum
        new, new_bias = momentum - step * grad, ahead - bias_step * wrong.sum()
        share = t / (t + 3.0)
        momentum, ahead = new + share * (new - weights), new_bias + share * (new_bias - bias)
        weights, bias = new, new_bias
    return weights, float(bias)


def train(docs: DataFrame, labels: DataFrame, params: ToxicityParams = ToxicityParams(), id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> Model:
    """Language model over all documents, regression over a bounded sample of labelled ones."""
    spark = docs.sparkSession
    decoder = Decoder(corpus_trigrams(docs, text_col))
    usable = (
        labels.select(F.col(id_col).alias("doc_id"), F.col(label_col).cast("int").alias("label"))
        .filter(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & ~is_held_out(F.col("doc_id"), params))
        .groupBy("doc_id")
        .agg(F.max("label").alias("label"))
    )
    chosen = usable.orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample)
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    # a row for each id, so that repeated ids cannot outgrow the bound
    once = texts.join(F.broadcast(chosen), "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    sample = once.select("text", "label")
    shared = spark.sparkContext.broadcast(decoder)

    def read(batches: Iterator[Lists]) -> Iterator[Lists]:
        reader = Reader(shared.value, params.prefixes, params.bits)
        for b in batches:
            yield {"label": b["label"], "features": [sorted(reader.features(t)) for t in b["text"]]}

    found = cut_lineage(map_lists(sample, read, "label int, features array<int>"))
    n, toxic_rows = found.agg(F.count("*"), F.coalesce(F.count_if(F.col("label") > 0), F.lit(0))).head()
    if not n:
        return Model(decoder, params, {}, np.zeros(0), -500.0)
    used = _used_features(found, toxic_rows / n, params)
    wanted = frozenset(used)

    def pick(batches: Iterator[Lists]) -> Iterator[Lists]:
        for b in batches:
            yield {"label": b["label"], "features": [[f for f in own if f in wanted] for own in b["features"]]}

    # only what is fitted comes to the driver
    fitted = map_lists(found, pick, "label int, features array<int>").toArrow()
    y = (fitted["label"].to_numpy() > 0).astype(np.float64)
    lists = fitted["features"].combine_chunks()
    place = np.full(1 << params.bits, -1)
    place[used] = np.arange(len(used))
    rows = np.repeat(np.arange(len(y)), np.diff(lists.offsets.to_numpy()))
    weights, bias = fit_weights(y, rows, place[lists.values.to_numpy()], len(used), params)
    return Model(decoder, params, {f: k for k, f in enumerate(used)}, weights, bias)


def _used_features(sample: DataFrame, rate: float, params: ToxicityParams) -> list[int]:
    """Features that ``params`` lets into the regression, counted where the rows lie; ``rate`` of all rows are toxic."""
    each = sample.select((F.col("label") > 0).alias("toxic"), F.explode("features").alias("feature"))
    counted = each.groupBy("feature").agg(F.count("*").alias("have"), F.count_if("toxic").alias("toxic"))
    found = counted.filter(F.col("toxic") >= params.min_toxic).toArrow()
    have, toxic = (found[c].to_numpy().astype(np.float64) for c in ("have", "toxic"))
    share = toxic / have
    low = share - 2 * np.sqrt((share * (1 - share) + 0.25 / have) / have)
    return np.sort(found["feature"].to_numpy()[low > params.lift * rate]).tolist()


def score(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, score`` for each row; nothing but the text enters the score."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[Lists]) -> Iterator[Lists]:
        reader = shared.value.reader()
        for b in batches:
            yield {"doc_id": b["doc_id"], "score": [shared.value.score(reader, t) for t in b["text"]]}

    return map_lists(rows, run, f"doc_id {rows.schema['doc_id'].dataType.simpleString()}, score double")


def clean_documents(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows that score under the threshold, with all their columns, judged where they lie."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def judge():
        reader = shared.value.reader()
        return lambda text: shared.value.score(reader, text) < shared.value.params.threshold

    return filter_rows(docs, text_col, judge)
