"""Personal data by weak supervision.

Strict patterns give the base spans. Wider shapes give further candidates: addresses with a spelled
at or dot, numbers in other groupings, numbers that fail a check. Labelers vote for or against each
candidate or abstain: the strict pattern, a validity check, a gazetteer, the words before it, and
its edges. Expectation-maximisation estimates from all votes of the corpus how reliable each labeler
is; its posteriors are the soft labels on which a logistic span classifier over shape features is
trained. Candidates that it accepts and that overlap no base span are added; base spans stay.

Texts are read once, whole. Votes and features take few values, so what is gathered for training
are counts of their combinations: a number of rows bounded by the labelers, not by the corpus.

Defined results: null and empty texts have no spans. Null and repeated ids are rows like any other.
An empty table gives an empty result. Columns beside id and text are not read. Offsets are code
points, the end exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from quillprep.llm.arrow import Lists, map_lists
from quillprep.session import cut_lineage

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")

_SPELLED_AT = re.compile(r"\x20?[(\[{]\x20?at\x20?[)\]}]\x20?", re.IGNORECASE)
_SPELLED_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:(?:\.|\x20?[(\[{]\x20?dot\x20?[)\]}]\x20?)[A-Za-z0-9-]+)+", re.IGNORECASE)
_SPELLED_IP = re.compile(r"(?<![0-9])[0-9]{1,3}(?:(?:\[\.\]|\(\.\))[0-9]{1,3}){3}(?![0-9])")
_GROUPS = re.compile(r"(?<![0-9A-Za-z])\(?[0-9]+\)?(?:[\x20./_-]{1,2}\(?[0-9]+\)?)+(?![0-9A-Za-z])")

# Gazetteers: fixed values.
TOP_LEVELS = frozenset("com org net edu gov mil int info biz io eu uk de fr es it nl us ca au example".split())
COUNTRY_CODES = frozenset("1 7 20 27 30 31 32 33 34 36 39 40 41 43 44 45 46 47 48 49 51 52 54 55 56 57 60 61 62 63 64 65 66 81 82 84 86 90 91 92 351 352 353 358".split())
ISSUERS = ("4", "51", "52", "53", "54", "55", "34", "37", "6011", "65", "35", "36", "38", "62", "22", "23", "24", "25", "26", "27")
CONTEXT = {
    "email": frozenset("email e-mail mail correo courriel mailto contact contacto kontakt write".split()),
    "ip": frozenset("ip ipv4 host server address adresse dirección direccion serveur servidor".split()),
    "card": frozenset("card visa mastercard amex credit karte kreditkarte carte tarjeta iban payment".split()),
    "phone": frozenset("phone tel telephone call fax mobile cell telefon anruf téléphone telefono teléfono llamar".split()),
}
AGAINST = frozenset("version isbn issn order invoice sku id no nr section chapter release build serial page".split())


def luhn(digits: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(digits)):
        d = int(c) * (1 + k % 2)
        total += d - 9 if d > 9 else d
    return total % 10 == 0


def digits_of(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """``(start, kind, end)`` of the strict patterns, leftmost and non-overlapping by kind, sorted."""
    out = []
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        right = _DOMAIN.match(text, at + 1) if start < at else None
        if right:
            out.append((start, 0, right.end()))
            free = right.end()
        # what lies left of an unmatched sign can belong to no later match, as locals hold no sign
        at, free = text.find("@", max(at + 1, free)), max(free, at + 1)
    if _DIGIT.search(text):
        for m in _IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split(".")):
                out.append((m.start(), 1, m.end()))
        for m in _CARD.finditer(text):
            if 12 <= len(found := digits_of(m[0])) <= 19 and luhn(found):
                out.append((m.start(), 2, m.end()))
        for m in _PHONE.finditer(text):
            if 9 <= len(digits_of(m[0])) <= 15:
                out.append((m.start(), 3, m.end()))
    return sorted(out)


def wide_spans(text: str) -> list[tuple[int, int, int]]:
    """Candidates beyond the strict patterns, as ``(start, kind, end)``."""
    out = []
    if "at" in text or "AT" in text or "At" in text:
        for m in _SPELLED_AT.finditer(text):
            start = m.start()
            while start and text[start - 1] in _LOCAL_CHARS:
                start -= 1
            right = _SPELLED_DOMAIN.match(text, m.end())
            if start < m.start() and right:
                out.append((start, 0, right.end()))
    if _DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in _SPELLED_IP.finditer(text)]
        out += [(m.start(), 1, m.end()) for m in _IP.finditer(text)]
        for m in _CARD.finditer(text):
            if 12 <= len(digits_of(m[0])) <= 19:
                out.append((m.start(), 2, m.end()))
        for m in _GROUPS.finditer(text):
            n = len(digits_of(m[0]))
            if 12 <= n <= 19:
                out.append((m.start(), 2, m.end()))
            if 9 <= n <= 15:
                out.append((m.start(), 3, m.end()))
    return out


def votes(text: str, start: int, kind: int, end: int, base: bool) -> tuple[int, ...]:
    """One vote for each labeler: 1 for, -1 against, 0 abstains."""
    span, digits = text[start:end], digits_of(text[start:end])
    if kind == 0:
        last = re.split(r"[^A-Za-z0-9-]+", span.strip(")]} "))[-1].lower()
        check, gazetteer = (1 if last.isalpha() and len(last) > 1 else -1), (1 if last in TOP_LEVELS else 0)
    elif kind == 1:
        parts = re.findall(r"[0-9]+", span)
        check = 1 if all(len(p) <= 3 and int(p) <= 255 for p in parts) else -1
        gazetteer = 1 if len(parts[0]) <= 3 and 1 <= int(parts[0]) <= 223 else -1
    elif kind == 2:
        check, gazetteer = (1 if luhn(digits) else -1), (1 if digits.startswith(ISSUERS) else -1)
    else:
        check = 1 if 10 <= len(digits) <= 13 else -1
        plus = span.startswith("+") or digits.startswith("00")
        code = digits.lstrip("0")
        gazetteer = 1 if plus and any(code[:n] in COUNTRY_CODES for n in (1, 2, 3)) else 0
    before = re.findall(r"[\w-]+", text[max(0, start - 40) : start].lower())[-4:]
    context = 1 if CONTEXT[KINDS[kind]] & set(before) else -1 if AGAINST & set(before) else 0
    left, right = text[start - 1 : start] if start else "", text[end : end + 1]
    joined = left.isalnum() or right.isalnum() or left in ("_", "=", "$", "€") or right in ("%", "_")
    return (1 if base else 0, check, gazetteer, context, -1 if joined else 1)


def shape(text: str, start: int, kind: int, end: int) -> tuple[int, ...]:
    """Features of the classifier: small whole numbers that say how a span looks."""
    span, digits = text[start:end], digits_of(text[start:end])
    left, right = text[start - 1 : start] if start else " ", text[end : end + 1] or " "
    return (
        min(4, len(digits) // 4),
        int(span[0] == "+"),
        sum(1 << k for k, c in enumerate(" -.([@") if c in span),
        int(left.isspace()) + 2 * int(right.isspace() or right in ".,;:!?"),
        int(luhn(digits)) if kind == 2 else int(max([len(p) for p in re.findall(r"[0-9]+", span)] or [0]) <= 4),
    )


def candidates(text: str | None) -> list[dict]:
    """All candidates of a text, base spans marked; the same span once for a kind."""
    text = text or ""
    base = base_spans(text)
    marked = set(base)
    return [
        {"start": s, "kind": k, "end": e, "base": (s, k, e) in marked, "votes": list(votes(text, s, k, e, (s, k, e) in marked)), "shape": list(shape(text, s, k, e))}
        for s, k, e in sorted(marked.union(wide_spans(text)))
    ]


FOUND = "found array<struct<start:int,kind:int,end:int,base:boolean,votes:array<int>,shape:array<int>>>"


@dataclass(frozen=True)
class PiiParams:
    """``prior`` counts hold a labeler right at first; ``threshold`` is the classifier's."""

    rounds: int = 50
    prior: float = 5.0
    steps: int = 500
    penalty: float = 1.0
    threshold: float = 0.5


def estimate(vote_rows: np.ndarray, counts: np.ndarray, params: PiiParams) -> np.ndarray:
    """Expectation-maximisation over vote patterns; the chance that each pattern's span is real.

    Every labeler has a distribution over its three votes for real and for other spans. Prior counts
    lean towards labelers being right, which keeps the two classes from changing places.
    """
    lean = np.array([[3.0, 2.0, 1.0], [1.0, 2.0, 3.0]]) / 6.0 * params.prior  # class x vote
    posterior = np.clip(0.5 + vote_rows.sum(axis=1) / 8.0, 0.05, 0.95)
    for _ in range(params.rounds):
        weight = np.stack([(1 - posterior) * counts, posterior * counts])
        prior = (weight.sum(axis=1) + 1.0) / (counts.sum() + 2.0)
        log = np.log(prior)[:, None].repeat(len(counts), axis=1)
        for j in range(vote_rows.shape[1]):
            chance = lean.copy()
            for v in (-1, 0, 1):
                chance[:, v + 1] += weight[:, vote_rows[:, j] == v].sum(axis=1)
            chance /= chance.sum(axis=1, keepdims=True)
            log += np.log(chance)[:, vote_rows[:, j] + 1]
        posterior = 1.0 / (1.0 + np.exp(np.clip(log[0] - log[1], -500, 500)))
    return posterior


def _encode(kind: int, shapes: tuple[int, ...], place: dict) -> list[int]:
    return [place[f] for f in [("kind", kind), *(("shape", kind, i, s) for i, s in enumerate(shapes))] if f in place]


class SpanClassifier:
    """Logistic regression on one-hot shapes, fitted to soft labels with their counts."""

    def __init__(self, rows: list[tuple[int, tuple[int, ...], float, float]], params: PiiParams) -> None:
        self.place: dict = {}
        for kind, shapes, _, _ in rows:
            for f in [("kind", kind), *(("shape", kind, i, s) for i, s in enumerate(shapes))]:
                self.place.setdefault(f, len(self.place))
        x = np.zeros((len(rows), len(self.place)))
        for r, (kind, shapes, _, _) in enumerate(rows):
            x[r, _encode(kind, shapes, self.place)] = 1.0
        target, count = np.array([r[2] for r in rows]), np.array([r[3] for r in rows])
        self.weights = np.zeros(len(self.place))
        for _ in range(params.steps if len(rows) else 0):
            p = 1.0 / (1.0 + np.exp(-x @ self.weights))
            curve = (x * (count * 0.25 * x.sum(axis=1))[:, None]).sum(axis=0) + params.penalty
            self.weights -= (x.T @ (count * (p - target)) + params.penalty * self.weights) / curve

    def chance(self, kind: int, shapes: tuple[int, ...]) -> float:
        return float(1.0 / (1.0 + np.exp(-self.weights[_encode(kind, shapes, self.place)].sum())))


def train(found: DataFrame, params: PiiParams) -> dict[tuple[int, tuple[int, ...]], float]:
    """The classifier's chance for each kind and shape that occurs."""
    each = found.select(F.explode("found").alias("s")).select("s.kind", "s.votes", "s.shape")
    rows = each.groupBy("kind", "votes", "shape").agg(F.count("*").alias("n")).collect()
    soft = []
    for kind in range(len(KINDS)):
        own = sorted((r for r in rows if r.kind == kind), key=lambda r: (r.votes, r.shape))
        if own:
            chances = estimate(np.array([r.votes for r in own]), np.array([float(r.n) for r in own]), params)
            soft += [(kind, tuple(r.shape), float(p), float(r.n)) for r, p in zip(own, chances, strict=True)]
    model = SpanClassifier(soft, params)
    return {(kind, shapes): model.chance(kind, shapes) for kind, shapes, _, _ in soft}


class Taken:
    """Stretches of a text that spans hold, merged and in order."""

    def __init__(self, spans: Iterable[tuple[int, int]]) -> None:
        self.starts: list[int] = []
        self.ends: list[int] = []
        for start, end in sorted(spans):
            if self.ends and start < self.ends[-1]:
                self.ends[-1] = max(self.ends[-1], end)
            else:
                self.starts.append(start)
                self.ends.append(end)

    def add(self, start: int, end: int) -> bool:
        """Take a stretch if nothing in it is taken. Only the last one that begins before its end can reach into it."""
        at = bisect_left(self.starts, end)
        if at and self.ends[at - 1] > start:
            return False
        self.starts.insert(at, start)
        self.ends.insert(at, end)
        return True


def find(docs: DataFrame, params: PiiParams = PiiParams(), id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, base, added`` for each row: lists of ``(start, kind, end)``."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    id_type = rows.schema["doc_id"].dataType.simpleString()

    def scan(batches: Iterator[Lists]) -> Iterator[Lists]:
        for b in batches:
            yield {"doc_id": b["doc_id"], "found": [candidates(t) for t in b["text"]]}

    found = cut_lineage(map_lists(rows, scan, f"doc_id {id_type}, {FOUND}"))
    chances = docs.sparkSession.sparkContext.broadcast(train(found, params))
    span = "array<struct<start:int,kind:int,end:int>>"

    def decide(batches: Iterator[Lists]) -> Iterator[Lists]:
        for b in batches:
            base, added = [], []
            for spans in b["found"]:
                own = [(s["start"], s["kind"], s["end"]) for s in spans if s["base"]]
                taken, more = Taken((s, e) for s, _, e in own), []
                likely = [(chances.value.get((s["kind"], tuple(s["shape"])), 0.0), s) for s in spans if not s["base"]]
                for p, s in sorted(likely, key=lambda x: (-x[0], x[1]["start"], x[1]["kind"])):
                    if p >= params.threshold and taken.add(s["start"], s["end"]):
                        more.append((s["start"], s["kind"], s["end"]))
                as_rows = lambda xs: [{"start": s, "kind": k, "end": e} for s, k, e in sorted(xs)]
                base.append(as_rows(own))
                added.append(as_rows(more))
            yield {"doc_id": b["doc_id"], "base": base, "added": added}

    return map_lists(found, decide, f"doc_id {id_type}, base {span}, added {span}")


def named(spans: str) -> Column:
    """``kind:start:end`` of a column of spans, in order, joined by commas."""
    kinds = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", F.get(kinds, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))), ","
    )
