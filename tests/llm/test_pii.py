import random
import re
import time

import numpy as np
import pytest

from quillprep.llm.pii import KINDS, PiiParams, Taken, base_spans, candidates, digits_of, estimate, find, luhn

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def plain(text):
    out = []
    for kind, pattern in enumerate(PATTERNS):
        for m in re.finditer(pattern, text):
            n = len(digits_of(m[0]))
            fine = (
                True,
                all(int(p) <= 255 for p in m[0].split(".")) if kind == 1 else True,
                12 <= n <= 19 and luhn(m[0].replace(" ", "").replace("-", "")) if kind == 2 else True,
                9 <= n <= 15,
            )[kind]
            if fine:
                out.append((m.start(), kind, m.end()))
    return sorted(out)


def test_base_spans_against_the_patterns():
    rng = random.Random(1)
    texts = ["".join(rng.choice("a@.0125+- (") for _ in range(rng.randrange(30))) for _ in range(20_000)]
    texts += ["é x.y@a.b.c@d.e +1 (477) 555-4197 4111 1111 1111 1111 10.0.0.256 1.2.3.4.5.6.7.8", "9" * 20_000, "a" * 20_000 + "@" * 50]
    for text in texts:
        assert base_spans(text) == plain(text)


def test_base_spans_stay_and_others_are_added(docs_of):
    rows = []
    for i in range(60):
        rows.append((i, f"mail a{i}@mail.example.com or call +1 (477) 555-{1000 + i} now, host 10.0.0.{i} and card 4111 1111 1111 1111 ok"))
        rows.append((1000 + i, f"email bob{i} (at) mail (dot) example (dot) com today. order no 123456789{i:02d}123 x"))
    rows += [(None, "x@y.zz"), (1, None), (2, ""), (2, "")]
    got = find(docs_of(*rows)).collect()
    assert len(got) == len(rows)
    texts = {}
    for (doc, text) in rows:
        texts.setdefault(doc, []).append(text or "")
    for r in got:
        base = [tuple(s) for s in r.base]
        assert any(base == plain(t) for t in texts[r.doc_id])
        for s in r.added:
            assert all(s.end <= b or e <= s.start for b, _, e in base)
    spelled = [r for r in got if r.doc_id is not None and r.doc_id >= 1000 and any(KINDS[s.kind] == "email" for s in r.added)]
    assert len(spelled) == 60


def test_votes_decide_reliability():
    rng = np.random.default_rng(0)
    real = rng.random(4000) < 0.4
    right = [0.95, 0.9, 0.6, 0.8, 0.55]
    votes = np.stack([np.where(rng.random(4000) < p, np.where(real, 1, -1), np.where(real, -1, 1)) for p in right], axis=1)
    chance = estimate(votes, np.ones(4000), PiiParams())
    assert ((chance >= 0.5) == real).mean() > 0.95
    assert ((chance >= 0.5) == real).mean() >= ((votes.sum(axis=1) > 0) == real).mean()


def test_empty(docs_of):
    assert find(docs_of((1, "a")).filter("false")).count() == 0
    assert candidates(None) == candidates("") == []


@pytest.mark.parametrize("text", ["+" * 5000, "1 " * 5000 + "a", "1.2.3." * 3000, "(at) " * 3000, "1-" * 9000])
def test_long_runs_end(text):
    assert isinstance(candidates(text), list)


def test_taken_against_all_pairs():
    rng = random.Random(4)
    for _ in range(300):
        spans = [(s, s + rng.randrange(1, 9)) for s in (rng.randrange(120) for _ in range(12))]
        held = spans[:4]
        taken = Taken(held)
        for s, e in spans[4:]:
            free = all(e <= a or b <= s for a, b in held)
            assert taken.add(s, e) == free
            held += [(s, e)] * free


def test_text_of_many_numbers(docs_of):
    text = "\n".join(f"call me at +49 30 {k:07d}, card or not 4{k:011d} ok" for k in range(50_000))
    start = time.time()
    (row,) = find(docs_of((1, text))).collect()
    assert len(row.base) >= 50_000 and time.time() - start < 120
