import random
from hashlib import sha256

import pytest

from quillprep.llm.substrings import CoverParams, remove_repeats


def brute(rows, n=13):
    first = {}
    split = [(d, (t or "").split()) for d, t in rows]
    order = lambda d: float("inf") if d is None else d
    for d, w in split:
        for i in range(len(w) - n + 1):
            key = tuple(w[i : i + n])
            first[key] = min(first.get(key, float("inf")), order(d))
    out = []
    for d, w in split:
        gone = set()
        for i in range(len(w) - n + 1):
            if first[tuple(w[i : i + n])] < order(d):
                gone.update(range(i, i + n))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((d, len(w), len(gone), sha256(kept.encode()).hexdigest()))
    return sorted(out, key=str)


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    passage = [f"p{i}" for i in range(60)]
    rows = [(None, None), (3, ""), (4, "short text"), (5, " ".join(passage)), (5, " ".join(passage[:20])), (None, " ".join(passage[10:40])), (None, " ".join(passage[10:40]))]
    for d in range(10, 70):
        text = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(40))]
        at, a = rng.randrange(len(text) + 1), rng.randrange(50)
        text[at:at] = passage[a : a + rng.choice([12, 13, 14, 30])]
        rows.append((d, " ".join(text)))
    rows += [(200, "ab " * 40), (201, "ab " * 14), (202, "ab " * 12), (1, " ".join(passage[5:17]))]
    got = [tuple(r) for r in remove_repeats(docs_of(*rows)).collect()]
    assert sorted(got, key=str) == brute(rows)


def test_kept_text(docs_of):
    words = [f"w{i}" for i in range(13)]
    rows = remove_repeats(docs_of((1, " ".join(words)), (2, "a " + " ".join(words) + "\nb")), with_text=True).collect()
    assert {r.doc_id: r.kept for r in rows} == {1: " ".join(words), 2: "a b"}


def test_other_cover_and_empty(docs_of):
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(words[i : i + 20])) for i in range(8)]
    params = CoverParams(window=8, period=3, cover=(0, 1))
    got = [tuple(r) for r in remove_repeats(docs_of(*rows), params).collect()]
    assert sorted(got, key=str) == brute(rows, 8)
    assert remove_repeats(docs_of((1, "a")).filter("false")).count() == 0
    with pytest.raises(ValueError):
        CoverParams(cover=(0, 1))
