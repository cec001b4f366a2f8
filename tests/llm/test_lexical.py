import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from quillprep.llm.lexical import SearchParams, accumulated, ranked, search, terms

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def split(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, top):
    counted = [(d, Counter(split(t)), len(split(t))) for d, t in docs if split(t)]
    n, total = len(counted), sum(x[2] for x in counted)
    df = Counter(t for _, c, _ in counted for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, length in counted:
            m = 50 + 50 * length * n // total
            score = 0
            for t in set(split(text)) & set(c):
                w = math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                score += w * (1_000_000_000 * c[t] // (1000 * c[t] + 20 * m))
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(item, k + 1, None if none else d, -s) for k, (s, none, d) in enumerate(sorted(rows)[:top])]
    return sorted(out, key=str)


def test_terms():
    text = "It's É-Ünï 42\x00a_b\x7f🙂x İ"
    assert terms(text) == [t.encode() for t in split(text)] == [t.encode() for t in ["it", "s", "É", "Ünï", "42", "a", "b", "🙂x", "İ"]]
    assert terms(None) == terms("") == terms("-- ..") == []


@pytest.mark.parametrize("seed", range(8))
def test_search_skips_nothing_that_counts(seed):
    rng = np.random.default_rng(seed)
    params = SearchParams(top=7, short=20, run=16)
    for _ in range(60):
        size, floor = int(rng.integers(1, 600)), int(rng.integers(0, 60)) if rng.random() < 0.3 else 0
        lists = []
        for _ in range(rng.integers(1, 8)):
            docs = np.sort(rng.choice(size, int(rng.integers(1, size + 1)) if rng.random() < 0.7 else 1, replace=False))
            adds = rng.integers(1, int(rng.choice([3, 20, 100])), len(docs))
            lists.append((int(adds.max()), docs, adds))
        sums = np.zeros(size, np.int64)
        for _, docs, adds in lists:
            sums[docs] += adds
        want = sorted((-s, d) for d, s in enumerate(sums.tolist()) if s > floor)[:7]
        docs, scores = search(lists, params, floor)
        assert [(-s, d) for d, s in zip(docs.tolist(), scores.tolist(), strict=True)] == want


def test_short_lists_become_one():
    most, docs, sums = accumulated([(3, np.array([1, 5]), np.array([3, 1])), (4, np.array([0, 5]), np.array([2, 4]))])
    assert (most, docs.tolist(), sums.tolist()) == (5, [0, 1, 5], [2, 3, 5])


@pytest.mark.parametrize("params", [SearchParams(top=5, short=3, run=4, shard_docs=17, block_terms=6), SearchParams(top=8, shard_postings=40), SearchParams()])
def test_against_brute_force(docs_of, spark, params):
    rng = random.Random(4)
    words = [f"w{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choices(words, [1 / (i + 1) for i in range(40)], k=n))
    docs = [(d, text(rng.randrange(25))) for d in rng.sample(range(1000), 150)]
    docs += [(None, "w1 w2 w39"), (None, "W39"), (5_000, None), (5_001, ""), (5_002, "--"), (5_003, "w3 " * 20_000)] + [(7, "w30 w31")] * 30
    items = [(i, text(6)) for i in range(12)] + [(20, "w39 w38"), (20, "w39 w38"), (21, None), (22, "unheard of"), (None, "W1, w1; w2")]
    given = spark.createDataFrame(items, "item_id long, text string")
    got = [tuple(r) for r in ranked(docs_of(*docs).repartition(3), given, params).collect()]
    assert sorted(got, key=str) == brute(docs, items, params.top)


def test_empty_tables(docs_of, spark):
    items = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert ranked(docs_of((1, "a")).filter("false"), items).count() == 0
    assert ranked(docs_of((1, "a")), items.filter("false")).count() == 0
    assert ranked(docs_of((1, "b")), items).columns == ["item_id", "rank", "doc_id", "score"]
    with pytest.raises(ValueError):
        SearchParams(top=0)
