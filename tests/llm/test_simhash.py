import random

import numpy as np
import pytest
import xxhash

from quillprep.llm.components import components
from quillprep.llm.simhash import SimHashParams, VantageTree, fingerprint, forest, near_duplicates, one_of_each


def brute_fingerprint(text, n=3):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    runs = [words[i : i + n] for i in range(len(words) - n + 1)] if len(words) >= n else [words]
    hashes = [xxhash.xxh64_intdigest(" ".join(r).encode(), 42) for r in runs]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(prints, bits):
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for a in range(len(prints)):
        for b in range(a):
            if bin(prints[a] ^ prints[b]).count("1") <= bits:
                root[find(a)] = find(b)
    return [find(a) for a in range(len(prints))]


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "one TWO", "À Ü one two three", "a b c d e f " * 50])
def test_fingerprint(text):
    assert fingerprint(text) == brute_fingerprint(text)


def crowded(n, seed=0):
    """Random prints with clusters and chains of near ones."""
    rng = random.Random(seed)
    out = []
    while len(out) < n:
        p = rng.getrandbits(64)
        for _ in range(rng.choice([1, 1, 1, 5, 30])):
            out.append(p)
            p ^= 1 << rng.randrange(64)
            if rng.random() < 0.5:
                p ^= 1 << rng.randrange(64)
    return out[:n]


@pytest.mark.parametrize("bits", [0, 2, 5])
def test_tree_loses_no_pair(bits):
    prints = np.unique(np.array(crowded(1500), np.uint64))
    tree = VantageTree(prints[::7], 12)
    row, leaf, own = tree.route(prints, bits)
    assert tree.leaves > 4 and sorted(row[own]) == list(range(len(prints)))
    links = []
    for k in range(tree.leaves):
        mine = leaf == k
        links += list(zip(*(x.tolist() for x in forest(prints[row[mine & own]], prints[row[mine]], bits)), strict=True))
    want = brute_groups(prints.tolist(), bits)
    place = {p: i for i, p in enumerate(prints.tolist())}
    root = list(range(len(prints)))

    def find(a):
        while root[a] != a:
            a = root[a]
        return a

    for u, v in links:
        root[find(place[u])] = find(place[v])
    got = [find(a) for a in range(len(prints))]
    assert len(set(zip(got, want, strict=True))) == len(set(got)) == len(set(want))
    assert len(links) <= len(row)


def test_components_of_a_chain_and_a_hub(spark):
    links = [(i, i + 1) for i in range(40)] + [(1000, 100 + i) for i in range(50)] + [(7, 7)]
    rows = components(spark.createDataFrame(links, "u long, v long")).collect()
    got = {r.node: r.root for r in rows}
    assert len(rows) == len(got)
    assert got == {i: 0 for i in range(41)} | {100 + i: 100 for i in range(50)} | {1000: 100}


def test_near_duplicates_and_choice(docs_of):
    base = " ".join(f"word{i}" for i in range(400))
    rows = [(9, base), (4, base + " extra"), (None, base), (5, "other text here now"), (5, "other text here now"), (6, None), (2, ""), (8, "x y")]
    docs = docs_of(*rows)
    params = SimHashParams(bits=4, shard_rows=1, cell_rows=2, sample_share=1)
    found = near_duplicates(docs, params).collect()
    assert len(found) == len(rows)
    got = {(r.doc_id, r.component_id) for r in found}
    assert got == {(9, 4), (4, 4), (None, 4), (5, 5), (6, 2), (2, 2), (8, 8)}
    kept = one_of_each(docs, params)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5, 8]


def test_rows_without_id_keep_one(docs_of):
    kept = one_of_each(docs_of((None, "a b c d"), (None, "a b c d"), (None, "a b c d")))
    assert [r.text for r in kept.collect()] == ["a b c d"]


def test_empty(docs_of, spark):
    none = docs_of((1, "a")).filter("false")
    assert near_duplicates(none).count() == 0 and one_of_each(none).count() == 0
