import random
import time
import tracemalloc

import pytest

from quillprep.llm.decontamination import Block, TilingParams, clean_documents, contained_items, tokens


def brute_tiling(item, text, least):
    """Greedy string tiling as published: longest unmarked match, mark, again."""
    a, b = tokens(item), tokens(text)
    least = min(least, len(a))
    ma, mb, tiles = [False] * len(a), [False] * len(b), 0
    while least:
        best = (0, 0, 0)
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and not ma[i + n] and not mb[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            break
        ma[i : i + n] = [True] * n
        mb[j : j + n] = [True] * n
        tiles += 1
    return sum(ma)


def test_tiling_against_brute_force():
    rng = random.Random(2)
    for _ in range(60):
        item = [f"w{rng.randrange(12)}" for _ in range(rng.choice([3, 8, 25]))]
        pieces = [item[a : a + rng.randrange(2, 12)] for a in (rng.randrange(len(item)) for _ in range(5))]
        text = [w for p in pieces for w in [*p, f"x{rng.randrange(9)}"][: len(p) + rng.randrange(2)]]
        got = Block([(0, [w.encode() for w in item])], 3).matches(" ".join(text), 1e-9)
        want = brute_tiling(" ".join(item), " ".join(text), 3)
        # equal lengths may be marked in another order, which may cost a tile its end
        assert abs((round(got[0][1] * len(item)) if got else 0) - want) <= 3


PASSAGE = " ".join(f"word{i}" for i in range(30))


def rows(spark, docs_of):
    swapped = " ".join(PASSAGE.split()[15:] + ["and"] + PASSAGE.split()[:15])
    docs = docs_of(
        (1, "Intro. " + PASSAGE.title().replace(" ", ", ") + "!"),
        (2, swapped),
        (3, " ".join(PASSAGE.split()[:10])),
        (4, "nothing of it"),
        (5, None),
        (5, ""),
        (None, PASSAGE),
        (6, "so a b it is"),
        (7, (PASSAGE + " z ") * 200),
    )
    items = [(10, PASSAGE), (11, None), (12, ""), (13, "a b"), (None, PASSAGE)]
    return docs, spark.createDataFrame(items, "item_id long, text string")


@pytest.mark.parametrize("block_words", [1_000_000, 20])
def test_contained_items(spark, docs_of, block_words):
    docs, items = rows(spark, docs_of)
    params = TilingParams(block_words=block_words)
    got = contained_items(docs, items, params).collect()
    pairs = sorted(((r.doc_id, r.item_id) for r in got), key=str)
    assert pairs == sorted([(d, i) for d in (1, 2, 7, None) for i in (10, None)] + [(6, 13)], key=str)
    assert all(r.coverage == 1.0 for r in got) and {r.tiles for r in got if r.doc_id == 2} == {2}
    kept = clean_documents(docs, items, params)
    assert kept.columns == docs.columns and sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 5]


def test_empty_sides(spark, docs_of):
    docs, items = rows(spark, docs_of)
    assert contained_items(docs.filter("false"), items).count() == 0
    assert contained_items(docs, items.filter("false")).count() == 0
    assert clean_documents(docs, items.filter("false")).count() == docs.count()


def test_tiling_is_exactly_the_published_one():
    rng = random.Random(7)
    for _ in range(400):
        item = [f"w{rng.randrange(6)}" for _ in range(rng.choice([3, 8, 25]))]
        pieces = [item[a : a + rng.randrange(2, 12)] for a in (rng.randrange(len(item)) for _ in range(6))]
        text = [w for p in pieces for w in [*p, f"x{rng.randrange(9)}"][: len(p) + rng.randrange(2)]]
        got = Block([(0, [w.encode() for w in item])], 3).matches(" ".join(text), 1e-9)
        assert (round(got[0][1] * len(item)) if got else 0) == brute_tiling(" ".join(item), " ".join(text), 3)


def peak_of(block, text, coverage):
    tracemalloc.start()
    start = time.process_time()
    found = block.matches(text, coverage)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return found, peak / 1e6, time.process_time() - start


def test_shared_template_takes_no_square():
    """One text with every item of a benchmark whose items share twenty words."""
    template = " ".join(f"t{i}" for i in range(20))
    items = [f"{template} " + " ".join(f"i{k}w{j}" for j in range(20)) for k in range(10_000)]
    block = Block([(k, tokens(t)) for k, t in enumerate(items)], 5)
    found, mb, seconds = peak_of(block, " stop ".join(items), 0.5)
    assert sorted(f[0] for f in found) == list(range(10_000)) and {f[1:] for f in found} == {(1.0, 1)}
    assert mb < 500 and seconds < 120
    # the template alone covers half of each item, and no more
    found, mb, _ = peak_of(block, template, 0.6)
    assert found == [] and mb < 50


def test_repeated_word_takes_no_square():
    block = Block([(0, tokens("w " * 400)), (1, tokens("w " * 30 + "x " * 100))], 5)
    found, mb, seconds = peak_of(block, "w " * 200_000, 0.5)
    assert found == [(0, 1.0, 1)] and mb < 300 and seconds < 60
    found, mb, _ = peak_of(block, "w " * 399 + "y " + "w " * 20_000, 0.2)
    assert [(k, round(share, 6)) for k, share, _ in found] == [(0, 1.0), (1, round(30 / 130, 6))] and mb < 300
