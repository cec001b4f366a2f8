import random

from quillprep.llm.quality import POLICIES, RULES, ablations, apply_policy, ledger, policy_mask


def brute_repeats(words, n=5):
    seen = {}
    for i in range(len(words) - n + 1):
        seen.setdefault(tuple(words[i : i + n]), []).append(i)
    return len({i + k for at in seen.values() if len(at) > 1 for i in at for k in range(n)})


def test_measurements_against_brute_force(docs_of):
    rng = random.Random(5)
    texts = [None, "", " \n\t ", "one", "a a a a a", "a a a a a a", "x # $5 |<> é\nx # $5 |<> é\n\n \nx", "w " * 3000]
    texts += [" ".join(f"w{rng.randrange(k)}" for _ in range(rng.randrange(60))) for k in (2, 3, 5, 50) for _ in range(12)]
    rows = {r.doc_id: r for r in ledger(docs_of(*enumerate(texts))).collect()}
    for i, text in enumerate(texts):
        words = (text or "").split()
        lines = [x for x in (text or "").split("\n") if x.strip()]
        got = rows[i]
        assert (got.n_words, got.word_chars) == (len(words), sum(map(len, words)))
        assert got.n_repeat_words == brute_repeats(words)
        assert got.n_dup_lines == len(lines) - len(set(lines))
        assert got.n_symbols == sum(c in "#*$%&|<>" for c in text or "")
        assert got.failed & 1 == (len(words) < 10)
        assert bool(got.failed & 2) == (100 * got.n_repeat_words > 20 * len(words))


def test_policies_and_ablations(spark):
    rows = spark.createDataFrame([(0,), (1,), (1,), (3,), (4,), (16,)], "failed long")
    assert [r.kept for r in apply_policy(rows, "base").collect()] == [True, False, False, False, True, True]
    assert [r.kept for r in apply_policy(rows, "strict").collect()] == [True] + [False] * 5
    got = {r.rule: tuple(r)[1:] for r in ablations(rows, "base").collect()}
    assert got == {"few_words": (3, 2, 5), "repeated_words": (1, 0, 3)}
    assert policy_mask(POLICIES["strict"]) == (1 << len(RULES)) - 1


def test_repeated_rows_null_ids_and_empty(docs_of):
    docs = docs_of((None, "a"), (7, "b"), (7, "b"))
    assert sorted((r.doc_id is None, r.failed) for r in ledger(docs).collect()) == [(False, 65), (False, 65), (True, 65)]
    assert ledger(docs.filter("false")).count() == 0 and ablations(ledger(docs.filter("false"))).count() == 0
