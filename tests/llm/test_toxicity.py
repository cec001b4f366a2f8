import time
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from quillprep.llm.toxicity import (
    IMITATES,
    SIZE,
    Decoder,
    Reader,
    ToxicityParams,
    clean_documents,
    collapse,
    corpus_trigrams,
    is_held_out,
    letter_class,
    score,
    train,
    trigram_counts,
)

WORDS = "the a stupid loser moron idiot people are walking in gardens with nice flowers today".split()
CLEAN = ["the people are walking in the gardens", "nice flowers in a garden today with people", "walking today"]


@pytest.fixture(scope="module")
def decoder():
    return Decoder(trigram_counts([" ".join(WORDS)] * 50))


def test_counts_are_a_plain_count():
    text = "Aß-bé 中"
    classes = [letter_class(c) for c in text.lower()]
    want = np.zeros(SIZE**3, np.int64)
    for a, b, c in zip(classes, classes[1:], classes[2:], strict=False):
        want[(a * SIZE + b) * SIZE + c] += 1
    assert (trigram_counts([text]) == want).all()
    assert trigram_counts([None, "", "a"]).sum() == 0


@pytest.mark.parametrize(
    ("token", "word"),
    [("l0ser", "loser"), ("m0r0n", "moron"), ("1d10t", "idiot"), ("$tupid", "stupid"), ("stuuuupid", "stupid"), ("l.o.s.e.r", "loser"), ("mo-r0n", "moron")],
)
def test_restores(decoder, token, word):
    assert collapse(Reader(decoder, (4,), 20).restored(token)) == word


def test_spacing_and_clean_tokens(decoder):
    reader = Reader(decoder, (), 20)
    wanted = crc32(b"loser") & reader.mask
    assert wanted in reader.features("so L 0 S 3 R they")
    assert wanted not in reader.features("so lost era")
    assert reader.restored("flowers,") == "flowers" and reader.restored("12345") == "" and reader.restored("!!!") == ""


def brute_restore(decoder, token):
    """The best of all readings, enumerated."""
    from quillprep.llm import toxicity as t

    best = {}

    def walk(rest, a, b, score, text):
        if not rest:
            score += decoder.log[(a * SIZE + b) * SIZE] if b else 0.0
            best[text] = max(best.get(text, -1e9), score)
            return
        c, rest = rest[0], rest[1:]
        for x, cost in [(c, 0.0)] if c.isalpha() else [(x, t.IMITATED) for x in IMITATES.get(c, "")]:
            k = letter_class(x)
            walk(rest, b, k, score + cost + decoder.log[(a * SIZE + b) * SIZE + k], text + x)
            if k == b and text.endswith(x):
                walk(rest, a, b, score + cost + t.DROPPED_REPEAT, text)
        if not c.isalpha():
            if not c.isdigit():
                walk(rest, a, b, score + (t.DROPPED_SIGN if c in IMITATES else t.DROPPED_GAP), text)
            gap = t.KEPT_OTHER if c.isdigit() else t.DROPPED_SIGN if c in IMITATES else t.KEPT_GAP
            if b:
                walk(rest, b, 0, score + gap + decoder.log[(a * SIZE + b) * SIZE], text + " ")
            else:
                walk(rest, a, b, score + gap, text)

    walk(token, 0, 0, 0.0, "")
    top = max(best.values())
    return {" ".join(x.split()) for x, s in best.items() if s > top - 1e-9}


@pytest.mark.parametrize("token", ["l0s3r", "m-0-r", "11a", "aaa1", "$+u", "9..z", "s t u p", "é1é"])
def test_viterbi_is_the_best_path(decoder, token):
    assert decoder.restore(token) in brute_restore(decoder, token)


@pytest.mark.parametrize("piece", ["a7f3kq0+zl9x/", "1!", "ab", "s t "])
def test_long_tokens_take_linear_time(decoder, piece):
    took = []
    for n in (50_000, 400_000):
        token = piece * (n // len(piece))
        start = time.process_time()
        restored = decoder.restore(token)
        took.append(time.process_time() - start)
        assert restored.count(" ") <= len(token) and set(restored) <= set(" abcdefghijklmnopqrstuvwxyz")
    assert took[1] < 8 * max(took[0], 0.05) * 2.5 and took[1] < 60


def test_long_tokens_read_like_their_parts(decoder):
    # clean letters between doubtful stretches settle what came before them
    token = "".join(f"{'abcdefgh'[k % 8]}l0s3rxq" for k in range(400))
    restored = decoder.restore(token)
    assert restored.count("loser") > 300 and len(restored) <= len(token)


def table(spark, n=400):
    rows, labels = [], []
    for i in range(n):
        bad = i % 4 == 0
        text = CLEAN[i % 3] + (" " + ["stupid", "loser", "m0r0n", "id1ot"][i // 4 % 4] if bad else "")
        rows.append((i, text))
        labels.append((i, int(bad)))
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int")


def test_held_out_accuracy_and_labels_left_alone(spark):
    docs, labels = table(spark)
    params = ToxicityParams()
    held = [r.doc_id for r in docs.filter(is_held_out(F.col("doc_id"), params)).collect()]
    assert held == [i for i in range(400) if crc32(str(i).encode()) % 4 == 2]
    model = train(docs, labels, params)
    got = {r.doc_id: r.score for r in score(docs, model).collect()}
    assert all((got[i] >= params.threshold) == (i % 4 == 0) for i in held)
    # other labels of held-out rows, repeated and null ones change nothing
    flipped = labels.withColumn("toxic", F.when(F.col("doc_id").isin(held), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    more = spark.createDataFrame([(None, 1), (3, None), (0, 1), (0, 0)], "doc_id long, toxic int")
    again = {r.doc_id: r.score for r in score(docs, train(docs, flipped.unionByName(more), params)).collect()}
    assert again == pytest.approx(got)
    # neither do repeated rows, which share one place in the sample
    twice = train(docs.unionByName(docs), labels, params)
    assert set(twice.wanted) == set(model.wanted)
    assert sorted(twice.weights) == pytest.approx(sorted(model.weights))
    kept = {r.doc_id for r in clean_documents(docs, model).collect()}
    assert kept == {i for i, s in got.items() if s < params.threshold}


def test_edges(spark, docs_of):
    docs, labels = table(spark, 40)
    odd = docs_of((None, "a loser"), (1, None), (1, None), (2, ""), (3, "x" * 100_000 + "0"))
    model = train(odd.select(*odd.columns).unionByName(docs, allowMissingColumns=True), labels, ToxicityParams(min_toxic=1))
    rows = score(odd, model).collect()
    assert len(rows) == 5 and all(0 <= r.score <= 1 for r in rows)
    assert len({r.score for r in rows if r.doc_id in (1, 2)}) == 1
    nothing = train(docs.filter("false"), labels.filter("false"))
    assert score(docs.filter("false"), nothing).count() == 0
    assert all(r.score < 1e-9 for r in score(docs, nothing).collect())
    assert corpus_trigrams(docs.filter("false")).sum() == 0
