import random

import pytest
from pyspark.sql import functions as F

from quillprep.functions import arrays, text
from quillprep.operators import audit, encoding, epochs, packing, vocabulary
from quillprep.operators.encoding import custom_tokenizer, decode_ids, encode, join_ids
from quillprep.operators.vocabulary import EOS_ID, RESERVED, UNK_ID, broadcast_lookup
from quillprep.params import PrepParams
from quillprep.plans.prepare import tokenize_splits


@pytest.fixture(scope="module")
def tokens(spark):
    words = "a b b c c c <|user|> é , d d d d".split()
    rng = random.Random(5)
    rows = [(str(i), [rng.choice(words) for _ in range(rng.randrange(0, 12))]) for i in range(200)]
    rows += [("none", []), ("reserved", ["<|eos|>", "<|pad|>", "z"])]
    return spark.createDataFrame(rows, "id string, tokens array<string>")


def reference_vocabulary(rows, size):
    counts = {}
    for r in rows:
        for t in r.tokens:
            counts[t] = counts.get(t, 0) + 1
    kept = sorted((t for t in counts if t not in RESERVED), key=lambda t: (-counts[t], t.encode()))
    return {t: i for i, t in enumerate([*RESERVED, *kept[:size]])}


@pytest.mark.parametrize("size", [1, 3, 6, 100])
def test_vocabulary(spark, tokens, size):
    got = vocabulary.build_vocabulary(tokens, size).collect()
    assert {r.token: r.token_id for r in got} == reference_vocabulary(tokens.collect(), size)


def test_broadcast_and_join_lookups_agree(spark, tokens):
    vocab = vocabulary.build_vocabulary(tokens, 5)
    ids = reference_vocabulary(tokens.collect(), 5)
    want = {r.id: [ids.get(t, UNK_ID) for t in r.tokens] for r in tokens.collect()}
    by_batch = encode(tokens, vocab, {"tokens": "ids"}, ["id"])
    by_join = join_ids(tokens, vocab, {"tokens": "ids"}, ["id"])
    assert {r.id: r.ids for r in by_batch.collect()} == want
    assert {r.id: r.ids for r in by_join.collect()} == want
    assert want["none"] == []


def test_large_vocabulary_is_not_broadcast(spark, tokens, monkeypatch):
    vocab = vocabulary.build_vocabulary(tokens, 5)
    monkeypatch.setattr(vocabulary, "BROADCAST_TOKENS", 3)
    assert broadcast_lookup(spark, vocab) is None
    assert encode(tokens, vocab, {"tokens": "ids"}, ["id"]).count() == 202


def test_decode(spark, tokens):
    vocab = vocabulary.build_vocabulary(tokens, 100)
    lookup = broadcast_lookup(spark, vocab)
    encoded = tokens.withColumn("ids", encoding.lookup_ids(F.col("tokens"), lookup))
    got = encoded.select("tokens", decode_ids(F.col("ids"), lookup).alias("text")).collect()
    skipped = {*RESERVED, "<|user|>"}
    assert [r.text for r in got] == [" ".join(t for t in r.tokens if t not in skipped) for r in got]


def test_joined_lookups_of_several_columns_and_decoding(spark, tokens):
    vocab = vocabulary.build_vocabulary(tokens, 5)
    lookup = broadcast_lookup(spark, vocab)
    both = tokens.withColumn("more", F.reverse("tokens"))
    names = {"tokens": "ids", "more": "more_ids"}
    by_join = join_ids(both, vocab, names, ["id"]).select("id", "ids", "more_ids")
    by_batch = encode(both, vocab, names, ["id"]).select("id", "ids", "more_ids")
    assert sorted(map(tuple, by_join.collect())) == sorted(map(tuple, by_batch.collect()))
    texts = {"ids": "a", "more_ids": "b"}
    joined = encoding.join_text(by_join, vocab, texts, ["id"]).select("id", "a", "b").collect()
    plain = by_join.select("id", decode_ids(F.col("ids"), lookup), decode_ids(F.col("more_ids"), lookup))
    assert sorted(map(tuple, joined)) == sorted(map(tuple, plain.collect()))


def test_article_cut_needs_room(spark):
    params = PrepParams(max_len=17, max_target=16, cut="article", system_prompt="s", instruction_template="{article}")
    tokens = packing.with_tokens(pairs(spark), params)
    with pytest.raises(Exception, match="shorter than what follows"):
        tokens.select(packing.cut_prompt(F.col("prompt_tokens"), params)).collect()


def test_epochs_are_validated(spark):
    with pytest.raises(ValueError):
        epochs.epoch_plan(spark.range(2), PrepParams(), epochs=0)


def reference_pack(prompt, target, max_len, max_target, pad):
    prompt = prompt[: max_len - max_target]
    target = (target + [EOS_ID])[: max_len - len(prompt)]
    rest = max_len - len(prompt) - len(target)
    return (
        prompt + target + [pad] * rest,
        [1] * (len(prompt) + len(target)) + [0] * rest,
        [-100] * len(prompt) + target + [-100] * rest,
    )


@pytest.mark.parametrize("max_len,max_target", [(8, 3), (8, 8), (8, 1), (1, 1)])
@pytest.mark.parametrize("pad", [None, 0])
def test_pack_edges(spark, max_len, max_target, pad):
    params = PrepParams(max_len=max_len, max_target=max_target, pad_id=pad)
    room = max_len - max_target
    cases = [
        (list(range(10, 10 + p)), list(range(50, 50 + t)))
        for p in {0, 1, room - 1, room, room + 1, max_len + 5} if p >= 0
        for t in {0, 1, max_target - 1, max_target, max_target + 1, max_len, max_len + 5}
    ]
    rows = [(i, p, t) for i, (p, t) in enumerate(cases)]
    df = spark.createDataFrame(rows, "id int, prompt_ids array<int>, target_ids array<int>")
    df = df.withColumn("prompt_ids", packing.cut_prompt(F.col("prompt_ids"), params))
    packed = packing.pack(packing.cut_targets(df, params), params)
    for r in packed.collect():
        want = reference_pack(*cases[r.id], max_len, max_target, EOS_ID if pad is None else pad)
        assert (r.input_ids, r.attention_mask, r.labels) == want
        assert len(r.input_ids) == len(r.attention_mask) == len(r.labels) == max_len
        assert all(label in (-100, token) for label, token in zip(r.labels, r.input_ids))
    assert audit.fully_masked_count(packed.withColumn("s", F.lit(1)), ["s"]).head().fully_masked == 0


def test_fully_masked_is_counted(spark):
    rows = [([-100, -100],), ([-100, 5],), ([],)]
    df = spark.createDataFrame(rows, "labels array<int>").withColumn("s", F.lit("x"))
    assert audit.fully_masked_count(df, ["s"]).head().fully_masked == 2


@pytest.mark.parametrize("max_target", [0, 513])
def test_budget_is_validated(max_target):
    with pytest.raises(ValueError):
        PrepParams(max_target=max_target)


def test_drop_prefix(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], 2), ([1], 1), ([7, 8], 0)], "ids array<int>, n int")
    got = [r[0] for r in df.select(arrays.drop_prefix(F.col("ids"), F.col("n"))).collect()]
    assert got == [[3, 4], [], [7, 8]]


def pairs(spark):
    rows = [(str(i), "train", "word " * (i * 8) + "end", "short target") for i in range(12)]
    rows += [("e", "test", "", ""), ("p", "test", "x", "...")]
    return spark.createDataFrame(rows, "id string, split string, prompt string, target string")


def test_article_cut_keeps_the_assistant_header(spark):
    def prompts(cut):
        params = PrepParams(max_len=64, max_target=16, cut=cut, system_prompt="s",
                            instruction_template="t\n{article}")
        tokens = packing.with_tokens(pairs(spark), params)
        short = packing.cut_prompt(F.col("prompt_tokens"), params).alias("short")
        return {r.id: (r.prompt_tokens, r.short) for r in tokens.select("id", "prompt_tokens", short).collect()}

    by_prompt, by_article = prompts("prompt"), prompts("article")
    cut = [i for i, (whole, _) in by_prompt.items() if len(whole) > 48]
    assert cut
    for i in cut:
        whole = by_prompt[i][0]
        assert by_prompt[i][1] == whole[:48]
        assert len(by_article[i][1]) == 48
        assert by_article[i][1][-2:] == ["<|end|>", "<|assistant|>"]
        assert by_article[i][1][:46] == whole[:46]
    assert by_article["e"][0] == by_article["e"][1]


def test_tokenize_splits_keeps_every_row(spark):
    packed = tokenize_splits(pairs(spark), PrepParams(max_len=64, max_target=16)).collect()
    assert len(packed) == 14
    empty = next(r for r in packed if r.id == "e")
    assert [x for x in empty.labels if x != -100] == [EOS_ID]


def test_truncation_audit(spark):
    params = PrepParams(max_len=64, max_target=16)
    tokens = packing.with_tokens(pairs(spark), params)
    whole = {r.id: len(r.prompt_tokens) for r in tokens.collect()}
    got = {r.split: r for r in audit.truncation_audit(tokens, params, ["split"]).collect()}
    train = [whole[str(i)] for i in range(12)]
    assert got["train"].naive_lost == sum(n >= 64 for n in train) > 0
    assert got["train"].prompt_cut == sum(n > 48 for n in train)
    assert got["train"].reserved_lost == 0 and got["train"].prompt_len_max == max(train)


def test_custom_tokenizer(spark):
    tokenize = custom_tokenizer(lambda: lambda texts: [[ord(c) for c in s] for s in texts])
    df = spark.createDataFrame([("ab",), ("",)], "t string")
    assert [r[0] for r in df.select(tokenize(F.col("t"))).collect()] == [[97, 98], []]


def test_epoch_plan(spark):
    params = PrepParams(batch_size=2, accumulation=3)
    rows = spark.range(50).select(F.col("id").cast("string").alias("id"))
    got = epochs.epoch_plan(rows, params, epochs=2).collect()
    assert len(got) == 100
    orders = []
    for e in range(2):
        mine = sorted((r for r in got if r.epoch == e), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(50))
        assert all(r.micro_batch == r.position // 2 and r.step == r.position // 6 for r in mine)
        orders.append([r.id for r in mine])
    assert orders[0] != orders[1] and sorted(orders[0]) == sorted(orders[1])


def test_step_token_stats(spark):
    params = PrepParams(max_len=10, max_target=5, batch_size=1, accumulation=2)
    rows = [(0, i // 2, 5, 1 + i) for i in range(4)]
    df = spark.createDataFrame(rows, "epoch int, step long, prompt_len int, target_len int")
    got = {r.step: r for r in epochs.step_token_stats(df, params).collect()}
    assert (got[0].target_tokens, got[1].target_tokens) == (3, 7)
    assert got[0].padding_share == pytest.approx(7 / 20)
