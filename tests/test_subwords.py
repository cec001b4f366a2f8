import base64
import random
import time
from collections import Counter

import pytest
from pyspark.sql import functions as F

from quillprep.operators.packing import pack, tokenize_pairs
from quillprep.operators.subwords import load_subwords, merge, subword_ids, subword_text, subword_usage, text_pieces
from quillprep.params import PrepParams

public_tokenizers = pytest.importorskip("public_tokenizers")
tiktoken = pytest.importorskip("tiktoken")
PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")
# letters, digits and white space of several kinds, contractions, marks, and bytes that are tokens by chance only
PARTS = ["a", "the", " the", "don't", "'S", "'", "é", "é", "  ", " ", "\n", "\t", "\x0b", "\x85", "\xa0", "　", "\x1c", "\x1f", "12", "٣", "²", "..", "日本", "😀", "\x00", "<|endoftext|>", "zzzzqx", "_"]


@pytest.fixture(scope="module")
def ranks():
    with open(PATH, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}


@pytest.fixture(scope="module")
def reference(ranks):
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary


@pytest.fixture(scope="module")
def known(spark):
    return load_subwords(spark, PATH)


def naive(piece, ranks):
    parts = [piece[i : i + 1] for i in range(len(piece))]
    while True:
        pairs = [(ranks[a + b], i) for i, (a, b) in enumerate(zip(parts, parts[1:], strict=False)) if a + b in ranks]
        if not pairs:
            return [ranks[p] for p in parts]
        _, at = min(pairs)
        parts[at : at + 2] = [parts[at] + parts[at + 1]]


def test_merge_against_the_plain_rule(ranks):
    rng = random.Random(1)
    for _ in range(2_000):
        piece = "".join(rng.choices("abceinorstéñ ", k=rng.randrange(1, 30))).encode()
        assert merge(piece, ranks) == naive(piece, ranks) or [ranks.get(piece)] == merge(piece, ranks)
    small = {bytes([c]): c for c in range(256)} | {b"aa": 256, b"aab": 257, b"ba": 258, b"aaaa": 259}
    for _ in range(2_000):
        piece = bytes(rng.choices(b"ab", k=rng.randrange(1, 14)))
        assert merge(piece, small) == naive(piece, small) or merge(piece, small) == [small.get(piece)]


def test_long_piece_takes_no_quadratic_time(ranks):
    piece = "".join(random.Random(2).choices("abcdefghij", k=400_000)).encode()
    start = time.process_time()
    ids = merge(piece, ranks)
    assert time.process_time() - start < 20
    tokens = {v: k for k, v in ranks.items()}
    assert b"".join(tokens[i] for i in ids) == piece


def test_ids_and_texts(spark, known, reference):
    rng = random.Random(3)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(25))) for _ in range(2_000)] + ["", None, "word " * 30_000, "x" * 50_000]
    rows = spark.createDataFrame(list(enumerate(texts)), "n long, text string").repartition(3)
    got = rows.select("n", text_pieces(F.col("text")).alias("pieces"), subword_ids(F.col("text"), known).alias("ids"))
    got = got.withColumn("back", subword_text(F.col("ids"), known)).collect()
    for r in got:
        text = texts[r.n]
        if text is None:
            assert r.ids is None and r.back is None
            continue
        assert "".join(r.pieces) == text
        assert r.ids == reference(text)
        assert r.back == text


def test_decoding_of_odd_ids(spark, known, reference):
    part = reference("日")[:1]  # some bytes of a character
    rows = spark.createDataFrame([(1, [known.size, *reference("end"), -1]), (2, part), (3, [])], "n int, ids array<int>")
    got = dict(rows.select("n", subword_text(F.col("ids"), known)).collect())
    assert got[1] == "end" and got[3] == "" and set(got[2]) == {"�"}


def test_packed_pairs(spark, known, reference):
    pairs = spark.createDataFrame([("a", "a long prompt " * 40, "its target"), ("b", "short", "t " * 300)], "id string, prompt string, target string")
    params = PrepParams(max_len=64, max_target=16, eos_id=known.size)
    rows = pack(tokenize_pairs(pairs, lambda t: subword_ids(t, known), params), params).collect()
    for r in rows:
        assert len(r.input_ids) == len(r.labels) == len(r.attention_mask) == 64
    a = next(r for r in rows if r.id == "a")
    target = [i for i in a.labels if i != -100]
    assert target == [*reference("its target"), known.size]


def test_usage(spark, known, reference):
    texts = ["one two two", "two", ""]
    rows = spark.createDataFrame([(t,) for t in texts], "text string")
    want = Counter(i for t in texts for i in reference(t))
    assert {r.token_id: r.uses for r in subword_usage(rows, known).collect()} == want


def test_incomplete_vocabulary(spark, tmp_path):
    path = tmp_path / "v.tiktoken"
    path.write_text("\n".join(f"{base64.b64encode(bytes([c])).decode()} {c}" for c in range(255)))
    with pytest.raises(ValueError, match="256 bytes"):
        load_subwords(spark, str(path))
