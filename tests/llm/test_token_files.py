import glob
import random
import sys
from zlib import crc32

import numpy as np
import pyarrow as pa
import pytest

public_tokenizers = pytest.importorskip("public_tokenizers")
from tokenizers import Tokenizer  # noqa: E402

from quillprep.llm.token_files import Encoder, FileParams, TokenFile, read_documents, write_files  # noqa: E402

PATH = public_tokenizers.path("word_bpe_49k.json")
# whatever the file's normalizer, pattern and special tokens treat in a way of their own
PARTS = [
    "a", "B", "'s", "'S", "don't", "'", "é", "é", "́", " ", "\n", "\t", "\x0b", "\x0c", "\r", "\x85", "\xa0", " ", " ",
    "<|endoftext|>", "<|", "|>", "1", "23", "٣", "..", "!", "\x01", "\x00", "\x7f", "\x1f", "Σ", "İ", "ß", "日本", "😀", "the", "Hello", "_",
]


@pytest.fixture(scope="module")
def whole():
    return Tokenizer.from_file(PATH)


def ids_of(whole, text):
    return [*whole.encode(text or "", add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("remembered", [50, 1 << 20])
def test_ids_are_the_librarys(whole, remembered):
    rng = random.Random(1)
    texts = ["".join(rng.choices(PARTS, k=rng.randrange(30))) for _ in range(3_000)] + [None, "", " "]
    own = Encoder(PATH, remembered)
    for at in range(0, len(texts), 500):
        ids, lengths = own.encode(pa.array(texts[at : at + 500], pa.string()))
        assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [ids_of(whole, t)[:-1] for t in texts[at : at + 500]]


def split(ids, lengths):
    return [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])]


def test_every_letter_in_its_neighbourhood(whole):
    texts = [t for c in map(chr, range(0x180)) for t in (c, f"x{c}Y 1{c}2", f"'{c}a {c}'s", f"'L{c} .{c}'RE'x", f"A{c}\u0301")]
    assert split(*Encoder(PATH, 1 << 20).encode(pa.array(texts))) == [ids_of(whole, t)[:-1] for t in texts]


@pytest.mark.parametrize("texts", [["", None], ["日本 é\u0301", ""], ["<|endoftext|>"], ["a b"], ["\n", "日本"]])
def test_plain_or_other_strings_alone(whole, texts):
    own = Encoder(PATH, 10)
    for _ in range(2):
        assert split(*own.encode(pa.array(texts, pa.string()))) == [ids_of(whole, t)[:-1] for t in texts]


def test_distinct_strings_take_no_calls_of_their_own(whole):
    words = [f"{a}{mark}{b}" for a in ("red", "Green", "blue's") for mark in ".,;:!?-" for b in map(str, range(500))]
    texts, own, calls = [" ".join(words), "red"], Encoder(PATH, 1 << 20), []
    sys.setprofile(lambda frame, event, arg: calls.append(event) if event in ("call", "c_call") else None)
    try:
        got = own.encode(pa.array(texts))
    finally:
        sys.setprofile(None)
    assert split(*got) == [ids_of(whole, t)[:-1] for t in texts]
    assert len(calls) < len(words) / 10


def test_other_vocabulary_is_encoded_whole():
    path = public_tokenizers.path("byte_bpe_50k.json")
    texts = ["two  spaces", "é x", ""]
    ids, lengths = Encoder(path, 10).encode(pa.array(texts))
    assert [x.tolist() for x in np.split(ids, np.cumsum(lengths)[:-1])] == [Tokenizer.from_file(path).encode(t).ids for t in texts]


def brute(whole, rows):
    """Rows in order of their ids, nulls first; (doc_id, ids) of each."""
    return [(d, ids_of(whole, t)) for d, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0))]


def test_round_trip(spark, docs_of, tmp_path, whole):
    rng = random.Random(2)
    rows = [(d, " ".join(rng.choices(["red", "Green", "blue.", "x\"y"], k=rng.randrange(40)))) for d in rng.sample(range(-500, 500), 300)]
    rows += [(1000, None), (1001, ""), (1002, "long " * 50_000)]
    params = FileParams(sequence=16, batch=4, file_ids=500)
    path = str(tmp_path / "files")
    write_files(docs_of(*rows).repartition(5), PATH, path, params)
    got = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in read_documents(spark, path).collect()}
    want, start = {}, 0
    for d, ids in brute(whole, rows):
        want[d] = start, len(ids), crc32(np.array(ids, "<u4").tobytes())
        start += len(ids)
    assert got == want

    # every file by itself: equal sequences, found by their number alone, views of the file
    files = [TokenFile(f) for f in glob.glob(f"{path}/part-*") if len(open(f, "rb").read()) > 1]
    files.sort(key=lambda f: (f.about["part"], f.about["nth"]))
    stream = []
    assert len(files) > 3
    for f in files:
        order = rng.sample(range(len(f)), len(f))
        parts = {i: f.sequence(i) for i in order}
        assert all(len(ids) == len(mask) == len(starts) == 16 for ids, mask, starts in parts.values())
        low, high = f.buffer.address, f.buffer.address + f.buffer.size
        assert all(low <= ids.__array_interface__["data"][0] < high for ids, _, _ in parts.values())
        ids, mask, starts = (np.concatenate([np.asarray(parts[i][k]) for i in range(len(f))]) for k in range(3))
        assert mask.sum() == f.about["ids"] and not mask[f.about["ids"] :].any() and starts.sum() == len(f.about["doc_ids"])
        stream += ids[mask].tolist()
        with pa.ipc.open_stream(f.buffer) as reader:
            assert sum(b.num_rows for b in reader) == len(f)
        with pytest.raises(IndexError):
            f.sequence(len(f))
    assert stream == [i for _, ids in brute(whole, rows) for i in ids]


def test_null_and_repeated_ids(spark, docs_of, tmp_path, whole):
    rows = [(None, "b"), (None, "b"), (7, "same"), (7, "same"), (7, "other text"), (3, None), (None, None)] + [(9, "copy")] * 200
    write_files(docs_of(*rows), PATH, str(tmp_path / "f"), FileParams(sequence=4, batch=2, file_ids=30))
    got = read_documents(spark, str(tmp_path / "f")).orderBy("start").collect()
    assert [r.doc_id for r in got] == [None] * 3 + [3] + [7] * 3 + [9] * 200
    assert [r.start for r in got] == np.cumsum([0, *[r.n_tokens for r in got[:-1]]]).tolist()
    assert sorted(r.ids_crc32 for r in got) == sorted(crc32(np.array(ids_of(whole, t), "<u4").tobytes()) for _, t in rows)


def test_empty_table(spark, docs_of, tmp_path):
    write_files(docs_of((1, "a")).filter("false"), PATH, str(tmp_path / "f"))
    assert read_documents(spark, str(tmp_path / "f")).count() == 0
