"""What must not grow with the input: batches, windows, files that one task writes; and tables that are folders."""

import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quillprep.functions import batches, rouge
from quillprep.operators import encoding, subwords
from quillprep.plans import catalog

DOCUMENTS = "doc_id long, text string, lang string, source string, n_chars long"
TURNS = "conv_id long, turn long, role string, text string"


def given(spark, sf, files=1):
    """Tables written as folders of part files."""
    rows = [(i, f"Words of {i}. And {i % 7} more, more.", "en", "s", 30) for i in range(60)]
    spark.createDataFrame(rows, DOCUMENTS).repartition(files).write.parquet(f"{sf}/documents.parquet")
    turns = [(1, 1, "user", "Why?"), (1, 2, "assistant", "So. It is.")]
    spark.createDataFrame(turns, TURNS).coalesce(1).write.parquet(f"{sf}/conversations.parquet")
    return sf


def test_streams_read_tables_of_several_files(spark, tmp_path):
    sf = given(spark, str(tmp_path / "sf"), 3)
    got = catalog.stream_prepare(spark, sf)
    assert sorted(r.id for r in got.select("id").collect()) == sorted(f"d{i}" for i in range(60))


def test_order_of_files_is_checked_without_a_window_over_rows(spark, tmp_path, monkeypatch):
    sf = given(spark, str(tmp_path / "sf"))
    got = catalog.prepare_from_csv(spark, sf)
    assert {(r.split, r.examples, r.files, r.in_order) for r in got.collect()} == {
        ("train", 49, 1, True), ("validation", 6, 1, True), ("test", 6, 1, True),
    }
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan[plan.index("Window") :]  # files are windowed, not rows
    # files written in an order that is not that of the index
    export = catalog.prepare_training_set

    def turned(rows, path, params, rows_per_file):
        export(rows, path + "-given", params, rows_per_file)
        shuffled = spark.read.parquet(path + "-given").repartition(1).sortWithinPartitions("split", F.desc("index"))
        shuffled.write.partitionBy("split").parquet(path)

    monkeypatch.setattr(catalog, "prepare_training_set", turned)
    assert {r.in_order for r in catalog.prepare_from_csv(spark, sf).collect()} == {False}


def test_landed_files_are_bounded(spark, tmp_path, monkeypatch):
    sf = given(spark, str(tmp_path / "sf"), 4)
    want = sorted(map(tuple, catalog.stream_score(spark, sf).collect()))
    monkeypatch.setattr(catalog, "LANDED_BYTES", 2_000)
    landed, rows = catalog._landed(spark, sf)
    assert len(spark.read.parquet(landed).inputFiles()) > 3
    assert spark.read.parquet(landed).distinct().count() == rows.count() == 60
    assert sorted(map(tuple, catalog.stream_score(spark, sf).collect())) == want


def token_lists(n, seed=1):
    rng = random.Random(seed)
    return [None if rng.random() < 0.1 else [rng.choice("abcdefg") for _ in range(rng.choice([0, 1, 5, 40]))] for _ in range(n)]


def test_parts_hold_a_bounded_number_of_elements(monkeypatch):
    monkeypatch.setattr(batches, "ELEMENTS_AT_ONCE", 30)
    left, right = (pa.array(token_lists(200, seed), pa.list_(pa.string())) for seed in (1, 2))
    found = list(batches.parts(left.slice(3), right.slice(3)))
    assert [x for one, _ in found for x in one.to_pylist()] == left.to_pylist()[3:]
    assert [x for _, two in found for x in two.to_pylist()] == right.to_pylist()[3:]
    assert all(len(one) == 1 or len(one.flatten()) + len(two.flatten()) + len(one) <= 30 for one, two in found)
    assert list(batches.parts(left.slice(0, 0))) == []


def test_overlaps_of_parts_are_those_of_the_whole(monkeypatch):
    left, right = (pa.array([x or [] for x in token_lists(300, seed)], pa.list_(pa.string())) for seed in (3, 4))
    kinds = ("rouge1", "rouge2", "rougeL")
    whole = rouge._overlaps(left, right, kinds, False).to_pylist()
    monkeypatch.setattr(batches, "ELEMENTS_AT_ONCE", 50)
    assert [x for one, two in batches.parts(left, right) for x in rouge._overlaps(one, two, kinds, False).to_pylist()] == whole


@pytest.mark.parametrize("step", ["lookup", "decode", "subwords", "stems", "overlaps"])
def test_functions_take_a_batch_in_parts(spark, monkeypatch, step):
    """A batch comes in one piece; no function makes more of its rows into arrays at once than the bound allows."""
    monkeypatch.setattr(batches, "ELEMENTS_AT_ONCE", 20)
    words = pa.array([["aa", "b"] * (n % 5) for n in range(40)], pa.list_(pa.string()))
    ids = pa.array([[1, 0] * (n % 5) for n in range(40)], pa.list_(pa.int32()))

    class Shared:
        value = pa.array(["aa", "b"])

    class Octets:
        value = pa.array([b"aa", b"b"])

    lookup, vocabulary = encoding.Lookup(Shared, 2), subwords.Subwords(Octets, 2)
    made, kept = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: made.append(f) or kept(kind)(f))
    one = F.col("x")
    if step == "lookup":
        encoding.lookup_ids(one, lookup)
    elif step == "decode":
        encoding.decode_ids(one, lookup)
    elif step == "subwords":
        subwords.subword_text(one, vocabulary)
    elif step == "overlaps":
        rouge.overlaps(one, one, ("rouge1",), False)
    else:
        made.append(rouge.stem_tokens.func)
    batch = ids if step in ("decode", "subwords") else (words, words) if step == "overlaps" else words
    out = list(made[0](iter([batch])))
    assert len(out) > 1 and sum(map(len, out)) == 40
    if step == "subwords":
        assert [x for o in out for x in o.to_pylist()] == ["baa" * (n % 5) for n in range(40)]
    if step == "lookup":
        assert [x for o in out for x in o.to_pylist()] == [[0, 1] * (n % 5) for n in range(40)]


def test_joined_ids_are_packed_and_texts_cut_once(spark, tmp_path, monkeypatch):
    rows = spark.createDataFrame([("k", ["b", "a", "zz"], ["a"]), ("l", [], None), (None, ["a"], ["b"])], "id string, p array<string>, t array<string>")
    vocabulary = spark.createDataFrame([("a", 3), ("b", 2_000_000_000)], "token string, token_id int")
    got = encoding.join_ids(rows, vocabulary, {"p": "p_ids", "t": "t_ids"}, ["id"])
    assert {(r.id, tuple(r.p_ids), tuple(r.t_ids)) for r in got.collect()} == {("k", (2_000_000_000, 3, 1), (3,)), ("l", (), ()), (None, (), ())}
    assert "array_sort" not in got._jdf.queryExecution().optimizedPlan().toString()
    # the vocabulary is counted over tokens that were written
    seen, fit = [], catalog.fit_vocabulary
    monkeypatch.setattr(catalog, "fit_vocabulary", lambda tokens, params: seen.append(tokens) or fit(tokens, params))
    assert catalog.tokenize_joined(spark, given(spark, str(tmp_path / "sf"))).count() == 61
    assert "regexp" not in seen[0]._jdf.queryExecution().optimizedPlan().toString()
