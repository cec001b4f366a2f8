from quillprep.params import EvalParams, PrepParams
from quillprep.streaming.prepare import start_prepare
from quillprep.streaming.score import first_scored, read_scored, score_batch, start_score, start_score_remembering

SCORE = EvalParams(use_stemmer=False)
RECORD = "run_id string, index long, prediction string, reference string"


def land(spark, path, ids):
    rows = [(str(i), f"text  {i}", " sum ") for i in ids]
    df = spark.createDataFrame(rows, "id string, article string, highlights string")
    df.coalesce(1).write.mode("append").parquet(path)


def test_prepare_adds_only_new_files(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land(spark, src, range(5))
    rows = spark.readStream.schema("id string, article string, highlights string").parquet(src)
    for expected, new in ((5, []), (5, range(5, 8)), (8, [])):
        start_prepare(rows, out, state, PrepParams()).awaitTermination()
        assert spark.read.parquet(out).count() == expected
        if new:
            land(spark, src, new)
    got = spark.read.parquet(out).filter("id = '7'").head()
    assert got.prompt.endswith("text 7") and got.target == "sum"


def land_predictions(spark, path, ids):
    df = spark.createDataFrame([("r", i, f"a b {i}", "a b") for i in ids], RECORD)
    df.coalesce(1).write.mode("append").parquet(path)


def test_score_skips_scored_and_replays_whole_batches(spark, tmp_path):
    src, out, state, second = (str(tmp_path / n) for n in ("src", "out", "state", "second"))
    land_predictions(spark, src, range(6))
    rows = spark.readStream.schema(RECORD).parquet(src)
    start_score(rows, out, state, SCORE).awaitTermination()
    land_predictions(spark, src, range(4, 9))  # 4 and 5 are scored already
    start_score(rows, out, state, SCORE).awaitTermination()
    want = sorted(tuple(r) for r in read_scored(spark, out).collect())
    assert sorted(r[1] for r in want) == list(range(9))
    # a crash before the commit runs the last batch again
    score_batch(spark.read.schema(RECORD).parquet(src).filter("index >= 6"), 1, out, SCORE)
    assert sorted(tuple(r) for r in read_scored(spark, out).collect()) == want
    # all files in one batch: the same records, each once
    start_score(rows, second, str(tmp_path / "state2"), SCORE).awaitTermination()
    once = read_scored(spark, second).drop("batch_id").collect()
    assert sorted(tuple(r) for r in once) == sorted(r[:-1] for r in want)


def test_nothing_scored_yet(spark, tmp_path):
    assert read_scored(spark, str(tmp_path / "none")).count() == 0


def test_forgetting_bounds_the_state(spark, tmp_path):
    src = str(tmp_path / "src")
    for n in range(8):  # each file repeats half of the one before
        land_predictions(spark, src, range(10 * n, 10 * n + 20))
    land_predictions(spark, src, range(20))  # long forgotten, or not
    rows = spark.readStream.schema(RECORD).option("maxFilesPerTrigger", 1).parquet(src)
    most = {}
    for remembered in ("0 seconds", "1 day"):
        out, state = (str(tmp_path / f"{n}{remembered[0]}") for n in ("out", "state"))
        query = start_score_remembering(rows, out, state, SCORE, remembered)
        query.awaitTermination()
        held = [p.stateOperators[0] for p in query.recentProgress if p.stateOperators]
        assert all(any("rocksdb" in name for name in h.customMetrics) for h in held)
        most[remembered] = max(h.numRowsTotal for h in held)
        scored = read_scored(spark, out)
        once = first_scored(scored)
        assert sorted(r["index"] for r in once.collect()) == list(range(90))
        assert scored.count() == (90 if remembered == "1 day" else 110)
        first = {r["index"]: r.batch_id for r in once.collect()}
        assert all(first[i] == max(0, i // 10 - 1) for i in range(90))
    # by arrival, a state that forgets at once holds a few batches, the other all keys
    assert most["1 day"] == 90 and most["0 seconds"] <= 45
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_remembered_over_restarts(spark, tmp_path):
    src, out, state = (str(tmp_path / n) for n in ("src", "out", "state"))
    land_predictions(spark, src, [1, 1, 2])
    rows = spark.readStream.schema(RECORD).parquet(src)
    for _ in range(2):
        start_score_remembering(rows, out, state, SCORE).awaitTermination()
        land_predictions(spark, src, [2, 3])
    start_score_remembering(rows, out, state, SCORE).awaitTermination()
    assert sorted(r["index"] for r in read_scored(spark, out).collect()) == [1, 2, 3]
