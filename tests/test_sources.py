import pyarrow.parquet as pq
import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from quillprep.params import PrepParams
from quillprep.plans.prepare import prepare_training_set
from quillprep.sources import splits
from quillprep.sources.export import export_training_set

COLUMNS = ["id", "article", "highlights"]


@pytest.fixture
def paths(tmp_path):
    tricky = 'He said ""no"", then\nleft, $1 \\ end '
    for name in ("train", "validation", "test"):
        (tmp_path / f"{name}.csv").write_text(
            f'id,article,highlights\n1,"{tricky}",  NA\n2,plain,\n3," edge ",x\n'
        )
    return {n: str(tmp_path / f"{n}.csv") for n in ("train", "validation", "test")}


def test_csv_text_is_kept(spark, paths):
    got = {r.id: r for r in splits.read_csv(spark, paths["train"], COLUMNS).collect()}
    assert got["1"].article == 'He said "no", then\nleft, $1 \\ end '
    assert got["1"].highlights == "  NA" and got["2"].highlights is None
    assert got["3"].article == " edge "


def test_columns_in_any_order_and_extra_ones(spark, tmp_path):
    (tmp_path / "a.csv").write_text("highlights,extra,article,id\nh,e,a,1\n")
    assert tuple(splits.read_csv(spark, str(tmp_path / "a.csv"), COLUMNS).head()) == ("1", "a", "h")


def test_missing_column_is_named(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,article\n1,a\n")
    with pytest.raises(ValueError, match="no column named highlights among id, article"):
        splits.read_csv(spark, str(tmp_path / "a.csv"), COLUMNS)


def test_null_rule(spark, paths):
    with pytest.raises(PySparkException, match="highlights holds a NULL"):
        splits.load_splits(spark, paths, PrepParams()).collect()
    assert splits.load_splits(spark, paths, PrepParams(on_null="drop")).count() == 6
    params = PrepParams(on_null="drop", null_tokens=("  NA",))
    assert splits.load_splits(spark, paths, params).count() == 3


@pytest.mark.parametrize("fmt", ["json", "parquet"])
def test_other_formats(spark, tmp_path, fmt):
    df = spark.createDataFrame([("1", "a\nb", "h")], "id string, article string, highlights string")
    df.write.format(fmt).save(str(tmp_path / "x"))
    got = splits.load_splits(spark, {"test": str(tmp_path / "x")}, PrepParams(), fmt).collect()
    assert [tuple(r) for r in got] == [("1", "a\nb", "h", "test")]


def test_row_key(spark, tmp_path):
    path = str(tmp_path / "same")
    spark.range(50).select(F.lit("x").alias("id")).repartition(3).write.parquet(path)
    keyed = splits.with_row_key(spark, path)
    assert keyed.select("id").distinct().count() == 50


def test_whole_preparation(spark, tmp_path):
    rows = spark.range(60).select(
        F.col("id").cast("string").alias("id"),
        F.when(F.col("id") < 40, "train").when(F.col("id") < 50, "validation").otherwise("test").alias("split"),
        F.concat(F.lit(" article  number "), "id").alias("article"),
        F.lit(" summary\n").alias("highlights"),
    )
    params = PrepParams(split_sizes={"train": 25, "validation": 4, "test": 100}, max_len=64, max_target=16)
    path = str(tmp_path / "out")
    pairs = prepare_training_set(rows, path, params)
    assert {r.split: r["count"] for r in pairs.groupBy("split").count().collect()} == {
        "train": 25, "validation": 4, "test": 10,
    }
    back = spark.read.parquet(path)
    assert back.count() == 39 and set(back.columns) == {
        "split", "index", "input_ids", "attention_mask", "labels",
    }
    assert back.filter((F.size("input_ids") != 64) | (F.size("labels") != 64)).count() == 0


def test_files_hold_consecutive_positions(spark, tmp_path):
    rows = spark.range(95).select(
        F.when(F.col("id") < 70, "train").otherwise("test").alias("split"),
        F.when(F.col("id") < 70, F.col("id")).otherwise(F.col("id") - 70).alias("index"),
        F.array(F.lit(7)).alias("prompt_ids"),
        F.array(F.col("id").cast("int")).alias("target_ids"),
    ).repartition(5)
    path = str(tmp_path / "out")
    export_training_set(rows, path, PrepParams(max_len=4, max_target=2), "index", 20)
    for split, n in (("train", 70), ("test", 25)):
        files = sorted((tmp_path / "out" / f"split={split}").glob("part-*.parquet"))
        assert len(files) == -(-n // 20)
        seen = [r["index"] for f in files for r in pq.read_table(f, columns=["index"]).to_pylist()]
        assert seen == list(range(n))


def test_saved_splits(spark, paths, tmp_path):
    rows = splits.load_splits(spark, paths, PrepParams(on_null="drop"))
    splits.save_splits(rows, str(tmp_path / "saved"))
    back = spark.read.parquet(str(tmp_path / "saved")).select(*rows.columns)
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, rows.collect()))


def test_json_fields_are_checked(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id":"1","article":"a"}\n{"id":"2","article":"b","highlights":null}\n')
    assert splits.read_json(spark, str(tmp_path / "a.json"), ["id", "highlights"]).count() == 2
    with pytest.raises(ValueError, match="no column named summary"):
        splits.read_json(spark, str(tmp_path / "a.json"), ["id", "summary"])


def test_csv_files_are_split_unless_told_otherwise(spark, tmp_path):
    path = tmp_path / "a.csv"
    path.write_text("id,article\n" + "".join(f"{i},text {i}\n" for i in range(3000)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        whole = splits.read_csv(spark, str(path), ["id"])
        lines = splits.read_csv(spark, str(path), ["id"], multi_line=False)
        assert whole.rdd.getNumPartitions() == 1 < lines.rdd.getNumPartitions()
        assert whole.count() == lines.count() == 3000
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
