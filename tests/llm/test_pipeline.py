import os
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from quillprep.llm import toxicity
from quillprep.llm.mixing import mix
from quillprep.llm.sql import ORACLE_SQL
from quillprep.session import cut_lineage
from tests.compare import difference, duck
from tests.llm.test_simhash import brute_fingerprint, brute_groups
from tests.llm.test_tiling import brute_tiling

SF = "/root/testdata/sf0.001"
given = pytest.mark.skipif(not os.path.isdir(SF), reason="needs the given tables")


@given
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_queries_against_sql(spark, name):
    got = __spark_entry__.queries()[name](spark, SF).toPandas()
    assert difference(got, duck(SF).execute(__spark_entry__.oracle_sql()[name]).df()) is None


@given
def test_stages_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    texts = {r.doc_id: r.text for r in docs.collect()}
    states = []
    for name, stage in corpus_pipeline.STAGES:
        docs = cut_lineage(stage(spark, docs, SF))
        states.append([r.asDict() for r in docs.collect()])
        if name != "sharding":
            assert docs.columns == columns
        if name == "decontamination":
            before_mix = docs
    ids = [sorted(r["doc_id"] for r in rows) for rows in states]

    model = toxicity.train(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    reader = model.reader()
    clean = sorted(d for d, t in texts.items() if model.score(reader, t) < model.params.threshold)
    assert ids[0] == clean

    groups = defaultdict(list)
    for d, g in zip(clean, brute_groups([brute_fingerprint(texts[d]) for d in clean], 2), strict=True):
        groups[g].append(d)
    firsts = sorted(map(min, groups.values()))
    assert ids[1] == firsts

    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    dropped = set(firsts) - set(ids[2])
    whole = {d for d in firsts if any(f" {i} " in f" {' '.join(texts[d].split())} " for i in (" ".join(x.split()) for x in items))}
    assert whole <= dropped and set(ids[2]) <= set(firsts)
    for d in dropped - whole:
        assert any(2 * brute_tiling(i, texts[d], 5) >= len(i.split()) for i in items)

    want = Counter()
    for r in mix(before_mix)[1].collect():
        want[r.doc_id] += r.copies
    assert Counter(ids[3]) == +want and Counter(ids[4]) == +want
    slots = defaultdict(list)
    for r in states[4]:
        slots[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < corpus_pipeline.SHARDS and r["text"] == texts[r["doc_id"]]
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def write_tables(spark, path, docs, labels, items):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")


@pytest.mark.parametrize("empty", [True, False])
def test_odd_rows_pass_through(spark, docs_of, tmp_path, empty):
    docs = docs_of((1, None), (1, None), (None, "a b"), (None, "a b"), (2, ""), (3, "w " * 30_000), (4, "one two", None))
    # the schemas' own shard and fp columns clash with what stages add
    docs = docs.filter("false") if empty else docs
    write_tables(spark, str(tmp_path), docs, [], [])
    out = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert (len(out) == 0) == empty
    if not empty:
        # of the rows without words one is kept at most, of each other text one copy or more
        assert {r.text for r in out} - {None, ""} <= {"a b", "w " * 30_000, "one two"}
        assert len({(r.doc_id, r.text) for r in out if not r.text}) <= 1
        assert {r.doc_id for r in out if r.text == "a b"} <= {None}


def helper_names():
    """Every column name that an operator of a stage gives itself, with and without underscores in front."""
    plain = {
        "row", "row_no", "doc", "id", "none", "digest", "fp", "component_id", "first", "key", "keys", "block", "hash", "h", "label",
        "score", "features", "gram", "n", "place", "source", "known", "size", "piece", "copies", "rows", "nth", "times", "before",
        "start", "bucket", "amount", "base", "within", "sum", "taken", "target", "rank", "best", "region", "rack", "shard", "slot",
        "slot_hash", "coverage", "tiles", "found", "item_id",
    }
    return sorted({f"{'_' * k}{n}" for n in plain for k in range(3)} - {"source"})


@given
def test_clashing_columns_pass_through(spark):
    names = helper_names()
    docs = spark.read.parquet(f"{SF}/documents.parquet").filter("doc_id < 120")
    wide = docs.withColumns({c: F.lit(f"value of {c}") for c in names})
    replaced = {"shard", "rack", "region", "slot"}
    narrow = docs
    for name, stage in corpus_pipeline.STAGES:
        wide, narrow = cut_lineage(stage(spark, wide, SF)), cut_lineage(stage(spark, narrow, SF))
        assert Counter(r.doc_id for r in wide.select("doc_id").collect()) == Counter(r.doc_id for r in narrow.select("doc_id").collect())
        last = name == "sharding"
        kept = [c for c in names if not (last and c in replaced)]
        assert set(kept) | set(docs.columns) <= set(wide.columns)
        assert len(wide.columns) == len(set(wide.columns)) == len(docs.columns) + len(names)
        wrong = wide.filter(" or ".join(f"not (`{c}` <=> 'value of {c}')" for c in kept))
        assert wrong.count() == 0
