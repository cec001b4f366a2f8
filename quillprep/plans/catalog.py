"""Every operator as a query over the given tables."""

from __future__ import annotations

import sys
from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from quillprep.functions import arrays, rouge, text
from quillprep.operators import audit, bootstrap, budgets, epochs, packing, runs, sampling, scoring, windows
from quillprep.operators.encoding import (
    custom_tokenizer,
    decode_ids,
    encode,
    join_ids,
    join_text,
    lookup_ids,
)
from quillprep.operators.pairs import (
    prompt_target_pairs,
    render_conversations,
    with_prompt_text,
)
from quillprep.operators.subwords import Subwords, load_subwords, subword_ids, subword_text, subword_usage
from quillprep.operators.vocabulary import EOS_ID, broadcast_lookup
from quillprep.params import SPLITS, ChatFormat, EvalParams, PrepParams
from quillprep.plans import evaluate
from quillprep.plans.prepare import fit_vocabulary, prepare_training_set
from quillprep.session import cut_lineage, scratch_path
from quillprep.sources import export, results, splits, store, tables
from quillprep.streaming.prepare import start_prepare
from quillprep.streaming.score import first_scored, read_scored, start_score, start_score_remembering

SAMPLE_SIZE = 300
SAMPLE_SIZES = {"train": 400, "validation": 60, "test": 1_000_000}
SMALL_SIZES = {"train": 100, "validation": 20, "test": 1_000}
PREFIX = 250
BUDGETS = [64, 128, 256, 512, 1024, 2048]
PREP = PrepParams(on_null="drop")
SCORE = EvalParams(use_stemmer=False, pattern="unicode")
LEAD = 128
SHORT_LEAD = 32
EVAL_TARGET = 400
# Bytes of predictions, as Parquet, that one task lands in one file.
LANDED_BYTES = 512 << 20


def _joined(column: str) -> Column:
    return F.array_join(F.col(column).cast("array<string>"), ",").alias(column)


def _documents(spark: SparkSession, sf: str) -> DataFrame:
    return tables.documents(spark, sf, tables.idle_cores(spark, sf))


def _all_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return tables.all_pairs(spark, sf, tables.idle_cores(spark, sf))


def _pairs(spark: SparkSession, sf: str) -> DataFrame:
    return prompt_target_pairs(_all_pairs(spark, sf), PREP)


def _tokenized(spark: SparkSession, sf: str) -> DataFrame:
    return packing.with_tokens(_pairs(spark, sf), PREP)


def _examples(spark: SparkSession, sf: str) -> DataFrame:
    tokenized = _tokenized(spark, sf)
    vocabulary = fit_vocabulary(tokenized, PREP)
    return packing.encode_examples(tokenized, vocabulary, PREP, ["id"])


# scans, sources, sinks


def csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents")
    path = scratch_path(spark, "csv")
    splits.write_csv(docs.select(F.col("doc_id").cast("string"), "lang", "text"), path)
    back = splits.read_csv(spark, path, ["doc_id", "text"])
    return back.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")


def split_union(spark: SparkSession, sf: str) -> DataFrame:
    pairs = tables.document_pairs(spark, sf).select("id", "article", "highlights", "split")
    named = {s: pairs.filter(F.col("split") == s).drop("split") for s in SPLITS}
    return splits.union_splits(named)


def results_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    results.append_results(_lead_records(spark, sf, LEAD), path)
    return _flat(results.read_results(spark, path))


def results_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    pairs = cut_lineage(_predicted(_indexed(spark, sf), SHORT_LEAD))
    for part in range(2):
        work = pairs.filter(F.col("index") % 2 == part)
        results.append_results(scoring.score_records(work, SCORE), path)
    return (
        results.read_results(spark, path)
        .groupBy("run_id", "attempt")
        .agg(
            F.count("*").alias("records"),
            F.sum("index").alias("index_sum"),
            F.sum(F.length("prediction")).alias("prediction_chars"),
            F.sum(F.length("reference")).alias("reference_chars"),
        )
    )


def export_parquet(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "export")
    export.export_training_set(_examples(spark, sf), path, PREP)
    total = lambda c: F.sum(F.aggregate(c, F.lit(0), lambda a, x: a + x))
    return (
        spark.read.parquet(path)
        .groupBy("split")
        .agg(
            F.count("*").alias("examples"),
            F.min(F.size("input_ids")).alias("shortest"),
            F.max(F.size("labels")).alias("longest"),
            total("attention_mask").cast("bigint").alias("used_tokens"),
            total("input_ids").cast("bigint").alias("id_sum"),
        )
    )


# sampling


def sample_exact(spark: SparkSession, sf: str) -> DataFrame:
    docs = tables.table(spark, sf, "documents").select("doc_id", "lang", "n_chars")
    return sampling.sample_exact(docs, SAMPLE_SIZE, "doc_id", PREP.seed).drop("index")


def sample_per_split(spark: SparkSession, sf: str) -> DataFrame:
    pairs = tables.document_pairs(spark, sf)
    sampled = sampling.sample_per_split(pairs, SAMPLE_SIZES, "id", PREP.seed)
    return sampled.select("id", "split", "article", "highlights")


def sample_small(spark: SparkSession, sf: str) -> DataFrame:
    """Small samples of each split in one scan."""
    pairs = tables.document_pairs(spark, sf)
    return sampling.sample_small(pairs, SMALL_SIZES, "split", "id", PREP.seed).select("id", "split", "index", "highlights")


def sample_index(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.all_pairs(spark, sf).select("id", "split")
    return sampling.sample_per_split(rows, dict.fromkeys(SPLITS), "id", PREP.seed)


def index_prefix(spark: SparkSession, sf: str) -> DataFrame:
    return sampling.index_prefix(_indexed(spark, sf), PREFIX).select("id", "index", "reference")


# text


def clean_whitespace(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    return docs.select("doc_id", text.clean_whitespace(F.col("text")).alias("cleaned"))


def strip_target(spark: SparkSession, sf: str) -> DataFrame:
    docs = _documents(spark, sf)
    padded = F.concat(F.lit(" \t\n "), "text", F.lit("\n  "))
    return docs.select("doc_id", text.strip_edges(padded).alias("stripped"))


def prompt_target(spark: SparkSession, sf: str) -> DataFrame:
    return _pairs(spark, sf).select("id", "split", "prompt", "target")


def chat_render_pair(spark: SparkSession, sf: str) -> DataFrame:
    return with_prompt_text(_pairs(spark, sf), PREP).select("id", "prompt_text", "target")


def chat_render_conversation(spark: SparkSession, sf: str) -> DataFrame:
    return render_conversations(tables.table(spark, sf, "conversations"), ChatFormat())


# tokens


def vocab_build(spark: SparkSession, sf: str) -> DataFrame:
    return fit_vocabulary(_tokenized(spark, sf), PREP)


def tokenize_ids(spark: SparkSession, sf: str) -> DataFrame:
    tokenized = _tokenized(spark, sf)
    vocabulary = fit_vocabulary(tokenized, PREP)
    names = {"prompt_tokens": "prompt_ids", "target_tokens": "target_ids"}
    encoded = encode(tokenized, vocabulary, names, ["id"])
    return encoded.select("id", _joined("prompt_ids"), _joined("target_ids"))


def truncate_prompt(spark: SparkSession, sf: str) -> DataFrame:
    return _examples(spark, sf).select("id", _joined("prompt_ids"))


def truncate_target(spark: SparkSession, sf: str) -> DataFrame:
    return _examples(spark, sf).select("id", _joined("target_ids"))


def _packed(column: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        return packing.pack(_examples(spark, sf), PREP).select("id", _joined(column))

    return query


def fully_masked_count(spark: SparkSession, sf: str) -> DataFrame:
    return audit.fully_masked_count(packing.pack(_examples(spark, sf), PREP), ["split"])


def truncation_audit(spark: SparkSession, sf: str) -> DataFrame:
    return audit.truncation_audit(_tokenized(spark, sf), PREP, ["split", "lang"])


def decode(spark: SparkSession, sf: str) -> DataFrame:
    tokenized = _tokenized(spark, sf)
    vocabulary = fit_vocabulary(tokenized, PREP)
    lookup = broadcast_lookup(spark, vocabulary)
    if lookup is None:
        return decode_joined(spark, sf)
    ids = lookup_ids(F.col("target_tokens"), lookup)
    closed = tokenized.select("id", F.concat(ids, F.array(F.lit(EOS_ID))).alias("ids"))
    return closed.select("id", decode_ids(F.col("ids"), lookup).alias("decoded"))


def decode_joined(spark: SparkSession, sf: str) -> DataFrame:
    tokenized = _tokenized(spark, sf)
    vocabulary = fit_vocabulary(tokenized, PREP)
    names = {"target_tokens": "target_ids"}
    ids = join_ids(tokenized.select("id", "target_tokens"), vocabulary, names, ["id"])
    closed = ids.select("id", F.concat("target_ids", F.array(F.lit(EOS_ID))).alias("ids"))
    return join_text(closed, vocabulary, {"ids": "decoded"}, ["id"]).select("id", "decoded")


def tokenize_joined(spark: SparkSession, sf: str) -> DataFrame:
    tokenized = cut_lineage(_tokenized(spark, sf))  # cut into tokens once, for the vocabulary and the join
    vocabulary = fit_vocabulary(tokenized, PREP)
    names = {"prompt_tokens": "prompt_ids", "target_tokens": "target_ids"}
    joined = join_ids(tokenized, vocabulary, names, ["id"], written=True)
    return joined.select("id", _joined("prompt_ids"), _joined("target_ids"))


def truncate_article(spark: SparkSession, sf: str) -> DataFrame:
    params = replace(PREP, cut="article")
    tokenized = packing.with_tokens(_pairs(spark, sf), params)
    vocabulary = fit_vocabulary(tokenized, params)
    return packing.encode_examples(tokenized, vocabulary, params, ["id"]).select("id", _joined("prompt_ids"))


def _word_lengths():
    return lambda texts: [[len(word) for word in text.split()] for text in texts]


def caller_tokenizer_packed(spark: SparkSession, sf: str) -> DataFrame:
    params = replace(PREP, eos_id=7)  # no pad id: padding falls back on the end token
    examples = packing.tokenize_pairs(_pairs(spark, sf), custom_tokenizer(_word_lengths), params)
    return packing.pack(examples, params).select(
        "id", _joined("input_ids"), _joined("attention_mask"), _joined("labels")
    )


def prepare_from_csv(spark: SparkSession, sf: str) -> DataFrame:
    """The whole preparation: CSV splits to an ordered training set, small files."""
    pairs = tables.all_pairs(spark, sf).select("split", "id", "article", "highlights")
    raw, path = scratch_path(spark, "splits"), scratch_path(spark, "training-set")
    for name in SPLITS:
        splits.write_csv(pairs.filter(F.col("split") == name).drop("split"), f"{raw}/{name}")
    params = replace(PREP, split_sizes=dict.fromkeys(SPLITS))
    loaded = splits.load_splits(spark, {name: f"{raw}/{name}" for name in SPLITS}, params)
    prepare_training_set(loaded, path, params, rows_per_file=100)
    written = spark.read.parquet(path)
    total = lambda c: F.sum(F.aggregate(c, F.lit(0), lambda a, x: a + x))
    ahead = F.col("index") - F.col("_metadata.row_index")  # the same all through a file in order
    files = written.groupBy("split", F.col("_metadata.file_name").alias("_file")).agg(
        F.count("*").alias("_rows"),
        F.min(ahead).alias("_least"),
        F.max(ahead).alias("_most"),
        total("attention_mask").alias("_used"),
        total("input_ids").alias("_ids"),
    )
    # a row for each file
    before = Window.partitionBy("split").orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    start = F.coalesce(F.sum("_rows").over(before), F.lit(0))
    return (
        files.withColumn("_next", (F.col("_least") == start) & (F.col("_most") == start))
        .groupBy("split")
        .agg(
            F.sum("_rows").alias("examples"),
            F.count("*").alias("files"),
            F.every("_next").alias("in_order"),
            F.sum("_used").cast("bigint").alias("used_tokens"),
            F.sum("_ids").cast("bigint").alias("id_sum"),
        )
    )


def caller_tokenizer(spark: SparkSession, sf: str) -> DataFrame:
    ids = custom_tokenizer(_word_lengths)(F.col("text")).alias("ids")
    return _documents(spark, sf).select("doc_id", ids).select("doc_id", _joined("ids"))


def drop_prompt(spark: SparkSession, sf: str) -> DataFrame:
    examples = _examples(spark, sf)
    whole = F.concat("prompt_ids", "target_ids")
    generated = arrays.drop_prefix(whole, F.size("prompt_ids"))
    return examples.select("id", generated.alias("generated")).select("id", _joined("generated"))


def epoch_plan(spark: SparkSession, sf: str) -> DataFrame:
    train = tables.all_pairs(spark, sf).filter(F.col("split") == "train").select("id")
    return epochs.epoch_plan(train, PREP, epochs=2)


def step_token_stats(spark: SparkSession, sf: str) -> DataFrame:
    train = _tokenized(spark, sf).filter(F.col("split") == "train")
    prompt = F.least(F.size("prompt_tokens"), F.lit(PREP.max_len - PREP.max_target))
    lengths = train.select("id", prompt.alias("prompt_len"), "target_tokens").select(
        "id",
        "prompt_len",
        F.least(F.size("target_tokens") + 1, PREP.max_len - F.col("prompt_len")).alias(
            "target_len"
        ),
    )
    return epochs.step_token_stats(epochs.epoch_plan(lengths, PREP), PREP)


# subwords


def _subwords(spark: SparkSession) -> Subwords:
    import public_tokenizers

    return load_subwords(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))


def _subword_examples(spark: SparkSession, sf: str) -> tuple[DataFrame, Subwords, PrepParams]:
    known = _subwords(spark)
    params = replace(PREP, eos_id=known.size)  # the first free id; it pads as well
    return packing.tokenize_pairs(_pairs(spark, sf), lambda text: subword_ids(text, known), params), known, params


def subwords_of_pairs(spark: SparkSession, sf: str) -> DataFrame:
    """Prompts and targets as subword ids within their budgets."""
    examples, _, _ = _subword_examples(spark, sf)
    return examples.select("id", _joined("prompt_ids"), _joined("target_ids"))


def subword_packed(spark: SparkSession, sf: str) -> DataFrame:
    examples, _, params = _subword_examples(spark, sf)
    return packing.pack(examples, params).select("id", _joined("input_ids"), _joined("attention_mask"), _joined("labels"))


def subword_decode(spark: SparkSession, sf: str) -> DataFrame:
    """Every whole text as ids, closed by an end token, and back."""
    known = _subwords(spark)
    ids = F.concat(subword_ids(F.col("text"), known), F.array(F.lit(known.size)))
    encoded = _documents(spark, sf).select("doc_id", ids.alias("ids"))
    return encoded.select("doc_id", subword_text(F.col("ids"), known).alias("decoded"))


def subword_counts(spark: SparkSession, sf: str) -> DataFrame:
    """How often each subword occurs in the documents."""
    return subword_usage(_documents(spark, sf), _subwords(spark))


def budget_curve(spark: SparkSession, sf: str) -> DataFrame:
    """The share of each split's examples that each budget would cut, from sketches by split and language."""
    sketches = cut_lineage(budgets.length_sketches(_tokenized(spark, sf), ["split", "lang"]))
    curve = budgets.budget_curve(budgets.merge_sketches(sketches, ["split"]), ["split"], BUDGETS)
    return curve.withColumns({f"{c}_cut": F.round(f"{c}_cut", 3) for c in budgets.LENGTHS})


def _train_lengths(spark: SparkSession, sf: str) -> DataFrame:
    train = tables.all_pairs(spark, sf).filter(F.col("split") == "train")
    return train.select("id", F.length("article").alias("length"))


def epoch_plan_bucketed(spark: SparkSession, sf: str) -> DataFrame:
    """Two epochs whose steps hold examples of like length."""
    return epochs.epoch_plan_bucketed(_train_lengths(spark, sf), PREP, epochs=2).drop("length")


def packed_windows(spark: SparkSession, sf: str) -> DataFrame:
    """The training examples in windows, several to each."""
    train = _tokenized(spark, sf).filter(F.col("split") == "train")
    examples = packing.encode_examples(train, fit_vocabulary(_tokenized(spark, sf), PREP), PREP, ["id"])
    packed = windows.packed_windows(examples, PREP)
    return packed.select("window", F.array_join("keys", " ").alias("keys"), _joined("input_ids"), _joined("labels"), _joined("segment_ids"), _joined("positions"))


# generation and scoring


def _eval_pairs(spark: SparkSession, sf: str) -> DataFrame:
    return _all_pairs(spark, sf).select(
        "id", "article", text.strip_edges(F.col("highlights")).alias("reference")
    )


def _indexed(spark: SparkSession, sf: str) -> DataFrame:
    whole = _eval_pairs(spark, sf).withColumn("set", F.lit("eval"))
    return sampling.assign_positions(whole, {"eval": None}, "set", "id", PREP.seed).drop("set")


def _indexed_pairs(spark: SparkSession, sf: str) -> DataFrame:
    whole = _pairs(spark, sf).select("id", "prompt", "target").withColumn("set", F.lit("eval"))
    return sampling.assign_positions(whole, {"eval": None}, "set", "id", PREP.seed).drop("set")


def _predicted(pairs: DataFrame, n: int) -> DataFrame:
    lead = scoring.lead_prediction(F.col("article"), n, SCORE.pattern)
    return pairs.withColumn("prediction", lead).withColumn("run_id", F.lit(f"lead-{n}"))


def _lead_records(spark: SparkSession, sf: str, n: int) -> DataFrame:
    return scoring.score_records(_predicted(_indexed(spark, sf), n), SCORE)


def _flat(records: DataFrame) -> DataFrame:
    scores = [F.round(F.col("scores")[k], 6).alias(k) for k in SCORE.rouge_types]
    return records.select("run_id", "index", "attempt", "prediction", "reference", *scores)


def _rounded(means: DataFrame) -> DataFrame:
    return means.withColumns({k: F.round(k, 6) for k in SCORE.rouge_types})


def generate_lead(spark: SparkSession, sf: str) -> DataFrame:
    return _predicted(_eval_pairs(spark, sf), LEAD).select("id", "prediction")


def _last_words():
    return lambda prompts: [" ".join(prompt.split()[-12:]) for prompt in prompts]


def caller_predictor(spark: SparkSession, sf: str) -> DataFrame:
    predict = scoring.batch_predictor(_last_words)
    return _pairs(spark, sf).select("id", predict(F.col("prompt")).alias("prediction"))


def caller_predictor_budget(spark: SparkSession, sf: str) -> DataFrame:
    """The same predictions in batches of bounded size, sorted by length."""
    prompts = _pairs(spark, sf).select("id", "prompt")
    return scoring.predict_by_budget(prompts, _last_words, budget=20_000)


def rouge_tokens(spark: SparkSession, sf: str) -> DataFrame:
    tokens = rouge.scoring_tokens(F.col("text"), SCORE.pattern)
    docs = _documents(spark, sf).select("doc_id", tokens.alias("t"))
    return docs.select("doc_id", F.size("t").alias("n"), F.array_join("t", " ").alias("tokens"))


def rouge_tokens_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    tokens = rouge.stem_tokens(rouge.scoring_tokens(F.col("text"), SCORE.pattern))
    docs = _documents(spark, sf)
    return docs.select("doc_id", F.array_join(tokens, " ").alias("tokens"))


def _rouge(kind: str):
    def query(spark: SparkSession, sf: str) -> DataFrame:
        params = EvalParams(use_stemmer=False, pattern="unicode", rouge_types=(kind,))
        scored = scoring.with_scores(_predicted(_eval_pairs(spark, sf), LEAD), params)
        return scored.select("id", F.round(F.col("scores")[kind], 6).alias(kind))

    return query


def score_records(spark: SparkSession, sf: str) -> DataFrame:
    return _flat(_lead_records(spark, sf, LEAD))


def rouge_mean(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.with_scores(_predicted(_eval_pairs(spark, sf), LEAD), SCORE)
    return _rounded(scoring.mean_scores(scored))


def rouge_mean_stemmed(spark: SparkSession, sf: str) -> DataFrame:
    scored = scoring.with_scores(_predicted(_eval_pairs(spark, sf), LEAD), EvalParams())
    return _rounded(scoring.mean_scores(scored))


TEMPLATE = "TL;DR of:\n{article}\nAnswer briefly."


def generate_lead_template(spark: SparkSession, sf: str) -> DataFrame:
    pairs = prompt_target_pairs(tables.all_pairs(spark, sf), replace(PREP, instruction_template=TEMPLATE))
    predict = evaluate.lead_baseline(SCORE, TEMPLATE)
    return pairs.select("id", predict(F.col("prompt")).alias("prediction"))


def _done(records: DataFrame) -> DataFrame:
    return records.filter(F.col("index") % 3 == 0)


def eval_progress(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    results.append_results(_done(_lead_records(spark, sf, LEAD)), path)
    params = replace(SCORE, num_samples=EVAL_TARGET)
    return _rounded(evaluate.check_progress(spark, path, f"lead-{LEAD}", params))


def eval_resume_todo(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    predicted = cut_lineage(_predicted(_indexed(spark, sf), LEAD))
    results.append_results(_done(scoring.score_records(predicted, SCORE)), path)
    done = results.read_results(spark, path)
    return runs.remaining(predicted.select("run_id", "index", "id"), done)


def results_commit(spark: SparkSession, sf: str) -> DataFrame:
    """A run's records in slices, the first committed twice and with other predictions the second time."""
    path, run, width = scratch_path(spark, "store"), f"lead-{LEAD}", SAMPLE_SIZE
    pairs = cut_lineage(_indexed(spark, sf))
    records = {n: scoring.score_records(_predicted(pairs, n), SCORE) for n in (LEAD, SHORT_LEAD)}
    first, rest = F.col("index") < width, F.col("index") >= width
    for n, rows, name in ((LEAD, first, "first"), (LEAD, rest, "rest"), (SHORT_LEAD, first, "first")):
        store.commit_slice(records[n].filter(rows), path, run, name)
    return _flat(store.read_slices(spark, path))


def eval_resume_bitmap(spark: SparkSession, sf: str) -> DataFrame:
    """What a run has left to do by the bitmaps in its manifests; no record is read."""
    path = scratch_path(spark, "store")
    predicted = cut_lineage(_predicted(_indexed(spark, sf), LEAD))
    store.commit_slice(_done(scoring.score_records(predicted, SCORE)), path, f"lead-{LEAD}", "third")
    return store.remaining_by_bitmap(predicted.select("run_id", "index", "id"), store.finished(spark, path))


def evaluate_resumed(spark: SparkSession, sf: str) -> DataFrame:
    """A run whose first third is in the store already, to its mean scores."""
    path = scratch_path(spark, "results")
    pairs = cut_lineage(_indexed_pairs(spark, sf))
    params = replace(SCORE, num_samples=sys.maxsize, rows_per_commit=50_000)
    third = pairs.withColumn("run_id", F.lit("lead")).filter(F.col("index") % 3 == 0)
    predict = evaluate.lead_baseline(params)
    done = third.select("run_id", "index", predict(F.col("prompt")).alias("prediction"), F.col("target").alias("reference"))
    results.append_results(scoring.score_records(done, params), path)
    return _rounded(evaluate.evaluate_run(pairs, "lead", path, params=params))


def rouge_by_run(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    pairs = cut_lineage(_indexed(spark, sf))
    for n in (SHORT_LEAD, LEAD):
        results.append_results(scoring.score_records(_predicted(pairs, n), SCORE), path)
    return _rounded(evaluate.compare_runs(spark, path, SCORE.rouge_types))


def _two_runs(spark: SparkSession, sf: str) -> DataFrame:
    pairs = _indexed(spark, sf)
    both = _predicted(pairs, SHORT_LEAD).unionByName(_predicted(pairs, LEAD))
    return scoring.score_records(both, SCORE)


def _six_digits(df: DataFrame, *columns: str) -> DataFrame:
    return df.withColumns({c: F.round(c, 6) for c in columns})


def rouge_interval(spark: SparkSession, sf: str) -> DataFrame:
    """Each run's means with the interval that other examples would leave them in."""
    found = bootstrap.score_interval(_two_runs(spark, sf), SCORE.rouge_types)
    return _six_digits(found, "mean", "low", "high")


def rouge_paired_difference(spark: SparkSession, sf: str) -> DataFrame:
    """By how much the longer lead beats the shorter on the same examples."""
    found = bootstrap.paired_difference(_two_runs(spark, sf), f"lead-{SHORT_LEAD}", SCORE.rouge_types)
    return _six_digits(found, "difference", "low", "high", "above_zero")


def eval_merge(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "results")
    pairs = cut_lineage(_indexed(spark, sf))
    results.append_results(scoring.score_records(_predicted(pairs, LEAD), SCORE), path)
    other = _predicted(_done(pairs), SHORT_LEAD).withColumn("run_id", F.lit(f"lead-{LEAD}"))
    results.append_results(scoring.score_records(other, SCORE, attempt=1), path)
    return _flat(runs.latest_records(results.read_results(spark, path)))


# streaming


def _stream(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table's files as they arrive. A stream reads folders alone: a table of one file is picked out of its own."""
    given = tables.table(spark, sf, name)
    reader = spark.readStream.schema(given.schema)
    if any(f"/{name}.parquet/" in file for file in given.inputFiles()):
        return reader.parquet(f"{sf}/{name}.parquet")
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf)


def stream_prepare(spark: SparkSession, sf: str) -> DataFrame:
    rows = tables.pairs_of_documents(_stream(spark, sf, "documents"))
    path, state = scratch_path(spark, "prepared"), scratch_path(spark, "state")
    for _ in range(2):  # the second run finds nothing new
        start_prepare(rows, path, state, PREP).awaitTermination()
    return spark.read.parquet(path).select("id", "split", "prompt_text", "target")


def _files_to_land(rows: DataFrame) -> int:
    """One, or as many as keep a task that writes one of them within ``LANDED_BYTES``, by the rows' own files."""
    files = rows.select("_metadata.file_path", "_metadata.file_size").distinct()
    size = files.agg(F.sum("file_size")).head()[0]
    return max(1, -(-(size or 0) // LANDED_BYTES))


def _landed(spark: SparkSession, sf: str) -> tuple[str, DataFrame]:
    """A folder of predictions in files whose keys overlap; a stream may take them as one micro-batch or several."""
    reference = text.strip_edges(F.col("highlights")).alias("reference")
    index = F.substring("id", 2, 19).cast("bigint").alias("index")
    landed = scratch_path(spark, "landed")
    given = tables.pairs_of_documents(tables.table(spark, sf, "documents"))
    rows = _predicted(given.select(index, "article", reference), LEAD)
    rows = cut_lineage(rows.select("run_id", "index", "prediction", "reference"))
    files = _files_to_land(rows)
    for keep in ("index % 2 = 0", "index % 3 <> 1", "true"):
        rows.filter(keep).coalesce(files).write.mode("append").parquet(landed)
    return landed, rows


def stream_score(spark: SparkSession, sf: str) -> DataFrame:
    landed, rows = _landed(spark, sf)
    scored = []
    for files in (1, 1_000):
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(landed)
        path, state = scratch_path(spark, "scored"), scratch_path(spark, "state")
        for _ in range(2):  # the second run finds nothing new
            start_score(arriving, path, state, SCORE).awaitTermination()
        scored.append(_flat(read_scored(spark, path)).withColumn("files_a_batch", F.lit(files)))
    return scored[0].unionByName(scored[1])


def stream_score_ttl(spark: SparkSession, sf: str) -> DataFrame:
    """The same predictions by streams that remember a key for a day, and for no time at all."""
    landed, rows = _landed(spark, sf)
    scored = []
    for remembered in ("1 day", "0 seconds"):
        arriving = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(landed)
        path, state = scratch_path(spark, "scored"), scratch_path(spark, "state")
        start_score_remembering(arriving, path, state, SCORE, remembered).awaitTermination()
        found = first_scored(read_scored(spark, path))
        scored.append(_flat(found).withColumn("remembered", F.lit(remembered)))
    return scored[0].unionByName(scored[1])


QUERIES = {
    "csv_scan": csv_scan,
    "split_union": split_union,
    "results_scan": results_scan,
    "results_roundtrip": results_roundtrip,
    "export_parquet": export_parquet,
    "sample_exact": sample_exact,
    "sample_per_split": sample_per_split,
    "sample_small": sample_small,
    "sample_index": sample_index,
    "index_prefix": index_prefix,
    "clean_whitespace": clean_whitespace,
    "strip_target": strip_target,
    "prompt_target_pairs": prompt_target,
    "chat_render_pair": chat_render_pair,
    "chat_render_conversation": chat_render_conversation,
    "vocab_build": vocab_build,
    "tokenize_ids": tokenize_ids,
    "truncate_prompt": truncate_prompt,
    "truncate_target": truncate_target,
    "pack_pad": _packed("input_ids"),
    "attention_mask": _packed("attention_mask"),
    "label_mask": _packed("labels"),
    "fully_masked_count": fully_masked_count,
    "truncation_audit": truncation_audit,
    "decode_ids": decode,
    "decode_ids_joined": decode_joined,
    "tokenize_ids_joined": tokenize_joined,
    "truncate_article": truncate_article,
    "caller_tokenizer_packed": caller_tokenizer_packed,
    "prepare_from_csv": prepare_from_csv,
    "generate_lead_template": generate_lead_template,
    "evaluate_resumed": evaluate_resumed,
    "drop_prompt": drop_prompt,
    "caller_tokenizer": caller_tokenizer,
    "subword_ids": subwords_of_pairs,
    "subword_packed": subword_packed,
    "subword_decode": subword_decode,
    "subword_usage": subword_counts,
    "epoch_plan": epoch_plan,
    "step_token_stats": step_token_stats,
    "packed_windows": packed_windows,
    "budget_curve": budget_curve,
    "epoch_plan_bucketed": epoch_plan_bucketed,
    "generate_lead": generate_lead,
    "caller_predictor": caller_predictor,
    "caller_predictor_budget": caller_predictor_budget,
    "rouge_tokens": rouge_tokens,
    "rouge_tokens_stemmed": rouge_tokens_stemmed,
    "rouge1_f": _rouge("rouge1"),
    "rouge2_f": _rouge("rouge2"),
    "rougeL_f": _rouge("rougeL"),
    "score_records": score_records,
    "rouge_mean": rouge_mean,
    "rouge_mean_stemmed": rouge_mean_stemmed,
    "eval_progress": eval_progress,
    "eval_resume_todo": eval_resume_todo,
    "eval_resume_bitmap": eval_resume_bitmap,
    "results_commit": results_commit,
    "rouge_by_run": rouge_by_run,
    "rouge_interval": rouge_interval,
    "rouge_paired_difference": rouge_paired_difference,
    "eval_merge": eval_merge,
    "stream_prepare": stream_prepare,
    "stream_score": stream_score,
    "stream_score_ttl": stream_score_ttl,
}
