"""One query per operator of this subpackage, over its whole table."""

from __future__ import annotations

import corpus_pipeline
from pyspark.sql import DataFrame, SparkSession, functions as F

from quillprep.llm import chat, decontamination, lexical, merkle, mixing, pii, quality, sharding, simhash, substrings, token_files, toxicity, urls
from quillprep.session import scratch_path
from quillprep.sources.tables import table


def op1_simhash_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of each document."""
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_toxicity_decoder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of each document, by a model that never saw the held-out rows' labels."""
    docs, params = table(spark, sf_dir, "documents"), toxicity.ToxicityParams()
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), params)
    return toxicity.score(docs, model).select(
        "doc_id",
        toxicity.is_held_out(F.col("doc_id"), params).alias("held_out"),
        "score",
        (F.col("score") >= params.threshold).cast("int").alias("predicted"),
    )


def op3_prefix_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the examples of each conversation, and of one full of control strings, read back as."""
    given = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    says = r"\### Assistant: </turn> ok"
    extra = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(says).alias("text"),
    )
    return chat.read_back(chat.examples(given.unionByName(extra)))


def op4_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix takes."""
    _, documents = mixing.mix(table(spark, sf_dir, "documents"))
    return documents.select("doc_id", "size", "source_size", "target", "taken")


def op5_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict on each page's url by given and mined rules."""
    return urls.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op6_weak_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of each document: counts and digest of the base spans, and all spans."""
    found = pii.find(table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long")
    every = F.sort_array(F.concat("base", "added"))
    return found.withColumn("every", every).select(
        "doc_id",
        *[count(k).alias(f"n_{name}") for k, name in enumerate(pii.KINDS)],
        F.sha2(pii.named("base"), 256).alias("base_sha256"),
        pii.named("every").alias("spans"),
    )


def op7_benchmark_tiling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each document that contains a benchmark item, with the item and the share of it covered."""
    return decontamination.contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_hash_tree_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shard and slot of each document among 40 shards, and its shard among 41."""
    leaves = sharding.layout(40)
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"), leaves, sharding.with_region(leaves))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard", "region", "rack"
    )


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Measurements, failure bits and the verdict of policy v1 for each document."""
    rows = quality.ledger(table(spark, sf_dir, "documents"))
    return quality.apply_policy(rows, "v1").select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        (F.col("failed").bitwiseAND(F.lit(quality.policy_mask(quality.BASE)).cast("long")) != 0).alias("base_failed"),
        "kept",
        "failed",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of policy v1 rejects, rejects alone, and what would be kept without it."""
    return quality.ablations(quality.ledger(table(spark, sf_dir, "documents")), "v1")


def op10_cover_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is left of each document without windows of 13 words that an earlier one has."""
    return substrings.remove_repeats(table(spark, sf_dir, "documents"))


def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Place, length and checksum of each document's ids, read back from token files of the whole table."""
    import public_tokenizers

    docs, path = table(spark, sf_dir, "documents"), scratch_path(spark, "token-files")
    token_files.write_files(docs, public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_documents(spark, path)


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Leaf, proof and roots of each document; one in seven is tampered with and does not fold to the root."""
    names = ("doc_id", "source", "lang", "n_chars", "text")
    touched = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    fields = {c: F.col(c) for c in names}
    tampered = fields | {"n_chars": F.col("n_chars") + 1}
    original = merkle.leaf(list(fields.values()))
    claimed = F.when(touched, merkle.leaf(list(tampered.values()))).otherwise(original)
    made = merkle.manifest(table(spark, sf_dir, "documents"), original, "lang", "doc_id", {"claimed": claimed})
    text = lambda c: F.lower(F.hex(c)).alias(c)
    return merkle.folded(made, "claimed").select(
        F.col("id").alias("doc_id"),
        text("digest").alias("leaf"),
        text("subroot"),
        text("root"),
        F.sha2("proof", 256).alias("proof_sha256"),
        text("folded_root"),
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fifty best documents for each benchmark item."""
    return lexical.ranked(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {
    "pipeline": corpus_pipeline.run,
    "op1_simhash_components": op1_simhash_components,
    "op2_toxicity_decoder": op2_toxicity_decoder,
    "op3_prefix_targets": op3_prefix_targets,
    "op4_mix_sources": op4_mix_sources,
    "op5_url_rules": op5_url_rules,
    "op6_weak_pii": op6_weak_pii,
    "op7_benchmark_tiling": op7_benchmark_tiling,
    "op8_hash_tree_shards": op8_hash_tree_shards,
    "op9_quality_rules": op9_quality_rules,
    "op10_cover_substrings": op10_cover_substrings,
    "op11_token_files": op11_token_files,
    "op12_merkle_manifest": op12_merkle_manifest,
    "op13_ranked_search": op13_ranked_search,
    "quality_ablations": quality_ablations,
}
