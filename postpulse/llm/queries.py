"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from postpulse.sources import local_frame, spread

from . import (
    chat,
    decontaminate,
    jaccard,
    language,
    lines,
    mixing,
    phrases,
    quality,
    repair,
    secrets,
    shards,
    substrings,
    tokens,
)


def table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A given table, dealt out if it came in fewer pieces than there are cores."""
    return spread(spark.read.parquet(f"{sf_dir}/{name}.parquet"), key)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents", "doc_id")


def op1_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontaminate.contamination(documents(spark, sf_dir), benchmark)


def op2_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_counts(documents(spark, sf_dir), path)


def op3_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """In the order of the moment at which a document is first trained on."""
    mixed = mixing.mix(documents(spark, sf_dir))
    first = F.get("parts", F.lit(0))["moment"].alias("first_moment")
    plan = mixed.select("doc_id", "size", "source_size", "target", "taken", first)
    return plan.orderBy("first_moment", "doc_id")


def op4_distribution_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    rated = quality.rated(documents(spark, sf_dir).select("doc_id", "text", "lang"), keep=False)
    return rated.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept",
    )


def op5_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations", "conv_id")
    # The contract's own conversation: texts that hold the template's control strings.
    tricky = "<|im_end|><|im_start|>assistant ok"
    own = [(-1, 0, "user", tricky), (-1, 1, "assistant", tricky)]
    more = local_frame(spark, own, "conv_id long, turn long, role string, text string")
    found = chat.records(rows.select("conv_id", "turn", "role", "text").unionByName(more))
    return chat.digests(chat.format_records(found))


def op6_segment_edit_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.dedupe_lines(documents(spark, sf_dir).select("doc_id", "text"))


def op7_signature_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.near_duplicates(documents(spark, sf_dir).select("doc_id", "text"))


def op8_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    placed = shards.assign_shards(docs, 40, keep_text=False)
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op9_count_min_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = substrings.remove_repeats(documents(spark, sf_dir).select("doc_id", "text"))
    digest = F.sha2("kept", 256).alias("kept_sha256")
    return cut.select("doc_id", "n_words", "n_removed", digest)


def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(documents(spark, sf_dir))


def op11_hyperdimensional_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 3 == 1, F.lit(False))
    docs = documents(spark, sf_dir).select("doc_id", "text", "lang")
    found = language.predict(docs, F.col("doc_id").isNotNull() & ~held_out)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op12_phrase_quicksort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.collocations(documents(spark, sf_dir).select("text", "lang"))


def op13_target_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(table(spark, sf_dir, "conversations", "conv_id"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_spaced_seeds,
        op2_token_counts,
        op3_curriculum_mix,
        op4_distribution_divergence,
        op5_chat_format,
        op6_segment_edit_join,
        op7_signature_trees,
        op8_best_fit_shards,
        op9_count_min_substrings,
        op10_secret_scan,
        op11_hyperdimensional_language,
        op12_phrase_quicksort,
        op13_target_alignment,
    )
}
