"""The registered queries of this package: thin wrappers that read whole tables and derive the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stayline.llm import (
    byte_bpe,
    collocations,
    conversation_repair,
    cotraining,
    decontaminate,
    near_duplicates,
    rules,
    secrets,
    site_trees,
    substrings,
    subword_lattice,
    token_counts,
    tool_calls,
)
from stayline.session import prepare_texts

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return prepare_texts(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.apply_rules(table(spark, sf_dir, "documents").select("doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        F.concat_ws("; ", "failed_rules").alias("failed_rules"),
    )


def decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return decontaminate.digest(found)


def tokenizer_file(name: str) -> str:
    """The place of a public vocabulary; only the driver needs it, tasks get the loaded tables."""
    import public_tokenizers

    return public_tokenizers.path(name)


def count_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.token_counts(docs, tokenizer_file("piece_bpe_32k.model"))


def bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, vocabulary = table(spark, sf_dir, "documents"), tokenizer_file("byte_bpe_50k.json")
    encoded = byte_bpe.encode(docs.select("doc_id", "text"), vocabulary)
    return byte_bpe.digest(byte_bpe.decode(encoded, vocabulary))


def jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.join(table(spark, sf_dir, "documents"))


def secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    words, score = secrets.trained(docs)
    real = F.filter("findings", lambda x: x["real"])
    return secrets.scan(docs, words, score).select(
        "doc_id",
        F.size("findings").cast("long").alias("n_candidates"),
        F.size(real).cast("long").alias("n_secrets"),
        F.array_join(F.transform(real, lambda x: F.concat_ws("+", x["start"], F.length(x["value"]))), ",").alias("spans"),
        F.sha2(F.coalesce("redacted", F.lit("")), 256).alias("redacted_sha256"),
    )


def substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.repeats(table(spark, sf_dir, "documents")).withColumn(
        "repeated", F.col("n_repeat_words") > 0
    ).select(
        "doc_id",
        "n_chunks",
        "n_words",
        "n_repeat_words",
        "n_removed_words",
        "repeated",
        F.array_join(F.col("removed").cast("array<string>"), ",").alias("removed_bytes"),
    )


def html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return site_trees.main_text(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


def chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    calls, results, predecessors = tool_calls.sample_exchanges(table(spark, sf_dir, "conversations"))
    return tool_calls.link(calls, results, predecessors, tool_calls.SAMPLE_SCHEMAS).withColumn(
        "errors", F.array_join("errors", "; ")
    )


def quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cotraining.scored(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def mine_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(table(spark, sf_dir, "documents"))


def repair_conversations(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversation_repair.damaged(table(spark, sf_dir, "conversations"))
    return conversation_repair.digest(conversation_repair.repaired(rows))


def lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return subword_lattice.scored(docs, tokenizer_file("piece_bpe_32k.model"))


QUERIES: dict[str, Query] = {
    "op1_html_extraction": html_extraction,
    "op2_jaccard_join": jaccard_join,
    "op3_substring_dedup": substring_dedup,
    "op4_decontamination": decontamination,
    "op5_token_counts": count_tokens,
    "op6_bpe_round_trip": bpe_round_trip,
    "op7_secret_scan": secret_scan,
    "op8_chat_formatting": chat_formatting,
    "op9_quality_classifier": quality_classifier,
    "op10_quality_rules": quality_rules,
    "op11_phrase_collocations": mine_collocations,
    "op12_conversation_repair": repair_conversations,
    "op13_lm_scoring": lm_scoring,
}
