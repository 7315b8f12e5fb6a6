"""The registered queries of the training-data operators: each applies its operator to the whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op4_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.packing import vocabulary
    from fieldspark.llm.token_counts import token_counts

    return token_counts(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("piece_bpe_32k.model"))


def op5_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.lm_scoring import lm_scores

    out = lm_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), order=3, backoff=0.4, min_count=2)
    return out.select("doc_id", "n_words", F.round("log_score", 4).alias("log_score"), F.round("mean_log_score", 6).alias("mean_log_score"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.quality import apply_policy, ledger, toxic_words

    docs = table(spark, sf_dir, "documents")
    out = apply_policy(ledger(docs, toxic_words(docs, table(spark, sf_dir, "labels"))), "v2")
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "n_toxic", "fail_bits", "lone_bit")


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each rule of each policy of op6 rejects, and rejects alone, from the bits of the ledger."""
    from fieldspark.llm.quality import ablations, ledger, toxic_words

    docs = table(spark, sf_dir, "documents")
    return ablations(ledger(docs, toxic_words(docs, table(spark, sf_dir, "labels"))))


def op7_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.urls import judge

    return judge(table(spark, sf_dir, "pages"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.lines import line_dedup

    out = line_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=20, min_docs=3)
    return out.select(
        "doc_id", F.col("line_count").alias("n_lines"), F.col("line_dropped").alias("n_dropped"), F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256")
    )


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.langid import identify

    return identify(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")).select("doc_id", "held_out", "lang_pred", "score", "spans")


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.packing import pack, vocabulary

    return pack(table(spark, sf_dir, "documents").select("doc_id", "text"), vocabulary("word_bpe_49k.json"), max_tokens=4096, end_id=1)


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.simhash import near_duplicates

    out = near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), shingle_words=4, budget=4)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.decontam import find_leaks

    return find_leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), threshold=0.8, shingle_words=5)


def op10_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.chat import format_conversations, read_back

    rows = table(spark, sf_dir, "conversations").select("conv_id", F.col("turn").cast("long").alias("turn"), "role", "text")
    said = "</s>[INST] ok [/INST]"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(own)))


def op11_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.naming import exact_groups

    return exact_groups(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.spelling import spelling_variants

    out = spelling_variants(table(spark, sf_dir, "documents").select("doc_id", "text"), min_chars=6, min_count=5, ratio=5, every=199)
    return out.select("word", "form", "root", "n", "n_near", "form_n")


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    from fieldspark.llm.merkle import verified_documents

    return verified_documents(table(spark, sf_dir, "documents"), arity=2)


QUERIES = {f.__name__: f for f in (op1_language_id, op2_best_fit_packing, op3_simhash, op4_token_counts, op5_lm_scoring, op6_quality_rules, quality_ablations, op7_url_filters, op8_line_dedup, op9_decontamination, op10_chat_formatting, op11_exact_dedup, op12_spelling_variants, op13_merkle_manifest)}
