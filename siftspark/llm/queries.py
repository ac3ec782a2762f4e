"""The registered queries of this subpackage, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from siftspark.llm import decontaminate, filter_audit, katz, line_dedup, merkle, mixing, oracles, pii, quality_model, quality_rules, simhash, token_counts, toxicity, url_filter
from siftspark.session import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_documents(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    covered = F.array_join(F.transform("spans", lambda s: F.format_string("%d:%d-%d", s["item_id"], s["first"], s["last"])), ",")
    return found.select("doc_id", "n_tokens", (F.col("n_items") > 0).alias("contaminated"), "n_items", F.array_join(F.col("items").cast("array<string>"), ",").alias("items"), covered.alias("spans"))


def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymise(table(spark, sf_dir, "documents"))


def op4_quality_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_model.quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_katz(spark: SparkSession, sf_dir: str) -> DataFrame:
    scores = katz.language_scores(table(spark, sf_dir, "documents"))
    return scores.withColumns({c: F.round(c, 6) for c in ("base_score", "score")})


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filter.url_verdicts(table(spark, sf_dir, "pages"))


def op7_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.line_verdicts(table(spark, sf_dir, "documents"))
    return found.withColumn("removed", F.array_join(F.col("removed").cast("array<string>"), ","))


def op8_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_verdicts(table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op11_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = merkle.leaves(table(spark, sf_dir, "documents")).withColumn("tampered", merkle.tampered())
    found = merkle.proofs(docs.select("doc_id", "source", "leaf", "tampered"))
    folded = merkle.fold(F.coalesce("_row.tampered", "_row.leaf"), F.col("siblings")).alias("folded_root")
    row = found.select("_row.doc_id", "_row.leaf", "subroot", "root", merkle.proof_digest(F.col("siblings")).alias("proof_sha256"), folded)
    return row.withColumn("verified", F.col("folded_root") == F.col("root"))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.filter_audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_token_counts(spark: SparkSession, sf_dir: str, vocabulary: str | None = None) -> DataFrame:
    if vocabulary is None:
        import public_tokenizers

        vocabulary = public_tokenizers.path("byte_bpe_50k.json")
    return token_counts.token_counts(table(spark, sf_dir, "documents"), token_counts.read_vocabulary(vocabulary))


def queries() -> dict[str, Query]:
    return {
        "op1_mixing": op1_mixing,
        "op2_decontamination": op2_decontamination,
        "op3_pii": op3_pii,
        "op4_quality_model": op4_quality_model,
        "op5_katz": op5_katz,
        "op6_url_filter": op6_url_filter,
        "op7_line_dedup": op7_line_dedup,
        "op8_simhash": op8_simhash,
        "op9_quality_rules": op9_quality_rules,
        "op10_toxicity": op10_toxicity,
        "op11_merkle": op11_merkle,
        "op12_filter_audit": op12_filter_audit,
        "op13_token_counts": op13_token_counts,
    }


def oracle_sql() -> dict[str, str]:
    """The others train models or permute by key, which is beyond SQL; tests compare them with brute force."""
    return {
        "op1_mixing": oracles.mixing_sql(),
        "op2_decontamination": oracles.leaks_sql(),
        "op5_katz": oracles.katz_sql(),
        "op7_line_dedup": oracles.lines_sql(),
        "op8_simhash": oracles.simhash_sql(),
        "op9_quality_rules": oracles.quality_sql(),
        "op11_merkle": oracles.merkle_sql(),
        "op12_filter_audit": oracles.audit_sql(),
    }
