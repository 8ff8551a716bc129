"""The operators applied to the whole test tables, and their SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from jobloom.llm import (
    align, decontaminate, exact, fim, language, licenses, mixing, scoring, secrets, sharding,
    simhash, tokens, warc,
)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.simhash_groups(_table(spark, folder, "documents"))


def op2_shard_minimax(spark: SparkSession, folder: str) -> DataFrame:
    return sharding.shard_documents(_table(spark, folder, "documents"), shards=24)


def op3_mix_sources(spark: SparkSession, folder: str) -> DataFrame:
    return mixing.mix_sources(_table(spark, folder, "documents"))


def op4_decontaminate(spark: SparkSession, folder: str) -> DataFrame:
    return decontaminate.contamination(
        _table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op5_token_files(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    return tokens.token_table(_table(spark, folder, "documents"), path)


def op6_exact_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact.exact_dedup(_table(spark, folder, "documents"))


def op7_secret_scan(spark: SparkSession, folder: str) -> DataFrame:
    return secrets.scan_secrets(_table(spark, folder, "documents"))


def op8_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, folder, "documents"))


def op9_language_id(spark: SparkSession, folder: str) -> DataFrame:
    return language.identify(_table(spark, folder, "documents"))


def op10_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return scoring.score_texts(_table(spark, folder, "documents"))


def op11_align_tokenizers(spark: SparkSession, folder: str) -> DataFrame:
    import public_tokenizers

    paths = map(public_tokenizers.path, ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align.alignment_table(_table(spark, folder, "documents"), *paths)


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return fim.middle_table(_table(spark, folder, "documents"))


def op13_warc_members(spark: SparkSession, folder: str) -> DataFrame:
    return warc.archived_pages(_table(spark, folder, "pages"))


QUERIES = {f.__name__: f for f in (
    op1_simhash_near_dedup, op2_shard_minimax, op3_mix_sources, op4_decontaminate,
    op5_token_files, op6_exact_dedup, op7_secret_scan, op8_license_scan, op9_language_id,
    op10_lm_score, op11_align_tokenizers, op12_fill_in_middle, op13_warc_members)}

ORACLE_SQL: dict[str, str] = {
    "op4_decontaminate": decontaminate.SQL,
    "op6_exact_dedup": exact.SQL,
    "op7_secret_scan": secrets.SQL,
    "op8_license_scan": licenses.SQL,
    "op12_fill_in_middle": fim.SQL,
    "op13_warc_members": warc.SQL,
}
