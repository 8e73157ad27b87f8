"""One query per operator, with production parameters, over the whole of its table."""

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from padron.llm import (
    classifier, decontamination, lexical_search, line_dedup, mixing, pii, quality_rules,
    secret_scan, simhash, source_divergence, token_counts, token_files, toxicity)
from padron.llm.shipping import ship_package
from padron.session import new_folder

#: Vocabularies, by the paths of the installed package.
BYTE_BPE, WORD_BPE, PIECE_BPE = (
    public_tokenizers.path(name)
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json", "piece_bpe_32k.model"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with their counts and a digest of the text that stays."""
    pages = line_dedup.drop_boilerplate(table(spark, sf_dir, "pages"))
    return pages.select("page_id", "host", "n_lines", "n_dropped",
                        F.md5(F.col("text").cast("binary")).alias("text_md5"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"), BYTE_BPE)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_folder(spark, "tokens")
    token_files.write_token_file(table(spark, sf_dir, "documents"), WORD_BPE, path)
    return token_files.token_digests(spark, path)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.judge(table(spark, sf_dir, "documents"), PIECE_BPE)


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op8_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_personal_data(table(spark, sf_dir, "documents"))


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return source_divergence.audit_sources(table(spark, sf_dir, "documents"))


def op12_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES = {f.__name__: f for f in (
    op1_decontamination, op2_line_dedup, op3_token_counts, op4_token_files, op5_mixing,
    op6_quality_rules, op7_simhash, op8_classifier, op9_pii, op10_secrets,
    op11_source_divergence, op12_toxicity, op13_lexical_search)}
