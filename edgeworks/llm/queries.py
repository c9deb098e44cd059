"""The registered queries of the operators, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from edgeworks.llm import bpe, decontaminate, divergence, language, language_model, lines, minhash, spelling, substrings, token_counts, tree_bpe, warc, winnow
from edgeworks.llm.common import table, texts
from edgeworks.llm.shipping import ship


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_model.score_documents(table(spark, sf_dir, "documents"))


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnow.fingerprints(texts(table(spark, sf_dir, "documents")))


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(table(spark, sf_dir, "pages"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), words=2)


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.report(table(spark, sf_dir, "documents"))


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.report(table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.page_report(table(spark, sf_dir, "pages"))


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op10_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(table(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))


def op12_tree_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tree_bpe.round_trip(table(spark, sf_dir, "documents"))


def op13_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


_PLAIN: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_counts": op1_token_counts,
    "op2_lm_scores": op2_lm_scores,
    "op3_fingerprints": op3_fingerprints,
    "op4_warc": op4_warc,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_language_id": op6_language_id,
    "op7_substring_dedup": op7_substring_dedup,
    "op8_line_dedup": op8_line_dedup,
    "op9_decontamination": op9_decontamination,
    "op10_bpe": op10_bpe,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_tree_bpe": op12_tree_bpe,
    "op13_divergence": op13_divergence,
}


def _shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run


QUERIES = {name: _shipped(query) for name, query in _PLAIN.items()}
ORACLES: dict[str, str] = {
    "op4_warc": warc.ORACLE,
    "op5_near_duplicates": minhash.ORACLE,
    "op7_substring_dedup": substrings.ORACLE,
    "op8_line_dedup": lines.ORACLE,
    "op9_decontamination": decontaminate.ORACLE,
    "op11_spelling_variants": spelling.ORACLE,
    "op13_divergence": divergence.ORACLE,
}
