"""Registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tachoflow.llm.centroid_clustering import centroid_clusters
from tachoflow.llm.decontamination import contaminated
from tachoflow.llm.fill_in_middle import transformed
from tachoflow.llm.html_extraction import main_text
from tachoflow.llm.jaccard_join import jaccard_components
from tachoflow.llm.lm_scoring import scored
from tachoflow.llm.oracle import ORACLES
from tachoflow.llm.personal_data import KINDS, joined, personal_data
from tachoflow.llm.quality_rules import quality_report
from tachoflow.llm.quotation_linking import reply_threads
from tachoflow.llm.sentencepiece_codec import encoded
from tachoflow.llm.tables import table
from tachoflow.llm.token_attribution import section_token_counts
from tachoflow.llm.toxicity import toxicity_scores
from tachoflow.llm.weak_labels import quality_scores

Query = Callable[[SparkSession, str], DataFrame]


def op1_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    return reply_threads(table(spark, folder, "conversations"))


def op2_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    return scored(table(spark, folder, "documents"))


def op3_quality_classifier(spark: SparkSession, folder: str) -> DataFrame:
    return quality_scores(table(spark, folder, "documents"))


def op4_sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    return encoded(table(spark, folder, "documents"))


def op5_jaccard_join(spark: SparkSession, folder: str) -> DataFrame:
    return jaccard_components(table(spark, folder, "documents"), size=4, percent=85)


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = personal_data(table(spark, folder, "documents"))

    def count(k: int, kind: str) -> Column:
        return F.size(F.filter("base", lambda x: x["kind"] == k)).cast("long").alias(f"n_{kind}")

    counts = (count(k, kind) for k, kind in enumerate(KINDS))
    return found.select("doc_id", *counts, F.sha2(joined("base"), 256).alias("base_sha256"), joined("spans").alias("spans"))


def op7_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return contaminated(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op8_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return section_token_counts(table(spark, folder, "documents"), rule="majority")


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return quality_report(table(spark, folder, "documents"))


def op10_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))


def op11_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity_scores(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op12_fill_in_middle(spark: SparkSession, folder: str) -> DataFrame:
    return transformed(table(spark, folder, "documents"), with_output=False).drop("output")


def op13_centroid_clustering(spark: SparkSession, folder: str) -> DataFrame:
    return centroid_clusters(table(spark, folder, "embeddings"))


def all_queries() -> dict[str, Query]:
    found = (
        op1_quotation_linking, op2_lm_scoring, op3_quality_classifier, op4_sentencepiece, op5_jaccard_join, op6_personal_data,
        op7_decontamination, op8_token_counts, op9_quality_rules, op10_html_extraction, op11_toxicity, op12_fill_in_middle,
        op13_centroid_clustering,
    )
    return {f.__name__: f for f in found}


def all_oracles() -> dict[str, str]:
    return dict(ORACLES)
