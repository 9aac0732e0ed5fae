"""Registered queries of the training-data operators, one per operator, over whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tidemark.llm.decontaminate import leaks
from tidemark.llm.language import predicted_languages
from tidemark.llm.licenses import license_matches, templates
from tidemark.llm.near_copies import near_copy_groups
from tidemark.llm.nearest import nearest
from tidemark.llm.oracle import EXACT_TOP_K, PERIODIC_RUNS, RANKED_SEARCH
from tidemark.llm.packing import pack
from tidemark.llm.pages import main_texts
from tidemark.llm.periodic import periodic_runs, run_digests, with_periodic_tails
from tidemark.llm.ranked import ranked_documents
from tidemark.llm.repeats import without_repeats
from tidemark.llm.segments import best_scaled_products
from tidemark.llm.settings import SURROGATE_KEY, TOKENIZER
from tidemark.llm.surrogates import with_surrogates
from tidemark.llm.tables import table
from tidemark.llm.toxicity import toxicity


def op1_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents"), length=400).drop("kept")


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_copy_groups(table(spark, sf_dir, "documents"), shingle=4, radius=4, seed=42)


def op5_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_matches(table(spark, sf_dir, "documents"), templates(spark))


def op6_multi_index_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest(table(spark, sf_dir, "embeddings"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op8_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return with_surrogates(documents, SURROGATE_KEY)


def op9_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), **TOKENIZER, capacity=1024)


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return predicted_languages(table(spark, sf_dir, "documents"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=10)


def op12_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_scaled_products(table(spark, sf_dir, "embeddings"), every=50, k=5, factor=256)


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_digests(periodic_runs(with_periodic_tails(table(spark, sf_dir, "documents")), least=24, times=3))


QUERIES = {
    "op1_decontamination": op1_decontamination,
    "op2_suffix_array_dedup": op2_suffix_array_dedup,
    "op3_toxicity": op3_toxicity,
    "op4_simhash_near_dedup": op4_simhash_near_dedup,
    "op5_license_scan": op5_license_scan,
    "op6_multi_index_neighbours": op6_multi_index_neighbours,
    "op7_html_extraction": op7_html_extraction,
    "op8_pii_surrogates": op8_pii_surrogates,
    "op9_best_fit_packing": op9_best_fit_packing,
    "op10_language_id": op10_language_id,
    "op11_ranked_search": op11_ranked_search,
    "op12_exact_top_k": op12_exact_top_k,
    "op13_periodic_runs": op13_periodic_runs,
    "pipeline": corpus_pipeline.run,
}
ORACLE: dict[str, str] = {
    "op11_ranked_search": RANKED_SEARCH,
    "op12_exact_top_k": EXACT_TOP_K,
    "op13_periodic_runs": PERIODIC_RUNS,
}
