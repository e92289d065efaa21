"""The registered queries of the training-data operators."""

from __future__ import annotations

from factloom.llm import decontaminate, fingerprints, html_extract, jaccard_join, language_id, lm_score, packing, suffix_dedup, toxicity, url_filter
from factloom.llm.oracle import ORACLE_SQL
from factloom.session import table

QUERIES: dict = {
    "op1_best_fit_packing": lambda spark, sf_dir: packing.pack(table(spark, sf_dir, "documents"), capacity=2048),
    "op2_html_extraction": lambda spark, sf_dir: html_extract.extract(table(spark, sf_dir, "pages")),
    "op3_suffix_array_dedup": lambda spark, sf_dir: suffix_dedup.deduplicate(table(spark, sf_dir, "documents"), length=100),
    "op4_toxicity": lambda spark, sf_dir: toxicity.toxicity(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")),
    "op5_ngram_jaccard_join": lambda spark, sf_dir: jaccard_join.join(table(spark, sf_dir, "documents")),
    "op6_url_filters": lambda spark, sf_dir: url_filter.judge(table(spark, sf_dir, "pages")),
    "op7_benchmark_decontamination": lambda spark, sf_dir: decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")),
    "op8_fingerprints": lambda spark, sf_dir: fingerprints.fingerprint(table(spark, sf_dir, "documents")),
    "op9_lm_scoring": lambda spark, sf_dir: lm_score.scores(table(spark, sf_dir, "documents")),
    "op10_language_id": lambda spark, sf_dir: language_id.identify(table(spark, sf_dir, "documents")),
}

__all__ = ["ORACLE_SQL", "QUERIES"]
