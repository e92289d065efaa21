"""The corpus pipeline: documents -> toxicity -> near duplicates -> repeated strings -> benchmark leaks -> packed sequences.

Every stage takes (spark, docs, sf_dir) and works on all rows that the one before kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.llm import decontaminate, jaccard_join, packing, suffix_dedup, toxicity
from factloom.session import table, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier rejects go."""
    model = toxicity.trained(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).where("predicted = 0").select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays: the one of the smallest doc_id."""
    return jaccard_join.one_of_each(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that also start earlier go from the texts; the documents stay."""
    cut = suffix_dedup.cleaned(docs, length=100)
    return cut.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    found = decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")).select("doc_id").distinct()
    return docs.join(found, "doc_id", "left_anti").select(*docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every kept text as token pieces, placed in sequences of 2048."""
    return packing.pack(docs, capacity=2048)


STAGES = [
    ("toxicity", drop_toxic),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("suffix_array_dedup", cut_repeats),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack_sequences),
]

#: No SQL expresses the stages; the tests compare them with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
