"""Continuous ingest: pages in, evidence appended, once per file through the checkpoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.functions import scalars as fn
from factloom.operators import extract, pages

PAGES = "page_id long, url string, html string"


def read(spark: SparkSession, folder: str, files: int = 10) -> DataFrame:
    return spark.readStream.schema(PAGES).option("maxFilesPerTrigger", files).parquet(folder)


def evidence_of(batch: DataFrame, least_words: int = 100) -> DataFrame:
    """Evidence of a batch of pages: thin and invalid ones out, text, sentences, facts."""
    good = batch.where((pages.url_verdict(F.col("url")) == "ok")).withColumn("text", pages.visible_text(F.col("html"))).where(fn.word_count(F.col("text")) >= least_words)
    facts = extract.svo(extract.annotate(extract.sentences(good.select("page_id", "text"))))
    cited = facts.join(batch.select("page_id", "url"), "page_id")
    return cited.select(F.col("page_id").alias("seq"), "subject", "rel", "object", F.lit(None).cast("string").alias("role"), "context", "date", F.col("url").alias("source_url"), fn.netloc(F.col("url")).alias("domain"))


def run(stream: DataFrame, evidence_path: str, checkpoint: str, least_words: int = 100):
    """Work off what is there and stop; a batch that is repeated after a failure replaces its own folder."""

    def append(batch: DataFrame, number: int) -> None:
        evidence_of(batch, least_words).write.mode("overwrite").parquet(f"{evidence_path}/batch={number}")

    return stream.writeStream.foreachBatch(append).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
