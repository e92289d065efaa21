"""Files: question texts, exports, append-only logs, the fetch cache, reports, topics.  Only Spark's readers and writers touch paths."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from factloom.operators import questions as qs

EXPORTS = {"json": qs.export_json, "csv": qs.export_csv, "huggingface": qs.export_huggingface, "squad": qs.export_squad, "hotpotqa": qs.export_hotpotqa, "markdown": qs.export_markdown}


def question_name(stamp: str) -> Column:
    """File name of a question: time of the run, chain hash and, if known, the year."""
    return F.concat(F.lit(f"question_{stamp}_"), F.col("chain_hash"), F.coalesce(F.concat(F.lit("_"), F.col("year").cast("string")), F.lit("")), F.lit(".txt"))


def write_questions(questions: DataFrame, path: str, stamp: str) -> None:
    """One row a question file: its name and text, as Parquet; a directory of a file a question would not scale."""
    named = questions.select("chain_hash", question_name(stamp).alias("file"))
    qs.as_text(questions).join(named, "chain_hash").select("file", "text").write.mode("append").parquet(path)


def read_questions(spark: SparkSession, path: str) -> DataFrame:
    """All questions of a table that write_questions wrote, parsed, by name."""
    return qs.parsed(spark.read.parquet(path)).orderBy("file")


def read_question_files(spark: SparkSession, folder: str) -> DataFrame:
    """All question_*.txt of a folder, parsed, by name; files without prompt or answer go."""
    texts = spark.read.option("pathGlobFilter", "question_*.txt").text(folder, wholetext=True)
    return qs.parsed(texts.select(F.element_at(F.split("_metadata.file_path", "/"), -1).alias("file"), F.col("value").alias("text"))).orderBy("file")


def known_hashes(spark: SparkSession, path: str) -> DataFrame:
    """Chain hashes that the names of written questions carry."""
    name = F.regexp_extract("file", r"_([0-9a-f]{8})(?:_\d{4})?\.txt$", 1)
    return spark.read.parquet(path).select(name.alias("hash")).where("hash <> ''").distinct()


def export(questions: DataFrame, path: str, kind: str) -> None:
    """Write the questions in one of EXPORTS: JSON lines, CSV with a header, or Markdown text."""
    made = EXPORTS[kind](questions)
    if kind == "csv":
        made.write.mode("overwrite").option("header", "true").option("escape", '"').csv(path)
    else:
        made.select(F.col("line").alias("value")).write.mode("overwrite").text(path)


def append_log(rows: DataFrame, path: str) -> None:
    """Append rows to a log of JSON lines."""
    rows.write.mode("append").json(path)


def read_log(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of JSON lines; lines that are no JSON are skipped."""
    return spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)


CACHE = "key string, url string, status_code int, text string"


def cache_key(url: Column) -> Column:
    return F.sha2(url, 256)


def from_cache(urls: DataFrame, cache: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Pages (url, status_code, text) that the cache has, failures included, and the URLs that it lacks."""
    keyed = urls.select("url").distinct().withColumn("key", cache_key(F.col("url")))
    held = cache.select("key", "status_code", "text")
    return keyed.join(held, "key").drop("key"), keyed.join(held.select("key"), "key", "left_anti").drop("key")


def to_cache(fetched: DataFrame, path: str) -> None:
    """Add fetched pages, failed ones too, with their keys."""
    fetched.select(cache_key(F.col("url")).alias("key"), "url", "status_code", "text").write.mode("append").parquet(path)


def write_report(report: DataFrame, path: str) -> None:
    """A contradiction report as JSON lines, one a contradiction."""
    report.write.mode("overwrite").json(path)


def emptied(spark: SparkSession, path: str) -> None:
    """Empty a Parquet table; its columns stay."""
    old = spark.read.parquet(path)
    spark.createDataFrame([], old.schema).write.mode("overwrite").parquet(path)


def read_merged(spark: SparkSession, path: str) -> DataFrame:
    """A Parquet table whose later files have more columns; older rows have nulls there."""
    return spark.read.option("mergeSchema", "true").parquet(path)


def resolved_topics(spark: SparkSession, given: list[str] | None = None, lines: DataFrame | None = None, default: list[str] | None = None, most: int | None = None) -> DataFrame:
    """Topics that were given, else those of a file's lines, else the default ones; cleaned alike."""
    from factloom.sources.evidence import topics

    if given or lines is None:
        lines = spark.createDataFrame([(t,) for t in given or default or ()], "value string").coalesce(1)
    found = topics(lines)
    return found if most is None else found.limit(most)


def raw_domain(url: Column) -> Column:
    """What stands between the second and the third slash, as written."""
    return F.split_part(url, F.lit("/"), F.lit(3))

