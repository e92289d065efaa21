"""Reports over the graph, the pages and the questions, each as a DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import scalars as fn
from factloom.operators import chains as ch


def percent(part: Column, whole: Column) -> Column:
    """Whole percent, rounded down; nothing of nothing is 0."""
    return F.floor(100 * part / F.greatest(whole, F.lit(1))).cast("long")


def advice(max_domains: Column, n_chains: Column) -> Column:
    """What to do next, by the best covered edge and the number of chains."""
    return (
        F.when(max_domains == 0, "empty")
        .when(max_domains < 2, "sparse")
        .when(n_chains == 0, "merge")
        .when(max_domains < 3, "relaxed")
        .when(max_domains < 6, "moderate")
        .otherwise("full")
    )


def health(found: DataFrame) -> DataFrame:
    """One row: entities, edges, dated ones and their percentage, those before 1950, the most domains, chains, advice."""
    names = found.select(F.col("subject").alias("name")).union(found.select("object")).distinct().agg(F.count("*").alias("n_entities"))
    dated, year = F.col("date").isNotNull(), F.substring("date", 1, 4).try_cast("int")
    edges = found.agg(
        F.count("*").alias("n_edges"),
        F.count_if(dated).alias("n_dated"),
        F.count_if(dated & (year < 1950)).alias("n_pre_1950"),
        F.coalesce(F.max(F.size("domains")), F.lit(0)).alias("max_domains"),
    )
    counted = ch.two_hop(found).agg(F.count("*").alias("n_chains"), F.coalesce(F.max("domain_count"), F.lit(0)).alias("max_chain_domains"), F.count_if(F.col("domain_count") >= 1).alias("_ready"))
    three = ch.three_hop(found).agg(F.count("*").alias("n_chains_3"))
    row = edges.join(F.broadcast(names)).join(F.broadcast(counted)).join(F.broadcast(three))  # one row each
    return row.withColumns({"dated_percent": percent(F.col("n_dated"), F.col("n_edges")), "advice": advice(F.col("max_domains"), F.col("_ready"))}).drop("_ready")


def readiness(found: DataFrame, top: int = 10) -> DataFrame:
    """Edges by number of domains, the highest first, with the band that each number belongs to."""
    counts = found.groupBy(F.size("domains").alias("n_domains")).agg(F.count("*").alias("n_edges")).orderBy(F.desc("n_domains")).limit(top)
    band = F.when(F.col("n_domains") >= 6, "production").when(F.col("n_domains") >= 3, "testing").when(F.col("n_domains") >= 1, "more sources").otherwise("none")
    return counts.withColumn("band", band)


def domain_summary(domains: Column, most: int = 12) -> Column:
    """The number of domains and the first of them by name."""
    ordered = F.array_sort(F.array_distinct(domains))
    n = F.size(ordered)
    shown = F.concat(n.cast("string"), F.lit(" domains: "), F.array_join(F.slice(ordered, 1, most), ", "))
    more = F.concat(shown, F.lit(", ... (+"), (n - most).cast("string"), F.lit(" more)"))
    return F.when(n == 0, "0 domains").when(n > most, more).otherwise(shown)


def request_gaps(fetches: DataFrame, by: str, at: str) -> DataFrame:
    """Seconds between two fetches of one domain that follow each other, as a diagnosis of its rate limit: fewest, mean, number."""
    from pyspark.sql import Window

    before = F.lag(at).over(Window.partitionBy(by).orderBy(at))
    gaps = fetches.select(by, (F.unix_timestamp(at) - F.unix_timestamp(before)).alias("gap")).where("gap IS NOT NULL")
    return gaps.groupBy(by).agg(F.min("gap").alias("least_gap"), F.round(F.avg("gap"), 3).alias("mean_gap"), F.count("*").alias("n_gaps"))


def recent(questions: DataFrame, most: int = 5) -> DataFrame:
    """The last question files by name (file, text): name, start of the prompt, answer, number of numbered lines, year in the name."""
    found = questions.orderBy(F.desc("file")).limit(most)
    prompt = F.trim(F.regexp_extract("text", r"(?s)PROMPT:\n(.*?)(?=\n\n[A-Z])", 1))
    return found.select(
        "file",
        F.when(prompt != "", F.concat(F.left(prompt, F.lit(200)), F.lit("..."))).otherwise("").alias("prompt"),
        F.trim(F.regexp_extract("text", r"ANSWER:\n([^\n]+)", 1)).alias("answer"),
        F.size(F.regexp_extract_all("text", F.lit(r"(?m)^\d+\.\s*([^\n]+)$"), F.lit(1))).alias("n_numbered"),
        F.nullif(F.regexp_extract("file", r"_(\d{4})\.txt$", 1), F.lit("")).try_cast("int").alias("year"),
    )


def overview(found: DataFrame, pages: DataFrame, processed: Column, questions: DataFrame) -> DataFrame:
    """One row for a dashboard: entities, edges, most domains, pages, pages still open, questions."""
    names = found.select(F.col("subject").alias("name")).union(found.select("object")).distinct().agg(F.count("*").alias("n_entities"))
    edges = found.agg(F.count("*").alias("n_edges"), F.coalesce(F.max(F.size("domains")), F.lit(0)).alias("max_domains"))
    counted = pages.agg(F.count("*").alias("n_pages"), F.count_if(~processed).alias("n_open"))
    return names.join(F.broadcast(edges)).join(F.broadcast(counted)).join(F.broadcast(questions.agg(F.count("*").alias("n_questions"))))  # one row each


def article_date(fields: Column) -> Column:
    """The year of the first of an infobox's date fields that has one; fields is a map."""
    return F.coalesce(*(fn.extract_year(F.try_element_at(fields, F.lit(k))) for k in DATE_FIELDS))


#: The date fields of an infobox, in order.
DATE_FIELDS = ("birth_date", "founded", "date_enacted", "effective", "date")
