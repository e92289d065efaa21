"""The fact-evidence view over the driver's tables, and page and topic sources."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from factloom.functions import scalars as fn
from factloom.session import table, written_once

COLUMNS = ["seq", "subject", "rel", "object", "role", "context", "date"]
#: What sites() tells of a page besides its URL.
SITE = ["domain", "page_year"]


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages without their text: page_id, source_url, domain and the year that the URL names; small, so that Spark can tell its size."""
    url = F.col("source_url")
    return written_once(spark, sf_dir, "sites", lambda: table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("source_url")).withColumns({"domain": fn.netloc(url), "page_year": fn.extract_year(url)}))


def on_pages(spark: SparkSession, sf_dir: str, rows: DataFrame, columns: list[str]) -> DataFrame:
    """Rows with these columns of the page that seq stands for."""
    pages = sites(spark, sf_dir)
    n = table(spark, sf_dir, "pages").agg(F.count("*").alias("n_pages"))
    numbered = rows.join(F.broadcast(n)).withColumn("page_id", F.col("seq") % F.col("n_pages"))  # one row
    return numbered.join(pages.select("page_id", *columns), "page_id").drop("page_id", "n_pages")


def facts(spark: SparkSession, sf_dir: str, columns: list[str] | None = None) -> DataFrame:
    """Facts with the order in which they were found; names are upper case and trimmed.  columns: of the page that states each one.

    Rows go through joins as keys and numbers; names come last.
    """
    t = lambda name: table(spark, sf_dir, name)
    nation, part = t("nation"), t("part")
    none = F.lit(None).cast("string")

    def rows(df, seq, subject, rel, object_, role=none, context="CORPORATE", date=none, also=()):
        numbered = df.withColumn("seq", seq.cast("long"))
        stated = on_pages(spark, sf_dir, numbered, columns) if columns else numbered
        for right, same in also:
            stated = stated.join(right, same)
        return stated.select("seq", F.upper(F.trim(subject)).alias("subject"), F.lit(rel).alias("rel"), F.upper(F.trim(object_)).alias("object"), role.cast("string").alias("role"), F.lit(context).alias("context"), date.cast("string").alias("date"), *(columns or []))

    c = F.col
    located = rows(t("supplier").join(nation, c("s_nationkey") == c("n_nationkey")), c("s_suppkey"), c("s_name"), "LOCATED_IN", c("n_name"))
    lines = t("lineitem").select("l_orderkey", "l_partkey", (c("l_orderkey") * 7 + c("l_linenumber")).alias("line"), F.year("l_shipdate").alias("shipped"))
    buyers = t("orders").select("o_orderkey", "o_custkey").join(t("customer").select("c_custkey", "c_nationkey"), c("o_custkey") == c("c_custkey")).select("o_orderkey", "c_nationkey")
    acquired = lines.join(buyers, c("l_orderkey") == c("o_orderkey")).select("l_partkey", "line", "shipped", "c_nationkey").join(part.select("p_partkey", "p_brand"), c("l_partkey") == c("p_partkey")).select("line", "shipped", "c_nationkey", "p_brand")
    acquired = rows(acquired, c("line"), c("n_name"), "ACQUIRED", c("p_brand"), date=c("shipped"), also=[(nation, c("c_nationkey") == c("n_nationkey"))])
    released = rows(part, c("p_partkey"), c("p_brand"), "RELEASED", c("p_type"), date=c("p_size") + 1900)
    roles = rows(t("customer").join(nation, c("c_nationkey") == c("n_nationkey")), c("c_custkey"), c("c_name"), "WAS_ROLE_OF", c("n_name"), role=c("c_mktsegment"), context="BIOGRAPHICAL")
    following = F.lead("event_type").over(Window.partitionBy("user_id").orderBy("ts", "event_id"))
    steps = t("events").select("event_id", "user_id", "ts", "event_type").withColumn("next_type", following).where("next_type <> event_type")
    led = rows(steps, c("event_id"), c("event_type"), "LED_TO", c("next_type"), context="HISTORICAL", date=F.year("ts"))
    return located.unionByName(acquired).unionByName(released).unionByName(roles).unionByName(led)


def evidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Facts with the page that states each one and its domain."""
    return facts(spark, sf_dir, ["source_url", "domain"])


def outlined(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As evidence(), but of the page only its domain and the year that its URL names (page_year)."""
    return facts(spark, sf_dir, SITE)


def topics(lines: DataFrame) -> DataFrame:
    """Topic titles of a text file: comments and blanks out, spaces to underscores, the first of equal ones (by case) stays."""
    numbered = lines.withColumn("line", F.monotonically_increasing_id())
    text = F.trim(F.split_part(F.trim("value"), F.lit(" #"), F.lit(1)))
    named = numbered.where(~F.trim("value").startswith("#")).select("line", F.replace(text, F.lit(" "), F.lit("_")).alias("topic")).where("topic <> ''")
    return named.groupBy(F.upper("topic").alias("key")).agg(F.min_by("topic", "line").alias("topic"), F.min("line").alias("line")).orderBy("line").select("topic")
