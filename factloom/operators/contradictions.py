"""Facts that disagree: URL years, several targets, several roles, impossible order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn
from factloom.operators import chains as ch


def url_years(found: DataFrame, spread: int = 3) -> DataFrame:
    """Dated edges whose source URLs name years that lie at least `spread` apart; over 10 is high."""
    years = F.col("years") if "years" in found.columns else F.filter(F.array_distinct(F.transform("sources", fn.url_year)), lambda y: y.isNotNull())
    dated = found.where("date IS NOT NULL").select("subject", "rel", "object", "date", F.array_sort(years).alias("years"))
    wide = dated.where(F.size("years") > 1).withColumn("spread", F.array_max("years") - F.array_min("years")).where(F.col("spread") >= spread)
    return wide.withColumn("severity", F.when(F.col("spread") > 10, "high").otherwise("medium"))


def several_targets(found: DataFrame, relations=lex.SINGLE_TARGET, most: int | None = 50) -> DataFrame:
    """Subjects with several objects of a relationship that should have one, and at most one distinct date among them; the limit comes before the date test."""
    per = found.where(F.col("rel").isin(*relations)).groupBy("subject", "rel").agg(F.array_sort(F.collect_set("object")).alias("targets"), F.count_distinct("date").alias("n_dates"))
    per = per.where(F.size("targets") > 1)
    if most is not None:
        per = per.orderBy(F.desc(F.size("targets")), "subject", "rel").limit(most)
    return per.where("n_dates <= 1").withColumn("severity", F.lit("medium"))


def several_roles(found: DataFrame) -> DataFrame:
    """People with more than one distinct role at one organisation."""
    roles = found.where("rel = 'WAS_ROLE_OF' AND role <> ''").groupBy("subject", "object").agg(F.array_sort(F.collect_set("role")).alias("roles"))
    return roles.where(F.size("roles") > 1).withColumn("severity", F.lit("low"))


def impossible_order(found: DataFrame, founding=lex.FOUNDING) -> DataFrame:
    """Chains whose first edge founds what acts earlier on the second."""
    pairs = ch.two_hop(found.where(F.col("rel").isin(*founding)).unionByName(found.where(~F.col("rel").isin(*founding)))).where(F.col("action_1").isin(*founding))
    years = pairs.withColumns({"year_1": fn.extract_year(F.col("date_1")), "year_2": fn.extract_year(F.col("date_2"))})
    return years.where("year_2 < year_1").withColumn("severity", F.lit("high"))


def report(found: DataFrame, founding=lex.FOUNDING) -> DataFrame:
    """All kinds in one schema; missing columns are null."""
    kinds = {"url_years": url_years(found), "several_targets": several_targets(found), "several_roles": several_roles(found), "impossible_order": impossible_order(found, founding)}
    merged = None
    for kind, df in kinds.items():
        part = df.withColumn("type", F.lit(kind))
        merged = part if merged is None else merged.unionByName(part, allowMissingColumns=True)
    return merged


def severities(reported: DataFrame) -> DataFrame:
    return reported.groupBy("type", "severity").agg(F.count("*").alias("n"))
