"""Scalar functions against hand-worked values."""

import pytest
from pyspark.sql import functions as F

from factloom.functions import scalars as fn

CASES = [
    (fn.netloc, "https://WWW.Example.org:8080/x", "example.org:8080"),
    (fn.netloc, "mailto:x", ""),
    (fn.netloc, "http://www.www.a.org", "www.a.org"),
    (fn.canonical_url, "http://a.org/x/?q=1#f", "http://a.org/x"),
    (fn.parse_year, "1880s", 1880),
    (fn.extract_year, "1880s", None),
    (fn.parse_year, "March 15, 1887", 1887),
    (fn.parse_year, "2035", None),
    (fn.parse_year, "the 940s", None),
    (fn.normalise_date, "the 1880's", "1880s"),
    (fn.normalise_date, " 1887 ", "1887"),
    (fn.normalise_date, "early spring", "early spring"),
    (fn.title_case, "J.P. MORGAN'S", "J.P. Morgan'S"),
    (fn.title_case, "3RD", "3Rd"),
    (fn.resolver_name, "The Acme Inc", "ACME"),
    (fn.word_count, "  a b\n c ", 3),
    (fn.clean_markup, "[[A|B]] ''x'' <ref>y</ref>{{z}}", "B x"),
]


@pytest.mark.parametrize("function,value,expected", CASES)
def test_scalar(spark, function, value, expected):
    assert spark.range(1).select(function(F.lit(value)).alias("x")).first()["x"] == expected


@pytest.mark.parametrize("a,b,expected", [("ACME RAILWAY", "ACME RAILWAYS", 0.9231), ("ACME RAIL", "ACME RAILWAY", 0.75), ("X", "X", 1.0), ("", "", 1.0)])
def test_similarity(spark, a, b, expected):
    assert round(spark.range(1).select(fn.similarity(F.lit(a), F.lit(b)).alias("x")).first()["x"], 4) == expected


def test_chain_hash_and_offset(spark):
    row = spark.range(1).select(fn.chain_hash(*map(F.lit, ("JANE DOE", "FOUNDED", "ACME RAIL", "ACQUIRED", "NORTH MILL"))).alias("h")).select("h", fn.variant_offset(F.col("h")).alias("o")).first()
    assert (row["h"], row["o"]) == ("51fec44d", 3)


def test_priority_and_terms(spark):
    rows = spark.createDataFrame([("1949", "2001"), ("1999", None), ("2000", None), (None, None)], "a string, b string")
    assert [r["p"] for r in rows.select(fn.priority(F.col("a"), F.col("b")).alias("p")).collect()] == [3, 2, 1, 0]
    text = F.lit("the rail line")
    row = spark.range(1).select(fn.term_matches(text, F.lit("railway")).alias("a"), fn.term_matches(text, F.lit("sec")).alias("b")).first()
    assert row["a"] and not row["b"]


def test_one_url_per_domain_and_best_date(spark):
    row = spark.range(1).select(
        fn.first_url_per_domain(F.array(*map(F.lit, ("http://www.a.org/1", "http://a.org/2", "http://b.org/3")))).alias("u"),
        fn.best_date(F.array(*map(F.lit, ("1887", "1887-03-15", "in the spring of 1887")))).alias("d"),
        fn.resolve_url(F.lit("http://a.org/x/y"), F.lit("z")).alias("r"),
    ).first()
    assert row["u"] == ["http://www.a.org/1", "http://b.org/3"]
    assert row["d"] == "1887-03-15" and row["r"] == "http://a.org/x/z"
