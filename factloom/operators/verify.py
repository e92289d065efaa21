"""Verification of chains against page texts, and enrichment of edges from candidate pages."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn
from factloom.session import written


def key_terms(hops: int = 2) -> Column:
    """Names, humanised actions and dates of a chain, blanks out, in order, distinct."""
    names = [f"entity_{x}" for x in "abcd"[: hops + 1]]
    parts = [F.col(n) for n in names] + [F.lower(F.replace(F.col(f"action_{k}"), F.lit("_"), F.lit(" "))) for k in (1, 2)] + [F.col(f"date_{k}") for k in range(1, hops + 1)]
    return F.array_distinct(F.filter(F.array(*parts), lambda x: F.trim(x) != ""))


def matched_terms(text: Column, terms: Column) -> Column:
    low = F.lower(text)
    return F.filter(terms, lambda t: fn.term_matches(low, F.lower(t)))


def checked(citations: DataFrame, pages: DataFrame, min_words: int = 100, min_terms: int = 2) -> DataFrame:
    """(chain_hash, url, terms) against (url, status_code, text): one row a URL, verified or not; a missing page is status 0."""
    joined = citations.join(pages.select("url", "status_code", "text"), "url", "left").withColumns({"status_code": F.coalesce("status_code", F.lit(0)), "text": F.coalesce("text", F.lit(""))})
    tested = joined.withColumns({"word_count": fn.word_count(F.col("text")), "matched_terms": matched_terms(F.col("text"), F.col("terms"))})
    passes = (F.col("status_code") == 200) & (F.col("word_count") >= min_words) & (F.size("matched_terms") >= min_terms)
    return tested.withColumn("verified", passes).select("chain_hash", "url", "status_code", "word_count", "matched_terms", "verified")


def gate(results: DataFrame, min_sources: int) -> DataFrame:
    """Chains with enough verified URLs from as many different locations (as written, www. kept)."""
    good = F.col("verified")
    counts = results.groupBy("chain_hash").agg(F.count_if(good).alias("n_verified"), F.count_distinct(F.when(good, fn.raw_netloc(F.col("url")))).alias("n_domains"))
    return counts.withColumn("passed", (F.col("n_verified") >= min_sources) & (F.col("n_domains") >= min_sources))


def under_covered(found: DataFrame, target: int, entity: str | None = None, most: int | None = None) -> DataFrame:
    """Edges with fewer domains than the target, the least covered first."""
    rows = found.where(F.size("domains") < target)
    if entity:
        rows = rows.where(F.contains("subject", F.lit(entity.upper())) | F.contains("object", F.lit(entity.upper())))
    rows = rows.orderBy(F.size("domains"), "subject", "rel", "object")
    return rows if most is None else rows.limit(most)


def search_query(subject: Column, rel: Column, object_: Column) -> Column:
    """What to search for to find more sources of a fact: the relation's wording, else names and relation."""
    said = F.lit("{A} {rel} {B}")
    for name, wording in lex.SEARCHES.items():
        said = F.when(rel == name, F.lit(wording)).otherwise(said)
    for mark, value in (("{A}", fn.title_case(subject)), ("{B}", fn.title_case(object_)), ("{rel}", F.lower(F.replace(rel, F.lit("_"), F.lit(" "))))):
        said = F.replace(said, F.lit(mark), value)
    return said


def enriched(found: DataFrame, pages: DataFrame, target: int = 6, strict: bool = False) -> DataFrame:
    """Edges in which those with fewer domains than the target take every page that confirms them as a source.

    Pages do not change by being cited, so one pass over all of them reaches what rounds
    of searches reach; n_new tells how many sources each edge gained.
    """
    from factloom.operators.edges import with_sources

    work = found.where(F.size("domains") < target)
    grown = with_sources(work, confirmations(work, pages, strict)).withColumn("n_new", F.lit(None).cast("int"))
    before = work.select("subject", "rel", "object", "role", F.size("sources").alias("_n"))
    same = [grown[k].eqNullSafe(before[k]) for k in ("subject", "rel", "object", "role")]
    counted = grown.join(before, same[0] & same[1] & same[2] & same[3]).select(*(grown[c] for c in found.columns), (F.size(grown["sources"]) - before["_n"]).alias("n_new"))
    return found.where(F.size("domains") >= target).withColumn("n_new", F.lit(0)).unionByName(counted)


def gains(work: DataFrame, pages: DataFrame, cited: Callable[[DataFrame], DataFrame], strict: bool = False) -> DataFrame:
    """Edges (subject, rel, object, role) without sources, each with n_new: how many URLs confirm it that it does not cite; cited as in confirmations()."""
    edge, role = ["subject", "rel", "object"], F.coalesce("role", F.lit("")).alias("_role")
    urls, wanted = _met(work.select(*edge).distinct(), pages, strict)
    old = cited(wanted).select(*edge, role, "url").distinct()
    new = work.select(*edge, role).distinct().join(urls.select(*edge, "url").distinct(), edge).join(old, [*edge, "_role", "url"], "left_anti")
    counted = new.groupBy(*edge, "_role").agg(F.count("*").cast("int").alias("n_new"))
    return work.withColumn("_role", role).join(counted, [*edge, "_role"], "left").withColumn("n_new", F.coalesce("n_new", F.lit(0))).drop("_role")


def confirmations(worklist: DataFrame, pages: DataFrame, strict: bool = False, cited: Callable[[DataFrame], DataFrame] | None = None) -> DataFrame:
    """(subject, rel, object, source_url, domain) of pages that name the edge's ends and are not yet its sources.

    cited gives the (subject, rel, object, url) that edges cite already, for those of them that some
    page names; without it they are in the worklist's column sources.  URLs are compared as rows: no
    edge's sources travel with its pages.
    """
    edge = ["subject", "rel", "object"]
    urls, wanted = _met(worklist.select(*edge).distinct(), pages, strict)
    old = cited(wanted) if cited else worklist.join(wanted, edge, "left_semi").select(*edge, F.explode("sources").alias("url"))
    new = urls.join(old.select(*edge, "url").distinct(), [*edge, "url"], "left_anti")
    return new.select(*edge, F.col("url").alias("source_url"), fn.netloc(F.col("url")).alias("domain"))


#: Lengths of the pieces on which words meet texts.
PIECES = (4, 8, 16, 32)


def _met(edges: DataFrame, pages: DataFrame, strict: bool) -> tuple[DataFrame, DataFrame]:
    """(subject, rel, object, url), once for each page that confirms the edge, and the edges that have any word on any page.

    A word of an edge has no white space, so a text that has it has it inside one run
    without white space.  Such runs repeat from page to page: each text is cut into them
    once, and only distinct runs meet distinct words, on the word's last 4, 8, 16 or 32
    characters, which misses none; the rule decides.  Pages come back by the runs that hold a word.
    """
    long = lambda name: F.array_distinct(F.filter(F.split(F.lower(F.coalesce(F.col(name), F.lit(""))), r"\s+"), lambda w: F.length(w) >= 4))
    named = edges.select("subject", "rel", "object", long("subject").alias("_subject"), long("object").alias("_object"))
    named = named.withColumn("_words", F.array_union("_subject", "_object"))
    runs = pages.select(F.monotonically_increasing_id().alias("page"), "url", long("text").alias("runs")).where(F.size("runs") > 0)
    runs = written(runs, "runs")
    each = runs.select("page", "url", F.explode("runs").alias("run"))
    width = F.lit(PIECES[0])
    for w in PIECES[1:]:
        width = F.when(F.length("word") >= w, w).otherwise(width)
    words = named.select(F.explode("_words").alias("word")).distinct().withColumn("piece", F.right("word", width))
    cut = lambda w: F.when(F.length("run") >= w, F.transform(F.sequence(F.lit(1), F.length("run") - w + 1), lambda i: F.substring(F.col("run"), i, F.lit(w)))).otherwise(F.array().cast("array<string>"))
    pieces = each.select("run").distinct().select("run", F.explode(F.array_distinct(F.concat(*map(cut, PIECES)))).alias("piece"))
    held = written(pieces.join(words, "piece").where(F.contains("run", F.col("word"))).select("run", "word").distinct(), "held")
    found = each.join(held, "run").groupBy("page", "url").agg(F.collect_set("word").alias("_found"))
    met = found.withColumn("word", F.explode("_found")).join(named.withColumn("word", F.explode("_words")), "word")
    # an edge meets a page at the least of its words there, so once
    once = met.where(F.col("word") == F.array_min(F.array_intersect("_words", "_found")))
    if strict:
        once = once.where(F.arrays_overlap("_subject", "_found") & F.arrays_overlap("_object", "_found"))
    wanted = named.select("subject", "rel", "object", F.explode("_words").alias("word")).join(held.select("word").distinct(), "word", "left_semi")
    return once.select("subject", "rel", "object", "url"), written(wanted.select("subject", "rel", "object").distinct(), "wanted")
