"""Evaluation of questions against answer services: two evaluators over response tables, scores, report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.operators import questions as qs


def _words(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != ""))


def _enough(answer: Column, response: Column, share: float) -> Column:
    """As many of the answer's words in the response as the share asks, one at least."""
    mine = _words(answer)
    return F.size(F.array_intersect(mine, _words(response))) >= F.greatest(F.lit(1.0), F.size(mine) * F.lit(share))


def instant_answer(asked: DataFrame) -> DataFrame:
    """(question, answer, abstract, reply, heading) to correct, confidence and ai_answer.

    Correct if 60 % of the answer's words stand in the abstract, the reply or the heading;
    then the confidence is high with a reply, medium without one.
    """
    c, text = F.col, lambda k: F.lower(F.coalesce(F.col(k), F.lit("")))
    correct = F.coalesce(*(F.when(_enough(c("answer"), c(k), 0.6), True) for k in ("abstract", "reply", "heading")), F.lit(False))
    found = lambda last: F.coalesce(F.nullif(text("heading"), F.lit("")), F.nullif(text("reply"), F.lit("")), last)
    confidence = F.when(~correct, "low").when(text("reply") != "", "high").otherwise("medium")
    said = F.when(correct, found(F.left(text("abstract"), F.lit(100)))).otherwise(found(F.lit("(no direct answer)")))
    return asked.select("question", F.lit("instant_answer").alias("evaluator"), correct.alias("correct"), confidence.alias("confidence"), said.alias("ai_answer"))


def title_search(asked: DataFrame, top: int = 3) -> DataFrame:
    """(question, answer, titles) to correct, confidence and ai_answer.

    Correct if half of the answer's words stand in one of the first titles; confidence
    is high if the first title that has them is the first of all, medium if a later one, unknown if none.
    """
    first = F.slice("titles", 1, top)
    hits = F.transform(first, lambda t: _enough(F.col("answer"), t, 0.5))
    at = F.array_position(hits, F.lit(True))
    best = F.lower(F.try_element_at("titles", F.lit(1)))
    same = F.lower(F.try_element_at("titles", F.greatest(at, F.lit(1)).cast("int"))) == best
    confidence = F.when(at == 0, "unknown").when(same, "high").otherwise("medium")
    return asked.select("question", F.lit("title_search").alias("evaluator"), (at > 0).alias("correct"), confidence.alias("confidence"), F.coalesce(F.try_element_at("titles", F.lit(1)), F.lit("(no results)")).alias("ai_answer"))


def evaluated(instant: DataFrame, titles: DataFrame) -> DataFrame:
    """Both evaluators' verdicts, and from them each question's difficulty and label."""
    both = instant_answer(instant).unionByName(title_search(titles))
    return qs.difficulty(both.select("question", "correct"))


def hardest(scored: DataFrame, most: int = 10) -> DataFrame:
    """The report's list: the hardest questions first."""
    return scored.orderBy(F.desc("score"), "question").limit(most)
