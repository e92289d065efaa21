"""Fact extraction from annotated sentences.

A sentence is text and tokens: ARRAY<STRUCT<i INT, text STRING, lemma STRING, pos STRING,
dep STRING, head INT, ent STRING>>.  Any annotator that yields this can be plugged in;
annotate() is a small rule-based one, so that no model is needed.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn

TOKENS = "array<struct<i:int,text:string,lemma:string,pos:string,dep:string,head:int,ent:string>>"
_FORMS = {f: v for v in lex.VERBS for f in (v, v + "s", v + "d" if v.endswith("e") else v + "ed")} | {"bought": "buy", "built": "build", "sold": "sell", "led": "lead"}


def _parse(sentence: str) -> list[dict]:
    """Runs of capitalised words are names; the first known verb governs the names beside it."""
    words = re.findall(r"[^\W\d_][\w'.&-]*|\d[\w-]*|[^\w\s]", sentence)
    tokens = [{"i": i, "text": w, "lemma": _FORMS.get(w.lower(), w.lower()), "pos": "VERB" if w.lower() in _FORMS else "PROPN" if w[0].isupper() else "NUM" if w[0].isdigit() else "X", "dep": "dep", "head": 0, "ent": "ORG" if w[0].isupper() and w.lower() not in lex.PRONOUNS else "DATE" if re.fullmatch(r"1\d{3}|20[0-2]\d", w) else ""} for i, w in enumerate(words)]
    verb = next((t["i"] for t in tokens if t["pos"] == "VERB"), None)
    if verb is not None:
        tokens[verb] |= {"dep": "ROOT", "head": verb}
        for side, dep in ((range(verb - 1, -1, -1), "nsubj"), (range(verb + 1, len(tokens)), "dobj")):
            run: list[int] = []
            for i in side:
                if tokens[i]["pos"] == "PROPN":
                    run.append(i)
                elif run:
                    break
            if run:
                head = max(run)
                for i in run:
                    tokens[i] |= {"dep": dep if i == head else "compound", "head": verb if i == head else head}
    return tokens


def annotate(sentences: DataFrame) -> DataFrame:
    """Adds tokens to rows with a column sentence (in Arrow batches)."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield f.assign(tokens=[_parse(s or "") for s in f["sentence"]])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in sentences.schema.fields)
    return sentences.mapInPandas(run, f"{fields}, tokens {TOKENS}")


def sentences(pages: DataFrame) -> DataFrame:
    """page_id, sentence, context of sentences of 5 to 60 words; general and interface sentences go."""
    parts = F.split("text", r"(?<=[.!?])\s+|\n+")
    rows = pages.select("page_id", F.posexplode(parts).alias("position", "sentence")).where(fn.word_count(F.col("sentence")).between(5, 60))
    return rows.withColumn("context", fn.context_of(F.col("sentence"))).where(~F.col("context").isin("GENERAL", "UI"))


def _span(tokens: Column, head: Column) -> Column:
    """Text of a token and what hangs on it directly."""
    mine = F.filter(tokens, lambda t: (t["i"] == head["i"]) | ((t["head"] == head["i"]) & t["dep"].isin("compound", "amod", "poss")))
    return F.array_join(F.transform(F.array_sort(mine), lambda t: t["text"]), " ")


def _is_name(x: Column) -> Column:
    low = F.lower(x)
    return x.isNotNull() & ~low.isin(*lex.PRONOUNS) & ~low.isin(*lex.GENERIC_ANSWERS) & F.length(x).between(3, 99) & (fn.word_count(x) <= 5)


def svo(annotated: DataFrame) -> DataFrame:
    """page_id, subject, rel, object, context, date: the governing known verb with its subject and its last object; negated verbs, pronouns and generic names give nothing; sentences of at most 40 words."""
    verb = F.try_element_at(F.filter("tokens", lambda t: (t["pos"] == "VERB") & t["lemma"].isin(*lex.VERBS)), F.lit(1))
    rows = annotated.where(F.size("tokens") <= 40).withColumn("verb", verb).where("verb IS NOT NULL")
    at = lambda deps, place: F.try_element_at(F.filter("tokens", lambda t: (t["head"] == F.col("verb.i")) & t["dep"].isin(*deps)), F.lit(place))
    rows = rows.where(~F.exists("tokens", lambda t: (t["head"] == F.col("verb.i")) & (t["dep"] == "neg")))
    rows = rows.withColumns({"s": F.coalesce(at(("agent",), 1), at(("nsubj",), 1)), "o": at(("dobj", "pobj", "iobj", "attr", "nsubjpass"), -1)})
    dates = F.transform(F.filter("tokens", lambda t: t["ent"] == "DATE"), lambda t: t["text"])
    verbs = F.create_map(*[F.lit(x) for kv in lex.VERBS.items() for x in kv])
    named = rows.select("page_id", _span(F.col("tokens"), F.col("s")).alias("subject"), F.try_element_at(verbs, F.col("verb.lemma")).alias("rel"), _span(F.col("tokens"), F.col("o")).alias("object"), "context", fn.normalise_date(fn.best_date(dates)).alias("date"))
    kept = named.where(_is_name(F.col("subject")) & _is_name(F.col("object")) & (F.lower("subject") != F.lower("object")))
    return kept.select("page_id", F.upper("subject").alias("subject"), "rel", F.upper("object").alias("object"), "context", "date").dropDuplicates()


def roles(annotated: DataFrame) -> DataFrame:
    """page_id, subject, role, object: a person with an appositive or copular title that a preposition ties to an organisation."""
    title = F.try_element_at(F.filter("tokens", lambda t: t["dep"].isin("attr", "appos") & t["pos"].isin("NOUN", "PROPN")), F.lit(1))
    rows = annotated.withColumn("title", title).where("title IS NOT NULL")
    prep = F.try_element_at(F.filter("tokens", lambda t: (t["dep"] == "prep") & (t["head"] == F.col("title.i"))), F.lit(1))
    person = F.try_element_at(F.filter("tokens", lambda t: (t["ent"] == "PERSON") & (t["dep"].isin("nsubj", "ROOT") | (t["i"] == F.col("title.head")))), F.lit(1))
    rows = rows.withColumns({"prep": prep, "person": person}).where("prep IS NOT NULL AND person IS NOT NULL")
    org = F.try_element_at(F.filter("tokens", lambda t: (t["dep"] == "pobj") & (t["head"] == F.col("prep.i")) & (t["ent"] == "ORG")), F.lit(1))
    rows = rows.withColumn("org", org).where("org IS NOT NULL")
    named = rows.select("page_id", _span(F.col("tokens"), F.col("person")).alias("subject"), F.col("title.text").alias("role"), _span(F.col("tokens"), F.col("org")).alias("object"))
    return named.where(_is_name(F.col("subject")) & _is_name(F.col("object"))).select("page_id", F.upper("subject").alias("subject"), "role", F.upper("object").alias("object")).dropDuplicates()


def consequences(rows: DataFrame) -> DataFrame:
    """page_id, cause, effect: the last name before a connective and the first after it, in sentences of 8 to 60 words."""
    name = r"[A-Z][\w'&.-]*(?: [A-Z][\w'&.-]*)*"
    at = F.regexp_extract("sentence", rf"(?i)\b({'|'.join(lex.CONNECTIVES)})\b", 1)
    found = rows.where(fn.word_count(F.col("sentence")).between(8, 60)).withColumn("connective", at).where("connective <> ''")
    place = F.expr("locate(connective, sentence)")
    names = lambda text: F.filter(F.regexp_extract_all(text, F.lit(f"({name})"), F.lit(1)), lambda x: ~F.lower(x).isin(*lex.PRONOUNS) & (F.length(x) > 1))
    left, right = F.substring("sentence", F.lit(1), place - 1), F.substring("sentence", place + F.length("connective"), F.lit(1 << 20))
    split = found.select("page_id", F.try_element_at(names(left), F.lit(-1)).alias("cause"), F.try_element_at(names(right), F.lit(1)).alias("effect"))
    return split.where("cause IS NOT NULL AND effect IS NOT NULL AND lower(cause) <> lower(effect)").select("page_id", F.upper("cause").alias("cause"), F.upper("effect").alias("effect")).dropDuplicates()


def infobox_fields(wikitext: str) -> dict[str, str]:
    """Fields of the first infobox, split at bars outside nested {{}} and [[]]."""
    m = re.search(r"\{\{\s*infobox", wikitext or "", re.IGNORECASE)
    if not m:
        return {}
    depth, part, parts, i = 0, "", [], m.start()
    while i < len(wikitext):
        two = wikitext[i : i + 2]
        if two in ("{{", "[["):
            depth, part, i = depth + 1, part + two, i + 2
        elif two in ("}}", "]]"):
            depth -= 1
            if not depth:
                break
            part, i = part + two, i + 2
        elif wikitext[i] == "|" and depth == 1:
            parts.append(part)
            part, i = "", i + 1
        else:
            part, i = part + wikitext[i], i + 1
    out = {}
    for p in [*parts, part][1:]:
        key, sign, value = p.partition("=")
        if sign and value.strip():
            out[re.sub(r"[\s-]", "_", key.strip().lower())] = value.strip()
    return out


def infobox(pages: DataFrame) -> DataFrame:
    """page_id, field, value (cleaned, up to five parts of 2 to 100 characters) of wikitext pages."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = [(p, k, v) for p, w in zip(f["page_id"], f["wikitext"], strict=True) for k, v in infobox_fields(w).items()]
            yield pd.DataFrame(rows, columns=["page_id", "field", "value"])

    raw = pages.select("page_id", "wikitext").mapInPandas(run, "page_id long, field string, value string")
    parts = F.slice(F.filter(F.transform(F.split(fn.clean_markup(F.col("value")), "[,;]"), F.trim), lambda x: F.length(x).between(2, 100)), 1, 5)
    return raw.select("page_id", "field", F.explode(parts).alias("value"))


def numbers(rows: DataFrame) -> DataFrame:
    """page_id, amount, unit of percentages and currency amounts with their multipliers; years and ordinals do not count."""
    pattern = r"(?i)([$€£¥])?\s?(\d+(?:,\d{3})*(?:\.\d+)?)\s?(thousand|million|billion|%|percent)?"
    found = rows.select("page_id", F.explode(F.regexp_extract_all("sentence", F.lit(pattern), F.lit(0))).alias("m"))
    sign, unit = F.regexp_extract("m", pattern, 1), F.lower(F.regexp_extract("m", pattern, 3))
    value = F.replace(F.regexp_extract("m", pattern, 2), F.lit(","), F.lit("")).try_cast("double")
    factor = F.when(unit == "thousand", 1e3).when(unit == "million", 1e6).when(unit == "billion", 1e9).otherwise(1.0)
    kind = F.when(unit.isin("%", "percent"), "percent").when(sign != "", sign)
    return found.select("page_id", (value * factor).alias("amount"), kind.alias("unit")).where("unit IS NOT NULL")
