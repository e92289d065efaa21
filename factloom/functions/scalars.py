"""Column functions: URLs, names, dates, hashes.  All stay inside whole-stage code generation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex

PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"


def netloc(url: Column) -> Column:
    """Lower-case network location without one leading www."""
    return F.regexp_replace(F.lower(raw_netloc(url)), r"^www[.]", "")


def raw_netloc(url: Column) -> Column:
    """Network location as written, port included."""
    return F.regexp_extract(F.trim(url), r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def canonical_url(url: Column) -> Column:
    """Without query, fragment and one trailing slash."""
    return F.regexp_replace(F.split_part(F.split_part(url, F.lit("?"), F.lit(1)), F.lit("#"), F.lit(1)), "/$", "")


def url_path(url: Column) -> Column:
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", 1)


def resolve_url(base: Column, link: Column) -> Column:
    """Absolute form of a link found on a page; a relative path replaces the base's last segment."""
    scheme = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*:)", 1)
    origin = F.regexp_extract(base, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    folder = F.regexp_replace(url_path(base), r"[^/]*$", "")
    return (
        F.when(link.rlike("^[A-Za-z][A-Za-z0-9+.-]*:"), link)
        .when(link.startswith("//"), F.concat(scheme, link))
        .when(link.startswith("/"), F.concat(origin, link))
        .when(link.startswith("#"), F.concat(F.split_part(base, F.lit("#"), F.lit(1)), link))
        .otherwise(F.concat(origin, F.when(folder == "", F.lit("/")).otherwise(folder), link))
    )


def word_count(text: Column) -> Column:
    return F.size(F.filter(F.split(F.coalesce(text, F.lit("")), r"\s+"), lambda w: w != ""))


def _without_suffixes(name: Column, suffixes) -> Column:
    for suffix in suffixes:
        name = F.regexp_replace(name, f" {suffix}$", "")
    return F.trim(name)


def plain_name(name: Column) -> Column:
    """Lower case, no surrounding punctuation, the plain suffixes cut in order."""
    return _without_suffixes(F.btrim(F.lower(F.trim(name)), F.lit(PUNCTUATION)), lex.PLAIN_SUFFIXES)


def resolver_name(name: Column) -> Column:
    """Upper case, no surrounding punctuation, one leading article of each kind and company suffixes cut in order."""
    x = F.btrim(F.upper(F.trim(name)), F.lit(PUNCTUATION))
    for article in ("THE", "A", "AN"):
        x = F.regexp_replace(x, f"^{article} ", "")
    return _without_suffixes(x, [s.upper() for s in lex.COMPANY_SUFFIXES])


def similarity(a: Column, b: Column) -> Column:
    """1 - edit distance / longer length; equal names, also empty ones, give 1."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(a == b, F.lit(1.0)).otherwise(1 - F.levenshtein(a, b) / longer)


def humanise(rel: Column) -> Column:
    pairs = [F.lit(x) for kv in lex.PHRASES.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), rel), F.lower(F.replace(rel, F.lit("_"), F.lit(" "))))


def title_case(name: Column) -> Column:
    """The first letter of every run of letters in upper case, the rest in lower case."""
    runs = F.regexp_extract_all(F.lower(name), F.lit(r"(\p{L}+|\P{L}+)"), F.lit(1))
    return F.array_join(F.transform(runs, lambda x: F.concat(F.upper(F.substring(x, 1, 1)), F.substring(x, 2, 1 << 20))), "")


def entity_type(name: Column) -> Column:
    """The first class with a key word inside the lower-cased name; else one word is an entity, more an organisation."""
    found = F.when(F.size(F.split(F.trim(name), r"\s+")) == 1, F.lit("entity")).otherwise(F.lit("organisation"))
    for kind, keys in reversed(lex.ENTITY_KEYS):
        found = F.when(F.lower(name).rlike("|".join(keys)), F.lit(kind)).otherwise(found)
    return found


def context_of(sentence: Column) -> Column:
    found = F.lit("GENERAL")
    for kind, keys in reversed(lex.CONTEXT_KEYS):
        found = F.when(F.lower(sentence).rlike("|".join(keys)), F.lit(kind)).otherwise(found)
    return found


_YEAR, _DECADE = r"\b(1[0-9]{3}|20[0-2][0-9])\b", r"\b([0-9]{4})'?s\b"


def _int(x: Column) -> Column:
    return F.nullif(x, F.lit("")).try_cast("int")


def extract_year(date: Column) -> Column:
    """The first whole word from 1000 to 2029."""
    return _int(F.regexp_extract(date, _YEAR, 1))


def parse_year(date: Column) -> Column:
    """As extract_year, else the year of a decade such as 1880s."""
    return F.coalesce(extract_year(date), _int(F.regexp_extract(date, _DECADE, 1)))


def normalise_date(date: Column) -> Column:
    year, decade = F.regexp_extract(date, _YEAR, 1), F.regexp_extract(date, _DECADE, 1)
    return F.when(decade != "", F.concat(decade, F.lit("s"))).when(year != "", year).otherwise(date)


def best_date(dates: Column) -> Column:
    """The longest hyphenated date, else the longest; the first on ties."""
    rank = lambda d: F.when(d.contains("-"), 1_000_000).otherwise(0) + F.length(d)
    return F.aggregate(dates, F.lit(None).cast("string"), lambda a, d: F.when(a.isNull() | (rank(d) > rank(a)), d).otherwise(a))


def in_url(year: Column) -> Column:
    """The first year of a URL, if from 1700 to 2024."""
    return F.when(year.between(1700, 2024), year)


def url_year(url: Column) -> Column:
    """A year inside a URL, if from 1700 to 2024."""
    return in_url(extract_year(url))


def priority(date_1: Column, date_2: Column) -> Column:
    """3 before 1950, 2 before 2000, 1 later, 0 undated; the earlier date counts."""
    first = F.least(parse_year(date_1), parse_year(date_2))
    return F.when(first < 1950, 3).when(first < 2000, 2).when(first.isNotNull(), 1).otherwise(0)


def chain_hash(*parts: Column) -> Column:
    """Eight hex digits that name a chain; null parts count as empty."""
    return F.substring(F.sha2(F.concat_ws("|", *(F.coalesce(p, F.lit("")) for p in parts)), 256), 1, 8)


def variant_offset(hash8: Column, variants: int = 5) -> Column:
    return (F.conv(hash8, 16, 10).cast("long") % variants).cast("int")


def term_matches(text: Column, term: Column) -> Column:
    """The term, or its first four letters if it has as many, stands in the text (both lower case)."""
    return F.contains(text, term) | ((F.length(term) >= 4) & F.contains(text, F.left(term, F.lit(4))))


def confirms(text: Column, subject: Column, object_: Column, strict: bool) -> Column:
    """A word of four letters or more of the subject (and/or of the object) stands in the text."""
    low = F.lower(text)
    hit = lambda name: F.exists(F.filter(F.split(F.lower(name), r"\s+"), lambda w: F.length(w) >= 4), lambda w: F.contains(low, w))
    return (hit(subject) & hit(object_)) if strict else (hit(subject) | hit(object_))


def first_url_per_domain(urls: Column, most: int | None = None) -> Column:
    """The first URL of each netloc, in order."""
    # every URL's site is found once: it is bound to a variable, which an expression repeated in a lambda is not
    per_site = lambda sites: F.filter(urls, lambda u, i: F.array_position(sites, F.get(sites, i)) == i + 1)
    kept = F.flatten(F.transform(F.array(F.transform(urls, netloc)), per_site))
    return kept if most is None else F.slice(kept, 1, most)


def least_url_per_domain(urls: Column) -> Column:
    """The least URL of each netloc, in order; one pass over the URLs sorted by netloc."""
    sites = F.array_sort(F.transform(urls, lambda u: F.struct(netloc(u).alias("site"), u.alias("url"))))
    start = F.struct(F.lit(None).cast("string").alias("site"), F.array().cast("array<string>").alias("urls"))
    step = lambda acc, x: F.when(acc["site"].eqNullSafe(x["site"]), acc).otherwise(F.struct(x["site"].alias("site"), F.array_append(acc["urls"], x["url"]).alias("urls")))
    return F.array_sort(F.aggregate(sites, start, step, lambda acc: acc["urls"]))


def clean_markup(value: Column) -> Column:
    """Wiki markup to plain text: references, tags, templates, links, quote marks, white space."""
    for pattern, by in ((r"(?s)<ref[^>]*?/>|<ref.*?</ref>", ""), (r"<[^>]+>", " "), (r"\{\{[^{}]*\}\}", ""), (r"\[\[(?:[^\]|]*\|)?([^\]]*)\]\]", "$1"), (r"'{2,}", ""), (r"\s+", " ")):
        value = F.regexp_replace(value, pattern, by)
    return F.trim(value)
