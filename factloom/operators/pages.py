"""Page pipeline: URL gates, text gates, links, page identity and deduplication."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn


def _alternatives(words) -> str:
    return "|".join(w.replace(".", "[.]") for w in words)


def is_allowed(url: Column) -> Column:
    return fn.netloc(url).isin(*lex.ALLOWED_DOMAINS)


def url_verdict(url: Column) -> Column:
    """ok, or the first rule that rejects the URL; listed hosts skip the noise rules."""
    path, host = F.lower(fn.url_path(url)), fn.netloc(url)
    return (
        F.when(~url.rlike("^(?i)https?://[^/?#]+"), "scheme")
        .when(path.rlike(rf"\.({'|'.join(lex.REJECTED_ENDINGS)})$"), "ending")
        .when(path.rlike(_alternatives(lex.DELIVERY_PARTS)), "delivery")
        .when(host.rlike(rf"(^|[.])({_alternatives(lex.BLOCKED_DOMAINS)})$"), "blocked")
        .when(path.rlike(rf"^({'|'.join(lex.FEED_PATHS)})(/|$)"), "feed")
        .when(~is_allowed(url) & path.rlike(_alternatives(lex.NOISY_PARTS)), "noisy")
        .otherwise("ok")
    )


def path_verdict(url: Column, filters: dict[str, tuple[str, ...]]) -> Column:
    """False if the host has filtered sections and the path is in one, true if it has and is not, null for other hosts."""
    path, host, found = F.lower(fn.url_path(url)), F.lower(fn.raw_netloc(url)), F.lit(None).cast("boolean")
    for site, prefixes in filters.items():
        inside = F.lit(False)
        for prefix in prefixes:
            inside = inside | path.startswith(prefix)
        found = F.when(host == site, ~inside).otherwise(found)
    return found


def is_skipped(url: Column) -> Column:
    """Pages that are marked as done unread: deliveries, binaries and forms, by parts of the URL."""
    return F.lower(url).rlike("|".join(w.replace(".", "[.]") for w in lex.SKIPPED_PARTS))


def rate_limit(host: Column, default: float = 2.0) -> Column:
    pairs = [F.lit(x) for kv in lex.RATE_LIMITS.items() for x in kv]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), host), F.lit(default))


def crawl_delay(robots: Column) -> Column:
    """The first crawl-delay of a robots.txt, whatever its user agent."""
    return F.nullif(F.regexp_extract(robots, r"(?im)^\s*crawl-delay\s*:\s*([0-9]+(?:\.[0-9]+)?)", 1), F.lit("")).try_cast("double")


def is_thin(html: Column, least: int = 300) -> Column:
    """Fewer than `least` white-space separated tokens of raw HTML."""
    return fn.word_count(html) < least


def links(pages: DataFrame) -> DataFrame:
    """page_id and the absolute, canonical target of every anchor with an href; repeated links of a page count once."""
    found = F.array_distinct(F.regexp_extract_all("html", F.lit(r"(?i)<a\b[^>]*?href=\"([^\"]*)\""), F.lit(1)))
    exploded = pages.select("page_id", "url", F.explode(found).alias("href")).where("href <> ''")
    return exploded.select("page_id", fn.canonical_url(fn.resolve_url(F.col("url"), F.col("href"))).alias("link")).distinct()


def frontier(found: DataFrame, visited: DataFrame) -> DataFrame:
    """Links worth fetching next: valid and not seen before, each once."""
    return found.select(F.col("link").alias("url")).distinct().where(url_verdict(F.col("url")) == "ok").join(visited.select("url"), "url", "left_anti")


def content_hash(html: Column) -> Column:
    return F.sha2(html, 256)


def new_pages(incoming: DataFrame, existing: DataFrame) -> DataFrame:
    """Incoming pages (page_id, url, html) whose URL and content are new; of equal ones the smallest page_id stays."""
    hashed = incoming.withColumn("content_hash", content_hash(F.col("html")))
    fresh = hashed.join(existing.select("url"), "url", "left_anti").join(existing.select("content_hash"), "content_hash", "left_anti")
    columns = ["page_id", "url", "html", "content_hash"]
    by_url = fresh.groupBy("url").agg(F.min(F.struct("page_id", "html", "content_hash")).alias("p")).select("url", "p.*")
    by_content = by_url.groupBy("content_hash").agg(F.min(F.struct("page_id", "url", "html")).alias("p")).select("content_hash", "p.*")
    return by_content.select(*columns)


def visible_text(html: Column) -> Column:
    """Text of a page by patterns alone: scripts, styles, menus, footers, adverts and tags out, references decoded, white space collapsed."""
    text = html
    for name in ("script", "style", "nav", "footer", "aside", "form"):
        text = F.regexp_replace(text, rf"(?is)<{name}\b.*?</{name}>", " ")
    text = F.regexp_replace(text, r'(?is)<div class="ad">.*?</div>', " ")
    text = F.regexp_replace(F.regexp_replace(text, r"(?s)<!--.*?-->", " "), r"<[^>]+>", " ")
    for code, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")):
        text = F.replace(text, F.lit(code), F.lit(sign))
    return F.trim(F.regexp_replace(text, r"\s+", " "))


def chunks(text: Column, most: int = 2_500_000, size: int = 100_000) -> Column:
    """Fixed windows of a text without overlap."""
    cut = F.left(text, F.lit(most))
    return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.length(cut), F.lit(1)) - 1) / size).cast("int")), lambda i: F.substring(cut, i * size + 1, F.lit(size)))


def per_domain(pages: DataFrame, most: int = 10) -> DataFrame:
    return pages.groupBy(fn.netloc(F.col("url")).alias("domain")).agg(F.count("*").alias("n_pages")).orderBy(F.desc("n_pages"), "domain").limit(most)
