"""URL verdicts: allow and block rules first, then a hashed n-gram classifier.

DataFrame and SQL functions only.  A logistic regression on hashed character n-grams
of host and path is trained from the small labelled table below; its features come
from the same Spark expression that scores the pages, and its weights go into the
plan as one constant array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: (rule, verdict); a rule is host/path-prefix.
RULES = (("org/", "allow"), ("example.org/es/", "block"), ("example.org/en/1", "block"), ("com/fr/", "allow"), ("com/de/", "block"))
#: Rules are a constant of the plan; longer lists belong in a table.
MAX_RULES = 1000
N_BUCKETS = 4096
GRAM = 4

#: The labelled URL table, written for this module: hosts whose pages are spam, adverts or worse, and ordinary ones.
BAD = """
www.spam-farm.example.org/en/5 link-farm.example.net/de/91 m.spam-links.example.com/out/7 seo-spam.example.org/fr/88 blog.content-farm.example.net/en/404.html
cheap-pills.example.com/en/10 www.buy-pills.example.org/de/66.html online-pharmacy-pills.example.net/es/5 m.cheap-meds.example.com/en/93 viagra-cheap.example.org/fr/1 blog.diet-pills.example.net/en/300
casino-win.example.com/en/77 www.online-casino.example.org/de/8 best-casino-bonus.example.net/es/901 m.casino-slots.example.com/en/3.html poker-win.example.org/en/61 blog.big-win-slots.example.net/fr/5 jackpot-win.example.com/en/18
www.free-bets.example.org/en/22 sports-bets.example.net/de/140 m.betting-tips.example.com/en/71 live-bets.example.org/fr/36 blog.free-spins.example.net/en/9 free-money.example.com/es/12
www.ads-track.example.org/en/31 adserver.example.net/click/4 m.track-clicks.example.com/de/9 ad-tracker.example.org/en/12 blog.ads-pixel.example.net/out/88 popup-ads.example.com/fr/14 www.clicktrack.example.org/en/6
payday-loan.example.net/en/1 m.cheap-loans.example.com/de/45 fast-cash-loan.example.org/es/77 blog.replica-watches.example.net/en/51 cheap-bags.example.com/fr/65
www.adult-cams.example.org/en/2 adult-x.example.net/en/61 m.adult-zone.example.com/fr/7 x-rated.example.org/en/52 blog.xxx-videos.example.net/de/7 porn-tube.example.com/es/19 www.hot-sex-chat.example.org/en/33 warez-crack.example.net/fr/8 m.keygen-crack.example.com/en/41 torrent-warez.example.org/de/72
blog.get-rich-quick.example.net/en/14 miracle-weight-loss.example.com/fr/2 www.malware-download.example.org/en/6 phishing-login.example.net/de/1 m.scam-prize.example.com/es/30
"""
GOOD = """
weather.example.com/en/12 www.northern.example.org/de/40 blog.gardening.example.net/fr/7.html m.theatre.example.com/es/88 station.example.net/en/5
blog.station.example.com/en/17 m.nation.example.net/de/300 www.thinking.example.org/fr/42 reading.example.com/es/6/ blog.other.example.org/en/71
www.brothers.example.net/de/9 mother.example.org/fr/820 blog.father.example.com/en/33.html m.there.example.net/en/250 theory.example.com/de/18
www.athens.example.org/en/4 blog.earth.example.net/es/51 north.example.com/fr/999 www.south.example.net/de/63 m.healthy.example.org/en/7
library.example.com/en/12 www.museum.example.net/en/100 blog.kitchen.example.org/de/5.html history.example.com/fr/31 m.science.example.net/es/404
www.teaching.example.com/en/23 blog.printing.example.net/fr/8 nations.example.org/de/77 m.action.example.com/en/66 www.fashion.example.net/es/2
blog.rivers.example.org/en/540 oceans.example.com/de/41 m.forest.example.net/fr/6 www.letters.example.org/en/90 blog.sewing.example.com/es/13
thread.example.net/en/88 www.weaving.example.com/de/25 blog.leather.example.org/fr/61 m.feather.example.net/en/3/ whether.example.com/es/74
www.harbour.example.org/en/9 blog.village.example.com/de/480 m.county.example.net/fr/19 parish.example.org/en/57 www.school.example.com/es/32
blog.reunion.example.net/en/21 m.edition.example.org/de/830 www.mention.example.com/fr/44 tension.example.net/en/11 blog.question.example.org/es/60
www.tithe.example.org/en/628 blog.ten.example.net/en/455 m.heron.example.com/de/14 inn.example.org/fr/5 www.stand.example.net/en/210 blog.hearing.example.com/de/38
thesaurus.example.com/es/21 thistle.example.net/en/54 theses.example.com/en/97 thimble.example.net/en/318 nimble.example.org/fr/81 trouble.example.com/de/3 double.example.net/es/47 humble.example.com/en/620
within.example.com/en/8 thin-ice.example.net/de/29 theresa.example.com/en/155 thirst.example.org/fr/4 breathe.example.net/en/36 bathhouse.example.com/es/70 theirs.example.com/en/910 these.example.net/en/68
thesis.example.org/en/43 heather.example.com/de/15 rather.example.net/fr/56 gather.example.com/en/49 together.example.net/es/24 bother.example.com/en/135 theatres.example.com/fr/10 cheese.example.net/en/78
tents.example.com/en/27 thought.example.net/de/86 month.example.com/es/39 months.example.net/en/12 tenth.example.com/en/581 ninth.example.org/fr/73 height.example.net/en/94 lighthouse.example.com/de/2
readable.example.net/en/64 stable.example.com/en/17 marble.example.org/es/88 pebble.example.net/fr/301 cable.example.com/de/57 horses.example.com/en/46 trees.example.net/es/90 bees.example.com/en/11
cars.example.com/en/440 maps.example.net/fr/22 stamps.example.org/de/34 lists.example.com/en/59 tests.example.net/es/65 hints.example.com/fr/38 pens.example.net/en/76 pots.example.com/en/83
"""


def host_of(url: Column) -> Column:
    """After the first :// up to / ? # or the end, A-Z lower-cased; empty for null or without ://."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From the host's end up to ? # or the end; empty for null or without ://."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """The longest rule whose host is the url's or one above it and whose path starts the url's; null if none."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules fit into the plan")
    found = F.lit(None).cast("string")
    for rule, _ in sorted(rules, key=lambda r: (len(r[0]), r[0])):
        at, _, below = rule.partition("/")
        fits = ((host == at) | host.endswith("." + at)) & path.startswith("/" + below)
        found = F.when(fits, F.lit(rule)).otherwise(found)
    return found


def buckets(host: Column, path: Column) -> Column:
    """Distinct hashed n-grams of host and path, each part padded so that its ends count."""

    def grams(kind: str, part: Column) -> Column:
        padded = F.concat(F.lit("^"), part, F.lit("$"))
        starts = F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(padded) - (GRAM - 1)))
        return F.transform(starts, lambda i: F.pmod(F.xxhash64(F.lit(kind), F.substring(padded, i, F.lit(GRAM))), F.lit(N_BUCKETS)).cast("int"))

    return F.array_distinct(F.concat(grams("host", host), grams("path", path)))


def train(spark: SparkSession, bad: str = BAD, good: str = GOOD, rounds: int = 400, rate: float = 0.5, l2: float = 1e-3) -> tuple[list[float], float]:
    """Weights by bucket and the intercept, by gradient descent over the labelled table (a few hundred rows at most)."""
    labelled = [(u, 1) for u in bad.split()] + [(u, 0) for u in good.split()]
    values = ", ".join(f"('http://{u}', {y})" for u, y in labelled)
    table = spark.sql(f"SELECT * FROM VALUES {values} AS labelled(url, label)")
    rows = [(r["b"], r["label"]) for r in table.select(buckets(host_of(F.col("url")), path_of(F.col("url"))).alias("b"), "label").collect()]
    weights, bias = [0.0] * N_BUCKETS, 0.0
    for _ in range(rounds):
        slope, slope_bias = [0.0] * N_BUCKETS, 0.0
        for found, label in rows:
            scale = 1 / math.sqrt(len(found))
            error = 1 / (1 + math.exp(-(bias + scale * sum(weights[b] for b in found)))) - label
            slope_bias += error
            for b in found:
                slope[b] += error * scale
        bias -= rate * slope_bias / len(rows)
        for b in {b for found, _ in rows for b in found}:
            weights[b] -= rate * 20 * (slope[b] / len(rows) + l2 * weights[b] / 20)
    return weights, bias


def judge(pages: DataFrame, rules=RULES, threshold: float = 0.5) -> DataFrame:
    """page_id, host, path, rule, verdict (the rule's, else the classifier's) and its score for every row.

    A null url, or one without ://, has an empty host and path and is judged by the
    classifier; repeated rows stay; other columns are ignored; an empty table stays empty.
    """
    weights, bias = train(pages.sparkSession)
    constant = F.lit(",".join(f"{w:.5f}" for w in weights))
    table = F.split(constant, ",").cast("array<double>")
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    found = parts.withColumn("rule", matching_rule(F.col("host"), F.col("path"), rules)).withColumn("_b", buckets(F.col("host"), F.col("path")))
    total = F.aggregate("_b", F.lit(0.0), lambda a, b: a + F.element_at(table, b + 1))
    scored = found.withColumn("score", 1 / (1 + F.exp(-(F.lit(bias) + total / F.sqrt(F.size("_b"))))))
    by_rule = F.lit(None).cast("string")
    for verdict in ("allow", "block"):
        by_rule = F.when(F.col("rule").isin([r for r, v in rules if v == verdict]), F.lit(verdict)).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col("score") >= threshold, F.lit("block")).otherwise(F.lit("allow")))
    return scored.select("page_id", "host", "path", "rule", verdict.alias("verdict"), F.round("score", 6).alias("score"))
