"""Multi-hop chains: edge self-joins on names and domain counts; arrays come back only for what is kept."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn


#: A leg carries the domains themselves only where it has fewer than this; with more it passes every gate alone.
FEW = 8


def prepared(found: DataFrame) -> DataFrame:
    """Edges with all that gates and wordings need of an edge, so that no chain parses a name or a date again."""
    subject, object_ = F.col("subject"), F.col("object")
    plain = fn.plain_name(object_)
    return found.withColumns(
        {
            "n_domains": F.size("domains"),
            "few": F.when(F.size("domains") < FEW, F.col("domains")),
            "year": fn.parse_year(F.col("date")),
            "plain": plain,
            "subject_noise": fn.plain_name(subject).isin(*lex.NOISE_WORDS),
            "subject_single": fn.word_count(fn.plain_name(subject)) == 1,
            "object_noise": plain.isin(*lex.NOISE_WORDS),
            "object_marked": F.contains("object", F.lit("'")) | F.startswith("object", F.lit("THE ")),
            "object_bad": F.lower("object").rlike("|".join(lex.BAD_ANSWER_PARTS)) | (F.length(plain) < 3) | plain.isin(*lex.GENERIC_ANSWERS),
            "subject_title": fn.title_case(subject),
            "object_title": fn.title_case(object_),
            "phrase": fn.humanise(F.col("rel")),
            "object_kind": fn.entity_type(object_),
        }
    )


def _leg(found: DataFrame, k: int, rel: str | None = None) -> DataFrame:
    if rel:
        found = found.where(F.col("rel") == rel)
    names, c = "abcd", F.col
    columns = {f"entity_{names[k - 1]}": "subject", f"action_{k}": "rel", f"role_{k}": "role", f"entity_{names[k]}": "object", f"date_{k}": "date", f"domains_{k}": "n_domains", f"few_{k}": "few", f"year_{k}": "year", f"phrase_{k}": "phrase"}
    if k == 1:
        columns |= {"a_noise": "subject_noise", "a_single": "subject_single", "b_plain": "plain", "b_marked": "object_marked", "b_bad": "object_bad", "title_a": "subject_title", "title_b": "object_title", "kind_b": "object_kind", "context": "context"}
    elif k == 2:
        columns |= {"c_noise": "object_noise", "title_c": "object_title"}
    else:
        columns |= {"title_d": "object_title"}
    return prepared(found).select(*(c(old).alias(new) for new, old in columns.items()))


def _counted(chains: DataFrame, hops: int, min_domains: int) -> DataFrame:
    """With domain_count, the edges' domains added up, and unique_domains, how many differ (exact below FEW)."""
    legs = range(1, hops + 1)
    total, most = F.col("domains_1"), F.greatest(*(F.col(f"domains_{k}") for k in legs))
    for k in legs[1:]:
        total = total + F.col(f"domains_{k}")
    unique = F.when(most >= FEW, most).otherwise(F.size(F.array_distinct(F.concat(*(f"few_{k}" for k in legs)))))
    return chains.withColumn("domain_count", total).where(total >= min_domains).withColumn("unique_domains", unique).drop(*(f"few_{k}" for k in legs))


def two_hop(found: DataFrame, min_domains: int = 0, first: str | None = None, kind: str = "SVO") -> DataFrame:
    """a -> b -> c with three distinct names and enough domains over both edges; first: the first edge's relationship."""
    chains = _leg(found, 1, first).join(_leg(found, 2), "entity_b").where("entity_a <> entity_b AND entity_b <> entity_c AND entity_a <> entity_c")
    return _counted(chains, 2, min_domains).withColumn("kind", F.lit(kind))


def three_hop(found: DataFrame, min_domains: int = 0) -> DataFrame:
    """a -> b -> c -> d with four distinct names."""
    chains = _leg(found, 1).join(_leg(found, 2), "entity_b").where("entity_a <> entity_b AND entity_b <> entity_c AND entity_a <> entity_c")
    chains = chains.join(_leg(found, 3), "entity_c").where("entity_c <> entity_d AND entity_b <> entity_d AND entity_a <> entity_d")
    return _counted(chains, 3, min_domains).withColumn("kind", F.lit("THREE_HOP"))


def all_chains(found: DataFrame, min_domains: int = 0) -> DataFrame:
    """Two-hop patterns in rank order (any, role first, consequence first); the first pattern that finds a chain keeps it."""
    ranked = None
    for rank, (first, kind) in enumerate(((None, "SVO"), ("WAS_ROLE_OF", "ROLE"), ("LED_TO", "CONSEQUENCE"))):
        part = two_hop(found, min_domains, first, kind).withColumn("query_rank", F.lit(rank))
        ranked = part if ranked is None else ranked.unionByName(part)
    return deduplicated(ranked)


KEY = ["entity_a", "action_1", "entity_b", "action_2", "entity_c"]


def key_of(chains: DataFrame) -> list[str]:
    """The key's columns; a chain of three edges has two more."""
    return KEY + [c for c in ("action_3", "entity_d") if c in chains.columns]


def deduplicated(chains: DataFrame) -> DataFrame:
    """The first chain of each key in rank order, then by roles and dates; a partial minimum, no sort."""
    key = key_of(chains)
    rest = [c for c in chains.columns if c not in key and c != "query_rank"]
    order = F.struct("query_rank", *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_{c}") for c in ("role_1", "role_2", "date_1", "date_2")), *rest)
    kept = chains.groupBy(*key).agg(F.min(order).alias("_first"))
    return kept.select(*key, "_first.query_rank", *(F.col(f"_first.{c}").alias(c) for c in rest))


def thresholds(chains: DataFrame, steps=(1, 2, 3, 6, 8)) -> DataFrame:
    """Chains at or above each domain count, in one pass."""
    counts = chains.agg(*(F.count_if(F.col("domain_count") >= t).alias(f"at_least_{t}") for t in steps))
    return counts.select(F.explode(F.array(*(F.struct(F.lit(t).alias("min_domains"), F.col(f"at_least_{t}").alias("n_chains")) for t in steps))).alias("r")).select("r.*")


def uniqueness(chains: DataFrame) -> DataFrame:
    """For each (a, action, action, c): how many different middles there are by normalised name; one is unique."""
    key = ["entity_a", "action_1", "action_2", "entity_c"]
    return chains.groupBy(*key).agg(F.count_distinct("b_plain").alias("n_middles")).withColumn("is_unique", F.col("n_middles") <= 1)


def with_sources(chains: DataFrame, found: DataFrame) -> DataFrame:
    """Chains with the URLs and domains of their edges, joined by edge key after every filter."""
    def side(k: int, a: str, b: str) -> DataFrame:
        return found.select(F.col("subject").alias(f"entity_{a}"), F.col("rel").alias(f"action_{k}"), F.col("object").alias(f"entity_{b}"), F.col("role").alias(f"_role_{k}"), F.col("sources").alias(f"_s{k}"), F.col("domains").alias(f"_d{k}"))

    joined = chains
    legs = (("a", "b"), ("b", "c"), ("c", "d"))[: 3 if "entity_d" in chains.columns else 2]
    for k, (a, b) in enumerate(legs, 1):
        right = side(k, a, b)
        keys = [f"entity_{a}", f"action_{k}", f"entity_{b}"]
        right = right.withColumnsRenamed({x: f"_{x}" for x in keys})
        same = F.col(f"role_{k}").eqNullSafe(F.col(f"_role_{k}"))
        for x in keys:
            same &= F.col(x) == F.col(f"_{x}")
        joined = joined.join(right, same).drop(f"_role_{k}", *(f"_{x}" for x in keys))
    union = lambda x: F.array_distinct(F.concat(*(f"_{x}{k}" for k in range(1, len(legs) + 1))))
    return joined.withColumns({"sources": union("s"), "domains": union("d")}).drop(*(f"_{x}{k}" for x in "sd" for k in range(1, len(legs) + 1)))


GATES = ("duplicate", "entity", "min_year", "uniqueness", "narrative", "graph_domains", "sources")


def gated(chains: DataFrame, min_year: int | None = None, known_hashes: DataFrame | None = None) -> DataFrame:
    """Chains with chain_hash, quality and the first of the row-wise gates (GATES[:3]) that rejects each one (null: none)."""
    tagged = chains.withColumn("chain_hash", fn.chain_hash(*(F.col(c) for c in key_of(chains)))).withColumn("quality", quality())
    if known_hashes is not None:
        tagged = tagged.join(known_hashes.select(F.col("hash").alias("chain_hash"), F.lit(True).alias("_seen")).distinct(), "chain_hash", "left")
    else:
        tagged = tagged.withColumn("_seen", F.lit(None).cast("boolean"))
    reason = F.when(F.col("_seen"), "duplicate").when((F.col("quality") < 5) | F.col("b_bad"), "entity")
    if min_year is not None:
        reason = reason.when(F.greatest("year_1", "year_2") >= min_year, "min_year")
    return tagged.withColumn("reject_reason", reason).drop("_seen")


def quality() -> Column:
    """Quality in tenths, 0 to 10, so that the gate at 5 is exact.

    Zero for an answer of under four letters or a noise word at an end.  From 10: -4 if
    a one-word name LED_TO the answer, -3 both LED_TO, -2 an answer with an apostrophe or a
    leading article, +1 both dated, -2 neither; +1 before 1950, -1 no year; +1 four
    different domains, -1 one.
    """
    c, when = F.col, lambda test, tenths: F.when(test, tenths).otherwise(0)
    first, led_1, led_2 = F.least("year_1", "year_2"), c("action_1") == "LED_TO", c("action_2") == "LED_TO"
    dated_1, dated_2 = (F.coalesce(c(d), F.lit("")) != "" for d in ("date_1", "date_2"))
    tenths = (
        F.lit(10)
        - when(led_1 & c("a_single"), 4)
        - when(led_1 & led_2, 3)
        - when(c("b_marked"), 2)
        + when(dated_1 & dated_2, 1)
        - when(~dated_1 & ~dated_2, 2)
        + when(first < 1950, 1)
        - when(first.isNull(), 1)
        + when(c("unique_domains") >= 4, 1)
        - when(c("unique_domains") == 1, 1)
    )
    return F.when((F.length("b_plain") < 4) | c("a_noise") | c("c_noise"), 0).otherwise(F.greatest(F.lit(0), F.least(F.lit(10), tenths)))


def funnel(gates: DataFrame) -> DataFrame:
    return gates.groupBy(F.coalesce("reject_reason", F.lit("kept")).alias("gate")).agg(F.count("*").alias("n_chains"))


def by_priority(chains: DataFrame, most: int | None = None) -> DataFrame:
    """Historical chains first; ties by key, so that a limit is deterministic."""
    ranked = chains.withColumn("priority", fn.priority(F.col("date_1"), F.col("date_2"))).orderBy(F.desc("priority"), *KEY)
    return ranked if most is None else ranked.limit(most)


def top_by_domains(chains: DataFrame, most: int) -> DataFrame:
    return chains.orderBy(F.desc("domain_count"), *KEY, "role_1", "role_2", "date_1", "date_2").limit(most)


def row_per_url(urls: DataFrame) -> DataFrame:
    """(chain, position, url) reduced to the first URL of each domain of a chain."""
    w = Window.partitionBy("chain_hash", fn.netloc(F.col("url"))).orderBy("position")
    return urls.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")
