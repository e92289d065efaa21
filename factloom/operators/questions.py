"""Questions from chains: rendering, export formats, parsing, evaluation.  Templates are this engine's own."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.functions import lexicons as lex
from factloom.functions import scalars as fn
from factloom.operators import chains as ch
from factloom.operators import verify
from factloom.session import written

#: Five wordings by kind; {a}, {c} and {e} are names, {r1} to {r3} actions, {t} the answer's class, {d} a date clause.
TEMPLATES = {
    "SVO": (
        "Name the {t} that links two records. According to one of them {a} {r1} it{d}; according to the other it {r2} {c}. Work out from both records which {t} is meant, and give its full name as the sources print it.",
        "Two independent statements share one {t}. The first says that {a} {r1} it{d}. The second says that it {r2} {c}. Which {t} fits both statements at once? Answer with the name that the sources use.",
        "Begin with {a}, which {r1} a certain {t}{d}. That same {t} {r2} {c}. Find the {t} in the middle of this chain and state its name exactly as it stands in the cited pages of both facts.",
        "Someone reads that {a} {r1} a {t}{d} and elsewhere that this {t} {r2} {c}. Neither page alone settles the matter. Put the two together and name the {t} that both pages speak about.",
        "Which {t} stands between {a} and {c}? The former {r1} it{d}, and it {r2} the latter. Only one {t} in the collection satisfies both relations; give its name as it appears there.",
    ),
    "ROLE": (
        "{a} held a post at a {t}{d}. The same {t} {r2} {c}. From these two facts alone, name the {t} in question, and write the name the way that the cited pages write it in full.",
        "A post at a certain {t} is on record for {a}{d}. That {t} also {r2} {c}. Which {t} do both records describe? Give the one name that fits, as it is printed in the sources.",
        "Follow {a} to the place where a post was held{d}; from there a second record says that it {r2} {c}. State the name of the {t} at which the two records meet, as the sources have it.",
        "One source lists {a} with a post at a {t}{d}, another says that this {t} {r2} {c}. Bring both together and tell which {t} it is, using the name under which it is listed.",
        "Identify the {t} that connects {a}, who held a post there{d}, with {c}, which it {r2}. Two records are needed to be sure; answer with the name of the {t} as written in them.",
    ),
    "CONSEQUENCE": (
        "{a} resulted in a certain {t}{d}, and this in turn {r2} {c}. What stands between the first and the last step of that sequence? Name the {t} as the sources that report both steps do.",
        "A sequence of three steps begins with {a}{d} and ends with {c}. The last step is one that the middle {r2}. Name the {t} in the middle, which the first step brought about.",
        "Two reports overlap in one {t}: in the first {a} resulted in it{d}, in the second it {r2} {c}. Which {t} do the two reports have in common? Answer with its name in the reports.",
        "What did {a} bring about{d} that afterwards {r2} {c}? Both links of this chain are on record, in different places; name the {t} that has to stand between them for both to hold.",
        "Between {a} and {c} lies one {t}. It came out of the former{d}, and it {r2} the latter. Give the name of the {t}, as the two records that make up this chain give it.",
    ),
    "THREE_HOP": (
        "Three records form one chain. {a} {r1} a certain {t}{d}; that {t} {r2} {c}; and {c} in turn {r3} {e}. Work out which {t} is meant, and give its full name as the sources print it.",
        "Begin with {a}, which {r1} a {t}{d}. The same {t} {r2} {c}, of which a third record says that it {r3} {e}. Name the {t} in this chain exactly as it stands in the cited pages.",
        "A chain of three links runs from {a} to {e}. The first: {a} {r1} a {t}{d}. The second: this {t} {r2} {c}. The third: {c} {r3} {e}. Which {t} fits the first two links at once?",
        "One page says that {a} {r1} a {t}{d}, another that this {t} {r2} {c}, and a third that {c} {r3} {e}. Put all three together and name the {t} that the first two pages speak about.",
        "Go back from {e}: it is on record that {c} {r3} it, that a certain {t} {r2} {c}, and that {a} {r1} this {t}{d}. Find the {t} and state its name as it appears in the sources.",
    ),
}
MIN_WORDS, MAX_WORDS = 30, 300


def clean_prompt(prompt: Column) -> Column:
    for wrong, right in ((r"\s+", " "), (r" ([,.;?])", "$1"), (r"\b([Aa]) ([aeiou])", "$1n $2"), (r"^In, ", "")):
        prompt = F.regexp_replace(prompt, wrong, right)
    return F.trim(prompt)


def rendered(chains: DataFrame, needed: Column | None = None) -> DataFrame:
    """Chains with answer and prompt: of the five wordings of the kind, from the hash's offset on, the first that does not give the answer away and has 30 to 300 words; null if none fits or where it is not needed."""
    c = F.col
    kind = F.when(c("kind").isin(*TEMPLATES), c("kind")).otherwise(F.lit("SVO"))
    wordings = F.lit(None).cast("array<string>")
    for name, texts in TEMPLATES.items():
        wordings = F.when(kind == name, F.array(*map(F.lit, texts))).otherwise(wordings)
    dated = F.coalesce(F.concat(F.lit(" (dated "), c("date_1"), F.lit(")")), F.lit(""))
    fill = {"{a}": c("title_a"), "{c}": c("title_c"), "{r1}": c("phrase_1"), "{r2}": c("phrase_2"), "{t}": c("kind_b"), "{d}": dated}
    if "entity_d" in chains.columns:
        fill |= {"{e}": F.coalesce("title_d", F.lit("")), "{r3}": F.coalesce("phrase_3", F.lit(""))}

    def filled(text: Column) -> Column:
        for mark, value in fill.items():
            text = F.replace(text, F.lit(mark), value)
        return clean_prompt(text)

    def wording(k: int) -> Column:
        at = (F.lit(k) + fn.variant_offset(c("chain_hash"))) % 5 + 1
        fits = F.filter(F.transform(F.array(F.element_at(wordings, at.cast("int"))), filled), lambda p: ~F.contains(F.lower(p), F.lower("entity_b")) & F.size(F.split(p, " ")).between(MIN_WORDS, MAX_WORDS))
        return F.try_element_at(fits, F.lit(1))

    prompt = F.coalesce(*(wording(k) for k in range(5)))
    return chains.withColumns({"prompt": prompt if needed is None else F.when(needed, prompt), "answer": F.upper("entity_b")})


SAME = ["entity_a", "action_1", "action_2", "entity_c"]


def _unique(found: DataFrame) -> DataFrame:
    return ch.uniqueness(ch.two_hop(found)).where("is_unique").select(*SAME, F.lit(True).alias("_unique"))


def chains(found: DataFrame, min_domains: int = 6, min_year: int | None = None, known_hashes: DataFrame | None = None) -> DataFrame:
    """Every chain of two and three edges with enough domains, once, with the first of the row-wise gates that it fails in reject_reason."""
    parallel = found.groupBy("subject", "rel", "object").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()

    def judged(some: DataFrame, hops: int) -> DataFrame:
        kept = some.where(F.col("unique_domains") >= min_domains)
        if parallel:  # otherwise no two chains have one key
            kept = ch.deduplicated(kept.withColumn("query_rank", F.lit(0))).drop("query_rank")
        return ch.gated(kept, min_year, known_hashes).withColumn("hops", F.lit(hops))

    return judged(ch.two_hop(found, min_domains), 2).unionByName(judged(ch.three_hop(found, min_domains), 3), allowMissingColumns=True)


def _late(some: DataFrame, found: DataFrame, min_sources: int) -> DataFrame:
    """The gates that need other chains or a wording: uniqueness, narrative, domains.  A chain that an earlier gate rejects is not worded."""
    tagged = rendered(some.join(_unique(found), SAME, "left"), F.col("reject_reason").isNull() & F.col("_unique").isNotNull())
    late = F.when(F.col("_unique").isNull(), "uniqueness").when(F.col("prompt").isNull(), "narrative").when(F.col("unique_domains") < min_sources, "graph_domains")
    return tagged.withColumn("reject_reason", F.coalesce("reject_reason", late)).drop("_unique")


def candidates(found: DataFrame, min_domains: int = 6, min_sources: int = 6, min_year: int | None = None, known_hashes: DataFrame | None = None) -> DataFrame:
    """Every chain of two and three edges with enough domains, in reject_reason the first gate that it fails (null: none), and its prompt if none before the wording rejects it.

    Chains of one key count once.  Gates in order: a hash written before, quality and
    bad answers, the year, another answer to the same question, no wording that fits,
    too few domains.  Sources are neither joined nor fetched here (see cited, verified).
    """
    return _late(chains(found, min_domains, min_year, known_hashes), found, min_sources)


ORDER = ["entity_a", "action_1", "entity_b", "action_2", "entity_c"]
#: What tells a chain from every other.
RANKED = ["hops", *ORDER, "action_3", "entity_d"]


def _edges_of(chains: DataFrame) -> DataFrame:
    """The edges (subject, rel, object) that chains consist of, each once."""
    legs = [chains.select(F.col(f"entity_{a}").alias("subject"), F.col(f"action_{k}").alias("rel"), F.col(f"entity_{b}").alias("object")) for k, (a, b) in enumerate(("ab", "bc", "cd"), 1)]
    return reduce(DataFrame.unionByName, legs).where("rel IS NOT NULL").distinct()


def run_of(tagged: DataFrame, most: int | None) -> DataFrame:
    """The accepted chains, the historical ones first, by a total order; at most as many as one run writes."""
    accepted = tagged.where("reject_reason IS NULL").withColumn("priority", F.when(F.least("year_1", "year_2") < 1950, 3).when(F.least("year_1", "year_2") < 2000, 2).when(F.least("year_1", "year_2").isNotNull(), 1).otherwise(0))
    ranked = accepted.orderBy(F.desc("priority"), "hops", *ORDER, F.coalesce("action_3", F.lit("")), F.coalesce("entity_d", F.lit("")))
    return ranked if most is None else ranked.limit(most)


def cited(chains: DataFrame, found: DataFrame) -> DataFrame:
    """Chains with the URLs of their edges, edge by edge in order of first mention, of each domain the first; keyed by chain_hash."""
    per_leg, sources = None, F.col("sources" if "sources" in found.columns else "firsts").alias("sources")
    for k, (a, b) in enumerate((("a", "b"), ("b", "c"), ("c", "d")), 1):
        if f"action_{k}" not in chains.columns:
            continue
        leg = chains.where(F.col(f"action_{k}").isNotNull()).select("chain_hash", F.col(f"entity_{a}").alias("subject"), F.col(f"action_{k}").alias("rel"), F.col(f"entity_{b}").alias("object"), F.coalesce(f"role_{k}", F.lit("")).alias("_role"))
        edge = found.select("subject", "rel", "object", F.coalesce("role", F.lit("")).alias("_role"), sources)
        urls = leg.join(edge, ["subject", "rel", "object", "_role"]).select("chain_hash", F.lit(k).alias("leg"), F.posexplode("sources").alias("pos", "url"))
        per_leg = urls if per_leg is None else per_leg.unionByName(urls)
    first = per_leg.groupBy("chain_hash", fn.netloc(F.col("url")).alias("domain")).agg(F.min(F.struct("leg", "pos", "url")).alias("first"))
    listed = first.groupBy("chain_hash").agg(F.transform(F.array_sort(F.collect_list("first")), lambda x: x["url"]).alias("sources"))
    return chains.join(listed, "chain_hash")


def verified(questions: DataFrame, pages: DataFrame, min_sources: int = 6) -> DataFrame:
    """Questions whose sources hold: pages (url, status_code, text) are checked against each chain's terms; only verified URLs stay, and questions with enough of them."""
    terms = questions.withColumn("terms", verify.key_terms(3 if "entity_d" in questions.columns else 2))
    checked = verify.checked(terms.select("chain_hash", F.explode("sources").alias("url"), "terms"), pages)
    good = checked.where("verified").groupBy("chain_hash").agg(F.collect_set("url").alias("_good"))
    kept = questions.join(good, "chain_hash").withColumn("sources", F.filter("sources", lambda u: F.array_contains("_good", u))).drop("_good")
    return kept.where(F.size("sources") >= min_sources)


def generate(found: DataFrame, most: int | None = None, min_domains: int = 6, min_sources: int = 6, min_year: int | None = None, known_hashes: DataFrame | None = None, pages: DataFrame | None = None) -> DataFrame:
    """Questions with prompt, answer, sources, explanation, fact_fanout and search_trajectory; sources are verified if pages are given.

    With a limit, chains that pass the row-wise gates are ranked, and only the first of
    them go through the others, four times as many each time until enough pass.  Ranking
    takes keys and years only; the first chains are then made again, whole, from their edges.
    """
    if most is None or pages is not None:
        tagged = candidates(found, min_domains, min_sources, min_year, known_hashes)
        if pages is None:
            return documents(cited(run_of(tagged, most), found))
        passed = verified(cited(run_of(tagged, None), found), pages, min_sources)
        return documents(run_of(passed, most))
    open_ = chains(found, min_domains, min_year, known_hashes).where((F.col("reject_reason").isNull()) & (F.col("unique_domains") >= min_sources))
    look = 4 * max(1, most)
    while True:
        ranked = written(run_of(open_.select(*RANKED, "year_1", "year_2", "reject_reason"), look), "ranked")
        enough = ranked.count() < look
        whole = chains(found.join(_edges_of(ranked), ["subject", "rel", "object"], "left_semi"), min_domains, min_year, known_hashes)
        same = [whole[k].eqNullSafe(ranked[k]) for k in RANKED]
        first = whole.join(ranked, reduce(Column.__and__, same), "left_semi")
        passed = written(_late(first, found, min_sources).where("reject_reason IS NULL"), "passed")
        if enough or passed.count() >= most:
            return documents(cited(run_of(passed, most), found))
        look *= 4


def funnel(tagged: DataFrame) -> DataFrame:
    """One row with the run's counters."""
    gate = lambda name: F.count_if(F.col("reject_reason") == name).alias(f"rejected_{name}")
    return tagged.agg(F.count("*").alias("total"), *(gate(g) for g in ch.GATES), F.count_if(F.col("reject_reason").isNull()).alias("accepted"))


def documents(questions: DataFrame) -> DataFrame:
    """Questions (with chain columns and sources) with explanation, fact_fanout and search_trajectory."""
    c = F.col
    step = lambda x, k, y: F.concat(c(f"title_{x}"), F.lit(" "), c(f"phrase_{k}"), F.lit(" "), c(f"title_{y}"), F.coalesce(F.concat(F.lit(", dated "), c(f"date_{k}")), F.lit("")))
    one, two = step("a", 1, "b"), step("b", 2, "c")
    three = step("c", 3, "d") if "entity_d" in questions.columns else F.lit(None).cast("string")
    facts = F.array_compact(F.array(one, two, three, F.concat(F.lit("The answer is of the class "), c("kind_b")), F.concat(F.lit("Domains that agree: "), F.size("sources").cast("string")), F.concat(F.lit("First source: "), F.coalesce(F.get("sources", F.lit(0)), F.lit("none")))))
    search = F.array(F.concat(F.lit("look up "), c("title_a")), F.concat(F.lit("list what it "), c("phrase_1")), F.concat(F.lit("look up "), c("title_c")), F.concat(F.lit("list what "), c("phrase_2"), F.lit(" it")), F.lit("keep what is on both lists"))
    return questions.withColumns({"explanation": F.concat(F.concat_ws("; ", one, two, three), F.lit(".")), "fact_fanout": F.slice(facts, 1, 12), "search_trajectory": search, "year": fn.parse_year(F.coalesce("date_1", "date_2"))})


SECTIONS = ("PROMPT", "SOURCES", "ANSWER", "EXPLANATION", "FACT_FANOUT", "SEARCH_TRAJECTORY")


def as_text(q: DataFrame) -> DataFrame:
    """chain_hash and the six sections as one text."""
    numbered = lambda col: F.array_join(F.transform(col, lambda x, i: F.concat((i + 1).cast("string"), F.lit(". "), x)), "\n")
    body = (F.col("prompt"), numbered("sources"), F.col("answer"), F.col("explanation"), numbered("fact_fanout"), numbered("search_trajectory"))
    text = F.concat_ws("\n\n", *(F.concat(F.lit(s + ":\n"), b) for s, b in zip(SECTIONS, body, strict=True)))
    return q.select("chain_hash", text.alias("text"))


def parsed(texts: DataFrame) -> DataFrame:
    """The sections of question texts (column text); rows without prompt or answer go."""
    section = lambda s: F.trim(F.regexp_extract(F.col("text"), rf"(?s)(?:^|\n){s}:\n(.*?)(?=\n\n(?:{'|'.join(SECTIONS)}):\n|\z)", 1))
    items = lambda s: F.filter(F.transform(F.split(section(s), "\n"), lambda x: F.regexp_replace(F.trim(x), r"^\d+\.\s*", "")), lambda x: x != "")
    out = texts.withColumns({"prompt": section("PROMPT"), "answer": section("ANSWER"), "explanation": section("EXPLANATION"), "sources": items("SOURCES"), "fact_fanout": items("FACT_FANOUT"), "search_trajectory": items("SEARCH_TRAJECTORY")})
    return out.where("prompt <> '' AND answer <> ''").drop("text")


def export_csv(q: DataFrame) -> DataFrame:
    short = F.when(F.length("explanation") > 200, F.concat(F.left("explanation", F.lit(200)), F.lit("..."))).otherwise(F.col("explanation"))
    return q.select(F.col("chain_hash").alias("id"), "prompt", "answer", F.array_join("sources", " | ").alias("sources"), short.alias("explanation"), "year")


def _json(*fields) -> Column:
    return F.to_json(F.struct(*fields), {"ignoreNullFields": "false"})


def export_json(q: DataFrame) -> DataFrame:
    return q.select(F.col("chain_hash").alias("id"), _json(F.col("chain_hash").alias("id"), "prompt", "answer", "sources", "explanation", "fact_fanout", "search_trajectory", "year").alias("line"))


def export_huggingface(q: DataFrame) -> DataFrame:
    answers = F.struct(F.array("answer").alias("text"), F.array(F.lit(-1)).alias("answer_start"))
    facts = F.transform("sources", lambda s: F.struct(s.alias("source"), F.lit(0).alias("sentence")))
    return q.select(F.col("chain_hash").alias("id"), _json(F.col("chain_hash").alias("id"), F.col("prompt").alias("question"), answers.alias("answers"), facts.alias("supporting_facts")).alias("line"))


def export_squad(q: DataFrame) -> DataFrame:
    qa = F.struct(F.col("chain_hash").alias("id"), F.col("prompt").alias("question"), F.array(F.struct(F.col("answer").alias("text"), F.lit(-1).alias("answer_start"))).alias("answers"), F.lit(False).alias("is_impossible"))
    paragraph = F.struct(F.col("explanation").alias("context"), F.array(qa).alias("qas"))
    return q.select(F.col("chain_hash").alias("id"), _json(F.col("entity_a").alias("title"), F.array(paragraph).alias("paragraphs")).alias("line"))


def export_hotpotqa(q: DataFrame) -> DataFrame:
    five = F.slice("sources", 1, 5)
    facts = F.transform(five, lambda s: F.struct(s.alias("title"), F.lit(0).alias("sentence")))
    context = F.transform(five, lambda s, i: F.struct(s.alias("title"), F.coalesce(F.get("fact_fanout", i), s).alias("text")))
    return q.select(F.col("chain_hash").alias("id"), _json(F.col("chain_hash").alias("_id"), F.col("prompt").alias("question"), "answer", facts.alias("supporting_facts"), context.alias("context"), F.lit("bridge").alias("type")).alias("line"))


def export_markdown(q: DataFrame) -> DataFrame:
    return q.select(F.col("chain_hash").alias("id"), F.concat(F.lit("## "), F.col("prompt"), F.lit("\n\n**"), F.col("answer"), F.lit("**\n\n- "), F.array_join("sources", "\n- "), F.lit("\n")).alias("line"))


def keyword_query(prompt: Column, first: int = 8, most: int = 5) -> Column:
    words = F.filter(F.split(F.lower(prompt), r"[^\p{L}\p{N}]+"), lambda w: (F.length(w) > 3) & ~w.isin(*lex.STOP_WORDS))
    return F.array_join(F.slice(F.slice(words, 1, first), 1, most), " ")


def last_sentence_query(prompt: Column) -> Column:
    last = F.trim(F.element_at(F.split(prompt, r"\."), -1))
    return F.left(F.regexp_replace(last, r"(?i)^(what|which|who|when|where|how)\s+", ""), F.lit(200))


def overlap_correct(answer: Column, response: Column, share: float) -> Column:
    """Enough of the answer's words occur in the response."""
    words = lambda x: F.array_distinct(F.filter(F.split(F.lower(x), r"\s+"), lambda w: w != ""))
    mine = words(answer)
    return F.size(F.array_intersect(mine, words(response))) >= F.greatest(F.lit(1.0), F.size(mine) * F.lit(share))


def difficulty(evaluations: DataFrame) -> DataFrame:
    """(question, correct) to score = 1 - correct / total, rounded, and a label; questions without evaluations are 0.5 unknown."""
    per = evaluations.groupBy("question").agg(F.count("correct").alias("total"), F.count_if("correct").alias("n_correct"))
    score = F.when(F.col("total") == 0, 0.5).otherwise(F.round(1 - F.col("n_correct") / F.col("total"), 2))
    label = F.when(F.col("total") == 0, "unknown").when(score >= 0.8, "HARD").when(score >= 0.5, "MEDIUM").when(score >= 0.2, "EASY").otherwise("TRIVIAL")
    return per.withColumns({"score": score, "label": label})


def difficulty_report(scored: DataFrame) -> DataFrame:
    return scored.agg(F.count("*").alias("n"), F.count_if(F.col("score") >= 0.8).alias("hard"), F.count_if((F.col("score") >= 0.5) & (F.col("score") < 0.8)).alias("medium"), F.count_if(F.col("score") < 0.5).alias("easy"), F.round(F.avg("score"), 4).alias("mean_score"))
