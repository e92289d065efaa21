"""Edges, chains, resolution, contradictions, extraction, questions, streaming on small fixtures."""

import itertools

from pyspark.sql import functions as F

from factloom.operators import chains as ch
from factloom.operators import contradictions as contra
from factloom.operators import edges as ed
from factloom.operators import extract
from factloom.operators import questions as qs
from factloom.operators import resolve

EVIDENCE = "seq long, subject string, rel string, object string, role string, context string, date string, source_url string, domain string"


def ev(spark, rows):
    return spark.createDataFrame([(i, s, r, o, role, c, d, u, u.split("/")[2].removeprefix("www.")) for i, (s, r, o, role, c, d, u) in enumerate(rows, 1)], EVIDENCE)


def test_upsert_keeps_first_values(spark):
    urls = ["https://www.a.org/1", "https://b.org/2", "https://a.org/9", "https://b.org/2"]
    dates, contexts = [None, "1887", "1870", "1850"], ["CORPORATE", "GENERAL", "CORPORATE", "CORPORATE"]
    for rel, date in (("FOUNDED", "1887"), ("LED_TO", None)):
        row = ed.edges(ev(spark, [("JANE DOE", rel, "ACME RAIL", None, c, d, u) for c, d, u in zip(contexts, dates, urls, strict=True)])).first()
        assert row["sources"] == urls[:3] and row["domains"] == ["a.org", "b.org"]
        assert (row["occurrences"], row["context"], row["date"]) == (4, "CORPORATE", date)


def test_roles_stay_apart_until_consolidated(spark):
    e = ed.edges(ev(spark, [("PP", "WAS_ROLE_OF", "OO", r, "X", None, "http://a.org/1") for r in ("CEO", "CHAIR")]))
    assert e.count() == 2
    row = ed.consolidated(e).first()
    assert (row["occurrences"], row["merged"]) == (2, 2)


def _arrows(spark, pairs):
    return ed.edges(ev(spark, [(a, "R", b, None, "X", None, "http://a.org/1") for a, b in pairs]))


def test_chains(spark):
    e = _arrows(spark, [("AA", "BB"), ("BB", "CC"), ("CC", "AA"), ("AA", "CC")])
    assert {tuple(r) for r in ch.two_hop(e).select("entity_a", "entity_b", "entity_c").collect()} == {("AA", "BB", "CC"), ("BB", "CC", "AA"), ("CC", "AA", "BB")}
    assert ch.three_hop(e).count() == 0
    assert ch.three_hop(_arrows(spark, [("AA", "BB"), ("BB", "CC"), ("CC", "DD")])).count() == 1


def _distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def test_fuzzy_pairs_equal_brute_force(spark):
    names = ["ACME RAILWAY", "ACME RAILWAYS", "ACME RAIL", "NORTH MILL", "NORTH HILL", "SOUTH MILL", "THE ACME", "ACME", "", "MILL NORTH", "ABCDEFGHIJ", "XABCDEFGHI", "ABCDEFGHI", "NORTHMILL", "ACNE RAILWAY"]
    for t in (0.85, 0.6):
        plain = lambda n: n.removeprefix("THE ")
        expected = {tuple(sorted((a, b))) for a, b in itertools.combinations(names, 2) if plain(a) and plain(b) and plain(a) != plain(b) and 1 - _distance(plain(a), plain(b)) / max(len(plain(a)), len(plain(b))) >= t - 1e-12}
        found = resolve.fuzzy_pairs(spark.createDataFrame([(n,) for n in names], "name string"), t)
        assert {(r["a"], r["b"]) for r in found.collect()} == expected


def test_greedy_merge_is_one_pass_over_ordered_pairs(spark):
    pairs = [("A1", "A2"), ("A2", "A3"), ("A3", "A4"), ("B1", "B22")]
    found = resolve.greedy_aliases(spark.createDataFrame(pairs, "a string, b string"))
    assert {tuple(r) for r in found.collect()} == {("A2", "A1"), ("A4", "A3"), ("B22", "B1")}


def test_greedy_merge_goes_on_until_no_pair_is_left(spark):
    import random

    rng = random.Random(4)
    hub = [("A0", f"B{i:03}") for i in range(300)]
    mixed = [tuple(sorted(rng.sample([f"{c}{'x' * rng.randint(0, 2)}{i}" for c in "CD" for i in range(40)], 2))) for _ in range(150)]
    pairs = sorted(set(hub + mixed + [("B000", "C"), ("E1", "E2"), ("E2", "E3"), ("E3", "E4"), ("E4", "E5")]))
    expected = {}
    for a, b in pairs:
        canonical, old = (a, b) if len(a) <= len(b) else (b, a)
        if canonical not in expected and old not in expected:
            expected[old] = canonical
    assert sum(c == "A0" for c in expected.values()) >= 299
    for alone in (0, 20, 20_000):
        found = resolve.greedy_aliases(spark.createDataFrame(pairs, "a string, b string"), alone).collect()
        assert len(found) == len(expected) and {r["old"]: r["canonical"] for r in found} == expected


def test_contradictions(spark):
    rows = [("XX", "FOUNDED", "BB", None, "X", "1920", "http://a.org/1870/x"), ("XX", "FOUNDED", "BB", None, "X", "1920", "http://b.org/1882/x"), ("BB", "ACQUIRED", "CC", None, "X", "1890", "http://a.org/1"), ("XX", "FOUNDED", "CC", None, "X", "1920", "http://a.org/1")]
    rows += [("PP", "WAS_ROLE_OF", "OO", r, "X", None, "http://a.org/1") for r in ("CEO", "CHAIR")]
    e = ed.edges(ev(spark, rows))
    assert [(r["spread"], r["severity"]) for r in contra.url_years(e).collect()] == [(12, "high")]
    assert contra.several_targets(e).first()["targets"] == ["BB", "CC"]
    assert contra.several_roles(e).first()["roles"] == ["CEO", "CHAIR"]
    assert contra.impossible_order(e).count() == 1
    assert contra.report(e).count() == 4


def test_extraction_and_infobox(spark):
    text = "Acme Rail acquired North Mill in 1887 for a company stake. The coal strike of Acme Rail led to the closing of South Mill in the company."
    found = extract.svo(extract.annotate(extract.sentences(spark.createDataFrame([(1, text)], "page_id long, text string"))))
    assert ("ACME RAIL", "ACQUIRED", "NORTH MILL", "1887") in {(r["subject"], r["rel"], r["object"], r["date"]) for r in found.collect()}
    assert ("ACME RAIL", "SOUTH MILL") in {(r["cause"], r["effect"]) for r in extract.consequences(extract.sentences(spark.createDataFrame([(1, text)], "page_id long, text string"))).collect()}
    assert extract.infobox_fields("{{Infobox company|name=[[A|B]]|Key people={{x|y}} C}}") == {"name": "[[A|B]]", "key_people": "{{x|y}} C"}


def test_question_text_round_trip(spark):
    e = ed.edges(ev(spark, [("RED MILL", "ACQUIRED", "NORTH MILL", None, "X", "1887", "http://a.org/1"), ("NORTH MILL", "RELEASED", "BLUE LINE", None, "X", "1890", "http://b.org/1")]))
    chains = ch.with_sources(ch.gated(ch.two_hop(e)), e)
    q = qs.documents(qs.rendered(chains))
    row = q.first()
    assert row["answer"] == "NORTH MILL" and "north mill" not in row["prompt"].lower()
    back = qs.parsed(qs.as_text(q)).first()
    for column in ("prompt", "answer", "sources", "explanation", "fact_fanout", "search_trajectory"):
        assert back[column] == row[column]


def test_difficulty(spark):
    rows = spark.createDataFrame([(1, True), (1, False), (2, False), (2, False), (3, None)], "question long, correct boolean")
    assert {r["question"]: (r["score"], r["label"]) for r in qs.difficulty(rows).collect()} == {1: (0.5, "MEDIUM"), 2: (1.0, "HARD"), 3: (0.5, "unknown")}


def test_streaming_equals_batch(spark, tmp_path):
    from factloom.streaming import ingest

    sentence = "Acme Rail acquired North Mill in 1887 for a company stake. "
    pages = spark.createDataFrame([(i, f"http://h{i}.org/p", f"<p>{sentence * (20 + i)}</p>") for i in range(4)], ingest.PAGES)
    pages.where("page_id < 2").coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    pages.where("page_id >= 2").coalesce(1).write.parquet(f"{tmp_path}/in", mode="append")
    ingest.run(ingest.read(spark, f"{tmp_path}/in", files=1), f"{tmp_path}/out", f"{tmp_path}/check").awaitTermination()
    streamed = {tuple(r) for r in spark.read.parquet(f"{tmp_path}/out").drop("batch").collect()}
    assert streamed == {tuple(r) for r in ingest.evidence_of(pages).collect()} and len(streamed) == 4


def test_greedy_merge_takes_every_customer(spark):
    from factloom.functions import scalars as fn
    from factloom.plans import catalog
    from factloom.session import table

    sf = "/root/testdata/sf0.001"
    names = catalog._names(spark, sf).union(table(spark, sf, "customer").select("c_name")).distinct()
    plain = {r["name"]: r["plain"] for r in names.withColumn("plain", fn.resolver_name(F.col("name"))).collect()}
    expected = {}
    for a, b in itertools.combinations(sorted(n for n in plain if plain[n]), 2):
        x, y = plain[a], plain[b]
        n = max(len(x), len(y))
        if x == y or abs(len(x) - len(y)) > 0.15 * n + 1e-9 or 1 - _distance(x, y) / n < 0.85 - 1e-12:
            continue
        canonical, old = (a, b) if len(x) <= len(y) else (b, a)
        if canonical not in expected and old not in expected:
            expected[old] = canonical
    assert {r["old"]: r["canonical"] for r in catalog.QUERIES["greedy_merge"](spark, sf).collect()} == expected
    assert sum(x.startswith("Customer#") for x in expected) > 100


def test_questions_take_six_domains_three_hops_and_every_source(spark, monkeypatch):
    from factloom.plans import catalog

    edge = lambda a, r, b, site, n: [(a, r, b, None, "X", "1887", f"http://{site}{i:02}.org/1") for i in range(n)]
    rows = edge("RED MILL", "ACQUIRED", "NORTH MILL", "a", 3) + edge("NORTH MILL", "RELEASED", "BLUE LINE", "b", 4) + edge("BLUE LINE", "ACQUIRED", "GREEN WORKS", "c", 25)
    monkeypatch.setattr(catalog, "_edges", lambda *_: ed.edges(ev(spark, rows)))
    found = {(r["entity_b"], r["entity_d"]): r for r in catalog._questions(spark, None).collect()}
    assert {k: len(r["sources"]) for k, r in found.items()} == {("NORTH MILL", None): 7, ("BLUE LINE", None): 29, ("NORTH MILL", "GREEN WORKS"): 32}
    three = found["NORTH MILL", "GREEN WORKS"]
    assert "Green Works" in three["prompt"] and "Green Works" in three["explanation"] and len({r["chain_hash"] for r in found.values()}) == 3


def test_confirmations_miss_no_substring(spark):
    from factloom.operators import verify

    edges = spark.createDataFrame([("RAILWAY", "ACQUIRED", "J.P. CO", ["http://z.org"]), ("X-RAY J.P.M", "LED_TO", "ABC", ["http://z.org"]), ("AB", "R", "CD", [])], "subject string, rel string, object string, sources array<string>")
    texts = {"http://a.org/1": "two Railways met", "http://b.org/1": "by j.p.m. and (x-ray)", "http://c.org/1": "rail way", "http://d.org/1": "abc", "http://e.org/1": "", "http://z.org": "railway"}
    found = verify.confirmations(edges, spark.createDataFrame(list(texts.items()), "url string, text string")).collect()
    expected = {(r["subject"], u) for r in edges.collect() for u, t in texts.items() if u not in r["sources"] and any(len(w) >= 4 and w in t.lower() for end in (r["subject"], r["object"]) for w in end.lower().split())}
    assert {(r["subject"], r["source_url"]) for r in found} == expected == {("RAILWAY", "http://a.org/1"), ("RAILWAY", "http://b.org/1"), ("X-RAY J.P.M", "http://b.org/1")} and len(found) == 3


def test_whole_enrichment_takes_every_edge(spark):
    from factloom.plans import catalog

    sf = "/root/testdata/sf0.001"
    urls, rels = catalog.QUERIES["pick_url_all"](spark, sf), {r["rel"] for r in catalog._edges(spark, sf).select("rel").distinct().collect()}
    assert {r["rel"] for r in urls.select("rel").distinct().collect()} == rels and len(rels) > 1
    released = urls.where("rel = 'RELEASED'").select("subject", "object", "urls").collect()
    assert sorted(map(tuple, released)) == sorted(map(tuple, catalog.QUERIES["pick_url"](spark, sf).collect()))
    assert set(catalog.QUERIES["enrich_all"](spark, sf).columns) == {"subject", "rel", "object", "source_url", "domain"}


def test_outlines_are_edges_without_sources(spark):
    import random

    rng = random.Random(7)
    names = ["AA", "BB", "CC", "D"]
    rows = [(rng.randrange(40), rng.choice(names), rng.choice(["LED_TO", "ACQUIRED"]), rng.choice(names), rng.choice([None, "CEO", "CHAIR"]), rng.choice([None, "X", "Y"]), rng.choice([None, "1990", "1880s"]), f"http://{rng.choice('abc')}.org/{rng.choice([1950, 2001, 'p'])}/{k}") for k in range(400)]
    evidence = spark.createDataFrame([(*r, r[-1].split("/")[2]) for r in rows], EVIDENCE)
    from factloom.functions import scalars as fn

    whole = ed.edges(evidence)
    plan = whole._jdf.queryExecution().executedPlan().toString()
    assert "SortAggregate" not in plan  # structs as minima would be sorted: a spill of all evidence
    first = {r["seq"]: r for r in evidence.groupBy("seq", "domain").agg(F.min("source_url").alias("u")).collect()}
    lean = ed.outlines(evidence.withColumn("url_year", fn.url_year(F.col("source_url"))), years=True)
    key = ["subject", "rel", "object", "role"]
    same = key + ["domains", "occurrences", "context", "date"]
    assert sorted(map(str, whole.select(*same).collect())) == sorted(map(str, lean.select(*same).collect())) and first
    years = lambda e: sorted(map(str, contra.url_years(e).select("subject", "rel", "object", "years", "spread").collect()))
    assert years(whole) == years(lean) != []


def test_edges_keep_the_first_url_of_each_domain(spark):
    from factloom.functions import scalars as fn
    from factloom.plans import catalog

    sf, key = "/root/testdata/sf0.001", ["subject", "rel", "object", "role"]
    found = catalog._edges(spark, sf)
    assert "sources" not in found.columns  # a chain, a gate or a count needs none of them
    whole = catalog._sourced(spark, sf).select(*key, "domains", "occurrences", "context", "date", fn.first_url_per_domain(F.col("sources")).alias("firsts"))
    assert sorted(map(str, found.select(*whole.columns).collect())) == sorted(map(str, whole.collect()))


def test_confirmations_equal_brute_force_and_carry_no_sources(spark):
    import random

    from factloom.operators import verify

    rng = random.Random(3)
    words = ["rail", "railway", "customer#000000012", "customer#000000013", "mill", "x-mill", "abc", "north", "counterrevolutionary-and-other-things-of-length"]
    name = lambda: " ".join(rng.sample(words, rng.randint(1, 2))).upper()
    pages = [(f"http://{i % 25}.org/x", " ".join(rng.choice(["re", "", "\t"]) + rng.choice([*words, "zzzz"]) + rng.choice(["s", ",", ""]) for _ in range(rng.randint(0, 4))) if i else None) for i in range(40)]
    pages.append(pages[-1])  # the same page twice
    rows = {(name(), "R", name()): rng.sample(sorted({u for u, _ in pages}), 4) for _ in range(25)}
    work = spark.createDataFrame([(*k, s) for k, s in rows.items()], "subject string, rel string, object string, sources array<string>")
    texts = spark.createDataFrame(pages, "url string, text string")
    for strict in (False, True):
        hit = lambda end, text: any(len(w) >= 4 and w in (text or "").lower() for w in end.lower().split())
        both = all if strict else any
        expected = sorted((s, r, o, u) for (s, r, o), old in rows.items() for u, t in pages if u not in old and both((hit(s, t), hit(o, t))))
        found = verify.confirmations(work, texts, strict)
        assert "first(sources" not in found._jdf.queryExecution().executedPlan().toString()
        assert sorted(tuple(r)[:4] for r in found.collect()) == expected != []
        cited = lambda wanted: work.join(wanted, ["subject", "rel", "object"], "left_semi").select("subject", "rel", "object", F.explode("sources").alias("url"))
        assert sorted(tuple(r)[:4] for r in verify.confirmations(work.drop("sources"), texts, strict, cited).collect()) == expected


def test_gains_count_by_role(spark):
    from factloom.operators import verify

    roles = {None: [], "CEO": ["http://1.org"], "CHAIR": ["http://1.org", "http://2.org"], "X": ["http://9.org"]}
    work = spark.createDataFrame([("RAILWAY", "R", "AB", r) for r in roles] + [("CD", "R", "AB", None)], "subject string, rel string, object string, role string")
    old = spark.createDataFrame([("RAILWAY", "R", "AB", r, u) for r, urls in roles.items() for u in urls], "subject string, rel string, object string, role string, url string")
    pages = spark.createDataFrame([(f"http://{i}.org", "the railways") for i in (1, 2, 3, 3)] + [("http://4.org", "rail way")], "url string, text string")
    found = verify.gains(work, pages, lambda wanted: old.join(wanted, ["subject", "rel", "object"], "left_semi"))
    assert {(r["subject"], r["role"]): r["n_new"] for r in found.collect()} == {("RAILWAY", None): 3, ("RAILWAY", "CEO"): 2, ("RAILWAY", "CHAIR"): 1, ("RAILWAY", "X"): 3, ("CD", None): 0}


def test_greedy_merge_by_blocks_is_one_pass_over_all_pairs(spark):
    import random

    rng = random.Random(11)
    names = {f"Customer#{i:09}" for i in rng.sample(range(400), 60)} | {"ACME RAIL" + "X" * rng.randint(0, 4) + rng.choice(["", "S", " Inc"]) for _ in range(20)} | {f"{rng.choice('AB')}{'O' * rng.randint(5, 12)}{rng.choice('CD')}" for _ in range(40)}
    rows = spark.createDataFrame([(n,) for n in sorted(names)], "name string")
    pairs = resolve.fuzzy_pairs(rows)
    assert pairs.count() == pairs.select("a", "b").distinct().count()  # each met once, before any is made distinct
    expected = {r["old"]: r["canonical"] for r in resolve.greedy_aliases(pairs).collect()}
    assert len(expected) > 60 and any(len(o) != len(c) for o, c in expected.items())
    for first in (1, 4, 30, 500):
        found = resolve.greedy_merge(rows, first=first).collect()
        assert len(found) == len(expected) and {r["old"]: r["canonical"] for r in found} == expected


def test_ranking_and_wording_take_no_more_than_they_need(spark, monkeypatch):
    edge = lambda a, r, b, site, n, role=None: [(a, r, b, role, "X", "1887", f"http://{site}{i:02}.org/1") for i in range(n)]
    rows = [x for k in range(6) for x in edge(f"RED MILL {k}", "WAS_ROLE_OF", "NORTH MILL", f"a{k}", 4, "CEO") + edge(f"RED MILL {k}", "WAS_ROLE_OF", "NORTH MILL", f"z{k}", 5, "CHAIR")]
    e = ed.edges(ev(spark, rows + edge("NORTH MILL", "RELEASED", "BLUE LINE", "b", 4) + edge("NORTH MILL", "RELEASED", "HIS", "c", 4)))
    seen = []
    ranked = qs.run_of
    monkeypatch.setattr(qs, "run_of", lambda tagged, most: seen.append(tagged.columns) or ranked(tagged, most))
    columns = ["entity_a", "chain_hash", "prompt", "answer", "explanation", "sources", "role_1"]
    few = sorted(map(str, qs.generate(e, 3).select(*columns).collect()))
    assert "title_a" not in seen[0] and "prompt" not in seen[0]
    assert few == sorted(map(str, qs.generate(e).select(*columns).collect()))[:3] and len(few) == 3
    tagged = qs.candidates(e).collect()
    assert {r["prompt"] is None for r in tagged if r["reject_reason"]} == {True} and {r["prompt"] is None for r in tagged if not r["reject_reason"]} == {False}
