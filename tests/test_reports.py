"""Reports, evaluation, files, known facts, enrichment and the gates of a run on small fixtures."""

from pyspark.sql import functions as F

from factloom.operators import chains as ch
from factloom.operators import edges as ed
from factloom.operators import evaluation, reports, verify
from factloom.operators import pages as pg
from factloom.operators import questions as qs
from factloom.sources import files

EVIDENCE = "seq long, subject string, rel string, object string, role string, context string, date string, source_url string, domain string"


def edges(spark, rows):
    return ed.edges(spark.createDataFrame([(i, s, r, o, None, "X", d, u, u.split("/")[2]) for i, (s, r, o, d, u) in enumerate(rows)], EVIDENCE))


def spread(a, r, b, date, site, n):
    return [(a, r, b, date, f"http://{site}{i:02}.org/1") for i in range(n)]


CHAIN = spread("RED MILL", "ACQUIRED", "NORTH MILL", "1887", "a", 4) + spread("NORTH MILL", "RELEASED", "BLUE LINE", "1890", "b", 4)


def test_health_and_advice(spark):
    row = reports.health(edges(spark, CHAIN)).first()
    assert (row["n_entities"], row["n_edges"], row["n_dated"], row["dated_percent"], row["n_pre_1950"], row["max_domains"], row["n_chains"], row["advice"]) == (3, 2, 2, 100, 2, 4, 1, "moderate")
    assert reports.health(edges(spark, CHAIN[:1])).first()["advice"] == "sparse"
    assert reports.health(edges(spark, CHAIN).limit(0)).first()["advice"] == "empty"


def test_domain_summary(spark):
    rows = spark.createDataFrame([([],), (["b", "a", "b"],), ([f"d{i}" for i in range(14)],)], "d array<string>")
    found = [r[0] for r in rows.select(reports.domain_summary(F.col("d"), 3)).collect()]
    assert found == ["0 domains", "2 domains: a, b", "14 domains: d0, d1, d10, ... (+11 more)"]


def test_gates_in_order(spark):
    rows = CHAIN + spread("RED MILL", "ACQUIRED", "SOUTH MILL", "1887", "c", 4) + spread("SOUTH MILL", "RELEASED", "GREEN LINE", "1999", "d", 4)
    rows += spread("GREY MILL", "ACQUIRED", "HIS", "1887", "e", 4) + spread("HIS", "RELEASED", "OLD LINE", "1890", "f", 4)
    rows += spread("RED MILL", "BOUGHT", "EAST MILL", "1887", "g", 4) + spread("EAST MILL", "RELEASED", "LINE", "1890", "h", 4) + spread("RED MILL", "BOUGHT", "WEST MILL", "1887", "i", 4) + spread("WEST MILL", "RELEASED", "LINE", "1890", "j", 4)
    e = edges(spark, rows)
    found = {r["entity_b"]: r["reject_reason"] for r in qs.candidates(e, min_year=1997).collect()}
    assert found == {"NORTH MILL": None, "SOUTH MILL": "min_year", "HIS": "entity", "EAST MILL": "uniqueness", "WEST MILL": "uniqueness"}
    written = qs.generate(e).select(F.col("chain_hash").alias("hash")).where(F.col("answer") == "NORTH MILL")
    again = {r["entity_b"]: r["reject_reason"] for r in qs.candidates(e, known_hashes=written).collect()}
    assert again["NORTH MILL"] == "duplicate" and again["SOUTH MILL"] is None
    assert all(r["unique_domains"] == 8 for r in ch.two_hop(e).collect())


def test_verified_sources(spark):
    e = edges(spark, CHAIN)
    good = "red mill bought north mill " * 30
    pages = spark.createDataFrame([(u, 200 if i != 1 else 404, good if i != 2 else "short") for i, (*_, u) in enumerate(CHAIN)], "url string, status_code int, text string")
    row = qs.generate(e, pages=pages).first()
    assert len(row["sources"]) == 6 and CHAIN[1][4] not in row["sources"] and CHAIN[2][4] not in row["sources"]
    assert qs.generate(e, pages=pages.limit(5)).count() == 0 and qs.generate(e, most=0).count() == 0


def test_files_round_trip(spark, tmp_path):
    made = qs.generate(edges(spark, CHAIN))
    q = spark.createDataFrame(made.collect(), made.schema)
    files.write_questions(q, f"{tmp_path}/q", "20240101_000000")
    back, row = files.read_questions(spark, f"{tmp_path}/q").first(), q.first()
    assert back["prompt"] == row["prompt"] and back["sources"] == row["sources"] and back["file"].endswith(f"_{row['chain_hash']}_1887.txt")
    assert files.known_hashes(spark, f"{tmp_path}/q").first()["hash"] == row["chain_hash"]
    for kind in files.EXPORTS:
        files.export(q, f"{tmp_path}/{kind}", kind)
        assert spark.read.text(f"{tmp_path}/{kind}").count() >= 1
    (tmp_path / "texts").mkdir()
    (tmp_path / "texts" / "question_1.txt").write_text(qs.as_text(q).first()["text"])
    (tmp_path / "texts" / "question_2.txt").write_text("no sections")
    assert [r["answer"] for r in files.read_question_files(spark, f"{tmp_path}/texts").collect()] == ["NORTH MILL"]
    recent = reports.recent(spark.read.parquet(f"{tmp_path}/q")).first()
    assert recent["year"] == 1887 and recent["n_numbered"] == len(row["sources"]) + len(row["fact_fanout"]) + len(row["search_trajectory"])


def test_logs_caches_and_tables(spark, tmp_path):
    log, cache, grown = f"{tmp_path}/log", f"{tmp_path}/cache", f"{tmp_path}/grown"
    for i in range(2):
        files.append_log(spark.createDataFrame([(i, "x")], "n long, s string"), log)
    (tmp_path / "log" / "part-bad.json").write_text("no json\n{\"n\": 9}\n")
    assert sorted(r["n"] for r in files.read_log(spark, log, "n long, s string").collect() if r["n"] is not None) == [0, 1, 9]
    files.to_cache(spark.createDataFrame([("http://a", 200, "t"), ("http://b", 0, "")], "url string, status_code int, text string"), cache)
    held, lacking = files.from_cache(spark.createDataFrame([("http://a",), ("http://b",), ("http://c",)], "url string"), spark.read.parquet(cache))
    assert {(r["url"], r["status_code"]) for r in held.collect()} == {("http://a", 200), ("http://b", 0)} and [r["url"] for r in lacking.collect()] == ["http://c"]
    spark.createDataFrame([(1,)], "a long").write.parquet(grown)
    spark.createDataFrame([(2, "x")], "a long, b string").write.mode("append").parquet(grown)
    assert {tuple(r) for r in files.read_merged(spark, grown).select("a", "b").collect()} == {(1, None), (2, "x")}
    files.emptied(spark, cache)
    assert spark.read.parquet(cache).count() == 0 and spark.read.parquet(cache).columns == ["key", "url", "status_code", "text"]
    assert [r["topic"] for r in files.resolved_topics(spark, None, None, ["Coal Mine", "# no", "coal mine"]).collect()] == ["Coal_Mine"]


def test_evaluators(spark):
    asked = spark.createDataFrame([(1, "North Mill", "the north mill", "", "Mill"), (2, "North Mill", "", "north mill co", None), (3, "North Mill", "north", None, "")], "question long, answer string, abstract string, reply string, heading string")
    assert [(r["correct"], r["confidence"], r["ai_answer"]) for r in evaluation.instant_answer(asked).orderBy("question").collect()] == [(True, "medium", "mill"), (True, "high", "north mill co"), (False, "low", "(no direct answer)")]
    titles = spark.createDataFrame([(1, "North Mill", ["Mill", "x"]), (2, "North Mill", ["x", "North"]), (3, "North Mill", ["a", "b", "c", "north mill"]), (4, "North Mill", [])], "question long, answer string, titles array<string>")
    assert [(r["correct"], r["confidence"], r["ai_answer"]) for r in evaluation.title_search(titles).orderBy("question").collect()] == [(True, "high", "Mill"), (True, "medium", "x"), (False, "unknown", "a"), (False, "unknown", "(no results)")]


def test_known_facts_come_first(spark):
    known = spark.createDataFrame([("RED MILL", "ACQUIRED", "NORTH MILL", ["http://www.z.org/1", "http://a00.org/1"], "K", "1700"), ("NEW", "MADE", "THING", ["http://z.org/1"], "K", "1700")], "subject string, rel string, object string, sources array<string>, context string, date string")
    found = {r["subject"]: r for r in ed.with_known(edges(spark, CHAIN), known).collect()}
    assert found["RED MILL"]["sources"][:2] == ["http://www.z.org/1", "http://a00.org/1"] and found["RED MILL"]["domains"][0] == "www.z.org"
    assert (found["RED MILL"]["occurrences"], found["RED MILL"]["date"]) == (5, "1887") and (found["NEW"]["occurrences"], found["NEW"]["date"]) == (1, "1700")


def test_enrichment_reaches_the_target(spark):
    pages = spark.createDataFrame([(f"http://n{i}.org/x", "all about the blue line") for i in range(5)], "url string, text string")
    found = {r["subject"]: r for r in verify.enriched(edges(spark, CHAIN), pages).collect()}
    assert (found["NORTH MILL"]["n_new"], len(found["NORTH MILL"]["domains"])) == (5, 9) and found["RED MILL"]["n_new"] == 0


def test_path_filters_and_article_dates(spark):
    rules = {"a.org": ("/search", "/help")}
    rows = spark.createDataFrame([("http://a.org/search/x",), ("http://A.org/book",), ("http://b.org/search",), (None,)], "url string")
    assert [r[0] for r in rows.select(pg.path_verdict(F.col("url"), rules)).collect()] == [False, True, None, None]
    fields = spark.createDataFrame([({"founded": "no year", "date": "May 1901"},), ({"x": "1"},)], "f map<string,string>")
    assert [r[0] for r in fields.select(reports.article_date(F.col("f"))).collect()] == [1901, None]
