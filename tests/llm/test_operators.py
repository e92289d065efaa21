"""The training-data operators on odd tables: nulls, empty and long texts, repeats, extra columns, no rows."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from factloom.llm import decontaminate, fingerprints, html_extract, jaccard_join, language_id, lm_score, packing, suffix_dedup, toxicity, url_filter

rng = random.Random(3)
WORDS = [f"{a}{b}" for a in "ka lo mi ru te so".split() for b in "bar dun fel gix hom jaz".split()]
SCHEMA = "doc_id long, text string, lang string, score double, row long, place long, part int"


def prose(n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


BASE = prose(300)
LONG = prose(6000)
TEXTS = [BASE, BASE, BASE[:-40] + prose(5), None, "", "one two", prose(80), prose(30) + " " + BASE[200:420] + " " + prose(30), LONG, "é" * 300, "ab" * 400, None]


@pytest.fixture(scope="module")
def docs(spark):
    rows = [(i, t, "xx", 0.5, 7, 8, 9) for i, t in enumerate(TEXTS)] + [(1, BASE, "xx", 0.5, 7, 8, 9), (None, prose(40), None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).coalesce(2)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(i, i % 2) for i in range(9)] + [(None, 1), (3, None), (0, 1)], "doc_id long, toxic int")


def test_packing(docs):
    found = packing.pack(docs, capacity=256).collect()
    by_sequence, by_doc = {}, {}
    for r in found:
        by_sequence.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        by_doc.setdefault(r["doc_id"], []).append((r["piece"], r["start"], r["length"]))
    for pieces in by_sequence.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 256
    assert by_doc[3] == [(0, 0, 1)] and len(by_doc[1]) % 2 == 0
    assert len(found) == sum(len(x) for x in by_doc.values())


def covered(texts):
    seen, out = set(), []
    for t in texts:
        b = (t or "").encode()
        marks = bytearray(len(b))
        for p in range(len(b) - 99):
            w = b[p : p + 100]
            if w in seen:
                marks[p : p + 100] = b"\1" * 100
            seen.add(w)
        kept = bytes(x for x, m in zip(b, marks, strict=True) if not m)
        out.append((len(b), sum(marks), len(re.findall(rb"\x01+", bytes(marks))), hashlib.sha256(kept).hexdigest()))
    return out


def test_suffix_dedup_equals_brute_force(spark, monkeypatch):
    texts = [*TEXTS, LONG[1000:3000], "ab" * 90 + BASE[:150] + "q" * 250]
    table = spark.createDataFrame([(i, t, 1) for i, t in enumerate(texts)], "doc_id long, text string, place int")
    for hot in (suffix_dedup.HOT, 1):  # also with every group resolved window by window
        monkeypatch.setattr(suffix_dedup, "HOT", hot)
        found = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.deduplicate(table).collect()}
        assert [found[i] for i in range(len(texts))] == covered(texts)


def test_suffix_dedup_of_long_texts(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "BUCKET", 1 << 14)  # buckets by the size of the texts
    line = "".join(chr(rng.randrange(97, 123)) for _ in range(600_000))
    texts = ["é" * 300 + line, "cd" * 150_000, line[100_000:101_000] + "cd" * 90 + line[523_900:524_500], line[:90]]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    assert suffix_dedup._buckets(table) > 50
    found = {r["doc_id"]: tuple(r)[1:] for r in suffix_dedup.deduplicate(table).collect()}
    assert [found[i] for i in range(len(texts))] == covered(texts)


def test_suffix_dedup_of_odd_rows(docs):
    assert suffix_dedup.deduplicate(docs).count() == len(TEXTS) + 2
    assert suffix_dedup.cleaned(docs.drop("place")).where("text IS NULL").count() == 2


def grams(text):
    w = (text or "").lower().split()
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def test_jaccard_join_equals_brute_force(spark):
    texts = list(TEXTS)
    seed = prose(200).split()
    for _ in range(40):  # a group of near copies that needs several blocks
        w = list(seed)
        for _ in range(rng.randint(0, 3)):
            w[rng.randrange(len(w))] = rng.choice(WORDS)
        texts.append(" ".join(w))
    sets = [grams(t) for t in texts]
    n, parent = [0] * len(texts), list(range(len(texts)))

    def root(x):
        return x if parent[x] == x else root(parent[x])

    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if (not sets[a] and not sets[b]) or (both and both >= 0.8 * len(sets[a] | sets[b])):
                n[a], n[b] = n[a] + 1, n[b] + 1
                parent[max(root(a), root(b))] = min(root(a), root(b))
    table = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")
    found = {r["doc_id"]: (r["class_id"], r["n_links"]) for r in jaccard_join.join(table).collect()}
    assert found == {i: (root(i), n[i]) for i in range(len(texts))}
    assert {r["doc_id"] for r in jaccard_join.one_of_each(table).collect()} == {root(i) for i in range(len(texts))}


def test_toxicity(spark):
    rows = [(i, prose(60) + (" idiot scum" if i % 3 == 0 else " the women and the muslim neighbour"), i % 3 == 0) for i in range(240)]
    table, given = spark.createDataFrame([r[:2] for r in rows], "doc_id long, text string"), spark.createDataFrame([(r[0], int(r[2])) for r in rows], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.toxicity(spark, table, given).collect()}
    assert all(found[i]["predicted"] == int(bad) for i, _, bad in rows)
    model = toxicity.trained(table, given)
    assert abs(model.score("the christian women") - model.score("the hindu men")) < 0.05


def test_toxicity_of_odd_rows(spark, docs, labels):
    assert toxicity.toxicity(spark, docs, labels).count() == len(TEXTS) + 2


RULES_EXPECTED = [
    ("http://a.example.org/es/1", "example.org/es/", "block"), ("http://EXAMPLE.org/en/17?x", "example.org/en/1", "block"), ("x://y.org/q", "org/", "allow"), ("x://y.org", None, None),
    ("http://b.com/de/x", "com/de/", "block"), ("http://b.com/fr/", "com/fr/", "allow"), ("http://notexample.org/es/1", "org/", "allow"), (None, None, None), ("no-scheme", None, None), ("http://casino-bets.example.net/en/3", None, "block"), ("http://weather.example.net/en/3", None, "allow"),
]


def test_url_filter(spark):
    pages = spark.createDataFrame([(i, u) for i, (u, _, _) in enumerate(RULES_EXPECTED)], "page_id long, url string")
    found = {r["page_id"]: r for r in url_filter.judge(pages).collect()}
    for i, (url, rule, verdict) in enumerate(RULES_EXPECTED):
        assert found[i]["rule"] == rule and found[i]["verdict"] == (verdict or found[i]["verdict"]), url
    assert (found[1]["host"], found[1]["path"]) == ("example.org", "/en/17") and (found[7]["host"], found[7]["path"]) == ("", "")


def test_decontamination(spark):
    items = [(k, " ".join(f"item{k}word{j}" if j % 2 else rng.choice(WORDS) for j in range(30)) + f". The answer is answer{k} of it{k}.") for k in range(4)]
    words = items[1][1].split()
    reworded = " ".join(w for i, w in enumerate(words) if i % 6)  # every sixth word gone
    texts = [prose(200), prose(50) + " " + items[0][1] + " " + prose(90), prose(30) + " " + reworded.upper() + " " + prose(20), None, "", items[2][1], prose(40) + " " + " ".join(words[:10])]
    table = spark.createDataFrame([(i, t, 1.0) for i, t in enumerate(texts)], "doc_id long, text string, cosine double")
    bench = spark.createDataFrame([*items, (8, None), (9, "")], "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(table, bench).collect()} == {(1, 0), (2, 1), (5, 2)}
    assert decontaminate.contaminated(table, bench.limit(0)).count() == 0
    assert decontaminate.contaminated(table.limit(0), bench).count() == 0


def test_fingerprints(spark):
    texts = [t or "" for t in TEXTS]
    table = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in fingerprints.fingerprint(table).collect()}
    for i, t in enumerate(texts):
        new = fingerprints.edited(t, texts[(i + 1) % len(texts)])
        assert found[i]["edited_sha256"] == hashlib.sha256(new.encode()).hexdigest() and found[i]["n_chars"] == len(t)
    assert found[0]["fingerprint"] == found[1]["fingerprint"] and found[0]["near_next"] == 1.0


def test_main_text(spark):
    same = " ".join(f"boiler{i}" for i in range(12))
    pages = [(i, f"http://h.org/{i}", f"<div>{same}</div><div>page {i} {prose(20)}</div>") for i in range(3)] + [(3, None, None), (4, "http://h.org/4", f"<article><p>{same}</p></article>"), (4, "x", "")]
    found = [(r["page_id"], r["text"], r["n_chars"]) for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()]
    assert len(found) == 6 and all(n == len(t) for _, t, n in found)
    texts = dict((p, t) for p, t, n in found if n)
    assert all(texts[i].startswith(f"page {i} ") for i in range(3)) and texts[4] == same


def test_unplaced_copies_keep_their_text(spark):
    same, copy = " ".join(f"boiler{i}" for i in range(12)), prose(40)
    pages = [(i, f"http://h.org/{i}", f"<div>{copy}</div>") for i in range(2)] + [(i, f"http://g.org/{i}", f"<div>{same}</div><div>page {i} {prose(20)}</div>") for i in range(2, 4)]
    texts = {r["page_id"]: r["text"] for r in html_extract.extract(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert texts[0] == texts[1] == " ".join(copy.split()) and all("boiler" not in texts[i] and texts[i] for i in (2, 3))


def test_lm_scores(spark, docs):
    import math
    import zlib
    from collections import Counter

    found = lm_score.scores(docs).collect()
    assert len(found) == len(TEXTS) + 2
    rows = [(r["doc_id"], re.findall(r"[^\x20\x09-\x0d]+", (r["text"] or "").lower()) + ["\0end"]) for r in docs.collect()]
    out = lambda i: i is not None and zlib.crc32(str(i).encode()) % 5 == 1
    counts = Counter(w for i, ws in rows if not out(i) for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = sorted((i if i is not None else -1, len(ws), sum(counts[w] > 0 for w in ws), n, round(sum(math.log10((counts[w] + 0.5) / (n + 0.5 * (v + 1))) for w in ws), 6)) for i, ws in rows)
    assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["n_known"], r["train_tokens"], round(r["base_score"], 6)) for r in found) == expected
    assert all(r["score"] < 0 for r in found)


def test_language_id(spark):
    made = {"aa": "ka lo mi", "bb": "xut zyp vor"}
    rows = [(i, " ".join(rng.choice(made[a].split()) for _ in range(30)), a) for i in range(120) for a in [("aa", "bb")[i % 2]]] + [(500, "123 ... ", "aa"), (501, None, "bb"), (502, "", None)]
    found = {r["doc_id"]: r for r in language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(found[i]["lang_pred"] == a for i, _, a in rows if i < 500)
    assert all(found[i]["lang_pred"] == "und" for i in (500, 501, 502))


@pytest.mark.parametrize("name", ["pack", "dedup", "join", "toxicity", "fingerprint", "lm", "language", "pages", "urls"])
def test_empty_tables(spark, docs, labels, name):
    none = docs.limit(0)
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    run = {
        "pack": lambda: packing.pack(none), "dedup": lambda: suffix_dedup.deduplicate(none), "join": lambda: jaccard_join.join(none), "toxicity": lambda: toxicity.toxicity(spark, none, labels), "fingerprint": lambda: fingerprints.fingerprint(none),
        "lm": lambda: lm_score.scores(none), "language": lambda: language_id.identify(none), "pages": lambda: html_extract.extract(pages), "urls": lambda: url_filter.judge(pages),
    }
    assert run[name]().count() == 0


def test_pipeline(spark):
    import corpus_pipeline

    assert [s for s, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_jaccard_join", "suffix_array_dedup", "benchmark_decontamination", "best_fit_packing"]
    found = corpus_pipeline.run(spark, "/root/testdata/sf0.001")
    per = found.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.max("n").alias("n")).first()
    assert 0 < per["n"] <= 2048


def test_end_tags_that_were_left_out():
    for page, kept in (
        ("<ul><li class='menu-item'>a<li class='menu-item'>b</ul><article>art</article>", (["art"], [])),
        ("<p class='ad'>buy<article>art</article>", (["art"], [])),
        ("<article><header><h1>Title</h1></header><p>x</article>", (["Title", "x"], [])),
        ("<header><h1>Site</h1></header><article>art</article>", (["art"], [])),
        ("<article><p class='ad'>buy<p>text<p class='promo'>more<h2>kept</h2></article>", (["text", "kept"], [])),
        ("<dl><dt class='nav'>a<dd>b</dl>", ([], ["b"])),
        ("<table><tr><td class='menu'>m<td>art<tr><td>two</table>", ([], ["art", "two"])),
        ("<article><ul><li class='ad'>x<ul><li>y</ul><li>z</ul></article>", (["z"], [])),
        ("<article><p>one<div class='comments'><p>c</div><p>two</article>", (["one", "two"], [])),
        ("<article><p>a &lt;b&gt; &amp;amp; &nbsp; c" + "<div>" * 3000, (["a <b> &amp; c"], [])),
        ("<p>" * 20_000 + "end", ([], ["end"])),
    ):
        assert html_extract.blocks_of(page) == kept, page[:80]


def test_long_and_broken_pages(spark):
    long = "<article>" + "".join(f"<p>word{i} and more" for i in range(60_000)) + "</article>"
    rows = [(0, "http://h.org/", long), (1, None, "<article><p>x" + "<" * 5000), (2, "http://h.org/", "<!-- open"), (2, "http://h.org/", "<!-- open"), (None, "h", "<script>never closed")]
    found = sorted(((r["page_id"] is None, r["page_id"] or 0, r["text"], r["n_chars"]) for r in html_extract.extract(spark.createDataFrame([(*r, 1, "z") for r in rows], "page_id long, url string, html string, text int, host string")).collect()))
    assert len(found) == 5 and found[0][2].count("\n") == 59_999 and found[1][2].startswith("x") and [f[2] for f in found[2:]] == ["", "", ""]


def test_the_latent_space_finds_what_shares_no_rare_word(spark, monkeypatch):
    own = random.Random(5)
    topics = [[f"topic{t}w{i}" for i in range(50)] for t in range(5)]
    rare = [f"rare{i}" for i in range(22)]
    common = own.sample(topics[0], 28)
    body = common + rare
    own.shuffle(body)
    answer = " ".join(own.sample(topics[0], 6))
    item = " ".join(body) + ". " + answer + "."
    reworded = " ".join(w if w in common else f"other{i}" for i, w in enumerate(body)) + ". " + answer + "."
    corpus = [" ".join(own.choice(topics[i % 5]) for _ in range(48)) for i in range(300)]
    docs = spark.createDataFrame([*enumerate(corpus), (900, reworded)], "doc_id long, text string")
    bench = spark.createDataFrame([(1, item)], "item_id long, text string")
    monkeypatch.setattr(decontaminate, "SKETCH", 2)  # five topics have few directions
    assert {r["doc_id"] for r in decontaminate.contaminated(docs, bench).collect()} == {900}
    import numpy as np

    monkeypatch.setattr(decontaminate, "_directions", lambda hits, idf, seed=11: np.zeros((len(idf), decontaminate.SKETCH)))
    assert decontaminate.contaminated(docs, bench).count() == 0


def test_decontamination_of_odd_rows(spark):
    item = "one two three four five six seven eight nine ten. The answer is eleven twelve."
    long = prose(200_000) + " " + item + " " + prose(1000)
    rows = [(None, item, 1.0), (3, item, 1.0), (3, item, 1.0), (4, long, 1.0), (5, "", 1.0), (6, None, 1.0)] + [(10 + i, prose(60), 1.0) for i in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, item_id double")
    bench = spark.createDataFrame([(1, item), (2, item), (None, item), (7, None)], "item_id long, text string")
    found = decontaminate.contaminated(docs, bench).collect()
    assert sorted((r["doc_id"] or 0, r["item_id"] or 0) for r in found) == sorted((d, i) for d in (0, 3, 3, 4) for i in (0, 1, 2))


def test_a_benchmark_in_several_blocks(spark, monkeypatch):
    items = [(k, " ".join(f"item{k}word{j}" for j in range(25)) + f". The answer is answer{k}.") for k in range(12)]
    docs = spark.createDataFrame([(k, prose(40) + " " + t + " " + prose(40)) for k, t in items], "doc_id long, text string")
    bench = spark.createDataFrame(items, "item_id long, text string")
    monkeypatch.setattr(decontaminate, "BLOCK", 1000)
    assert {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(docs, bench).collect()} == {(k, k) for k, _ in items}


def test_fingerprints_of_odd_rows(spark):
    rows = [(None, "b", "x"), (None, "a", "x"), (7, "same", "x"), (7, "same", "x"), (7, None, "x"), (9, prose(300_000), "x")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fingerprint string")
    found = fingerprints.fingerprint(docs).collect()
    ordered = ["a", "b", "", "same", "same", rows[5][1]]
    expected = sorted(hashlib.sha256(fingerprints.edited(t, ordered[(i + 1) % 6]).encode()).hexdigest() for i, t in enumerate(ordered))
    assert sorted(r["edited_sha256"] for r in found) == expected
    one = fingerprints.fingerprint(docs.where("doc_id = 9")).first()
    assert one["near_next"] == 1.0 and 0.7 < one["near_edited"] < 0.85


def test_language_of_odd_rows(spark):
    rows = [(i, " ".join(rng.choice(w.split()) for _ in range(30)), a, 0.1) for i in range(80) for a, w in [(("aa", "ka lo mi"), ("bb", "xut zyp vor"))[i % 2]]]
    rows += [(900, "½ ² Ⅷ 12", "aa", 0.1), (901, "x" * 3_000_000, None, 0.1), (None, "ka lo mi", "aa", 0.1), (902, "ka lo mi", None, 0.1), (902, "ka lo mi", None, 0.1)]
    found = language_id.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string, score double")).collect()
    by = {r["doc_id"]: r for r in found}
    assert len(found) == len(rows) and by[900]["lang_pred"] == "und" and by[902]["lang_pred"] == by[None]["lang_pred"] == "aa"
    assert by[901]["lang_pred"] in ("aa", "bb") and by[None]["held_out"] is False


def test_url_rules_equal_brute_force(spark):
    sites = ["example.org", "www.example.org", "notexample.org", "a.org", "org", "x.com", "com", "example.org.net", "EXAMPLE.ORG", "a.b.example.org"]
    urls = [f"{s}://{h}{p}" for s in ("http", "x") for h in sites for p in ("", "/", "/es", "/es/", "/es/1", "/en/1", "/en/12", "/fr/", "/de/x", "?q=/es/", "#/de/")] * 2
    rows = [(i, u, "h", "v") for i, u in enumerate(urls)]
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string, host string, verdict string")).collect()

    def rule(url):
        host, path = re.match(r"[^:]*://([^/?#]*)([^?#]*)", url).groups()
        host = host.lower()
        fits = [r for r, _ in url_filter.RULES for at, _, below in [r.partition("/")] if (host == at or host.endswith("." + at)) and path.startswith("/" + below)]
        return max(fits, key=len, default=None)

    assert {r["page_id"]: r["rule"] for r in found} == {i: rule(u) for i, u in enumerate(urls)}
    verdicts = dict(url_filter.RULES)
    assert all(r["verdict"] == verdicts[r["rule"]] for r in found if r["rule"])


def test_jaccard_join_misses_no_link_of_near_copies(spark):
    """Recall against brute force on 600 texts, most of them near copies at similarities around 0.8."""
    own = random.Random(11)
    seeds = [[own.choice(WORDS) + str(own.randrange(40)) for _ in range(own.randint(40, 120))] for _ in range(60)]
    texts = []
    for s in seeds:
        for _ in range(10):
            w = list(s)
            for _ in range(own.randint(0, 3)):  # each change touches five of the grams
                w[own.randrange(len(w))] = "new" + str(own.randrange(10**6))
            texts.append(" ".join(w))
    sets = [grams(t) for t in texts]
    links = [0] * len(texts)
    for a in range(len(texts)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
    found = {r["doc_id"]: r["n_links"] for r in jaccard_join.join(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")).collect()}
    assert sum(links) > 1000 and found == dict(enumerate(links))


def test_jaccard_join_of_odd_rows(spark):
    rows = [(None, "a b c d e f", 1), (None, "a b c d e f", 1), (5, "a b c d e f", 1), (5, None, 1), (6, "", 1), (7, prose(150_000), 1), (8, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, class_id int")
    found = sorted((r["doc_id"] or -1, r["class_id"], r["n_links"]) for r in jaccard_join.join(docs).collect())
    assert found == [(-1, 5, 2), (-1, 5, 2), (5, 5, 1), (5, 5, 2), (6, 5, 1), (7, 7, 0), (8, 8, 0)]
    assert sorted(r["doc_id"] for r in jaccard_join.one_of_each(docs).collect()) == [5, 5, 7, 8]
