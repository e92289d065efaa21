"""Parts of the training-data operators that need no Spark session, against brute force."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from factloom.llm import decontaminate, fingerprints, hashing, html_extract, lm_score, packing, suffix_dedup
from factloom.llm.suffix_array import suffix_array
from factloom.llm.tokens import encoder

rng = random.Random(7)


def test_suffix_array_equals_sorting():
    for _ in range(200):
        a = np.array([rng.randint(1, rng.choice([2, 4, 300])) for _ in range(rng.randint(0, 70))], dtype=np.int64)
        assert suffix_array(a).tolist() == sorted(range(len(a)), key=lambda i: a[i:].tolist())


def test_tokens_equal_the_tokenizers_library():
    import public_tokenizers as public
    from tokenizers import Tokenizer

    odd = ["", " ", "a  b", "it's\n\n x\t y ", "Éa %%% <|endoftext|> 12,5", "x \u00a0 y", "naïve ### don't", "<|endoftext|>", "a<|endoftext|><|endoftext|>  b \n", "<|endoftext", "end <|endoftext|>\n\n next", "\u3000\u2028x", "a\r\n\r\nb", "0123 ½ Ⅷ"]
    for ordinary in (True, False):
        t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
        t.encode_special_tokens = ordinary
        for text in odd:
            assert np.frombuffer(encoder(special=not ordinary)(text), "<u4").tolist() == t.encode(text, add_special_tokens=False).ids, text


def test_packing_has_the_ids_of_the_tokenizers_library(spark):
    """ids_crc32, start and length of every document of sf0.01, whole, against the contract's own call."""
    import public_tokenizers as public
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(public.path("byte_bpe_50k.json"))
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text").union(spark.createDataFrame([(-1, "a <|endoftext|> b"), (-2, None), (-3, "")], "doc_id long, text string"))
    expected = set()
    rows = docs.collect()
    for r, e in zip(rows, t.encode_batch([r["text"] or "" for r in rows], add_special_tokens=False), strict=True):
        ids = np.array([*e.ids, 0], "<u4")
        first = (len(ids) - 1) % 2048 + 1
        cuts = [0, *range(first, len(ids) + 1, 2048)]
        expected |= {(r["doc_id"], k, a, b - a, zlib.crc32(ids[a:b].tobytes())) for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))}
    found = packing.pack(docs).collect()
    assert len(found) == len(expected) and {tuple(r)[:5] for r in found} == expected


def test_plan_places_every_piece_without_overlap():
    lengths = {n: rng.randint(1, 40) for n in rng.sample(range(1, 65), 30)}
    places = packing.plan(lengths, 64)
    used: dict[int, list] = {}
    for n, count in lengths.items():
        runs = places[n]
        for r in range(count):
            run = runs[np.searchsorted(runs[:, 0], r, side="right") - 1]
            used.setdefault(int(run[1] + r - run[0]), []).append((int(run[2]), n))
    for pieces in used.values():
        at = 0
        for offset, n in sorted(pieces):
            assert offset == at
            at += n
        assert at <= 64
    total = sum(n * c for n, c in lengths.items())
    least = max(-(-total // 64), sum(c for n, c in lengths.items() if n > 32))
    assert len(used) <= 11 / 9 * least + 1


def alike(a, b):
    """Likeness by sets of paragraphs, without sketches."""
    x, y = ({(k, n) for k, n in zip(key.tolist(), n.tolist(), strict=True)} for _, key, n in (fingerprints.digests([a]), fingerprints.digests([b])))
    return 1 - sum(n for _, n in x ^ y) / max(1, len(a) + len(b))


def test_likeness_of_fingerprints_equals_that_of_paragraph_sets():
    vocabulary = ["".join(rng.choice("abcdefgh") for _ in range(rng.randint(2, 9))) for _ in range(400)]
    texts = [" ".join(rng.choice(vocabulary) for _ in range(n)) for n in (0, 1, 3, 30, 300, 3000, 300, 30, 3)] + ["", "ab\n" * 5000, "x" * 90_000, "x" * 50_000, "é\n" * 300]
    texts += [texts[4][:900] + texts[5], texts[5][:-700]]
    changed = [fingerprints.edited(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True)]
    own, new = fingerprints.Fingerprints.of(texts), fingerprints.Fingerprints.of(changed)
    at, after = np.arange(len(texts)), np.roll(np.arange(len(texts)), -1)
    assert np.allclose(fingerprints.likeness(own, at, new, at), [alike(a, b) for a, b in zip(texts, changed, strict=True)])
    assert np.allclose(fingerprints.likeness(own, at, own, after), [alike(a, b) for a, b in zip(texts, texts[1:] + texts[:1], strict=True)])
    # the strings alone are enough
    read, reread = fingerprints.Fingerprints.read(own.written()), fingerprints.Fingerprints.read(new.written())
    assert (fingerprints.likeness(read, at, reread, at) == fingerprints.likeness(own, at, new, at)).all()


@pytest.mark.parametrize("a,b", [("", ""), ("x", ""), ("abc " * 500, "abc " * 500), ("a" * 5000, "a" * 3000)])
def test_likeness_bounds(a, b):
    made = fingerprints.Fingerprints.of([a, b])
    value = fingerprints.likeness(made, np.array([0]), made, np.array([1]))[0]
    assert 0 <= value <= 1 and (value == 1) == (a == b) == (made.written()[0] == made.written()[1])


def test_sketch_peels_to_the_difference():
    words = [f"word{rng.randint(0, 10**6)}" for _ in range(900)]
    a, b = " ".join(words), " ".join(words[:450] + ["other"] * 3 + words[450:])
    (_, x, n), (_, y, m) = fingerprints.digests([a]), fingerprints.digests([b])
    made = [fingerprints.Sketches.of(np.zeros(len(k), np.int64), k, size, np.array([256])) for k, size in ((x, n), (y, m))]
    folded = [s.folded(np.array([0]), np.array([32])) for s in made]
    owner, key, length, done = folded[0].minus(folded[1]).peel()
    assert done[0] and set(key.tolist()) == set(x.tolist()) ^ set(y.tolist()) and alike(a, b) > 0.9


def test_two_equal_digests_never_stand_in_one_sketch():
    _, key, _ = fingerprints.digests(["same line of text\n" * 3000])
    assert len(np.unique(key)) == len(key) >= 3000


def test_blocks_of_a_page():
    page = '<html><head><title>T</title></head><body><nav><p>menu</p></nav><script>if (a<b) "</p>"</script><article><h1>A &amp; B</h1><p>one\n two<br>three<div class="ad">buy</div><p>four<aside>side</aside></article><footer>f</footer></body>'
    assert html_extract.blocks_of(page) == (["A & B", "one two three", "four"], [])
    assert html_extract.blocks_of("") == ([], [])
    assert html_extract.blocks_of("<p>x<p>y <!-- open") == ([], ["x", "y"])


def test_unique_runs():
    block = " ".join(f"w{i}" for i in range(20))
    names = html_extract.prefixes(block)
    assert html_extract.unique_runs(block, {names[4]}) == ["w0 w1 w2 w3", " ".join(f"w{i}" for i in range(12, 20))]
    assert html_extract.unique_runs("short one", set(html_extract.prefixes("short one"))) == []


def test_equal_windows_share_a_representative():
    shared = bytes(rng.randrange(97, 123) for _ in range(150))
    texts = [bytes(rng.randrange(97, 123) for _ in range(rng.randint(0, 300))) + shared + b"x" * k for k in range(3)]
    s = suffix_dedup.Stretches(texts)
    windows: dict[bytes, set] = {}
    for key, doc, start, end in zip(s.key.tolist(), s.doc.tolist(), s.start.tolist(), s.end.tolist(), strict=True):
        for p in range(start, end - 99):
            windows.setdefault(texts[doc][p : p + 100], set()).add(key)
    assert sum(max(0, len(t) - 99) for t in texts) == sum(e - a - 99 for a, e in zip(s.start.tolist(), s.end.tolist(), strict=True))
    assert all(len(k) == 1 for k in windows.values())


def test_long_stretches_are_cut():
    text = b"ab" * 200_000
    s = suffix_dedup.Stretches([text])
    assert (s.end - s.start).max() <= suffix_dedup.WINDOWS + 99 and s.inner.all()
    assert sorted(np.concatenate([np.arange(a, e - 99) for a, e in zip(s.start, s.end, strict=True)]).tolist()) == list(range(len(text) - 99))


def test_suffix_array_of_wide_symbols():
    for top in (2, 256, 1 << 40):  # the last does not fit packed triples
        symbols = np.array([rng.randint(1, top) for _ in range(rng.randint(8, 400))])
        assert suffix_array(symbols).tolist() == sorted(range(len(symbols)), key=lambda i: symbols[i:].tolist())


def test_a_task_holds_bounded_text():
    batch = pa.record_batch({"place": pa.array([5, 6, 7]), "text": pa.array(["x" * 3_000_000, None, "y" * 99])})
    parts = list(suffix_dedup._parts(iter([batch]), 100))
    assert max(sum(map(len, texts)) for _, texts, _ in parts) < 2 * suffix_dedup.READ
    assert sum(max(0, len(x) - 99) for _, texts, _ in parts for x in texts) == 3_000_000 - 99
    assert {p for places, _, _ in parts for p in places.tolist()} == {5, 6, 7}


def test_words_and_shingles():
    assert [len(x) for x in hashing.shingles(["", "a", "A b", "a b c d e f", "a b c d e a b c d e"])] == [0, 1, 1, 2, 5]
    assert (hashing.shingles(["x Y"])[0] == hashing.shingles(["X  y"])[0]).all()


def test_lcs():
    a, b = (1, 2, 3, 4, 2), [9, 1, 3, 2, 4]
    assert decontaminate._lcs(decontaminate._pattern(a), len(a), b) == 3


def test_model_probabilities_sum_to_one():
    texts = ["the cat sat on the mat", "the dog sat", "a cat", ""] * 3
    model = lm_score.fit(texts, epochs=1)
    ids = np.arange(lm_score.VOCABULARY)
    assert abs(model.prior.first(np.full(len(ids), int(lm_score.END)), ids).sum() - 1) < 1e-4
    s = lm_score.sliced(["the cat sat"])
    assert model.score(s)[0] < 0 and model.score(lm_score.sliced([""]))[0] < 0
    # a word seen in training is likelier than a strange one
    assert model.score(lm_score.sliced(["the cat"]))[0] > model.score(lm_score.sliced(["the zqx"]))[0]


def test_attention_learns_from_every_text():
    words = ["red", "green", "blue", "white", "black", "brown", "gold", "silver"]
    model = lm_score.attention([f"the {w} cat and the {w} dog" for w in words], epochs=1)
    ids = [np.frombuffer(encoder()(" " + w), "<u4")[0] for w in words]
    start = lm_score.Attention.new()
    assert (model.sink[ids] != start.sink[ids]).all() and (model.key[ids] != start.key[ids]).any(axis=1).all()


def test_crc_of_pieces_is_of_little_endian_ids():
    ids = encoder()("hello world") + b"\0\0\0\0"
    assert zlib.crc32(ids) == zlib.crc32(np.frombuffer(ids, "<u4").tobytes())


def test_lm_counts_cover_every_training_document(spark, monkeypatch):
    import zlib

    monkeypatch.setattr(lm_score, "SLICE", 7)  # many slices: counts must meet across them
    texts = [" ".join(rng.choice("alpha beta gamma delta unbelievable unbelievably reading re-read x1 zyzzyva".split()) for _ in range(rng.randint(0, 30))) for _ in range(60)]
    model = lm_score.fit([t for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 5 != 1], epochs=1)
    few = lm_score.scores(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), model.attention)
    expected = model.score(lm_score.sliced(texts))
    found = {r["doc_id"]: r["score"] for r in few.collect()}
    assert np.allclose([found[i] for i in range(60)], expected, rtol=1e-4, atol=1e-4)


def test_tasks_learn_from_all_training_documents(spark):
    import zlib

    words = ["red", "green", "blue", "white", "black", "brown", "gold", "silver", "grey", "pink", "orange", "yellow"]
    table = spark.createDataFrame([(i, f"the {w} cat and the {w} dog", "en") for i, w in enumerate(words)], "doc_id long, text string, lang string")
    ids = np.array([np.frombuffer(encoder()(" " + w), "<u4")[0] for w in words])
    out = np.array([zlib.crc32(str(i).encode()) % 5 == 1 for i in range(len(words))])
    assert out.any()
    one = lm_score.trained(table.coalesce(1))
    assert ((one.sink[ids] != 4) == ~out).all()
    assert np.allclose(one.key, lm_score.attention([f"the {w} cat and the {w} dog" for w, o in zip(words, out, strict=True) if not o], epochs=1).key, atol=1e-5)
    assert ((lm_score.trained(table.repartition(3, "doc_id")).sink[ids] != 4) == ~out).all()
    assert (lm_score.trained(table.limit(0)).sink == 4).all()


def test_lm_reads_texts_once(spark, monkeypatch):
    import zlib

    texts = [" ".join(rng.choice("alpha beta gamma delta unbelievable reading re-read x1".split()) for _ in range(rng.randint(0, 30))) for _ in range(40)]
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").coalesce(1)
    expected = {r["doc_id"]: r["score"] for r in lm_score.scores(table, lm_score.trained(table)).collect()}
    monkeypatch.setattr(lm_score, "trained", None)  # attention learns as the texts are packed, not from a second reading
    found = {r["doc_id"]: r["score"] for r in lm_score.scores(table).collect()}
    assert np.allclose([found[i] for i in range(40)], [expected[i] for i in range(40)], rtol=1e-5)
    assert any(zlib.crc32(str(i).encode()) % 5 == 1 for i in range(40))


def test_lm_counted_parts_go_at_once(spark, monkeypatch):
    held, dropped = [], lm_score.dropped

    def seen(table, part=""):
        dropped(table, part=part)
        left = spark.read.schema(table.schema).parquet(table._factloom_path)
        held.append((part, {r["kind"] for r in left.select("kind", "slice").distinct().collect()}))

    monkeypatch.setattr(lm_score, "dropped", seen)
    lm_score.scores(spark.createDataFrame([(i, f"unbelievable re-reading {i} things") for i in range(50)], "doc_id long, text string"), lm_score.Attention.new()).collect()
    asked = [f"kind={lm_score.ASKED + r}" for r in range(lm_score.ROUNDS)]
    assert [part for part, _ in held][: lm_score.ROUNDS] == asked
    for r, (_, kinds) in enumerate(held[: lm_score.ROUNDS]):  # those of later parts are still there
        assert not kinds & set(range(lm_score.ASKED, lm_score.ASKED + r + 1)) and len([k for k in kinds if k and k > lm_score.ASKED + r]) == lm_score.ROUNDS - 1 - r


def test_halves_learn_from_each_other():
    texts = ["the cat sat on the mat unbelievable", "the dog sat", "a cat unbelievably re-read", "", "on a dog", "left out entirely dog"] * 2
    half = np.array([0, 1, 0, 1, 0, 2] * 2)
    s = lm_score.sliced(texts)
    prior = lm_score.Halves(s, half)
    _, chance, begin = lm_score.stream(prior.twice(), prior)
    for own in (0, 1):
        other = lm_score.Prior(iter([lm_score.sliced([t for t, h in zip(texts, half, strict=True) if h == 1 - own])]))
        _, expected, edges = lm_score.stream(lm_score.sliced([t for t, h in zip(texts, half, strict=True) if h == own]), other)
        mine = np.concatenate([chance[begin[i] : begin[i + 1]] for i in np.flatnonzero(half == own)])
        assert np.allclose(mine, expected, rtol=1e-5)


def test_attention_far_from_its_sink():
    s = lm_score.sliced(["the cat sat on the mat and the cat sat on the mat again"])
    model = lm_score.fit(["the cat sat on the mat", "a dog"], epochs=0)
    for shift in (0, 300, -300):  # one softmax: a shift of all of its terms changes nothing
        model.attention.distance[:], model.attention.sink[:] = shift, 4 + shift
        found = model.score(s)[0]
        expected = found if shift == 0 else expected  # noqa: F821
        assert np.isfinite(found) and abs(found - expected) < 1e-3


def test_distinct_is_numpys():
    rows = np.random.default_rng(1)
    top = rows.integers(1 << 40, 1 << 63, 200, dtype=np.uint64)
    for x in (np.zeros(0, np.int64), np.array([5]), rows.integers(0, 50, 1000), rows.integers(0, 1 << 62, 1000).astype(np.uint64), top[rows.integers(0, 200, 5000)], np.concatenate([top, top + np.uint64(1), top[::-1]])):
        for found, expected in zip(hashing.distinct(x), np.unique(x, return_index=True, return_inverse=True), strict=True):
            assert (found == expected).all() and len(found) == len(expected)
        assert (hashing.ordered(x) == np.argsort(x, kind="stable")).all()


def test_articles_win_over_names_of_classes():
    for page in (
        "<article class='post comments-open'>kept</article>",
        "<main class='with-sidebar'>kept</main>",
        "<div id='page' class='no-sidebar'><article>kept</article></div>",
        "<div class='search-results'><article>kept</article></div>",
        "<div class='sidebar'><main class='search'>kept<div class='share'>gone</div><div class='comment-form'>gone</div></main></div>",
        "<div class='banner'><p>kept not, unplaced<article>kept</article></div><div class='ad'>gone</div>",
    ):
        assert html_extract.blocks_of(page)[0] == ["kept"]
    assert html_extract.blocks_of("<div class='no-sidebar'>kept</div><div class='sidebar'>gone</div><nav>gone</nav>") == ([], ["kept"])
