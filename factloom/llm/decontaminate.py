"""Benchmark decontamination by latent semantic retrieval.

1. Every document becomes the sequence of its words that occur in the benchmark (with
   their places); all later steps read only that.
2. Passages of PASSAGE words get TF-IDF vectors over those words, with document
   frequencies over all passages.  A randomised SVD, distributed over the passages and
   over them alone, gives the corpus' main directions: the latent space.
3. Windows of two passages are compared with every item.  A window is a candidate if its
   TF-IDF cosine with the item is high, or if that is low but the two lie close together
   in the latent space: reworded copies keep their subject's words, not the rare ones.
   The latent space alone does not do (README): it blurs items that differ in rare words.
4. A candidate counts if the longest common subsequence of words covers enough of the
   item within a stretch not much longer than the item, and the item's answer (its last
   sentence) is there too, so reworded copies are found and chance matches are not.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import slices_of
from factloom.llm.hashing import PUNCTUATION, words
from factloom.session import written

PASSAGE, SKETCH = 24, 48
#: Characters of items that are searched for in one pass over the documents; larger benchmarks take several.
BLOCK = 1 << 25
#: Passages times queries whose products are held at once.
PRODUCTS = 1 << 22
#: A word in more than this share of the passages is a stop word.
MAX_SHARE = 0.1
COSINE, WEIGHT = 0.3, 0.3
#: Both cosines of a candidate that only the latent space finds.
WEAK, LATENT = 0.2, 0.9
OVERLAP, ANSWER, SURE = 0.6, 0.5, 0.85
_SENTENCE = re.compile(r"(?<=[.!?])\s+|\n+")


@dataclass(frozen=True)
class Item:
    item_id: int
    features: tuple[int, ...]
    answer: tuple[int, ...]


@dataclass(frozen=True)
class Space:
    """The items' queries by feature (an inverted index), and the latent space."""

    weight: np.ndarray  # idf of each feature, 0 for stop words
    low: np.ndarray  # idf of each feature, above 0: for items of stop words only
    first: np.ndarray  # where each feature's postings begin
    query: np.ndarray  # the query of each posting
    value: np.ndarray  # what one occurrence adds to the product with it
    norm: np.ndarray  # of each query
    plain: np.ndarray  # which queries are of stop words only
    owner: np.ndarray  # the item of each query
    basis: np.ndarray  # features x SKETCH, idf folded in
    latent: np.ndarray  # queries x SKETCH, of length 1


def _vocabulary(texts: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    hashes, edges = words(texts, PUNCTUATION)
    vocabulary, index = np.unique(hashes, return_inverse=True)
    return vocabulary, [index[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _items(rows: list[tuple]) -> tuple[np.ndarray, list[Item]]:
    texts, answers = [], []
    for _, text in rows:
        parts = [p for p in _SENTENCE.split((text or "").strip()) if p.strip()]
        texts.append(text or "")
        answers.append(parts[-1] if parts else "")
    vocabulary, found = _vocabulary(texts + answers)
    n = len(rows)
    return vocabulary, [Item(r[0], tuple(found[i].tolist()), tuple(found[n + i].tolist())) for i, r in enumerate(rows) if len(found[i])]


def _hits(docs: DataFrame, vocabulary: np.ndarray) -> DataFrame:
    """doc_id, n_words, places and features (int32 arrays as bytes) of each document's benchmark words."""

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        near = np.zeros(1 << 18, bool)
        near[(vocabulary & np.uint64((1 << 18) - 1)).astype(np.int64)] = True
        for b in slices_of(batches, 128):
            hashes, edges = words([t or "" for t in b.column(1).to_pylist()], PUNCTUATION)
            at = np.flatnonzero(near[(hashes & np.uint64((1 << 18) - 1)).astype(np.int64)])
            feature = np.minimum(np.searchsorted(vocabulary, hashes[at]), len(vocabulary) - 1)
            real = vocabulary[feature] == hashes[at]
            at, feature = at[real], feature[real].astype(np.int32)
            cuts = np.searchsorted(at, edges)
            rows = list(zip(cuts[:-1].tolist(), cuts[1:].tolist(), edges[:-1].tolist(), strict=True))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(np.diff(edges)), pa.array([(at[i:j] - e).astype(np.int32).tobytes() for i, j, e in rows], pa.binary()), pa.array([feature[i:j].tobytes() for i, j, _ in rows], pa.binary())],
                names=["doc_id", "n_words", "places", "features"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(find, "doc_id long, n_words long, places binary, features binary")


def _passages(b: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of a batch of hits: row, place and feature of each, its passage, and where each row's passages begin (passages are numbered through the batch, a free one after each row)."""
    places, features = ([np.frombuffer(x, np.int32) for x in b.column(b.schema.get_field_index(c)).to_pylist()] for c in ("places", "features"))
    row = np.repeat(np.arange(b.num_rows), [len(p) for p in places])
    first = np.cumsum([0] + [n // PASSAGE + 2 for n in b.column(b.schema.get_field_index("n_words")).to_pylist()])
    place = np.concatenate([np.zeros(0, np.int32), *places])
    return row, place, np.concatenate([np.zeros(0, np.int32), *features]), first[row] + place // PASSAGE, first


def _frequencies(hits: DataFrame, n_features: int) -> np.ndarray:
    """Passages with each feature, over all passages."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(n_features, np.int64)
        for b in slices_of(batches, 512):
            _, _, feature, passage, _ = _passages(b)
            total += np.bincount(np.unique(passage * n_features + feature) % n_features, minlength=n_features)
        at = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(total[at])], names=["feature", "n"])

    found = np.zeros(n_features, np.int64)
    for r in hits.mapInArrow(count, "feature int, n long").groupBy("feature").agg(F.sum("n").alias("n")).collect():  # one row a benchmark word
        found[r["feature"]] = r["n"]
    return found


def _sums(passage: np.ndarray, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Passages that occur and the sum of the values of each; passage is sorted."""
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    return passage[starts], np.add.reduceat(values, starts, axis=0)


def _directions(hits: DataFrame, idf: np.ndarray, seed: int = 11) -> np.ndarray:
    """The corpus' main directions (features x at most SKETCH, orthonormal), A the TF-IDF passages.

    A'A is applied to a random matrix, distributed over the passages; the product's
    Nystrom decomposition gives the leading right singular vectors of A.
    """
    random = np.random.default_rng(seed).normal(size=(len(idf), SKETCH)).astype(np.float32)
    step = max(1, (1 << 18) // SKETCH)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(idf), SKETCH), np.float32)
        weighted = random * idf[:, None]
        for b in slices_of(batches, 256):
            _, _, feature, passage, _ = _passages(b)
            used = idf[feature] > 0
            feature, passage = feature[used], passage[used]
            if len(feature):
                owner, y = _sums(passage, weighted[feature])
                back = y[np.searchsorted(owner, passage)]
                order = np.argsort(feature, kind="stable")
                which, s = _sums(feature[order], back[order])
                total[which] += s * idf[which, None]
        for i in range(0, len(idf), step):
            yield pa.RecordBatch.from_arrays([pa.array([i], pa.int32()), pa.array([total[i : i + step].tobytes()], pa.binary())], names=["part", "sums"])

    def add(part: pa.Table) -> pa.Table:
        total = sum(np.frombuffer(x, np.float32).astype(np.float64) for x in part.column("sums").to_pylist())
        return pa.table({"part": pa.array(part.column("part").to_pylist()[:1], pa.int32()), "sums": pa.array([total.astype(np.float32).tobytes()], pa.binary())})

    rows = hits.mapInArrow(project, "part int, sums binary").groupBy("part").applyInArrow(add, "part int, sums binary").collect()
    found = [np.frombuffer(r["sums"], np.float32) for r in sorted(rows, key=lambda r: r["part"])]
    if not found:
        return np.zeros((len(idf), SKETCH))
    made = np.concatenate(found).reshape(len(idf), SKETCH).astype(np.float64)
    core = random.astype(np.float64).T @ made
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    real = values > 1e-6 * max(values.max(), 1e-30)  # the float32 sums carry about six digits
    left, _, _ = np.linalg.svd(made @ (vectors[:, real] / np.sqrt(values[real])), full_matrices=False)
    return np.pad(left, ((0, 0), (0, SKETCH - left.shape[1])))


def _space(items: list[Item], weight: np.ndarray, low: np.ndarray, directions: np.ndarray) -> Space:
    """Queries are the items' stretches of at most two passages; an item's last stretch is as long as the others and may overlap."""
    feature, query, value, norm, plain, owner, latent = [], [], [], [], [], [], []
    for i, item in enumerate(items):
        whole = np.array(item.features)
        n, width = len(whole), 2 * PASSAGE
        only_stop_words = not weight[whole].any()
        idf = low if only_stop_words else weight
        for a in dict.fromkeys([*range(0, max(1, n - width + 1), width), max(0, n - width)]):
            f, times = np.unique(whole[a : a + width], return_counts=True)
            w = times * idf[f]
            if not w.any():
                continue
            feature.append(f)
            query.append(np.full(len(f), len(norm)))
            value.append(w * idf[f])
            norm.append(float(np.linalg.norm(w)))
            plain.append(only_stop_words)
            owner.append(i)
            at = (times * weight[f]) @ directions[f]
            latent.append(at / max(float(np.linalg.norm(at)), 1e-30))
    feature, query, value = (np.concatenate([np.zeros(0, t), *x]) for x, t in ((feature, np.int64), (query, np.int64), (value, np.float64)))
    order = np.argsort(feature, kind="stable")
    first = np.searchsorted(feature[order], np.arange(len(weight) + 1))
    latent_queries = np.array(latent, np.float32).reshape(len(norm), directions.shape[1])
    return Space(weight, low, first, query[order], value[order], np.array(norm), np.array(plain, bool), np.array(owner, np.int64), (directions * weight[:, None]).astype(np.float32), latent_queries)


def _products(space: Space, feature: np.ndarray, passage: np.ndarray, n: int) -> np.ndarray:
    """n x queries: the sum of each passage's products with every query; passages are numbered from 0."""
    queries = len(space.norm)
    times = space.first[feature + 1] - space.first[feature]
    begin = np.cumsum(times) - times
    at = np.arange(int(times.sum())) + np.repeat(space.first[feature] - begin, times)
    return np.bincount(np.repeat(passage, times) * queries + space.query[at], space.value[at], n * queries).reshape(n, queries)


def _candidates(space: Space, feature: np.ndarray, passage: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Windows (by their first passage) and queries that may match, and their TF-IDF cosines; passage is sorted."""
    out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
    if not len(feature) or not len(space.norm):
        return out[0]
    starts = np.flatnonzero(np.concatenate([[True], passage[1:] != passage[:-1]]))
    owner, number = passage[starts], np.cumsum(np.concatenate([[0], passage[1:] != passage[:-1]]))
    follows = np.concatenate([owner[1:] == owner[:-1] + 1, [False]])
    masses = []
    for idf in (space.weight, space.low):
        mass = np.add.reduceat(idf[feature].astype(np.float64) ** 2, starts)
        mass[follows] += mass[1:][follows[:-1]]
        masses.append(np.sqrt(mass))
    size = np.where(space.plain, *(m[:, None] for m in masses[::-1])) if space.plain.any() else masses[0][:, None]
    step = max(1, PRODUCTS // len(space.norm))
    starts = np.append(starts, len(feature))
    for low in range(0, len(owner), step):
        high = min(len(owner), low + step)
        last = min(len(owner), high + 1)  # a window's second passage
        mine = slice(starts[low], starts[last])
        dots = _products(space, feature[mine], number[mine] - low, last - low)
        joined = np.flatnonzero(follows[low:high])
        dots[joined] = dots[joined] + dots[joined + 1]
        dots = dots[: high - low]
        floor = size[low:high] * space.norm
        w, q = np.nonzero((dots >= WEAK * floor) & (dots > 0))
        dot, unit = dots[w, q], np.broadcast_to(floor, dots.shape)[w, q]
        good = (dot >= COSINE * unit) & (dot >= WEIGHT * space.norm[q] ** 2)
        rest = np.flatnonzero(~good & ~space.plain[q])
        if len(rest):
            windows, which = np.unique(w[rest], return_inverse=True)
            at = np.concatenate([windows, windows[follows[low + windows]] + 1])
            begin, end = starts[low + at], starts[low + at + 1]
            tokens = np.repeat(begin - np.concatenate([[0], np.cumsum(end - begin)[:-1]]), end - begin) + np.arange(int((end - begin).sum()))
            parts = np.add.reduceat(space.basis[feature[tokens]], np.cumsum(end - begin) - (end - begin), axis=0)
            latent = parts[: len(windows)].copy()
            latent[follows[low + windows]] += parts[len(windows) :]
            latent /= np.maximum(np.linalg.norm(latent, axis=1, keepdims=True), 1e-30)
            good[rest] = np.einsum("ij,ij->i", latent[which], space.latent[q[rest]]) >= LATENT
        out.append((owner[low + w[good]], q[good], dot[good] / unit[good]))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _lcs(pattern: dict[int, int], n: int, features: list[int]) -> int:
    """Length of the longest common subsequence; pattern has the bits of each feature's places (Hyyro's bit vectors)."""
    full = (1 << n) - 1
    v = full
    for f in features:
        m = pattern.get(f, 0)
        if m:
            u = v & m
            v = ((v + u) | (v - u)) & full
    return n - v.bit_count()


def _pattern(features: tuple[int, ...]) -> dict[int, int]:
    made: dict[int, int] = {}
    for i, f in enumerate(features):
        made[f] = made.get(f, 0) | 1 << i
    return made


def _verdict(item: Item, pattern: dict, answer: dict, place: np.ndarray, feature: np.ndarray, start: int) -> tuple[float, float, int]:
    """The best share of the item, and of its answer, that a stretch around the window has in order; where it begins.  Shares below OVERLAP are given as 0."""
    n = len(item.features)
    width = n + n // 3 + 4
    best = (0.0, 0.0, start)
    low, high = np.searchsorted(place, (start - n, start + 2 * PASSAGE + 1 + width))
    # only the item's own words can be in a common subsequence
    own = [(p, f) for p, f in zip(place[low:high].tolist(), feature[low:high].tolist(), strict=True) if f in pattern]
    if len(own) < OVERLAP * n:
        return best
    places, features = (list(x) for x in zip(*own, strict=True))
    for a in range(start - n, start + 2 * PASSAGE + 1, max(2, n // 6)):
        i, j = bisect_left(places, a), bisect_left(places, a + width)
        if j - i <= best[0] * n or j - i < OVERLAP * n:
            continue
        part = features[i:j]
        share = _lcs(pattern, n, part) / n
        if share > best[0]:
            reply = _lcs(answer, len(item.answer), part) / len(item.answer) if item.answer else 1.0
            best = (share, reply, places[i])
    return best


def _search(hits: DataFrame, items: list[Item], space: Space) -> DataFrame:
    shared = hits.sparkSession.sparkContext.broadcast((items, space))  # bounded by BLOCK
    names = ["doc_id", "item_id", "cosine", "overlap", "answer_overlap", "start_word"]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, space = shared.value
        patterns: dict[int, tuple] = {}
        wanted = (space.weight > 0) | (np.diff(space.first) > 0) | bool(space.plain.any())
        for b in slices_of(batches, 192):
            ids = b.column(0).to_pylist()
            row, place, feature, passage, first = _passages(b)
            used = np.flatnonzero(wanted[feature])
            found: dict[tuple[int, int], tuple] = {}
            begin = np.searchsorted(row, np.arange(b.num_rows + 1))
            for window, q, cosine in zip(*(x.tolist() for x in _candidates(space, feature[used], passage[used])), strict=True):
                r = int(np.searchsorted(first, window, side="right") - 1)
                i = int(space.owner[q])
                if i not in patterns:
                    patterns[i] = (_pattern(items[i].features), _pattern(items[i].answer))
                mine = slice(begin[r], begin[r + 1])
                share, reply, at = _verdict(items[i], *patterns[i], place[mine], feature[mine], (window - int(first[r])) * PASSAGE)
                if (share >= SURE or share >= OVERLAP and reply >= ANSWER) and share > found.get((r, i), (0, 0, 0.0))[2]:
                    found[r, i] = (r, cosine, share, reply, at)
            out = [(ids[r], items[i].item_id, c, s, a, at) for (r, i), (_, c, s, a, at) in sorted(found.items())]
            cols = list(zip(*out, strict=True)) or [()] * 6
            types = (pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.float64(), pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)], names=names)

    return hits.mapInArrow(search, FOUND)


FOUND = "doc_id long, item_id long, cosine double, overlap double, answer_overlap double, start_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row for each document and benchmark item that it holds, word for word or reworded.

    doc_id, item_id, cosine (TF-IDF), overlap (share of the item's words in order),
    answer_overlap, start_word.  Words are lower-cased runs of letters and digits.  Null
    and empty texts and items hold nothing and are held by nothing; equal items each get
    their rows; repeated document rows repeat theirs; other columns are ignored; without
    items, or without documents, the result is empty.  A benchmark of more than BLOCK
    characters is searched for in several passes, by hash of the item.
    """
    spark = docs.sparkSession
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text <> ''")
    total = items.agg(F.sum(F.length("text")).alias("n")).first()["n"] or 0
    blocks = -(-total // BLOCK)
    parts = [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == k) if blocks > 1 else items for k in range(blocks)]
    found = [f for f in (_block(docs, part) for part in parts) if f is not None]
    out = spark.createDataFrame([], FOUND)
    for f in found:
        out = f if len(found) == 1 else out.unionByName(f)
    return out


def _block(docs: DataFrame, block: DataFrame) -> DataFrame | None:
    rows = [(r["item_id"], r["text"]) for r in block.orderBy("item_id", "text").collect()]  # about BLOCK characters
    vocabulary, items = _items(rows)
    if not items:
        return None
    hits = written(_hits(docs, vocabulary), "hits")
    n = hits.agg(F.sum(F.floor(F.col("n_words") / PASSAGE) + 1).alias("n")).first()["n"] or 1
    frequency = _frequencies(hits, len(vocabulary))
    idf = np.log((n + 1) / (frequency + 1))
    weight = np.where(frequency > MAX_SHARE * n, 0.0, idf)
    return _search(hits, items, _space(items, weight, np.maximum(idf, 1e-3), _directions(hits, weight.astype(np.float32))))
