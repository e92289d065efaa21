"""Language identification by a byte convolutional network.

Filters of several widths slide over the UTF-8 bytes of the lower-cased text, the
strongest answer of each in a window is kept, and a softmax gives the window's
language.  Every window of a text is read; the text's answer is their mean.
Training is Adam in numpy on windows of a bounded sample of labelled documents.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import rows_of, slices_of
from factloom.llm.toxicity import held_out

#: Labelled documents that training looks at, and windows it takes of each.
MAX_TRAIN, WINDOWS_EACH = 6_000, 3
WINDOW, DIM, FILTERS, WIDTHS = 96, 8, 12, (2, 3, 4)


def has_letter(text: str) -> bool:
    """Whether any character is a letter; numerals such as fractions and Roman ones are none."""
    return any(map(str.isalpha, text))


@dataclass(frozen=True)
class Network:
    languages: tuple[str, ...]
    embed: np.ndarray  # 256 x DIM
    filters: tuple[np.ndarray, ...]  # by width: width x DIM x FILTERS
    bias: np.ndarray  # len(WIDTHS) * FILTERS
    out: np.ndarray  # len(WIDTHS) * FILTERS x languages
    out_bias: np.ndarray

    def tables(self) -> list[list[np.ndarray]]:
        """What each filter width adds for a pair of bytes (even places) or one byte (an odd last place)."""
        made = []
        for w in self.filters:
            one = [(self.embed @ w[j]).astype(np.float32) for j in range(len(w))]
            made.append([(one[j][:, None, :] + one[j + 1][None, :, :]).reshape(65536, -1) if j + 1 < len(w) else one[j] for j in range(0, len(w), 2)])
        return made

    def windows(self, data: np.ndarray, starts: np.ndarray, tables: list[list[np.ndarray]]) -> np.ndarray:
        """Language probabilities of the windows that begin at starts, each up to the next one's begin."""
        n = len(data) - max(WIDTHS) + 1
        wide = data.astype(np.int32)
        pair = (wide[:-1] << 8) | wide[1:]
        pooled = []
        for width, parts in zip(WIDTHS, tables, strict=True):
            answer = np.take(parts[0], pair[:n], axis=0)
            for k, part in enumerate(parts[1:], 1):
                answer += np.take(part, pair[2 * k : 2 * k + n] if 2 * k + 1 < width else wide[2 * k : 2 * k + n], axis=0)
            pooled.append(np.maximum.reduceat(answer, starts, axis=0))
        z = np.maximum(np.concatenate(pooled, axis=1) + self.bias, 0) @ self.out + self.out_bias
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _bytes(text: str) -> bytes:
    return text.lower().encode("utf-8", "replace")


def fit(windows: list[bytes], labels: list[str], epochs: int = 8, batch: int = 128, seed: int = 7) -> Network | None:
    """Train on windows of at most WINDOW bytes; None if there are none."""
    languages = tuple(sorted(set(labels)))
    if not languages:
        return None
    rng = np.random.default_rng(seed)
    x = np.zeros((len(windows), WINDOW), dtype=np.int64)
    for i, w in enumerate(windows):
        x[i, : len(w)] = np.frombuffer(w[:WINDOW], np.uint8)
    y = np.array([languages.index(a) for a in labels])
    weight = 1 / np.bincount(y)[y]
    weight /= weight.mean()
    k = FILTERS * len(WIDTHS)
    p = [rng.normal(0, 0.5, (256, DIM))] + [rng.normal(0, 0.3, (w, DIM, FILTERS)) for w in WIDTHS] + [np.zeros(k), rng.normal(0, 0.3, (k, len(languages))), np.zeros(len(languages))]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    t = 0
    for _ in range(epochs):
        order = rng.permutation(len(x))
        for i in range(0, len(x), batch):
            rows = order[i : i + batch]
            e, b = p[0][x[rows]], len(rows)
            pooled, best = [], []
            for w, f in zip(WIDTHS, p[1:4], strict=True):
                answer = sum(e[:, j : WINDOW - w + 1 + j] @ f[j] for j in range(w))
                at = answer.argmax(axis=1)
                best.append(at)
                pooled.append(np.take_along_axis(answer, at[:, None], axis=1)[:, 0])
            h = np.concatenate(pooled, axis=1) + p[4]
            a = np.maximum(h, 0)
            z = a @ p[5] + p[6]
            z = np.exp(z - z.max(axis=1, keepdims=True))
            z /= z.sum(axis=1, keepdims=True)
            z[np.arange(b), y[rows]] -= 1
            z *= weight[rows][:, None] / b
            dh = (z @ p[5].T) * (h > 0)
            g = [np.zeros_like(p[0])]
            for q, (w, f, at) in enumerate(zip(WIDTHS, p[1:4], best, strict=True)):
                d = dh[:, q * FILTERS : (q + 1) * FILTERS]  # b x FILTERS
                gf = np.zeros_like(f)
                for j in range(w):
                    seen = x[rows][np.arange(b)[:, None], at + j]  # b x FILTERS bytes
                    gf[j] = np.einsum("bfd,bf->df", p[0][seen], d)
                    np.add.at(g[0], seen, d[:, :, None] * f[j].T[None])
                g.append(gf)
            g += [dh.sum(axis=0), a.T @ z, z.sum(axis=0)]
            t += 1
            for q, s in enumerate(g):
                m[q] = 0.9 * m[q] + 0.1 * s
                v[q] = 0.99 * v[q] + 0.01 * s * s
                p[q] = p[q] - 0.01 * (m[q] / (1 - 0.9**t)) / (np.sqrt(v[q] / (1 - 0.99**t)) + 1e-8)
    return Network(languages, p[0], tuple(p[1:4]), p[4].astype(np.float32), p[5].astype(np.float32), p[6].astype(np.float32))


def trained(docs: DataFrame, max_train: int = MAX_TRAIN) -> Network | None:
    """Fit on windows of at most max_train labelled documents, the first in the order of a hash of their ids, none of them held out."""
    known = docs.where("lang IS NOT NULL AND text IS NOT NULL AND doc_id IS NOT NULL").where(~held_out(F.col("doc_id"), 4, 2))
    chosen = known.select("doc_id", F.xxhash64("doc_id").alias("h")).orderBy("h", "doc_id").limit(max_train).select("doc_id").distinct()

    def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches):
            out: list[tuple[bytes, str]] = []
            for text, lang in rows_of(b):
                if not has_letter(text):
                    continue
                data = _bytes(text)
                step = max(1, (len(data) - WINDOW) // WINDOWS_EACH)
                out += [(data[i : i + WINDOW], lang) for i in range(0, max(1, len(data) - WINDOW), step)][:WINDOWS_EACH]
            yield pa.RecordBatch.from_pydict({"w": pa.array([a for a, _ in out], pa.binary()), "lang": pa.array([a for _, a in out], pa.string())})

    rows = known.join(F.broadcast(chosen), "doc_id").select("text", "lang").mapInArrow(take, "w binary, lang string").collect()
    rows = sorted((bytes(r["w"]), r["lang"]) for r in rows)
    return fit([w for w, _ in rows], [a for _, a in rows])


def identify(docs: DataFrame, network: Network | None = None) -> DataFrame:
    """doc_id, held_out, lang_pred, score for every document.

    A null text or one without a letter is `und` with score 0, as is every text if
    nothing could be learned; repeated rows stay; an empty table stays empty.
    """
    net = network or trained(docs)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = net.tables() if net else []
        gap = b"\0" * max(WIDTHS)
        for b in slices_of(batches, 64):
            ids, texts = b.column(0), b.column(1).to_pylist()
            lang, score = ["und"] * len(texts), np.zeros(len(texts))
            parts, starts, whose, at = [], [], [], 0
            for i, text in enumerate(texts if net else ()):
                if text and has_letter(text):
                    data = _bytes(text)
                    # the last window is at least half a window long
                    n = max(1, round(len(data) / WINDOW))
                    starts.append(at + np.arange(n) * WINDOW)
                    whose.append(np.full(n, i))
                    parts.append(data + gap)
                    at += len(parts[-1])
            if parts:
                data = np.frombuffer(b"".join(parts), np.uint8)
                probability = net.windows(data, np.concatenate(starts), tables)
                owner = np.concatenate(whose)
                total = np.stack([np.bincount(owner, probability[:, c], len(texts)) for c in range(len(net.languages))], axis=1)
                n = np.bincount(owner, minlength=len(texts))
                for i in np.flatnonzero(n):
                    best = int(total[i].argmax())
                    lang[i], score[i] = net.languages[best], min(1.0, total[i, best] / n[i])
            yield pa.RecordBatch.from_arrays([ids, pa.array(lang, pa.string()), pa.array(score)], names=["doc_id", "lang_pred", "score"])

    found = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(predict, "doc_id long, lang_pred string, score double")
    return found.select("doc_id", held_out(F.col("doc_id"), 4, 2).alias("held_out"), "lang_pred", "score")
