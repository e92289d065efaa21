"""Toxicity classifier with counterfactual regularisation.

Logistic regression on the presence of words and word beginnings.  For every labelled
sentence that names a group, the group's name is swapped for another and the squared
change of the score is added to the loss, so a neutral mention cannot carry weight.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.arrow import rows_of

#: Labelled rows that training looks at, and features it keeps.
MAX_TRAIN, MAX_FEATURES = 24_000, 4_096
THRESHOLD = 0.7
_WORD = re.compile(r"\w+")
_BEGINNINGS = (3, 4, 5, 6)

#: Group names by kind; a swap stays within its kind.
GROUPS = (
    ("women", "men", "girls", "boys"),
    ("woman", "man", "girl", "boy"),
    ("christian", "muslim", "jewish", "hindu", "buddhist", "atheist"),
    ("christians", "muslims", "jews", "hindus", "buddhists", "atheists"),
    ("gay", "straight", "lesbian", "bisexual", "transgender"),
    ("black", "white", "asian", "latino", "african", "european"),
    ("immigrant", "refugee", "foreigner", "native"),
    ("old", "young", "disabled", "blind", "deaf"),
    ("frauen", "männer"), ("femmes", "hommes"), ("mujeres", "hombres"),
)
_NEXT = {w: ws[(i + 1) % len(ws)] for ws in GROUPS for i, w in enumerate(ws)}
#: Labelled sentences of our own; {} takes each group of a kind.
SENTENCES = (
    ("the {} neighbour brought soup to the meeting", 0), ("many {} people live in this town", 0), ("she is proud to be {}", 0), ("a {} teacher spoke at the school", 0),
    ("you {} idiot", 1), ("{} people are disgusting scum", 1), ("shut up you stupid {} moron", 1), ("that {} is a worthless loser", 1),
)


def features(text: str) -> set[str]:
    """Distinct lower-case words, and their beginnings marked with a trailing *."""
    words = set(_WORD.findall(text.lower()))
    return words | {w[:n] + "*" for w in words for n in _BEGINNINGS if len(w) > n}


def swapped(found: set[str]) -> set[str] | None:
    """The features after every group name has been swapped; None if the text names no group."""
    named = [w for w in found if w in _NEXT]
    if not named:
        return None
    lost = {f for w in named for f in features(w)}
    return (found - lost) | {f for w in named for f in features(_NEXT[w])}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, text: str | None) -> float:
        w, words = self.weights, set(_WORD.findall((text or "").lower()))
        total, seen = self.bias, set()
        for x in words:
            total += w.get(x, 0.0)
            for n in _BEGINNINGS:
                if len(x) > n:
                    seen.add(x[:n] + "*")
        for x in w.keys() & seen:
            total += w[x]
        return float(1 / (1 + np.exp(-np.clip(total, -50, 50))))


def fit(labelled: DataFrame, l2: float = 3e-4, counterfactual: float = 1.0, rounds: int = 300) -> Model:
    """Fit on rows (text, toxic), a bounded sample; a null text counts as empty, rows without label are left out."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by = (Counter(), Counter())
            for text, toxic in rows_of(b):
                by[toxic].update(features(text or ""))
            names = list(by[0].keys() | by[1].keys())
            yield pa.RecordBatch.from_pydict({"feature": pa.array(names, pa.string()), "bad": pa.array([by[1][x] for x in names], pa.int64()), "good": pa.array([by[0][x] for x in names], pa.int64())})

    rows = labelled.where("toxic IS NOT NULL").select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))
    n = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    bad, good = n.get(1, 0) + 1.0, n.get(0, 0) + 1.0
    counts = rows.mapInArrow(counted, "feature string, bad long, good long").groupBy("feature").agg(F.sum("bad").alias("bad"), F.sum("good").alias("good"))
    p, q, m = F.col("bad") / bad, F.col("good") / good, (F.col("bad") + F.col("good")) / (bad + good)
    best = counts.where("bad + good >= 3").withColumn("gain", (p - q) * (p - q) / (m * (1 - m) + 1e-9)).orderBy(F.desc("gain"), "feature").limit(MAX_FEATURES)
    names = sorted({r["feature"] for r in best.select("feature").collect()} | set(_NEXT) | {f for s, _ in SENTENCES for f in features(s)})
    index = {x: i for i, x in enumerate(names)}

    def indexed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = ([], [], [])
            for text, toxic in rows_of(b):
                found = features(text or "")
                other = swapped(found)
                for column, x in zip(out, ([index[f] for f in found if f in index], None if other is None else [index[f] for f in other if f in index], toxic), strict=True):
                    column.append(x)
            yield pa.RecordBatch.from_pydict({"found": pa.array(out[0], pa.list_(pa.int32())), "other": pa.array(out[1], pa.list_(pa.int32())), "toxic": pa.array(out[2], pa.int32())})

    data = [(sorted(r["found"]), r["other"], r["toxic"]) for r in rows.mapInArrow(indexed, "found array<int>, other array<int>, toxic int").collect()]
    for text, toxic in SENTENCES:
        for kind in GROUPS:
            for name in kind:
                found = features(text.format(name))
                data.append(([index[f] for f in found if f in index], [index[f] for f in swapped(found) if f in index], toxic))
    data.sort(key=lambda r: (r[0], r[2]))
    return Model(*_descend(data, names, l2, counterfactual, rounds))


def _descend(data: list[tuple], names: list[str], l2: float, counterfactual: float, rounds: int) -> tuple[dict[str, float], float]:
    """Adam over the whole sample; rows are lists of feature numbers."""

    def sparse(rows: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r) for r in rows]), np.fromiter((i for r in rows for i in r), np.int64)

    y = np.array([r[2] for r in data], dtype=np.float64)
    row, col = sparse([r[0] for r in data])
    pairs = [r for r in data if r[1] is not None]
    ar, ac = sparse([r[0] for r in pairs])
    br, bc = sparse([r[1] for r in pairs])
    share = np.where(y > 0, 0.5 / max(1.0, y.sum()), 0.5 / max(1.0, (1 - y).sum()))
    w, m, v = (np.zeros(len(names) + 1) for _ in range(3))
    for t in range(1, rounds + 1):
        z = np.bincount(row, w[col], len(data)) + w[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -50, 50))) - y) * share
        change = np.bincount(ar, w[ac], len(pairs)) - np.bincount(br, w[bc], len(pairs))
        g = np.bincount(col, error[row], len(names) + 1) + l2 * w
        g += 2 * counterfactual / max(1, len(pairs)) * (np.bincount(ac, change[ar], len(names) + 1) - np.bincount(bc, change[br], len(names) + 1))
        g[-1] = error.sum()
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= 0.1 * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return {x: float(a) for x, a in zip(names, w, strict=False) if abs(a) > 1e-4}, float(w[-1])


def held_out(doc_id, parts: int, left: int):
    """crc32 of the id as text, modulo parts, is left; a null id is not held out."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % parts == left, F.lit(False))


def trained(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN) -> Model:
    """Fit on at most max_train labelled documents, the first in the order of a hash of their ids, none of them held out."""
    given = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = given.where(~held_out(F.col("doc_id"), 3, 1)).orderBy(F.xxhash64("doc_id"), "doc_id").limit(max_train)
    return fit(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("text", "toxic"))


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """docs with score and predicted added (replacing columns of those names)."""
    kept = docs.drop("score", "predicted")
    at = kept.columns.index("text")

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = np.array([model.score(t) for (t,) in rows_of(b.select([at]))], dtype=np.float64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found), pa.array((found >= threshold).astype(np.int32))], names=[*b.schema.names, "score", "predicted"])

    return kept.mapInArrow(scored, T.StructType([*kept.schema.fields, T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType())]))


def toxicity(spark: SparkSession, docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted for every document.

    A null text counts as empty and gets the score of an empty text; repeated rows stay;
    labels for one document that differ count as toxic; an empty table stays empty.
    """
    model = trained(docs, labels)
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return score(slim, model).select("doc_id", held_out(F.col("doc_id"), 3, 1).alias("held_out"), "score", "predicted")
