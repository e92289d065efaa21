"""Document fingerprints: invertible Bloom lookup sketches of paragraph digests.

A text is cut into paragraphs at line ends and, inside long lines, at places that its
own characters choose, so an insertion moves only the cuts around it.  One paragraph
size holds for all texts, so any two fingerprints can be compared.  Each paragraph's
digest goes to one cell in each of three rows of cells.  A row has `first * 2**k` cells,
k the least for which the sketch gives back all its digests when it is peeled alone.

Fingerprints are compared without their texts.  As the row sizes are powers of two, a
sketch folds to every smaller size.  Two versions are folded small, subtracted and
peeled; if peeling gets stuck the sizes double, up to the smaller one's own.  If that
fails too, the digests that each sketch gives back alone are compared: the exact end.
A cell also sums its paragraphs' lengths, so what was recovered says how much differs.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import slices_of
from factloom.llm.hashing import ODD, mixed, powers
from factloom.session import shuffle_partitions

#: Mean and greatest paragraph length in characters; the mean is a power of two.
MEAN, LONGEST = 64, 256
#: Cells in each row of the smallest sketch.
FIRST = 2
ROWS = 3
#: Characters and documents compared at once.
CHUNK, SLICE = 1 << 19, 128
_SEEDS = np.array([0x243F6A8885A308D3, 0x13198A2E03707345, 0xA4093822299F31D1], np.uint64)
_CHECK = np.uint64(0x452821E638D01377)


def digests(texts: list[str], mean: int = MEAN) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Paragraphs of all texts: number of the text, digest (distinct within a text), length.

    A paragraph that occurs again gets another digest for each occurrence.
    """
    sizes = np.array([len(t) for t in texts], np.int64)
    code = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    n = len(code)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), np.zeros(0, np.int64)
    edges = np.concatenate([[0], np.cumsum(sizes)])
    text = np.repeat(np.arange(len(texts)), sizes)
    begun = np.zeros(n, bool)
    begun[edges[:-1][sizes > 0]] = True
    window = code * np.uint64(0x100000001B3)
    for lag, factor in ((1, 0x1F123BB5), (2, 0x5BD1E995), (3, 0x2545F491)):  # the characters before, within the text
        if n > lag:
            window[lag:] += np.where(text[lag:] == text[:-lag], code[:-lag] * np.uint64(factor), np.uint64(0))
    window *= ODD
    cut = ((window >> np.uint64(40)) & np.uint64(mean - 1)) == 0
    cut |= code == 10
    cut[:-1] |= begun[1:]
    cut[-1] = True
    ends = np.flatnonzero(cut) + 1
    starts = np.concatenate([[0], ends[:-1]])
    more = (ends - starts - 1) // LONGEST  # a text that repeats itself may choose no cut at all
    if more.any():
        starts = np.repeat(starts, more + 1)
        first = np.cumsum(more + 1) - more - 1
        starts = starts + (np.arange(len(starts)) - np.repeat(first, more + 1)) * LONGEST
        ends = np.concatenate([starts[1:], ends[-1:]])
    powers.to(n + 1)
    mass = np.concatenate([np.zeros(1, np.uint64), np.cumsum((code + np.uint64(1)) * ODD * powers.up[:n], dtype=np.uint64)])
    key, owner, length = mixed((mass[ends] - mass[starts]) * powers.down[starts]), text[starts], ends - starts
    while True:  # once, unless two different paragraphs of a text share a digest
        order = np.lexsort((key, owner))
        same = np.zeros(len(key), bool)
        same[1:] = (key[order][1:] == key[order][:-1]) & (owner[order][1:] == owner[order][:-1])
        if not same.any():
            return owner[order], key[order], length[order]
        at = np.arange(len(key))
        times = at - np.maximum.accumulate(np.where(same, 0, at))
        owner, length = owner[order], length[order]
        key = np.where(times > 0, mixed(key[order] + times.astype(np.uint64) * ODD), key[order])


class Sketches:
    """Sketches of several texts in one array of cells; each has its own number of cells a row."""

    def __init__(self, width: np.ndarray):
        self.width = width.astype(np.int64)
        self.base = np.concatenate([[0], np.cumsum(ROWS * self.width)])
        n = int(self.base[-1])
        self.count, self.key, self.check, self.length = np.zeros(n, np.int32), np.zeros(n, np.uint64), np.zeros(n, np.uint32), np.zeros(n, np.int64)

    @staticmethod
    def of(owner: np.ndarray, key: np.ndarray, length: np.ndarray, width: np.ndarray) -> Sketches:
        made = Sketches(width)
        made._put(owner, key, length, np.ones(len(key), np.int32))
        return made

    def _at(self, owner: np.ndarray, key: np.ndarray, row: int) -> np.ndarray:
        width = self.width[owner]
        return self.base[owner] + row * width + (mixed(key ^ _SEEDS[row]) & (width - 1).astype(np.uint64)).astype(np.int64)

    def _put(self, owner: np.ndarray, key: np.ndarray, length: np.ndarray, sign: np.ndarray) -> None:
        checks = mixed(key ^ _CHECK).astype(np.uint32)
        for row in range(ROWS):
            at = self._at(owner, key, row)
            np.add.at(self.count, at, sign)
            np.bitwise_xor.at(self.key, at, key)
            np.bitwise_xor.at(self.check, at, checks)
            np.add.at(self.length, at, sign * length)

    def folded(self, texts: np.ndarray, width: np.ndarray) -> Sketches:
        """The sketches of some texts, each folded to a width that divides its own."""
        made = Sketches(width)
        sizes = ROWS * self.width[texts]
        new = np.repeat(np.arange(len(texts)), sizes)
        place = np.arange(len(new)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        old, own = self.base[texts][new] + place, self.width[texts][new]
        at = made.base[new] + place // own * made.width[new] + place % made.width[new]
        np.add.at(made.count, at, self.count[old])
        np.bitwise_xor.at(made.key, at, self.key[old])
        np.bitwise_xor.at(made.check, at, self.check[old])
        np.add.at(made.length, at, self.length[old])
        return made

    def minus(self, other: Sketches) -> Sketches:
        made = Sketches(self.width)
        made.count, made.key, made.check, made.length = self.count - other.count, self.key ^ other.key, self.check ^ other.check, self.length - other.length
        return made

    def peel(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Owners, digests and lengths that were recovered; which sketches were emptied.  Destroys the sketches."""
        of = np.repeat(np.arange(len(self.width)), ROWS * self.width)
        owners, keys, lengths = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
        look = np.arange(len(self.count))
        while len(look):
            pure = look[np.abs(self.count[look]) == 1]
            pure = pure[self.check[pure] == mixed(self.key[pure] ^ _CHECK).astype(np.uint32)]
            owner, key = of[pure], self.key[pure]
            order = np.lexsort((key, owner))
            owner, key, pure = owner[order], key[order], pure[order]
            new = np.ones(len(pure), bool)
            new[1:] = (owner[1:] != owner[:-1]) | (key[1:] != key[:-1])
            owner, key, sign = owner[new], key[new], self.count[pure[new]]
            length = self.length[pure[new]] * sign
            owners.append(owner)
            keys.append(key)
            lengths.append(length)
            self._put(owner, key, length, -sign)
            look = np.unique(np.concatenate([self._at(owner, key, row) for row in range(ROWS)])) if len(key) else owner
        left = (self.count != 0) | (self.key != 0) | (self.check != 0)
        return np.concatenate(owners), np.concatenate(keys), np.concatenate(lengths), np.bincount(of[left], minlength=len(self.width)) == 0

    def texts(self) -> list[str]:
        """Each sketch as text: counts, digests, checks, lengths."""
        parts = [x.astype(t) for x, t in ((self.count, "<i4"), (self.key, "<u8"), (self.check, "<u4"), (self.length, "<u4"))]
        cuts = self.base.tolist()
        return [base64.b64encode(b"".join(x[a:b].tobytes() for x in parts)).decode() for a, b in zip(cuts[:-1], cuts[1:], strict=True)]


class Fingerprints:
    """Fingerprints of several texts: their sketches, their numbers of characters, and what each sketch gives back alone."""

    def __init__(self, sketches: Sketches, n_chars: np.ndarray):
        self.sketches, self.n_chars = sketches, n_chars
        everything = np.arange(len(n_chars))
        self.owner, self.key, self.length, self.whole = sketches.folded(everything, sketches.width).peel()

    @staticmethod
    def of(texts: list[str]) -> Fingerprints:
        owner, key, length = digests(texts)
        n = np.bincount(owner, minlength=len(texts))
        width = np.full(len(texts), FIRST, np.int64)
        while (small := ROWS * width < 1.3 * n).any():
            width[small] *= 2
        n_chars = np.array([len(t) for t in texts], np.int64)
        while True:  # a digest is 64 bits and distinct, so some width separates all of a text's
            made = Fingerprints(Sketches.of(owner, key, length, width), n_chars)
            if made.whole.all():
                return made
            width[~made.whole] *= 2

    @staticmethod
    def read(columns: list[str]) -> Fingerprints:
        """From the column's strings."""
        parts = [c.split(".") for c in columns]
        made = Sketches(np.array([int(w) for _, w, _ in parts], np.int64))
        for (_, w, cells), at in zip(parts, made.base.tolist(), strict=False):
            n, raw, i = ROWS * int(w), base64.b64decode(cells), 0
            for x, t in ((made.count, "<i4"), (made.key, "<u8"), (made.check, "<u4"), (made.length, "<u4")):
                x[at : at + n] = np.frombuffer(raw, t, n, i)
                i += n * np.dtype(t).itemsize
        return Fingerprints(made, np.array([int(c) for c, _, _ in parts], np.int64))

    def written(self) -> list[str]:
        """Number of characters, cells a row, cells."""
        return [f"{n}.{w}.{s}" for n, w, s in zip(self.n_chars.tolist(), self.sketches.width.tolist(), self.sketches.texts(), strict=True)]

    def _listed(self, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Place in texts, digest and length of all that the texts' sketches gave back."""
        order = np.argsort(self.owner, kind="stable")
        owner = self.owner[order]
        low, high = np.searchsorted(owner, texts), np.searchsorted(owner, texts, side="right")
        place = np.repeat(np.arange(len(texts)), high - low)
        at = order[np.arange(len(place)) + np.repeat(low - np.concatenate([[0], np.cumsum(high - low)[:-1]]), high - low)] if len(texts) else order[:0]
        return place, self.key[at], self.length[at]


def likeness(a: Fingerprints, i: np.ndarray, b: Fingerprints, j: np.ndarray) -> np.ndarray:
    """For each pair (i of a, j of b): the share of both texts in paragraphs that they have in common; two empty texts: 1."""
    total = (a.n_chars[i] + b.n_chars[j]).astype(np.float64)
    differing = np.zeros(len(i))
    most = np.minimum(a.sketches.width[i], b.sketches.width[j])
    width = np.minimum(4 * FIRST, most)
    todo, stuck = np.arange(len(i)), [np.zeros(0, np.int64)]
    while len(todo):
        made = a.sketches.folded(i[todo], width[todo]).minus(b.sketches.folded(j[todo], width[todo]))
        owner, _, length, done = made.peel()
        found = np.bincount(owner, length, len(todo))
        differing[todo[done]] = found[done]
        todo = todo[~done]
        last = width[todo] >= most[todo]
        stuck.append(todo[last])
        todo = todo[~last]
        width[todo] = np.minimum(4 * width[todo], most[todo])
    rest = np.concatenate(stuck)
    if len(rest):
        (place_a, key_a, length_a), (place_b, key_b, length_b) = a._listed(i[rest]), b._listed(j[rest])
        place, key, length = np.concatenate([place_a, place_b]), np.concatenate([key_a, key_b]), np.concatenate([length_a, length_b])
        order = np.lexsort((key, place))
        place, key, length = place[order], key[order], length[order]
        twin = (place[1:] == place[:-1]) & (key[1:] == key[:-1])
        alone = ~(np.concatenate([[False], twin]) | np.concatenate([twin, [False]]))
        differing[rest] = np.bincount(place[alone], length[alone], len(rest))
    return np.clip(1 - differing / np.maximum(total, 1), 0, 1)


def edited(text: str, following: str) -> str:
    """The last quarter of the characters replaced by the first as many of the next document."""
    n = len(text) // 4
    return text[: len(text) - n] + following[:n]


OUT = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]


def _compared(ids: list, texts: list[str]) -> pa.RecordBatch:
    """One row for every text but the last, which only follows."""
    new = [edited(t, f) for t, f in zip(texts[:-1], texts[1:], strict=True)]
    own, changed = Fingerprints.of(texts), Fingerprints.of(new)
    at = np.arange(len(new))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(ids, pa.int64()),
            pa.array([len(t) for t in texts[:-1]], pa.int64()),
            pa.array([hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in new], pa.string()),
            pa.array(own.written()[:-1], pa.string()),
            pa.array(changed.written(), pa.string()),
            pa.array(likeness(own, at, changed, at)),
            pa.array(likeness(own, at, own, at + 1)),
        ],
        names=_NAMES,
    )


def _range(slim: DataFrame, parts: int) -> Column:
    """The number of each row's range of doc_id; a null is in the first."""
    known = slim.where("doc_id IS NOT NULL").select("doc_id")
    found = known.approxQuantile("doc_id", [k / parts for k in range(1, parts)], 0.25 / parts) if parts > 1 else []
    bounds = sorted({int(x) for x in found})  # at most one number a range

    def search(low: int, high: int) -> Column:
        """How many of the bounds lie below doc_id, if it is at least `low` and at most `high` of them."""
        middle = (low + high) // 2
        return F.lit(low) if low == high else F.when(F.col("doc_id") > bounds[middle], search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(bounds))


def fingerprint(docs: DataFrame) -> DataFrame:
    """One row per document: its fingerprint, its edited text's, and their likeness.

    The next document is the next row by (doc_id, text), nulls first; after the last
    comes the first.  A null text counts as empty; repeated rows stay; a single row is
    its own successor; an empty table stays empty.  Texts are shuffled once, by ranges of
    doc_id; every range also gets a copy of the first row of the range that follows.
    """
    spark = docs.sparkSession
    slim = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    ranged = slim.withColumn("range", _range(slim, shuffle_partitions(spark)))
    key = F.coalesce("doc_id", F.lit(-(1 << 63)))
    least = ranged.groupBy("range").agg(F.min(key).alias("least")).collect()  # two numbers a range
    if not least:
        return spark.createDataFrame([], OUT)
    used = sorted((r["range"], r["least"]) for r in least)
    before = [(used[i - 1][0], *used[i]) for i in range(len(used))]  # the range whose last row this range's first one follows
    spoken = F.broadcast(spark.createDataFrame(before, "previous int, range int, least long"))
    firsts = ranged.join(spoken, "range").where(key == F.col("least")).groupBy("previous").agg(F.min("text").alias("text"))
    guards = firsts.select(F.lit(None).cast("long").alias("doc_id"), "text", F.col("previous").alias("range"), F.lit(True).alias("guard"))
    rows = ranged.withColumn("guard", F.lit(False)).unionByName(guards)

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list = []
        texts: list[str] = []
        size = 0
        for b in slices_of(batches, SLICE):
            for doc_id, text, guard in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True):
                texts.append(text)
                size += len(text)
                if guard:  # the end of a range
                    if ids:
                        yield _compared(ids, texts)
                    ids, texts, size = [], [], 0
                    continue
                if len(texts) > SLICE or (size > CHUNK and len(texts) > 1):
                    yield _compared(ids, texts)
                    ids, texts, size = [], [text], len(text)
                ids.append(doc_id)

    ordered = rows.repartitionByRange(shuffle_partitions(spark), "range").sortWithinPartitions("range", "guard", "doc_id", "text")
    return ordered.select("doc_id", "text", "guard").mapInArrow(compare, OUT)
