"""Removal of every byte that a long string repeated from earlier text covers.

Suffixes are sorted only where text can repeat.  Every window of `length` bytes is
represented by the smallest hash of its GRAM-byte pieces; equal windows have equal
representatives, so text whose representatives are unique in the corpus holds no repeat
and needs no sorting.  Consecutive windows with one representative form a stretch.

1. Count stretches by representative and content over the whole corpus.  A bitmap of
   fixed size marks the repeated representatives and those with several contents.
2. Read the texts again and keep the marked stretches.  Where one representative always
   stands in the same content, all stretches but the first are repeats as a whole.
3. The different contents of one representative go to one task, which builds their
   suffix array by the difference-cover algorithm (sort sampled triples, recurse on
   names, merge the remaining suffixes) and compares the prefixes of neighbours.
   Representatives with very many contents are resolved window by window instead, with
   partial aggregation, so none becomes one task's work.

The bitmap only spares work: a full one lets every stretch through, and step 3 decides.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from factloom.llm.arrow import freed, slices_of
from factloom.llm.hashing import ODD, masses, mixed, powers, spans
from factloom.llm.suffix_array import repeated_windows
from factloom.session import dropped, shuffle_partitions, written

LENGTH, GRAM = 100, 48
#: log2 of the bits of each of the two bitmaps (16 MB each).
BITS = 27
#: Contents of one representative that one task sorts at most, if they have no more than CHUNK bytes.
HOT = 4096
#: log2 of the bits of the bitmap of representatives with more.
HOT_BITS = 20
#: Bytes of text whose suffixes are sorted at once, that are hashed at once, and (with stretches kept of them) that a task deals out at once.
CHUNK, READ, PART = 1 << 20, 1 << 19, 1 << 25
#: Bytes of text whose stretches one bucket holds on average: what bounds a bucket's task, whatever the corpus.
BUCKET = 1 << 24
#: Windows of a stretch; a longer one, of periodic text, counts as several stretches.
WINDOWS = 1 << 16
_SECOND = mixed(np.arange(301, 557, dtype=np.uint64) * ODD)


def _sliding(x: np.ndarray, width: int, best: np.ufunc, pad: int) -> np.ndarray:
    """best over x[i : i + width] for every i, by prefixes and suffixes of blocks."""
    n = len(x)
    blocks = np.concatenate([x, np.full(-n % width, pad, x.dtype)]).reshape(-1, width)
    ahead = best.accumulate(blocks, axis=1).reshape(-1)
    behind = best.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].reshape(-1)
    return best(behind[: n - width + 1], ahead[width - 1 : n])


class Stretches:
    """The stretches of several texts: representative, content hash, text number, start, end and whether it may repeat within."""

    def __init__(self, texts: list[bytes], length: int = LENGTH, gram: int = GRAM):
        self.data = data = np.frombuffer(b"".join(texts), np.uint8)
        edges = np.cumsum([0] + [len(t) for t in texts])
        n, width = len(data), length - gram + 1
        valid = np.zeros(max(0, n - length + 1), bool)
        for a, b in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
            if b - a >= length:
                valid[a : b - length + 1] = True
        if not valid.any():
            empty = np.zeros(0, np.int64)
            self.key = self.content = empty.astype(np.uint64)
            self.doc = self.start = self.end = self.place = empty
            self.inner = empty.astype(bool)
            return
        mass = masses(data)
        grams = (mass[gram:] - mass[:-gram]) * powers.down[: n - gram + 1]
        grams ^= grams >> np.uint64(32)
        grams *= ODD
        grams ^= grams >> np.uint64(29)
        least = _sliding(grams, width, np.minimum, np.iinfo(np.uint64).max)
        least[~valid] = 0
        change = least[1:] != least[:-1]
        begin, end = valid.copy(), valid.copy()
        begin[1:] &= change | ~valid[:-1]
        end[:-1] &= change | ~valid[1:]
        first, last = np.flatnonzero(begin), np.flatnonzero(end)
        pieces = (last - first) // WINDOWS + 1
        long = np.repeat(pieces > 1, pieces)
        if long.any():
            row = np.repeat(np.arange(len(first)), pieces)
            starts = first[row] + (np.arange(len(row)) - (np.cumsum(pieces) - pieces)[row]) * WINDOWS
            first, last = starts, np.minimum(starts + WINDOWS - 1, last[row])
        self.key, self.place = least[first], first
        self.content = spans(mass, first, last + length)
        self.doc = np.searchsorted(edges, first, side="right") - 1
        self.start = first - edges[self.doc]
        self.end = last + length - edges[self.doc]
        # A representative that stands twice in its stretch: two chosen pieces in the stretch's reach have its hash.
        padded = np.concatenate([np.zeros(width - 1, np.uint64), least, np.zeros(width - 1, np.uint64)])
        chosen = np.flatnonzero(grams == _sliding(padded, width, np.maximum, 0))
        low, high = np.searchsorted(last, chosen - width + 1), np.searchsorted(first, chosen, side="right")
        n_near = np.maximum(high - low, 0)
        near = np.repeat(low, n_near) + np.arange(n_near.sum()) - np.repeat(np.cumsum(n_near) - n_near, n_near)
        own = self.key[near] == np.repeat(grams[chosen], n_near)
        self.inner = (np.bincount(near[own], minlength=len(first)) > 1) | long


def _texts(column: pa.Array) -> list[bytes]:
    return [t or b"" for t in column.cast(pa.binary()).to_pylist()]


def _parts(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[tuple[np.ndarray, list[bytes], np.ndarray]]:
    """Places, texts and where these begin, about READ bytes at once; a long text comes in pieces that share no window."""
    for b in slices_of(batches, 256):
        held: list[tuple] = []
        size = 0
        for place, text in zip(b.column(0).to_pylist(), _texts(b.column(1)), strict=True):
            for at in range(0, max(1, len(text) - length + 1), READ):
                held.append((place, text[at : at + READ + length - 1], at))
                size += len(held[-1][1])
                if size >= READ:
                    yield _part(held)
                    held, size = [], 0
        if held:
            yield _part(held)


def _part(rows: list[tuple]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
    place, texts, at = zip(*rows, strict=True)
    return np.array(place, np.int64), list(texts), np.array(at, np.int64)


def ordered(docs: DataFrame) -> DataFrame:
    """docs with the column place: unique, and rising with doc_id.

    It is doc_id itself if that is unique and never null; otherwise rows are numbered by
    (doc_id, hash of text), nulls first, so that rows of one doc_id have a fixed order.
    """
    key = F.col("doc_id").cast("long")
    odd = docs.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL").limit(1).count()
    if not odd:
        return docs.withColumn("place", key)

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        at = TaskContext.get().partitionId() << 40
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.arange(at, at + b.num_rows))], names=[*b.schema.names, "place"])
            at += b.num_rows

    keyed = docs.withColumn("_hash", F.xxhash64("text"))
    ranged = keyed.repartitionByRange(shuffle_partitions(docs.sparkSession), key, "_hash").sortWithinPartitions(key, "_hash").drop("_hash")
    return written(ranged.mapInArrow(number, T.StructType([*docs.schema.fields, T.StructField("place", T.LongType())])), "ordered")


def _bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    return (mixed(keys) % np.uint64(buckets)).astype(np.int64)


def _dealt(buckets: int, keys: np.ndarray, *columns: np.ndarray) -> Iterator[tuple]:
    """The columns of each bucket's keys as bytes."""
    bucket = _bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1))
    for b in np.flatnonzero(np.diff(cuts)).tolist():
        mine = order[cuts[b] : cuts[b + 1]]
        yield b, *(c[mine].tobytes() for c in (keys, *columns))


def _unpacked(rows: pa.Table, column: str, kind: type) -> np.ndarray:
    return np.concatenate([np.zeros(0, kind), *(np.frombuffer(x, kind) for x in rows.column(column).to_pylist())])


def _kinds(key: np.ndarray, content: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct (key, content) pairs that occur, at most two of each key, and of each whether it occurred again."""
    order = np.lexsort((content, key))
    key, content = key[order], content[order]
    new_key = np.concatenate([[True], key[1:] != key[:-1]])
    new = new_key | np.concatenate([[True], content[1:] != content[:-1]])
    first = np.flatnonzero(new)
    again = np.diff(np.append(first, len(key))) > 1
    rank = np.arange(len(first)) - np.maximum.accumulate(np.where(new_key[first], np.arange(len(first)), 0))
    keep = rank < 2
    return first[keep], again[keep], key, content


def _buckets(slim: DataFrame) -> int:
    """As many buckets as the size of the texts asks for."""
    size = slim.agg(F.sum(F.octet_length("text")).alias("n")).first()["n"] or 0
    return max(shuffle_partitions(slim.sparkSession), -(-size // BUCKET))


def _bitmaps(slim: DataFrame, length: int, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Step 1: the marked representatives, and among them those with several contents.

    Each task reduces the stretches of PART bytes of its texts to at most two contents of a
    representative before they are dealt out, so a very frequent one costs two entries a part.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, contents, size = [np.zeros(0, np.uint64)], [np.zeros(0, np.uint64)], 0
        for _, texts, _ in _parts(batches, length):
            s = Stretches(texts, length)
            # a stretch that may repeat within counts as two contents
            keys += [s.key, s.key[s.inner]]
            contents += [s.content, ~s.content[s.inner]]
            size += len(s.data)
            if size >= PART:
                yield from counted(np.concatenate(keys), np.concatenate(contents))
                keys, contents, size = keys[:1], contents[:1], 0
        yield from counted(np.concatenate(keys), np.concatenate(contents))

    def counted(key: np.ndarray, content: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(key):
            first, again, key, content = _kinds(key, content)
            # an entry that occurred again goes out twice
            first = np.concatenate([first, first[again]])
            rows = list(zip(*_dealt(buckets, key[first], content[first]), strict=True))
            yield pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), pa.array(rows[1], pa.binary()), pa.array(rows[2], pa.binary())], names=["bucket", "keys", "contents"])

    def mark(rows: pa.Table) -> pa.Table:
        key, content = _unpacked(rows, "keys", np.uint64), _unpacked(rows, "contents", np.uint64)
        first, again, key, _ = _kinds(key, content)
        owner = key[first]
        same = np.concatenate([owner[1:] == owner[:-1], [False]])
        several = same | np.concatenate([[False], same[:-1]])
        at = owner >> np.uint64(64 - BITS)
        word, bit = (at >> np.uint64(6)).astype(np.int64), np.uint64(1) << (at & np.uint64(63))
        marked, mixed_up = np.zeros(1 << (BITS - 6), np.uint64), np.zeros(1 << (BITS - 6), np.uint64)
        np.bitwise_or.at(marked, word[several | again], bit[several | again])
        np.bitwise_or.at(mixed_up, word[several], bit[several])
        used = np.flatnonzero(marked)
        freed()
        return pa.table({"word": pa.array(used), "any": pa.array(marked[used].view(np.int64)), "several": pa.array(mixed_up[used].view(np.int64))})

    found = written(slim.mapInArrow(count, "bucket int, keys binary, contents binary").groupBy("bucket").applyInArrow(mark, "word long, any long, several long"), "marks")
    words = found.groupBy("word").agg(F.bit_or("any").alias("any"), F.bit_or("several").alias("several")).toArrow()  # at most 2**(BITS - 6) rows
    marked, mixed_up = np.zeros(1 << (BITS - 6), np.int64), np.zeros(1 << (BITS - 6), np.int64)
    index = words.column("word").to_numpy()
    marked[index], mixed_up[index] = words.column("any").to_numpy(), words.column("several").to_numpy()
    dropped(found)
    return marked, mixed_up


def _hot_bitmap(contents: DataFrame) -> np.ndarray:
    """Marks the representatives with more than HOT contents or CHUNK bytes of them; what shares a mark with one is resolved the same way."""
    bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(key, {64 - HOT_BITS}) & 63 as int))")
    many = contents.groupBy("key").agg(F.count("*").alias("n"), F.sum(F.octet_length("bytes")).alias("size")).where((F.col("n") > HOT) | (F.col("size") > CHUNK))
    words = many.groupBy(F.shiftrightunsigned("key", 64 - HOT_BITS + 6).alias("word")).agg(F.bit_or(bit).alias("bits")).collect()  # at most 2**(HOT_BITS - 6) rows
    made = np.zeros(1 << (HOT_BITS - 6), np.int64)
    for r in words:
        made[r["word"]] = r["bits"]
    return made


def _in_hot(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys.view(np.uint64) >> np.uint64(64 - HOT_BITS)
    return (bitmap.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _hit(bitmap: np.ndarray, keys: np.ndarray) -> np.ndarray:
    at = keys >> np.uint64(64 - BITS)
    return (bitmap.view(np.uint64)[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def _runs(doc: np.ndarray, start: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Window starts as (doc, from, to) of the bytes they cover, consecutive ones joined."""
    order = np.lexsort((start, doc))
    doc, start = doc[order], start[order]
    new = np.ones(len(doc), bool)
    new[1:] = (doc[1:] != doc[:-1]) | (start[1:] != start[:-1] + 1)
    first = np.flatnonzero(new)
    last = np.concatenate([first[1:], [len(doc)]]) - 1 if len(doc) else first
    return doc[first], start[first], start[last] + length


def _sorted_repeats(place: np.ndarray, start: np.ndarray, contents: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Step 3 for the contents of some representatives: the windows that occur earlier among them."""
    sizes = np.array([len(c) for c in contents])
    text = np.frombuffer(b"".join(contents), np.uint8)
    ends = np.cumsum(sizes)
    windows = sizes - length + 1
    row = np.repeat(np.arange(len(sizes)), windows)
    offset = np.arange(len(row)) - np.repeat(np.cumsum(windows) - windows, windows)
    order, group = repeated_windows(text, (ends - sizes)[row] + offset, length, ends)
    doc, at = place[row[order]], start[row[order]] + offset[order]
    by = np.lexsort((at, doc, group))
    repeat = np.zeros(len(by), bool)
    repeat[1:] = group[by][1:] == group[by][:-1]
    return _runs(doc[by][repeat], at[by][repeat], length)


def _batch(cols: tuple) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=["place", "start", "end"])


def _firsts(key: np.ndarray, content: np.ndarray, place: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of equal (key, content): the earliest by (place, start), and all others."""
    order = np.lexsort((start, place, content, key))
    a, b = key[order], content[order]
    new = np.ones(len(order), bool)
    new[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return order[new], order[~new]


def _joined_ranges(place: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranges of one place that touch become one; those that only overlap through a third do too."""
    if not len(place):
        return place, start, end
    order = np.lexsort((end, start, place))
    place, start, end = place[order], start[order], end[order]
    _, number = np.unique(place, return_inverse=True)
    span = int(end.max()) + 1
    reach = np.maximum.accumulate(end + number * span)  # ends of earlier places lie below
    new = np.ones(len(place), bool)
    new[1:] = start[1:] + number[1:] * span > reach[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(place)) - 1
    return place[first], start[first], reach[last] - number[last] * span


_KEPT = "bucket int, keys binary, contents binary, places binary, starts binary, sizes binary, key long, content long, place long, start long, bytes binary"
_KEPT_TYPES = (pa.int32(), *(pa.binary(),) * 5, *(pa.int64(),) * 4, pa.binary())
_KEPT_NAMES = [c.split()[0] for c in _KEPT.split(", ")]


def _kept(bucket: list, packed: list[tuple], rows: list) -> pa.RecordBatch:
    """Either packed stretches of a bucket, or stretches with their bytes; then content tells whether a stretch may repeat within."""
    n = len(bucket)
    columns = [bucket, *map(list, zip(*packed, strict=True)), *([None] * n if r is None else r for r in rows)]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _KEPT_TYPES, strict=True)], names=_KEPT_NAMES)


def _ranges_out(place: np.ndarray, start: np.ndarray, end: np.ndarray) -> Iterator[pa.RecordBatch]:
    """Ranges as rows of place, start and (in content) end."""
    place, start, end = _joined_ranges(place, start, end)
    for i in range(0, len(place), 8192):
        part = slice(i, i + 8192)
        n = len(place[part])
        yield _kept([None] * n, [(None,) * 5] * n, [None, end[part], place[part], start[part], None])


def repeats(placed: DataFrame, length: int = LENGTH) -> list[DataFrame]:
    """Written tables of place, start, end: byte ranges (they may overlap) that earlier text repeats; placed has place (unique, in order) and text."""
    spark = placed.sparkSession
    slim = placed.select("place", "text")
    buckets = _buckets(slim)
    maps = spark.sparkContext.broadcast(_bitmaps(slim, length, buckets))

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        marked, several = maps.value
        columns: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in (np.uint64, np.uint64, np.int64, np.int64, np.int64, bool)]
        held: list[bytes | None] = []
        size = 0
        for places, texts, offset in _parts(batches, length):
            s = Stretches(texts, length)
            at = np.flatnonzero(_hit(marked, s.key))
            doc = s.doc[at]
            for column, x in zip(columns, (s.key[at], s.content[at], places[doc], s.start[at] + offset[doc], s.end[at] + offset[doc], s.inner[at]), strict=True):
                column.append(x)
            mixed_up = _hit(several, s.key[at])
            long = (s.end - s.start)[at]
            held += [s.data[p : p + n].tobytes() if m else None for p, n, m in zip(s.place[at].tolist(), long.tolist(), mixed_up.tolist(), strict=True)]
            size += len(s.data) + int(long[mixed_up].sum())
            if size >= PART:
                yield from kept_of(columns, held)
                columns, held, size = [c[:1] for c in columns], [], 0
        yield from kept_of(columns, held)

    def kept_of(columns: list[list[np.ndarray]], held: list[bytes | None]) -> Iterator[pa.RecordBatch]:
        key, content, place, start, end, inner = (np.concatenate(c) for c in columns)
        first, later = _firsts(key, content, place, start)
        yield from _ranges_out(place[later], start[later], end[later])
        for row in _dealt(buckets, key[first], content[first], place[first], start[first].astype(np.uint32), (end - start)[first].astype(np.uint32)):
            yield _kept([row[0]], [row[1:]], [None] * 5)
        own = [i for i in first.tolist() if held[i] is not None]
        for i in range(0, len(own), 1024):
            part = np.array(own[i : i + 1024], np.int64)
            n = len(part)
            yield _kept([None] * n, [(None,) * 5] * n, [key[part].view(np.int64), inner[part].astype(np.int64), place[part], start[part], [held[k] for k in part.tolist()]])

    kept = written(slim.mapInArrow(keep, _KEPT), "stretches")
    local = kept.where("bucket IS NULL AND bytes IS NULL").select("place", "start", F.col("content").alias("end"))

    def later(rows: pa.Table) -> pa.Table:
        key, content = _unpacked(rows, "keys", np.uint64), _unpacked(rows, "contents", np.uint64)
        place = _unpacked(rows, "places", np.int64)
        start, size = (_unpacked(rows, c, np.uint32).astype(np.int64) for c in ("starts", "sizes"))
        end = start + size
        _, again = _firsts(key, content, place, start)
        freed()
        return pa.Table.from_batches([_batch(_joined_ranges(place[again], start[again], end[again]))])

    packed = kept.where("bucket IS NOT NULL").select("bucket", "keys", "contents", "places", "starts", "sizes")
    whole = written(packed.groupBy("bucket").applyInArrow(later, "place long, start long, end long").unionByName(local), "whole")
    contents = kept.where("bytes IS NOT NULL").select("key", "place", "start", "bytes", F.col("content").alias("inner"))
    hot = spark.sparkContext.broadcast(_hot_bitmap(contents))

    def part_of(wanted: bool):
        def take(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in batches:
                yield b.filter(pa.array(_in_hot(hot.value, b.column(0).to_numpy()) == wanted))

        return contents.mapInArrow(take, contents.schema)

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0
        for b in slices_of(batches, 1024):
            for row in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if size > CHUNK and row[0] != held[-1][0]:
                    yield solved(held)
                    held, size = [], 0
                held.append(row)
                size += len(row[3])
        if held:
            yield solved(held)

    def solved(rows: list[tuple]) -> pa.RecordBatch:
        # the only content of a representative, let through by the bitmap, repeats nothing unless it may within itself
        times = Counter(r[0] for r in rows)
        rows = [r for r in rows if times[r[0]] > 1 or r[4]]
        if not rows:
            return _batch(((), (), ()))
        _, place, start, contents, _ = zip(*rows, strict=True)
        return _batch(_sorted_repeats(np.array(place), np.array(start), list(contents), length))

    ranges = "place long, start long, end long"
    by_key = part_of(False).repartition(shuffle_partitions(spark), "key").sortWithinPartitions("key")
    found = [whole, written(by_key.mapInArrow(sort, ranges), "suffixes")]

    def sized(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Slices of at most 512 contents and about READ bytes."""
        for b in slices_of(batches, 512):
            part = np.cumsum([len(x) for x in b.column(2).to_pylist()]) // READ
            for k in np.unique(part):
                rows = np.flatnonzero(part == k)
                yield b.slice(int(rows[0]), len(rows))

    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sized(batches):
            texts = b.column(2).to_pylist()
            data = np.frombuffer(b"".join(texts), np.uint8)
            sizes = np.array([len(t) for t in texts])
            n = sizes - length + 1
            row = np.repeat(np.arange(len(sizes)), n)
            offset = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
            at = (np.cumsum(sizes) - sizes)[row] + offset
            other = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_SECOND[data] * powers.to(len(data) + 1).up[: len(data)], dtype=np.uint64)])
            names = (spans(masses(data), at, at + length), spans(other, at, at + length))
            yield pa.RecordBatch.from_arrays([*(pa.array(x.view(np.int64)) for x in names), pa.array(b.column(0).to_numpy()[row]), pa.array(b.column(1).to_numpy()[row] + offset)], names=["a", "b", "place", "start"])

    if not hot.value.any():
        dropped(kept)
        return found
    exploded = written(part_of(True).select("place", "start", "bytes").mapInArrow(windows, "a long, b long, place long, start long"), "windows")
    # written, so that the join reads two exchanges and Spark can split a frequent window's rows
    earliest = written(exploded.groupBy("a", "b").agg(F.min(F.struct("place", "start")).alias("first"), F.count("*").alias("n")).where("n > 1"), "earliest")
    by_window = exploded.join(earliest, ["a", "b"]).where((F.col("place") != F.col("first.place")) | (F.col("start") != F.col("first.start"))).select("place", "start", (F.col("start") + length).alias("end"))
    found.append(written(by_window, "hot"))
    dropped(kept, exploded, earliest)
    return found


def _cut(text: bytes, ranges: list | None) -> tuple[bytes, int, int]:
    """What is left, how many bytes went, in how many spans."""
    parts, at, removed, spans_ = [], 0, 0, 0
    begun = -1
    for start, end in sorted((r["start"], r["end"]) for r in ranges or ()):
        if start > at or begun < 0:
            parts.append(text[at:start])
            spans_ += 1
            removed += end - start
            at = end
        elif end > at:
            removed += end - at
            at = end
        begun = at
    parts.append(text[at:])
    return b"".join(parts), removed, spans_


def _with_ranges(docs: DataFrame, length: int) -> DataFrame:
    placed = ordered(docs)
    found = repeats(placed, length)
    by_doc = written(reduce(DataFrame.unionByName, found).groupBy("place").agg(F.collect_list(F.struct("start", "end")).alias("ranges")), "ranges")
    dropped(*found)  # the texts are dealt out only when all else is gone
    return placed.join(by_doc, "place", "left")


def deduplicate(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 for every row.

    A byte goes if it lies in a string of `length` bytes that also starts earlier: in a
    smaller doc_id, or earlier in the same text.  Rows that share a doc_id (or have none)
    count as documents in the order of a hash of their text.  A null text counts as
    empty; other columns are ignored; an empty table stays empty.
    """

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 256):
            out = []
            for doc_id, text, ranges in zip(b.column(0).to_pylist(), _texts(b.column(1)), b.column(2).to_pylist(), strict=True):
                kept, removed, n = _cut(text, ranges)
                out.append((doc_id, len(text), removed, n, hashlib.sha256(kept).hexdigest()))
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), (pa.int64(),) * 4 + (pa.string(),), strict=True)], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"])

    found = _with_ranges(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), length)
    return found.select("doc_id", "text", "ranges").mapInArrow(digest, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string")


def cleaned(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """docs with the repeated bytes gone from text; a character that is cut apart goes whole, a null text stays null."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 256):
            at, r = b.schema.get_field_index("text"), b.schema.get_field_index("ranges")
            texts = [None if t is None else _cut(t.encode("utf-8", "surrogatepass"), x)[0].decode("utf-8", "ignore") if x else t for t, x in zip(b.column(at).to_pylist(), b.column(r).to_pylist(), strict=True)]
            arrays = [pa.array(texts, pa.string()) if i == at else c for i, c in enumerate(b.columns) if i != r]
            yield pa.RecordBatch.from_arrays(arrays, names=[n for n in b.schema.names if n != "ranges"])

    found = _with_ranges(docs.drop("place", "ranges"), length)
    return found.select(*docs.drop("place", "ranges").columns, "ranges").mapInArrow(cut, docs.drop("place", "ranges").schema)
