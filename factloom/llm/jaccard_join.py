"""N-gram Jaccard self-join by chosen paths.

Every text is the set of its word 5-grams; equal sets form one class at once.  In each
of RUNS independent runs the classes are split recursively on a sampled token of their
set (the smallest under a random order, so two sets choose the same token with
probability equal to their Jaccard similarity).  A bucket of at most SMALL classes is
compared by brute force; a larger one is split again, down to DEPTH tokens, and what is
still large then is compared in blocks.  A pair of similarity 0.8 is missed with
probability (1 - 0.8**DEPTH)**RUNS even if every bucket splits to the end; RUNS follows
from the share that may be missed.

A pair that several runs bring together is compared in the first of them only: every
class carries its paths, so any task can tell which run that is.  Blocks give back link
counts and a spanning forest, never the pairs, so a group of n near copies yields O(n)
rows.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import slices_of
from factloom.llm.hashing import ODD, mixed, shingles
from factloom.session import dropped, shuffle_partitions, written

WORDS, SIMILARITY, DEPTH = 5, 0.8, 4
#: Share of the pairs at the similarity that may be missed; runs are repeated until no more are expected.
MISSED = 4e-6
RUNS = math.ceil(math.log(MISSED) / math.log(1 - SIMILARITY**DEPTH))
SMALL, BLOCK = 160, 384
#: Depths at which buckets are looked at: a large bucket is split on all its other sampled tokens at once.
LEVELS = (1, DEPTH)
#: Classes whose signatures agree less are not compared; 0.8 - 0.58 is over five standard deviations.
ESTIMATE = 0.58
_SEEDS = mixed(np.arange(1, RUNS * DEPTH + 1, dtype=np.uint64) * ODD)


def _as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def signature(tokens: np.ndarray) -> np.ndarray:
    """The sampled token of each run and depth as 32 bits; place run + RUNS * depth."""
    if not len(tokens):
        return np.zeros(RUNS * DEPTH, np.uint32)
    least = np.full(RUNS * DEPTH, np.iinfo(np.uint64).max, np.uint64)
    for i in range(0, len(tokens), 4096):
        part = tokens[i : i + 4096, None]
        np.minimum(least, ((part ^ _SEEDS) * ODD ^ (part >> np.uint64(29))).min(axis=0), out=least)
    return (mixed(least) >> np.uint64(32)).astype(np.uint32)


def path_keys(signatures: np.ndarray, depth: int) -> np.ndarray:
    """Key of the bucket at `depth` in every run, from signatures of shape n x (RUNS * DEPTH)."""
    key = np.broadcast_to(np.arange(1, RUNS + 1, dtype=np.uint64) * ODD, (len(signatures), RUNS)).copy()
    for d in range(depth):
        key = mixed(key * np.uint64(3) + signatures[:, d * RUNS : (d + 1) * RUNS].astype(np.uint64))
    return key


def _signatures(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(len(column), RUNS * DEPTH)


def _first_common_run(sig: np.ndarray, depth: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The first run in which row i shares its last bucket with row j, for each pair; RUNS if none."""
    first = np.full(len(i), RUNS, np.int64)
    for run in range(RUNS - 1, -1, -1):
        deep = depth[i, run]
        same = (deep == depth[j, run]) & (deep > 0)
        for d in range(DEPTH):
            column = d * RUNS + run
            same &= (sig[i, column] == sig[j, column]) | (deep <= d)
        first[same] = run
    return first


def _pairs(tile: np.ndarray, block: np.ndarray, across: np.ndarray, sig: np.ndarray, depth: np.ndarray, run: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows i < j of one tile whose signatures agree enough and whose first common run is the tile's.

    tile is sorted; a tile across two blocks pairs only rows of different blocks.
    """
    n = len(tile)
    end = np.searchsorted(tile, tile, side="right")
    rest = end - np.arange(n) - 1
    total = np.concatenate([[0], np.cumsum(rest)])
    low = 0
    while low < n:
        high = max(low + 1, int(np.searchsorted(total, total[low] + 40_000, side="right")) - 1)
        i = np.repeat(np.arange(low, high), rest[low:high])
        j = i + 1 + np.arange(len(i)) - np.repeat(total[low:high] - total[low], rest[low:high])
        keep = ~across[i] | (block[i] != block[j])
        i, j = i[keep], j[keep]
        good = (sig[i] == sig[j]).sum(axis=1) >= ESTIMATE * RUNS * DEPTH
        i, j = i[good], j[good]
        good = _first_common_run(sig, depth, i, j) == run[i]
        yield i[good], j[good]
        low = high


def _similar(sets: list[np.ndarray], i: np.ndarray, j: np.ndarray, similarity: float) -> np.ndarray:
    """Exact: which pairs of sets reach the similarity."""
    common = np.array([np.isin(sets[a], sets[b], assume_unique=True).sum() for a, b in zip(i.tolist(), j.tolist(), strict=True)], np.int64)
    sizes = np.array([len(s) for s in sets])
    return common >= similarity * (sizes[i] + sizes[j] - common) - 1e-9


def _all_similar(sets: list[np.ndarray], similarity: float) -> np.ndarray:
    """Exact: the matrix of which sets reach the similarity, for tiles where most pairs are candidates."""
    sizes = np.array([len(s) for s in sets])
    _, name, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owner = np.repeat(np.arange(len(sizes)), sizes)
    shared = times[name] > 1
    owner = owner[shared]
    _, name = np.unique(name[shared], return_inverse=True)
    common = np.zeros((len(sets), len(sets)), np.float64)
    for low in range(0, int(name.max(initial=-1)) + 1, 8192):
        now = (name >= low) & (name < low + 8192)
        dense = np.zeros((len(sizes), 8192), np.float32)
        dense[owner[now], name[now] - low] = 1
        common += dense @ dense.T
    return common >= similarity * (sizes[:, None] + sizes[None, :] - common) - 1e-9


def _forest(a: np.ndarray, b: np.ndarray) -> list[tuple[int, int]]:
    """Edges (id, smaller id of its component) that connect what the links (a, b) connect."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, root(x)) for x in list(parent) if root(x) != x]


def _described(docs: DataFrame) -> DataFrame:
    """row, doc_id and of each text's set: size, a 128-bit name, signature."""

    def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 128):
            sets = shingles([t or "" for t in b.column(2).to_pylist()], WORDS)
            names = [np.array([mixed(s ^ seed).sum(dtype=np.uint64) for s in sets], np.uint64) for seed in _SEEDS[:2]]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([len(s) for s in sets], pa.int32()), *(pa.array(_as_long(n)) for n in names), pa.array([signature(s).tobytes() for s in sets], pa.binary())],
                names=["row", "doc_id", "size", "name_a", "name_b", "sig"],
            )

    return docs.select("row", "doc_id", "text").mapInArrow(describe, "row long, doc_id long, size int, name_a long, name_b long, sig binary")


def _leaves(classes: DataFrame) -> DataFrame:
    """row, run, depth, bucket, n for every class in a last bucket of at least two."""

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 512):
            keys = path_keys(_signatures(b.column(1)), 1)
            yield pa.RecordBatch.from_arrays([pa.array(np.repeat(b.column(0).to_numpy(), RUNS)), pa.array(np.tile(np.arange(RUNS, dtype=np.int32), b.num_rows)), pa.array(_as_long(keys.reshape(-1)))], names=["row", "run", "bucket"])

    def deeper(depth: int):
        def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for b in slices_of(batches, 512):
                run = b.column(1).to_numpy()
                keys = path_keys(_signatures(b.column(2)), depth)[np.arange(b.num_rows), run]
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(_as_long(keys))], names=["row", "run", "bucket"])

        return split

    slim = classes.where("size > 0").select("row", "sig")
    rows = slim.mapInArrow(first, "row long, run int, bucket long")
    done, steps = None, []
    for depth, deeper_still in zip(LEVELS, (*LEVELS[1:], None), strict=True):
        shared = rows.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
        counted = written(rows.join(shared, "bucket").select("row", "run", F.lit(depth).alias("depth"), "bucket", "n"), f"paths{depth}")
        steps.append(counted)
        leaf = counted if deeper_still is None else counted.where(F.col("n") <= SMALL)
        done = leaf if done is None else done.unionByName(leaf)
        if deeper_still is not None:
            rows = counted.where(F.col("n") > SMALL).select("row", "run").join(slim, "row").select("row", "run", "sig").mapInArrow(deeper(deeper_still), "row long, run int, bucket long")
    leaves = written(done, "leaves")
    dropped(*steps)
    return leaves


def _tiles(rows: DataFrame) -> DataFrame:
    """Rows of a bucket dealt into blocks of about BLOCK, and each pair of blocks a tile (block_a <= block_b)."""
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    block = F.pmod(F.xxhash64("row"), blocks).cast("int")
    dealt = rows.withColumn("block", block).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return dealt.withColumns({"block_a": F.least("block", "other"), "block_b": F.greatest("block", "other")}).drop("other", "n")


_TILE = ["run", "bucket", "block_a", "block_b"]


@dataclass
class _Rows:
    """Rows of whole tiles, sorted by tile; tiles are numbered."""

    batch: pa.RecordBatch
    tile: np.ndarray

    def column(self, name: str) -> pa.Array:
        return self.batch.column(self.batch.schema.get_field_index(name))

    def pairs(self) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        a, b, block, run = (self.column(c).to_numpy() for c in ("block_a", "block_b", "block", "run"))
        depth = np.frombuffer(b"".join(self.column("depths").to_pylist()), np.int8).reshape(-1, RUNS)
        return _pairs(self.tile, block, a != b, _signatures(self.column("sig")), depth, run)


def _tiles_of(batches: Iterator[pa.RecordBatch], rows: int = 4096) -> Iterator[_Rows]:
    """Whole tiles, at least `rows` rows together; a tile has at most two blocks."""

    def keys(t: pa.Table) -> np.ndarray:
        return np.stack([t.column(c).to_numpy().astype(np.int64) for c in _TILE], axis=1)

    held: list[pa.RecordBatch] = []
    for b in slices_of(batches, 1024):
        held.append(b)
        if sum(x.num_rows for x in held) >= rows:
            t = pa.Table.from_batches(held)
            k = keys(t)
            cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1))
            if len(cut):
                n = int(cut[-1]) + 1
                yield _whole(t.slice(0, n), k[:n])
                held = t.slice(n).combine_chunks().to_batches()
    if held:
        t = pa.Table.from_batches(held)
        yield _whole(t, keys(t))


def _whole(t: pa.Table, keys: np.ndarray) -> _Rows:
    new = np.concatenate([[0], (keys[1:] != keys[:-1]).any(axis=1).astype(np.int64)])
    return _Rows(pa.RecordBatch.from_arrays([c.combine_chunks() for c in t.columns], names=t.column_names), np.cumsum(new))


def _by_tile(rows: DataFrame) -> DataFrame:
    return rows.repartition(shuffle_partitions(rows.sparkSession), *_TILE).sortWithinPartitions(*_TILE, "block")


def _components(edges: DataFrame) -> DataFrame:
    """Written table of a, least: the smallest row that each row of edges (a, b) is connected with; hash-to-min with pointer jumping."""
    both = written(edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy("a").agg(F.least(F.col("a"), F.min("b")).alias("least")), "labels")
    while True:
        near = both.join(labels.select(F.col("a").alias("b"), "least"), "b").groupBy("a").agg(F.min("least").alias("near"))
        better = labels.join(near, "a").select("a", F.col("least").alias("old"), F.least("least", "near").alias("least"))
        jump = labels.select(F.col("a").alias("least"), F.col("least").alias("up"))
        new = written(better.join(jump, "least").select("a", "old", F.least("least", "up").alias("least")), "labels")
        dropped(labels)
        labels = new
        if not new.where("least <> old").limit(1).count():
            dropped(both)
            return labels


def one_of_each(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """The rows of docs that stay if every group of near duplicates keeps one: that of the smallest doc_id (a row without one comes last).

    Groups as in join(); texts without words are one group.
    """
    numbered, members = _members(docs, similarity)
    first = members.groupBy("class_id").agg(F.min(F.struct(F.coalesce("doc_id", F.lit((1 << 63) - 1)), "row")).alias("first"))
    return numbered.join(first.select(F.col("first.row").alias("_row")), "_row", "left_semi").drop("_row")


def _numbered(docs: DataFrame) -> DataFrame:
    """docs with a number _row for each row: doc_id if that is unique and never null, otherwise numbers that are written down with the rows."""
    key = F.col("doc_id").cast("long")
    odd = docs.groupBy(key.alias("k")).agg(F.count("*").alias("n")).where("n > 1 OR k IS NULL").limit(1).count()
    return written(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered") if odd else docs.withColumn("_row", key)


def _members(docs: DataFrame, similarity: float) -> tuple[DataFrame, DataFrame]:
    """docs with a number _row for each row; row, doc_id, class_id, n_links of each."""
    numbered = _numbered(docs)
    slim = numbered.select(F.col("_row").alias("row"), F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = written(_described(slim), "sets")
    classified, used = _classified(slim, described, similarity)
    members = written(classified, "members")
    dropped(described, *used)
    return numbered, members


def _classified(numbered: DataFrame, described: DataFrame, similarity: float) -> tuple[DataFrame, list[DataFrame]]:
    """row, doc_id, class_id, n_links (class_id is the row number of the group's first member), and the tables that this needs."""
    name = ["size", "name_a", "name_b"]
    classes = written(described.groupBy(*name).agg(F.min("row").alias("row"), F.count("*").alias("copies"), F.min("sig").alias("sig")), "classes")
    leaves = _leaves(classes)

    def depths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 512):
            out = np.zeros((b.num_rows, RUNS), np.int8)
            for i, pairs in enumerate(b.column(3).to_pylist()):
                for code in pairs:
                    out[i, code // 16] = code % 16
            yield pa.RecordBatch.from_arrays([*b.columns[:3], pa.array([r.tobytes() for r in out], pa.binary())], names=["row", "sig", "copies", "depths"])

    described_rows = leaves.groupBy("row").agg(F.collect_list(F.col("run") * 16 + F.col("depth")).alias("pairs")).join(classes.select("row", "sig", "copies"), "row").select("row", "sig", "copies", "pairs")
    paths = written(described_rows.mapInArrow(depths, "row long, sig binary, copies long, depths binary"), "depths")

    def active(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _tiles_of(batches):
            keep = np.zeros(len(r.tile), bool)
            for i, j in r.pairs():
                keep[i] = keep[j] = True
            yield r.batch.filter(pa.array(keep)).select([*_TILE, "block", "row"])

    tiled = _tiles(leaves.select("row", "run", "bucket", "n")).join(paths.select("row", "sig", "depths"), "row").select(*_TILE, "block", "row", "sig", "depths")
    alive = written(_by_tile(tiled).mapInArrow(active, "run int, bucket long, block_a int, block_b int, block int, row long"), "alive")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in slices_of(batches, 128):
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([s.tobytes() for s in shingles([t or "" for t in b.column(1).to_pylist()], WORDS)], pa.binary())], names=["row", "grams"])

    wanted = alive.select("row").distinct()
    grams = written(numbered.select("row", "text").join(wanted, "row").select("row", "text").mapInArrow(sets, "row long, grams binary"), "grams")

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for r in _tiles_of(batches, 1024):
            ids, copies = r.column("row").to_numpy(), r.column("copies").to_numpy()
            tokens = [np.frombuffer(g, np.uint64) for g in r.column("grams").to_pylist()]
            counts, a, b = np.zeros(len(ids), np.int64), [], []
            first = np.searchsorted(r.tile, np.arange(r.tile[-1] + 2)) if len(r.tile) else []
            for i, j in r.pairs():
                good = np.zeros(len(i), bool)
                for tile, start, n in zip(*np.unique(r.tile[i], return_index=True, return_counts=True), strict=True):
                    mine = np.arange(start, start + n)
                    low, high = int(first[tile]), int(first[tile + 1])
                    if n > 4 * (high - low):
                        good[mine] = _all_similar(tokens[low:high], similarity)[i[mine] - low, j[mine] - low]
                    else:
                        good[mine] = _similar(tokens, i[mine], j[mine], similarity)
                i, j = i[good], j[good]
                np.add.at(counts, i, copies[j])
                np.add.at(counts, j, copies[i])
                a.append(ids[i])
                b.append(ids[j])
            hit = np.flatnonzero(counts)
            forest = _forest(np.concatenate(a), np.concatenate(b)) if a else []
            yield pa.RecordBatch.from_arrays(
                [pa.array([*ids[hit].tolist(), *(x for x, _ in forest)], pa.int64()), pa.array([*counts[hit].tolist(), *[0] * len(forest)], pa.int64()), pa.array([*[None] * len(hit), *(x for _, x in forest)], pa.int64())],
                names=["row", "n", "other"],
            )

    full = alive.join(paths, "row").join(grams, "row").select(*_TILE, "block", "row", "sig", "copies", "depths", "grams")
    found = written(_by_tile(full).mapInArrow(linked, "row long, n long, other long"), "links")
    dropped(leaves, paths, alive, grams)
    counts = found.where("n > 0").groupBy("row").agg(F.sum("n").alias("n"))
    labels = _components(found.where("other IS NOT NULL").select(F.col("row").alias("a"), F.col("other").alias("b")))
    least = labels.select(F.col("a").alias("row"), "least")
    labelled = classes.select(*name, "row", "copies").join(least, "row", "left").join(counts, "row", "left")
    labelled = labelled.select(*name, F.coalesce("least", "row").alias("class_id"), (F.coalesce("n", F.lit(0)) + F.col("copies") - 1).alias("n_links"))
    return described.select("row", "doc_id", *name).join(labelled, name).select("row", "doc_id", "class_id", "n_links"), [classes, found, labels]


def join(docs: DataFrame, similarity: float = SIMILARITY) -> DataFrame:
    """doc_id, class_id and n_links for every row; class_id is the smallest doc_id of its group, null if none has one.

    Word 5-grams of the lower-cased text; a text of one to four words is one gram; all
    texts without words are equal.  n_links counts the other rows that are linked with
    this one, copies included.  Groups are the connected components of the links.  A null
    text counts as empty; repeated rows are copies of one another; other columns are
    ignored; an empty table stays empty.
    """
    _, members = _members(docs, similarity)
    names = members.groupBy("class_id").agg(F.min("doc_id").alias("least"))
    return members.join(names, "class_id").select("doc_id", F.col("least").alias("class_id"), "n_links")
