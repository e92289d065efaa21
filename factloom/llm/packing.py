"""Best-fit packing of documents into token sequences.

Bulk-synchronous best-fit.  Pieces and gaps are kept sorted by length, and equal
lengths are run-length encoded, so the sorted gaps are at most `capacity` rows
whatever the corpus.  Each round takes the longest open piece length, sweeps to its
successor among the gaps (the shortest that holds it), gives as many pieces as there
are such gaps one place each, by rank within their length, and puts what is left of
those gaps back.  The pieces themselves are range-sorted by Spark; a piece finds its
place from its length and its rank, so no piece passes through the driver.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from factloom.llm.arrow import rows_of
from factloom.session import shuffle_partitions, written

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """Documents as token pieces of at most `capacity` ids, each document ended by id 0.

    Only documents of more than `capacity` ids are cut; their first piece takes the
    remainder.  A null text counts as empty (one piece, the id 0); a null doc_id is kept;
    repeated rows are packed as often as they occur; other columns are ignored.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from factloom.llm.tokens import encoder

        encode = encoder(tokenizer, special=True)
        for batch in batches:
            out: list[tuple] = []
            for doc_id, text in rows_of(batch):
                ids = encode(text or "") + b"\0\0\0\0"
                n = len(ids) // 4
                ends = list(range(n, 0, -capacity))[::-1]
                start = 0
                for k, end in enumerate(ends):
                    out.append((doc_id, k, start, end - start, zlib.crc32(ids[4 * start : 4 * end])))
                    start = end
            cols = list(zip(*out, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(cut, PIECES)


def plan(lengths: dict[int, int], capacity: int) -> dict[int, np.ndarray]:
    """Best-fit places of `lengths` (length -> count).

    For each length an array of rows (first rank, first sequence, offset), by rank:
    the pieces of ranks r, r + 1, ... go to sequences s, s + 1, ... at that offset.
    The work is bounded by the number of distinct lengths, not of pieces.
    """
    gaps: list[list[tuple[int, int]]] = [[] for _ in range(capacity + 1)]  # by gap: runs of (first sequence, how many)
    made, places = 0, {}
    for length in sorted(lengths, reverse=True):
        rank, left, rows = 0, lengths[length], []
        per = capacity // length
        while left:
            gap = next((g for g in range(length, capacity + 1) if gaps[g]), 0)
            if not gap:
                opened = -(-left // per)
                gaps[capacity].append((made, opened))
                made += opened
                continue
            first, n = gaps[gap].pop()
            k = min(n, left)
            rows.append((rank, first, capacity - gap))
            if k < n:
                gaps[gap].append((first + k, n - k))
            if gap > length:
                gaps[gap - length].append((first, k))
            rank, left = rank + k, left - k
        places[length] = np.array(rows, dtype=np.int64)
    return places


def pack(docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None) -> DataFrame:
    """Pieces with the sequence and the offset at which each stands.

    Returns doc_id, piece, start, length, ids_crc32, sequence_id, offset.  An empty
    table gives an empty result.  Ties (equal lengths) go by doc_id and piece.
    """
    spark = docs.sparkSession
    cut = written(pieces(docs, capacity, tokenizer), "pieces")
    lengths = {r["length"]: r["n"] for r in cut.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    places = plan(lengths, capacity)
    begins, at = {}, 0
    for length in sorted(lengths):
        begins[length], at = at, at + lengths[length]

    def numbered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(np.full(b.num_rows, part, np.int32)), pa.array(np.arange(n, n + b.num_rows))], names=[*b.schema.names, "part", "row"])
            n += b.num_rows

    keys = ["length", "doc_id", "piece"]
    ranged = written(cut.repartitionByRange(shuffle_partitions(spark), *keys).sortWithinPartitions(*keys).mapInArrow(numbered, PIECES + ", part int, row long"), "ranged")
    before, sizes = {}, sorted((r["part"], r["n"]) for r in ranged.groupBy("part").agg(F.count("*").alias("n")).collect())  # one row a partition
    at = 0
    for part, n in sizes:
        before[part], at = at, at + n

    def placed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, part, row = (b.column(b.schema.get_field_index(c)).to_numpy() for c in ("length", "part", "row"))
            order = np.fromiter((before[p] for p in part.tolist()), np.int64, b.num_rows) + row
            sequence, offset = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows, np.int64)
            for n in np.unique(length).tolist():
                mine, runs = np.flatnonzero(length == n), places[n]
                rank = order[mine] - begins[n]
                run = runs[np.searchsorted(runs[:, 0], rank, side="right") - 1]
                sequence[mine], offset[mine] = run[:, 1] + rank - run[:, 0], run[:, 2]
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence), pa.array(offset)], names=[*b.schema.names[:5], "sequence_id", "offset"])

    return ranged.mapInArrow(placed, PIECES + ", sequence_id long, offset long")
