"""Best-fit packing planned on the histogram of lengths.

Documents become token ids of a public tokenizer plus a closing id 0 and, if
longer than a sequence, pieces of full length with the shorter one first.  The
number of pieces of each length (at most ``capacity`` counts, summed in Spark)
is all that reaches the driver.  Best-fit-decreasing runs over these counts:
one step places all equal pieces into all equally full sequences at once, so
its cost depends on the capacity only.  Its plan is a table of runs ``(length,
rank from, rank to, pieces per sequence, first sequence, offset)``.

A piece takes its slot by its rank among the pieces of its length.  Ranks come
from counts per (length, salt) and a row number inside each such cell, so no
length, however frequent, is ranked in one task.

Defined results: a null or empty text is the single id 0; rows that repeat a
``doc_id`` are packed one by one; a null ``doc_id`` is packed and stays null;
no rows give no rows; further columns are ignored.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from dichot.llm.spark import ready, written
from dichot.llm.text import slices
from dichot.llm.tokens import token_ids

CAPACITY = 2048
SALTS = 256


def _pieces(path: str, ranks: str | None, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = token_ids(path, ranks)
        for batch in batches:
            for part in slices(batch, "text"):
                row, piece, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(tokens.ids(part.column("text"))):
                    ids = ids.tobytes() + b"\0\0\0\0"
                    total = len(ids) // 4
                    at, size, number = 0, (total - 1) % capacity + 1, 0
                    while at < total:
                        row.append(i)
                        piece.append(number)
                        start.append(at)
                        length.append(size)
                        crc.append(crc32(ids[4 * at:4 * (at + size)]))
                        at, size, number = at + size, capacity, number + 1
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                     *(pa.array(x, pa.int64()) for x in (start, length, crc))],
                    names=["doc_id", "piece", "start", "length", "ids_crc32"])
    return run


def plan(counts: dict[int, int], capacity: int = CAPACITY) -> list[tuple[int, int, int, int, int, int]]:
    """Best-fit-decreasing over a histogram of lengths.

    Returns runs ``(length, rank_from, rank_to, each, sequence, offset)``: the
    pieces of this length with ranks in ``[rank_from, rank_to)`` go, ``each`` to
    a sequence, into consecutive sequences from ``sequence`` on, from place
    ``offset`` on.  Sequences with equal room form runs of consecutive numbers,
    so the work grows with the capacity, not with the counts."""
    runs: list[tuple[int, int, int, int, int, int]] = []
    rooms: dict[int, list[tuple[int, int]]] = {}
    levels: list[int] = []
    used = 0

    def put(room: int, first: int, n: int) -> None:
        if not n or not room:
            return
        if room not in rooms:
            rooms[room] = []
            levels.insert(bisect_left(levels, room), room)
        rooms[room].append((first, n))

    for length in sorted(counts, reverse=True):
        left, rank = counts[length], 0
        while left:
            at = bisect_left(levels, length)
            if at == len(levels):
                each = capacity // length
                n = -(-left // each)
                put(capacity, used, n)
                used += n
                at = bisect_left(levels, length)
            room = levels[at]
            first, n = rooms[room].pop()
            if not rooms[room]:
                del rooms[room]
                levels.pop(at)
            each = min(room // length, left)
            full = min(n, left // each)
            runs.append((length, rank, rank + full * each, each, first, capacity - room))
            put(room, first + full, n - full)
            put(room - each * length, first, full)
            rank += full * each
            left -= full * each
    return runs


def _place(runs: list[tuple[int, int, int, int, int, int]]):
    table = np.array(runs, dtype=np.int64).reshape(-1, 6)
    table = table[np.lexsort((table[:, 1], table[:, 0]))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        edge = np.zeros(int(table[:, 0].max(initial=0)) + 2, dtype=np.int64)
        np.add.at(edge, table[:, 0] + 1, 1)
        edge = np.cumsum(edge)
        for batch in batches:
            length, rank = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "rank"))
            at = np.empty(len(length), dtype=np.int64)
            for value in np.unique(length):
                mine = length == value
                lo, hi = edge[value], edge[value + 1]
                at[mine] = lo + np.searchsorted(table[lo:hi, 1], rank[mine], side="right") - 1
            chosen = table[at]
            k = rank - chosen[:, 1]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in names), pa.array(chosen[:, 4] + k // chosen[:, 3]),
                 pa.array(chosen[:, 5] + k % chosen[:, 3] * length)], names=[*names, "sequence_id", "offset"])
    return run


def pack(docs: DataFrame, tokenizer: str, ranks: str | None = None, capacity: int = CAPACITY,
         salts: int = SALTS) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset`` for every
    piece of ``docs`` (``doc_id`` integer, ``text``); ``tokenizer`` is the path of a
    tokenizer file on every worker and ``ranks`` that of the same vocabulary in
    rank form, if there is one."""
    if capacity < 1:
        raise ValueError("capacity must be positive")
    ready(docs)
    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        _pieces(tokenizer, ranks, capacity), "doc_id long, piece int, start long, length long, ids_crc32 long")
    pieces = written(pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(salts))), "packing-pieces")
    cells = pieces.groupBy("length", "salt").agg(F.count("*").alias("n"))
    cells = cells.select("length", "salt", "n", (F.sum("n").over(
        Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    # at most capacity x salts rows
    cells = written(cells, "packing-cells")
    counts = {r["length"]: r["n"] for r in cells.groupBy("length").agg(F.sum("n").alias("n")).collect()}
    cell = Window.partitionBy("length", "salt").orderBy("doc_id", "piece", "ids_crc32")
    ranked = (pieces.withColumn("place", F.row_number().over(cell) - 1)
              .join(F.broadcast(cells.drop("n")), ["length", "salt"]).withColumn("rank", F.col("place") + F.col("before")))
    return ranked.select("doc_id", "piece", "start", "length", "ids_crc32", "rank").mapInArrow(
        _place(plan(counts, capacity)),
        "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
