"""Best-fit packing of tokenised documents into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so the whole problem is a histogram. The plan is
made on the histogram: pieces above one third of the capacity are matched greedily, largest with
the largest that still fits, at most two in a sequence; smaller pieces then go, largest first,
into the smallest gap that holds them. A plan entry places a run of equally long pieces, so the
plan's size follows the capacity, not the data. Each piece finds its place by its rank among the
pieces of its length: its number within its task plus the counts of the tasks before. No group of
pieces meets in one task, however many have the same length.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfwise.functions.storage import materialise
from shelfwise.llm.batches import sliced
from shelfwise.llm.bpe import coder

RANK_BITS = 44


class Run(NamedTuple):
    """Pieces ``first_rank`` and on of one length: ``each`` in a sequence, from ``offset`` on."""

    length: int
    first_rank: int
    each: int
    sequence: int
    offset: int


def plan_runs(counts: dict[int, int], capacity: int) -> tuple[list[Run], int]:
    """Placement of ``counts[length]`` pieces of each length, and the number of sequences."""
    left = {length: n for length, n in counts.items() if n}
    placed: dict[int, int] = defaultdict(int)
    gaps: dict[int, list[tuple[int, int]]] = defaultdict(list)  # gap: (first sequence, how many)
    runs: list[Run] = []
    opened = 0

    def put(length: int, n: int, each: int, sequence: int, gap: int) -> None:
        runs.append(Run(length, placed[length], each, sequence, capacity - gap))
        placed[length] += n
        left[length] -= n

    def leave(gap: int, sequence: int, n: int) -> None:
        if gap and n:
            gaps[gap].append((sequence, n))

    large = sorted((x for x in left if 3 * x > capacity), reverse=True)
    for length in large:
        while left[length]:
            fits = [x for x in large if x <= min(length, capacity - length)
                    and left[x] > (x == length)]
            n = left[length]
            if fits:
                n = left[length] // 2 if fits[0] == length else min(n, left[fits[0]])
            put(length, n, 1, opened, capacity)
            if fits:
                put(fits[0], n, 1, opened, capacity - length)
            leave(capacity - length - (fits[0] if fits else 0), opened, n)
            opened += n
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        while n := left[length]:
            gap = min((g for g, some in gaps.items() if g >= length and some), default=capacity)
            each = gap // length
            if gaps[gap]:
                sequence, there = gaps[gap].pop()
            else:
                sequence, there = opened, -(-n // each)
                opened += there
            full = min(n // each, there)
            rest = n - full * each if full < there else 0
            put(length, full * each + rest, each, sequence, gap)
            leave(gap - each * length, sequence, full)
            leave(gap - rest * length, sequence + full, int(rest > 0))
            leave(gap, sequence + full + (rest > 0), there - full - (rest > 0))
    return runs, opened


def cut_pieces(docs: DataFrame, path: str, capacity: int = 1024, end_id: int = 2) -> DataFrame:
    """Pieces of at most ``capacity`` tokens of each document, which ends with ``end_id``.

    ``doc_id, piece, start, length, ids_crc32`` and the piece's number among those of its length
    in its task. Only longer documents are cut; then the first piece has what the full ones leave.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, task = coder(path), TaskContext.get().partitionId()
        seen = np.zeros(capacity + 1, np.int64)
        end = int(end_id).to_bytes(4, "little")
        for batch in sliced(batches):
            row, piece, start, length, crc, rank = [], [], [], [], [], []
            for at, ids in enumerate(own.encode_blocks(batch.column(1).to_pylist())):
                ids += end
                total = len(ids) // 4
                a, b, k = 0, (total - 1) % capacity + 1, 0
                while a < total:
                    row.append(at)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(memoryview(ids)[4 * a:4 * b]))
                    rank.append(int(seen[b - a]))
                    seen[b - a] += 1
                    a, b, k = b, b + capacity, k + 1
            longs = [pa.array(x, pa.int64()) for x in (start, length, crc, rank)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(row, pa.int64())), pa.array(piece, pa.int32()),
                 *longs, pa.array([task] * len(row), pa.int32())],
                ["doc_id", "piece", "start", "length", "ids_crc32", "rank", "task"])

    schema = T.StructType(
        [T.StructField("doc_id", docs.schema["doc_id"].dataType),
         T.StructField("piece", T.IntegerType())]
        + [T.StructField(x, T.LongType()) for x in ("start", "length", "ids_crc32", "rank")]
        + [T.StructField("task", T.IntegerType())])
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, schema)


def pack_documents(docs: DataFrame, path: str, capacity: int = 1024,
                   end_id: int = 2) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32, sequence_id, offset``, one row per piece.

    Every row of ``docs`` is packed, those with a null or repeated ``doc_id`` too; a null or empty
    text is the end token alone. Other columns are not read. An empty table gives no rows.
    """
    pieces = materialise(cut_pieces(docs, path, capacity, end_id))
    counts = pieces.groupBy("length", "task").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("length").orderBy("task").rowsBetween(
        Window.unboundedPreceding, -1)
    bases = materialise(counts.withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0))))
    totals = bases.groupBy("length").agg(F.sum("n").alias("n")).collect()  # capacity rows at most
    runs, _ = plan_runs({row["length"]: row["n"] for row in totals}, capacity)
    runs.sort()
    keys = np.array([r.length << RANK_BITS | r.first_rank for r in runs], np.int64)
    first, each, sequence, offset = (np.array([r[i] for r in runs], np.int64) for i in (1, 2, 3, 4))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(x).to_numpy() for x in ("length", "rank"))
            at = np.searchsorted(keys, length << RANK_BITS | rank, side="right") - 1
            beyond = rank - first[at]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(x) for x in kept),
                 pa.array(sequence[at] + beyond // each[at]),
                 pa.array(offset[at] + beyond % each[at] * length)],
                [*kept, "sequence_id", "offset"])

    kept = ["doc_id", "piece", "start", "length", "ids_crc32"]
    schema = T.StructType([pieces.schema[x] for x in kept]
                          + [T.StructField(x, T.LongType()) for x in ("sequence_id", "offset")])
    ranked = pieces.join(bases.select("length", "task", "base"), ["length", "task"]).select(
        *kept, (F.col("rank") + F.col("base")).alias("rank"))
    return ranked.mapInArrow(place, schema)


def sequences(placed: DataFrame, coded: DataFrame, capacity: int = 1024,
              end_id: int = 2) -> DataFrame:
    """``sequence_id, ids, doc_ids, offsets``: the packed sequences themselves.

    ``placed`` as from ``pack_documents`` and ``coded`` as from ``bpe.encode_documents``, with
    unique ``doc_id``. A sequence gathers ``capacity`` pieces at most.
    """
    end = F.unhex(F.lit(int(end_id).to_bytes(4, "little").hex()))
    ids = F.concat(F.col("ids"), end)
    cut = placed.join(coded.select("doc_id", "ids"), "doc_id").select(
        "sequence_id", "offset", "doc_id",
        F.substring(ids, 4 * F.col("start") + 1, 4 * F.col("length")).alias("ids"))
    rows = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids")))
    return cut.groupBy("sequence_id").agg(rows.alias("rows")).select(
        "sequence_id",
        F.aggregate("rows", F.lit(b""), lambda a, r: F.concat(a, r["ids"])).alias("ids"),
        F.col("rows.doc_id").alias("doc_ids"), F.col("rows.offset").alias("offsets"))
