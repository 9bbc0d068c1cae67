"""Packing of token sequences by minimum bin slack over the histogram of lengths."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from inkwright.llm.store import small_batches, trimmed, written
from inkwright.llm.tokens import encoded

#: Pieces of one length that are numbered in a task.
GROUP = 200_000


def fullest(counts: list[int], room: int) -> list[tuple[int, int]]:
    """(length, copies) of the fullest combination within room; counts[length] are left. Prefers long pieces.

    Bit s of the integer after a length is set if lengths up to it sum to s.
    """
    steps, reach = [], 1
    mask = (1 << (room + 1)) - 1
    for length in range(1, room + 1):
        if n := counts[length]:
            steps.append((length, reach))
            for _ in range(min(n, room // length)):
                more = (reach | reach << length) & mask
                if more == reach:
                    break
                reach = more
    left, out = reach.bit_length() - 1, []
    for length, before in reversed(steps):
        most = min(counts[length], left // length)
        if copies := next((k for k in range(most, 0, -1) if before >> (left - k * length) & 1), 0):
            out.append((length, copies))
            left -= copies * length
        elif not before >> left & 1:  # cannot be: left was reached through this length
            raise AssertionError
    return out


def min_bin_slack(counts: list[int], size: int) -> list[tuple[list[tuple[int, int]], int]]:
    """Bins of at most size for counts[length] pieces: ([(length, copies)], number of such bins).

    Each bin starts with the longest piece left and takes the fullest combination of what remains;
    the same bin is repeated while its pieces last. Work depends on size, not on the number of pieces.
    """
    counts, plan = list(counts), []
    for longest in range(size, 0, -1):
        while counts[longest]:
            counts[longest] -= 1
            room = size - longest
            rest = [] if not room else [(room, 1)] if counts[room] else fullest(counts, room)
            counts[longest] += 1
            bin_ = {longest: 1}
            for length, copies in rest:
                bin_[length] = bin_.get(length, 0) + copies
            times = min(counts[length] // copies for length, copies in bin_.items())
            for length, copies in bin_.items():
                counts[length] -= copies * times
            plan.append((sorted(bin_.items(), reverse=True), times))
    return plan


def _cut(vocabulary: str, size: int, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, ids, bounds in encoded(batches, vocabulary, end_id):
            rows: list[tuple] = []
            for key, first, last in zip(keys.to_pylist(), bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
                n = last - first
                at, to, piece = 0, n % size or size, 0
                while at < n:
                    rows.append((key, piece, at, to - at, zlib.crc32(ids[first + at : first + to])))
                    at, to, piece = to, to + size, piece + 1
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int32() if i == 1 else pa.int64()) for i, c in enumerate(zip(*rows, strict=True))],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return run


def _placed(tables):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts, bases, copies, offsets, bounds = tables.value
        for batch in batches:
            length, rank = batch.column(3).to_numpy(), batch.column(5).to_numpy()
            row = np.empty(len(length), np.int64)
            for n in np.unique(length):
                own = length == n
                a, b = bounds[n], bounds[n + 1]
                row[own] = a + np.searchsorted(firsts[a:b], rank[own], "right") - 1
            at = rank - firsts[row]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:5], pa.array(bases[row] + at // copies[row]), pa.array(offsets[row] + at % copies[row] * length)],
                [*batch.schema.names[:5], "sequence_id", "offset"],
            )

    return run


def pack(docs: DataFrame, vocabulary: str, size: int = 2048, end_id: int = 0, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Packs all texts into sequences of at most size tokens: a row per piece with its sequence and offset.

    A document is the ids of its whole text, then end_id; null and empty texts are end_id alone. Only
    longer documents are cut, into pieces of size tokens, of which the first may be shorter. Equal
    rows are packed each; null ids like others; no rows give no rows. Returns doc_id, piece, start,
    length, ids_crc32, sequence_id (from 0, no gaps), offset.

    Only counts of lengths, size of them at most, come to the driver; the plan refers to pieces by
    their rank among those of their length, which tasks number apart and sum up.
    """
    spark = docs.sparkSession
    small_batches(spark)
    rows = docs.select(docs[doc_id].cast("long").alias("doc_id"), docs[text].cast("string"))
    pieces = written(rows.mapInArrow(trimmed(_cut(vocabulary, size, end_id)), "doc_id long, piece int, start long, length long, ids_crc32 long"), "pieces")
    counts = [0] * (size + 1)
    for r in pieces.groupBy("length").count().collect():
        counts[r["length"]] = r["count"]
    slots: dict[int, list[tuple[int, int, int, int]]] = {}
    used, base = [0] * (size + 1), 0
    for bin_, times in min_bin_slack(counts, size):
        offset = 0
        for length, copies in bin_:
            slots.setdefault(length, []).append((used[length], base, copies, offset))
            used[length] += copies * times
            offset += copies * length
        base += times
    flat = np.array([s for n in sorted(slots) for s in slots[n]], np.int64).reshape(-1, 4)
    bounds = np.concatenate([[0], np.cumsum([len(slots.get(n, ())) for n in range(size + 1)])])
    tables = spark.sparkContext.broadcast((*flat.T.copy(), bounds))
    groups = max(16, -(-max(counts) // GROUP))
    salted = pieces.withColumn("salt", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(groups)))
    salted = salted.withColumn("rn", F.row_number().over(Window.partitionBy("length", "salt").orderBy("doc_id", "piece")))
    before = salted.groupBy("length", "salt").agg(F.max("rn").cast("long").alias("n"))
    before = before.select("length", "salt", (F.sum("n").over(Window.partitionBy("length").orderBy("salt")) - F.col("n")).alias("before"))
    ranked = salted.join(before, ["length", "salt"]).select(*pieces.columns, (F.col("before") + F.col("rn") - 1).alias("rank"))
    return ranked.mapInArrow(trimmed(_placed(tables)), "doc_id long, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
