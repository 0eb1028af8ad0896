"""Best-fit-decreasing packing of all documents into sequences of a fixed length.

Best-fit decreasing looks at lengths only, and there are at most ``capacity`` of them. So the counts
of pieces by length, added up by Spark, are packed on the driver: bins with the same room left are
held as ranges of numbers, a segment tree over the room left finds the tightest open bins in
logarithmic time, and equal lengths are placed together. That is the packing of all pieces at once,
not of shards. The plan's size depends on the capacity, not on the documents: it makes at most three
new ranges per length, and a range takes at most ``sqrt(2 * capacity)`` different lengths. Each piece then
finds its place from its number among the pieces of its length.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.workspace import Workspace, workspace_for
from .tokenize import default_vocabulary, document_ids


class CapacityTree:
    """Segment tree over the room left in bins, 0 to ``capacity``: which of these rooms have open bins."""

    def __init__(self, capacity: int):
        self.leaves = 1 << (capacity + 1).bit_length()
        self.open = np.zeros(2 * self.leaves, bool)

    def set(self, room: int, is_open: bool) -> None:
        k = room + self.leaves
        self.open[k] = is_open
        while k > 1:
            k >>= 1
            self.open[k] = self.open[2 * k] | self.open[2 * k + 1]

    def tightest(self, length: int) -> int | None:
        """The least room of at least ``length`` with an open bin."""
        k = length + self.leaves
        while not self.open[k]:
            while k & 1:  # up to where a right neighbour is left to look at
                k >>= 1
                if k <= 1:
                    return None
            k += 1
            if k & (k - 1) == 0:  # past the last node of this row
                return None
        while k < self.leaves:
            k = 2 * k if self.open[2 * k] else 2 * k + 1
        return k - self.leaves


def best_fit_decreasing(counts: dict[int, int], capacity: int) -> np.ndarray:
    """The packing as rows (length, first piece, pieces per bin, first bin, offset), in order.

    Of the pieces of ``length``, numbered from 0, those from ``first piece`` on go, so many per bin,
    into the bins from ``first bin`` on, ``offset`` after a bin's start, up to the next row.
    """
    tree, ranges, plan, bins = CapacityTree(capacity), {}, [], 0

    def put(room: int, first: int, count: int) -> None:
        if count and room:
            if not ranges.setdefault(room, []):
                tree.set(room, True)
            ranges[room].append((first, count))

    for length in sorted(counts, reverse=True):
        done, total = 0, counts[length]
        while done < total:
            room = tree.tightest(length)
            if room is None:
                room = capacity
                first, count = bins, -(-(total - done) // (capacity // length))
                bins += count
            else:
                first, count = ranges[room].pop()
                if not ranges[room]:
                    tree.set(room, False)
            each = room // length
            whole = min(count, (total - done) // each)
            if whole:
                plan.append((length, done, each, first, capacity - room))
                done += whole * each
                put(room - each * length, first, whole)
            rest = min(total - done, each) if whole < count else 0
            if rest:
                plan.append((length, done, rest, first + whole, capacity - room))
                done += rest
                put(room - rest * length, first + whole, 1)
                whole += 1
            put(room, first + whole, count - whole)
    return np.array(plan, np.int64).reshape(-1, 5)


def pieces(docs: DataFrame, vocabulary: str, capacity: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, piece, start, length, ids_crc32, part, place) of every piece of every document.

    ``place`` numbers the pieces of one length that one task has met; ``part`` is the task.
    """
    schema = docs.select(F.col(id_col).alias("_id")).schema
    for name, kind in (("piece", "integer"), ("start", "long"), ("length", "long"), ("ids_crc32", "long"), ("part", "integer"), ("place", "long")):
        schema = schema.add(name, kind)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            rows: list[tuple] = []
            for k, text in enumerate(batch.column(1)):
                ids = document_ids(vocabulary, text.as_py())
                for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
                    own = ids[at : at + 4 * capacity]
                    length = len(own) // 4
                    rows.append((k, piece, at // 4, length, zlib.crc32(own), seen[length]))
                    seen[length] += 1
            if not rows:
                continue
            k, piece, start, length, crc, place = np.array(rows, np.int64).T
            columns = [batch.column(0).take(pa.array(k)), pa.array(piece.astype(np.int32)), pa.array(start), pa.array(length)]
            columns += [pa.array(crc), pa.array(np.full(len(k), part, np.int32)), pa.array(place)]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col)).mapInArrow(cut, schema)


def pack_documents(
    docs: DataFrame,
    vocabulary: str | None = None,
    capacity: int = 4096,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, piece, start, length, ids_crc32, sequence_id, offset), one row per piece.

    A document is the ids of its text and the end id; null and empty texts are the end id alone. Only
    documents longer than ``capacity`` are cut. Sequences are filled from offset 0 without gaps.
    Repeated rows, rows with the same id and null ids are packed as documents of their own. Other
    columns are not looked at; no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    cut = workspace.store(pieces(docs, vocabulary or default_vocabulary(), capacity, id_col, text_col), "pieces")
    met = cut.groupBy("part", "length").agg(F.count(F.lit(1)).alias("met"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = met.select("part", "length", "met", F.coalesce(F.sum("met").over(before), F.lit(0)).alias("base"))
    bases = workspace.store(bases, "piece-counts")
    # One count for each length: at most ``capacity`` rows.
    counts = {r[0]: r[1] for r in bases.groupBy("length").agg(F.sum("met")).collect()}
    plan = best_fit_decreasing(counts, capacity)
    plan = plan[np.lexsort((plan[:, 1], plan[:, 0]))]
    key = plan[:, 0] << 44 | plan[:, 1]

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(n).to_numpy() for n in ("length", "_number"))
            _, first_piece, each, first_bin, offset = plan[np.searchsorted(key, length << 44 | number, "right") - 1].T
            ahead = number - first_piece
            found = [pa.array(first_bin + ahead // each), pa.array(offset + ahead % each * length)]
            yield pa.RecordBatch.from_arrays(batch.columns[:-1] + found, names=names)

    # The counts by task and length grow with the documents, so they are not to be broadcast.
    numbered = cut.join(bases.drop("met").hint("merge"), ["part", "length"]).select(
        F.col("_id").alias(id_col), "piece", "start", "length", "ids_crc32", (F.col("base") + F.col("place")).alias("_number")
    )
    schema = numbered.drop("_number").schema.add("sequence_id", "long").add("offset", "long")
    names = schema.names
    return numbered.mapInArrow(place, schema)
