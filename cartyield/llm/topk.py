"""Exact top-k inner products by pruning of document blocks.

Candidates are cut into ranges of ids, a range into small blocks. A block keeps the largest and
smallest value of each dimension, from which the sum over a query's dimensions bounds every score
in it. A query first looks into its block of the largest bound, then blocks are visited by falling bound and
scored through their own vectors for the queries whose kth best score is not above their bound.

Queries are broadcast in groups of a fixed size, one pass over the candidates per group, so what is broadcast does
not grow with the vectors. A task carries the k best of each query from range to range; the best of all tasks' are kept.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from ..plans.workspace import Workspace, workspace_for

#: Whole numbers up to here are exact as doubles, which multiply faster.
_EXACT = 1 << 53
#: And up to here as floats, which multiply faster still.
_EXACT_FLOAT = 1 << 24
#: Rows of a chunk of queries, which are compared with a range at once.
QUERIES = 2048
#: Numbers in the queries that are broadcast at once: 16 MB.
AT_ONCE = 1 << 21
#: Tasks of a pass, as each gives k rows per query.
TASKS = 128
#: Candidates whose blocks are scored in one matrix product.
_TILE = 1024
#: Stands for a score not there yet.
_NONE = np.iinfo(np.int64).min


def quantized(vectors: DataFrame, factor: int, id_col: str, vector_col: str) -> DataFrame:
    """(_row, _id, vector) of the rows that take part: known id, all components known and finite."""
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_vector"))
    usable = F.forall("_vector", lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) < float("inf")))
    scaled = F.transform("_vector", lambda x: F.floor(F.lit(factor) * x.cast("double")))
    return rows.filter(F.col("_id").isNotNull() & F.col("_vector").isNotNull() & usable).select(
        F.monotonically_increasing_id().alias("_row"), F.col("_id").cast("bigint").alias("_id"), scaled.alias("vector")
    )


def _chunks(rows: DataFrame, size: int, parts: int) -> DataFrame:
    """(part, chunk, width, rows, ids, vectors): up to ``size`` neighbours by id as arrays; short vectors end in zeros."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        for batch in batches:
            for at in range(0, len(batch), size):
                piece = batch.slice(at, size)
                lists = piece.column("vector")
                lengths = lists.value_lengths().to_numpy()
                width = int(lengths.max(initial=0))
                matrix = np.zeros((len(piece), width), np.int64)
                matrix[np.arange(width) < lengths[:, None]] = lists.flatten().to_numpy()
                columns = [pa.array([part]), pa.array([part << 32 | number]), pa.array([width], pa.int32())]
                columns += [pa.array([a.tobytes()], pa.binary()) for a in (piece.column("_row").to_numpy(), piece.column("_id").to_numpy(), matrix)]
                yield pa.RecordBatch.from_arrays(columns, names=["part", "chunk", "width", "rows", "ids", "vectors"])
                number += 1

    ordered = rows.repartitionByRange(parts, "_id", "_row").sortWithinPartitions("_id", "_row")
    return ordered.mapInArrow(cut, "part bigint, chunk bigint, width int, rows binary, ids binary, vectors binary")


def _exact(a: np.ndarray, b: np.ndarray) -> type:
    """The fastest type in which inner products of the rows of two whole-number matrices are exact."""
    most = int(np.abs(a).max(initial=0)) * int(np.abs(b).max(initial=0)) * a.shape[1]
    return np.float32 if most < _EXACT_FLOAT else np.float64 if most < _EXACT else np.int64


class Best:
    """The k best (score, id) of each query so far; as a sequence: (query, ids, scores)."""

    def __init__(self, queries: int, k: int):
        self.k, self.counts = k, np.zeros(queries, np.int64)
        self.scores, self.ids = np.full((queries, k), _NONE), np.full((queries, k), np.iinfo(np.int64).max)

    def __len__(self) -> int:
        return len(self.counts)

    def __getitem__(self, q: int) -> tuple[int, np.ndarray, np.ndarray]:
        if not 0 <= q < len(self):
            raise IndexError(q)
        return q, self.ids[q, : self.counts[q]], self.scores[q, : self.counts[q]]

    def add(self, found: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        """Take what belongs among the best of the query ``found`` of each row; equal scores go by the smaller id."""
        last, last_id = self.scores[found, -1], self.ids[found, -1]
        wins = (scores > last) | (scores == last) & (ids < last_id) | (self.counts[found] < self.k)
        found, ids, scores = found[wins], ids[wins], scores[wins]
        touched, new = np.unique(found, return_counts=True)
        of = np.concatenate([np.repeat(touched, self.k), found])
        ids, scores = np.concatenate([self.ids[touched].ravel(), ids]), np.concatenate([self.scores[touched].ravel(), scores])
        # The complement falls as the score rises and does not overflow.
        order = np.lexsort((ids, ~scores, of))
        kept = order[np.searchsorted(of[order], touched)[:, None] + np.arange(self.k)]
        self.ids[touched], self.scores[touched] = ids[kept], scores[kept]
        self.counts[touched] = np.minimum(self.counts[touched] + new, self.k)


def search_blocks(
    queries: np.ndarray, own: np.ndarray, vectors: np.ndarray, rows: np.ndarray, ids: np.ndarray, k: int, block: int, best: Best | None = None
) -> tuple[Best, int]:
    """The k best rows of ``vectors`` for each query, and how many blocks were scored, each counted once per query.

    ``own`` has the row that each query is itself, which does not count. ``best`` has what other ranges gave, and is added to.
    """
    best = Best(len(queries), k) if best is None else best
    if not (len(queries) and len(vectors) and k > 0):
        return best, 0
    width = max(queries.shape[1], vectors.shape[1])
    queries, vectors = (x if x.shape[1] == width else np.pad(x, ((0, 0), (0, width - x.shape[1]))) for x in (queries, vectors))
    kind = _exact(queries, vectors)
    starts = np.arange(0, len(vectors), block)
    queries, vectors = queries.astype(kind), vectors.astype(kind)
    high, low = np.maximum.reduceat(vectors, starts), np.minimum.reduceat(vectors, starts)
    bounds = np.maximum(queries, 0) @ high.T + np.minimum(queries, 0) @ low.T
    scored = 0

    def score(asking: np.ndarray, blocks: np.ndarray, seen: np.ndarray | None = None) -> None:
        """Score ``blocks`` for the queries ``asking``, without the block that each has ``seen``."""
        nonlocal scored
        scored += len(asking) * len(blocks)
        inside = (starts[blocks][:, None] + np.arange(block)).ravel()
        inside = inside[inside < len(vectors)]
        # An equal score may still win by its smaller id.
        some = queries if len(asking) == len(queries) else queries[asking]
        scores = some @ vectors[inside].T
        high_enough = np.flatnonzero(scores >= best.scores[asking, -1].astype(kind)[:, None])
        q, at = np.divmod(high_enough, len(inside))
        found, place = asking[q], inside[at]
        counts = rows[place] != own[found]
        if seen is not None:
            counts &= place // block != seen[found]
        if counts.any():
            best.add(found[counts], ids[place[counts]], scores[q, at][counts].astype(np.int64))

    first = bounds.argmax(axis=1)
    hopeful = np.flatnonzero(bounds.max(axis=1) >= best.scores[:, -1].astype(kind))
    hopeful = hopeful[np.argsort(first[hopeful], kind="stable")]
    for asking in np.split(hopeful, np.flatnonzero(np.diff(first[hopeful])) + 1) if len(hopeful) else ():
        score(asking, first[asking[:1]])
    order, at, step = np.argsort(-bounds.max(axis=0), kind="stable"), 0, 1
    while at < len(order):
        blocks = np.sort(order[at : at + step])
        left = (bounds[:, blocks] >= best.scores[:, -1].astype(kind)[:, None]) & (first[:, None] != blocks)
        if left.any():
            score(np.flatnonzero(left.any(axis=1)), blocks[left.any(axis=0)], first)
        at += step
        step = min(2 * step, max(1, _TILE // block))
    return best, scored


def _arrays(get: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Rows, ids and vectors of a chunk."""
    rows, ids, vectors = (np.frombuffer(get[n], np.int64) for n in ("rows", "ids", "vectors"))
    return rows, ids, vectors.reshape(len(rows), get["width"])


def _groups(queries: DataFrame, at_once: int) -> list[tuple[int, int]]:
    """First and last chunk of each group of neighbours that hold some ``at_once`` numbers, a chunk at least."""
    groups, held = [], 0
    for chunk, numbers in sorted(queries.select("chunk", F.length("vectors") / 8).collect()):
        if not groups or held + numbers > at_once:
            groups, held = [*groups, (chunk, chunk)], 0
        groups[-1], held = (groups[-1][0], chunk), held + numbers
    return groups


def _held(queries: DataFrame) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    found = queries.select("width", "rows", "ids", "vectors").toArrow()
    return [_arrays({n: found[n][i].as_py() for n in found.column_names}) for i in range(found.num_rows)]


def _searched(sent: Broadcast, k: int, block: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A task's k best (_query, query_id, _id, score) of all its ranges for each query that was broadcast."""

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked = [(*chunk, Best(len(chunk[0]), k)) for chunk in sent.value]
        for batch in batches:
            for row in range(len(batch)):
                rows, ids, inside = _arrays({n: batch.column(n)[row].as_py() for n in ("width", "rows", "ids", "vectors")})
                for own, _, asking, best in asked:
                    search_blocks(asking, own, inside, rows, ids, k, block, best)
        for own, query_ids, _, best in asked:
            there = np.arange(k) < best.counts[:, None]
            columns = [np.repeat(own, best.counts), np.repeat(query_ids, best.counts), best.ids[there], best.scores[there]]
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["_query", "query_id", "_id", "score"])

    return search


def top_k(
    vectors: DataFrame,
    k: int = 5,
    every: int = 50,
    factor: int = 256,
    block: int = 64,
    range_size: int = 8192,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    workspace: Workspace | None = None,
    at_once: int = AT_ONCE,
) -> DataFrame:
    """(query_id, rank, id, score): the k rows of highest inner product for each query.

    Queries are the rows whose id is divisible by ``every``, candidates all rows but the query's own.
    Components are turned into floor(factor * x). Equal scores are ranked by smaller id. Vectors that are
    null or hold null or non-finite components take no part, nor do rows without an id; a shorter vector counts as zero
    beyond its end. Repeated rows are rows of their own, as queries too. Other columns are not looked at.
    """
    workspace = workspace_for(vectors, workspace)
    rows = workspace.store(quantized(vectors, factor, id_col, vector_col), "vectors")
    asked = rows.filter(F.col("_id") % every == 0)
    parts = max(1, -(-rows.count() // range_size))
    candidates = workspace.store(_chunks(rows, range_size, parts), "ranges")
    queries = workspace.store(_chunks(asked, QUERIES, max(1, -(-asked.count() // QUERIES))), "queries")
    schema = "_query bigint, query_id bigint, _id bigint, score bigint"
    chosen = F.col("rank") <= k
    order = Window.partitionBy("_query").orderBy(F.desc("score"), F.col("_id"))
    path, context = workspace.path("best"), vectors.sparkSession.sparkContext
    groups = _groups(queries, at_once)
    for low, high in groups:
        # One task per pass and chunk would be as many as the square of the vectors; TASKS bounds the rows that are ranked.
        sent = context.broadcast(_held(queries.filter(F.col("chunk").between(low, high))))
        best = candidates.coalesce(TASKS).mapInArrow(_searched(sent, k, block), schema)
        best.withColumn("rank", F.row_number().over(order)).filter(chosen).write.mode("append").parquet(path)
        sent.destroy()
    columns = ["query_id", F.col("rank").cast("int").alias("rank"), F.col("_id").alias(id_col), "score"]
    ranked = StructType.fromDDL(f"{schema}, rank int")
    if not groups:
        return vectors.sparkSession.createDataFrame([], ranked).select(*columns)
    return vectors.sparkSession.read.schema(ranked).parquet(path).select(*columns)
