"""Vector codes by product quantisation, trained by Lloyd rounds over resident members.

A vector is cut into parts, and each part is a row of its own. Rows are kept by owner: (position of the part,
entry of its codebook, salt). In a round the owners compare their members with the codebook of their position; a member that stays
with its entry stays where it is stored, and only those that change entry are shuffled, to their new owners. Then each owner adds up its
members, and the sums, one row per position and entry, make the next codebook. The salt deals an entry with very many members
out over several owners.

All arithmetic is in whole numbers, so the codes do not depend on how rows are dealt out.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace, workspace_for

SCALE = 4096
#: Larger components would not leave room for sums of squares in 64 bits.
LARGEST = 1 << 27
_MEMBER = "row bigint, position int, part binary, entry int, error bigint, moved boolean"


@dataclass(frozen=True)
class Codebooks:
    """``entries[p]`` is the codebook of part p, an array (entries, components); ``moves[r]`` the members shuffled in round r."""

    entries: list[np.ndarray]
    moves: list[int]

    def digest(self) -> str:
        """SHA-256 of all components as decimals, by part, entry and place, comma-joined."""
        numbers = ",".join(str(x) for book in self.entries for x in book.ravel().tolist())
        return hashlib.sha256(numbers.encode()).hexdigest()


def nearest(parts: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nearest entry of each part, ties to the lower index, and its squared distance."""
    chosen = np.zeros(len(parts), np.int64)
    least = np.full(len(parts), np.iinfo(np.int64).max)
    for k, entry in enumerate(entries):
        distance = ((parts - entry) ** 2).sum(1)
        nearer = distance < least
        chosen[nearer], least[nearer] = k, distance[nearer]
    return chosen, least


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(_id, _units array<bigint>) of the vectors that are not null and hold finite components only.

    A component x is floor(4096 x). One beyond 2^27 is an error.
    """
    x = F.col(vector_col)
    finite = F.forall(x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < F.lit(float("inf"))))
    units = F.transform(x, lambda e: F.floor(e.cast("double") * SCALE).cast("bigint"))
    fits = F.forall("_units", lambda u: F.abs(u) <= LARGEST)
    error = F.raise_error(F.lit("a component exceeds 2^27 units")).cast("array<bigint>")
    rows = vectors.filter(x.isNotNull() & finite).select(F.col(id_col).alias("_id"), *_labels(vectors), units.alias("_units"))
    return rows.withColumn("_units", F.when(fits, F.col("_units")).otherwise(error))


def _labels(vectors: DataFrame) -> list:
    return [F.col("_label")] if "_label" in vectors.columns else []


def _cut(length: int, parts: int) -> list[int]:
    """Where the parts of a vector begin and end; they are equal where the length allows it."""
    return [p * length // parts for p in range(parts + 1)]


def _first_codebooks(rows: DataFrame, parts: int, entries: int) -> list[np.ndarray]:
    """The parts of the vectors with the smallest ids, null ids last, equal ids by their components."""
    first = rows.orderBy(F.col("_id").asc_nulls_last(), "_units").limit(entries).collect()
    vectors = np.array([r["_units"] for r in first], np.int64)
    ends = _cut(vectors.shape[1], parts)
    return [np.ascontiguousarray(vectors[:, a:b]) for a, b in zip(ends, ends[1:])]


def _parts(rows: DataFrame, parts: int) -> DataFrame:
    """Members (row, position, part) of vectors (_row, _units)."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            flat = batch.column(1).flatten().to_numpy(zero_copy_only=False)
            vectors = flat.reshape(len(batch), -1)
            ends = _cut(vectors.shape[1], parts)
            for p, (a, b) in enumerate(zip(ends, ends[1:])):
                held = [v.tobytes() for v in vectors[:, a:b]]
                position = pa.array(np.full(len(batch), p, np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0), position, pa.array(held, pa.binary())], names=["row", "position", "part"])

    return rows.select("_row", "_units").mapInArrow(cut, "row bigint, position int, part binary")


def _by_position(batch: pa.RecordBatch, books: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(position, places in the batch, parts) of the members of a batch."""
    positions = batch.column("position").to_numpy()
    for p in np.unique(positions).tolist():
        places = np.flatnonzero(positions == p)
        held = batch.column("part").take(pa.array(places))
        parts = np.frombuffer(b"".join(held.to_pylist()), np.int64).reshape(len(places), books[p].shape[1])
        yield p, places, parts


def _assigned(members: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """Members with their nearest entry, its squared distance, and whether that is another entry than before."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            entry, error = np.zeros(len(batch), np.int32), np.zeros(len(batch), np.int64)
            for p, places, parts in _by_position(batch, books):
                entry[places], error[places] = nearest(parts, books[p])
            moved = entry != batch.column("entry").to_numpy()
            columns = [*(batch.column(c) for c in ("row", "position", "part")), pa.array(entry), pa.array(error), pa.array(moved)]
            yield pa.RecordBatch.from_arrays(columns, names=["row", "position", "part", "entry", "error", "moved"])

    return members.select("row", "position", "part", "entry").mapInArrow(assign, _MEMBER)


def _updated(residents: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """The codebooks after the owners have added up their members; an entry without members stays.

    Each task sends one row per position and entry, whatever the number of members.
    """

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = [np.zeros_like(book) for book in books]
        counts = [np.zeros(len(book), np.int64) for book in books]
        for batch in batches:
            entries = batch.column("entry").to_numpy()
            for p, places, parts in _by_position(batch, books):
                np.add.at(sums[p], entries[places], parts)
                counts[p] += np.bincount(entries[places], minlength=len(books[p]))
        found = [(p, e, int(n), sums[p][e].tolist()) for p in range(len(books)) for e, n in enumerate(counts[p].tolist()) if n]
        schema = pa.schema([("position", pa.int32()), ("entry", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.int64()))])
        yield pa.RecordBatch.from_pylist([dict(zip(schema.names, r)) for r in found], schema)

    partial = residents.select("position", "entry", "part").mapInArrow(add, "position int, entry int, n bigint, sums array<bigint>")
    places = partial.select("position", "entry", "n", F.posexplode("sums").alias("place", "value"))
    totals = places.groupBy("position", "entry", "place").agg(F.sum("value").alias("value"), F.sum("n").alias("n"))
    new = [book.copy() for book in books]
    # One row per component of the codebooks.
    for r in totals.collect():
        new[r["position"]][r["entry"], r["place"]] = r["value"] // r["n"]
    return new


def _settled(assigned: DataFrame, name: str, salts: int, workspace: Workspace) -> tuple[DataFrame, int]:
    """Residents after those that change entry have been shuffled to their new owners, and how many these are.

    The others are read from where they are stored.
    """
    stay, go = assigned.filter("not moved"), assigned.filter("moved")
    owner = [F.col("position"), F.col("entry"), F.pmod(F.xxhash64("row"), F.lit(salts))]
    came = workspace.store(go.repartition(salts, *owner), name)
    return stay.unionByName(came), came.count()


def train_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str | None = None,
    parts: int = 8,
    entries: int = 16,
    rounds: int = 6,
    workspace: Workspace | None = None,
) -> tuple[DataFrame, Codebooks]:
    """(id, [label,] entries, error), one row per usable vector, and the codebooks.

    ``entries`` is an array of the nearest entry of each part, ``error`` the sum of their squared distances. Vectors that are
    null or hold null or non-finite components are left out; so are those whose length differs from the vector's with
    the smallest id, and empty ones. Codebooks start as the parts of the vectors with the smallest ids; null ids come last, and
    where there are fewer vectors than ``entries``, the codebooks are as short. Repeated rows each get a row. A length that
    ``parts`` does not divide gives parts that differ by one. Other columns are not looked at; without vectors
    the codebooks are empty.
    """
    workspace = workspace_for(vectors, workspace)
    spark = vectors.sparkSession
    salts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    if label_col:
        vectors = vectors.select(F.col(id_col), F.col(vector_col), F.col(label_col).alias("_label"))
    rows = usable(vectors, id_col, vector_col).filter(F.size("_units") > 0)
    rows = workspace.store(rows.withColumn("_row", F.monotonically_increasing_id()), "vectors")
    lengths = rows.orderBy(F.col("_id").asc_nulls_last(), "_units").limit(1).select(F.size("_units")).first()
    keys = ["_id", "_row", *(["_label"] if label_col else [])]
    if lengths is None:
        none = rows.select(*keys, F.array().cast("array<int>").alias("entries"), F.lit(0).cast("bigint").alias("error"))
        return none, Codebooks([], [])
    rows = rows.filter(F.size("_units") == lengths[0])
    books, moves = _first_codebooks(rows, parts, entries), []
    # Before the first round no member has an owner, so all are sent to one.
    members = _parts(rows, parts).withColumn("entry", F.lit(-1))
    for number in range(rounds):
        assigned = workspace.store(_assigned(members, books), f"assigned-{number}")
        members, moved = _settled(assigned, f"moved-{number}", salts, workspace)
        moves.append(moved)
        books = _updated(members, books)
        if number:
            workspace.discard(f"assigned-{number - 1}")
            workspace.discard(f"moved-{number - 1}")
    last = _assigned(members, books)
    coded = last.groupBy("row").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("position", "entry"))), lambda m: m["entry"]).alias("entries"),
        F.sum("error").alias("error"),
    )
    return rows.select(*keys).join(coded, F.col("_row") == F.col("row")).drop("row"), Codebooks(books, moves)


def vector_codes(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    workspace: Workspace | None = None,
    **settings,
) -> DataFrame:
    """(id, code, error, label_error, codebooks_sha256), one row per vector that ``train_codes`` uses.

    ``code`` has two hex digits per part. ``label_error`` is the error summed over equal labels, null being one of them.
    """
    workspace = workspace_for(vectors, workspace)
    coded, books = train_codes(vectors, id_col, vector_col, label_col, workspace=workspace, **settings)
    coded = workspace.store(coded, "codes")
    sums = coded.groupBy("_label").agg(F.sum("error").alias("label_error"))
    digits = F.transform("entries", lambda e: F.lpad(F.lower(F.hex(e)), 2, "0"))
    return coded.join(sums.withColumnRenamed("_label", "_of"), F.col("_label").eqNullSafe(F.col("_of"))).select(
        F.col("_id").alias(id_col),
        F.array_join(digits, "").alias("code"),
        "error",
        "label_error",
        F.lit(books.digest()).alias("codebooks_sha256"),
    )
