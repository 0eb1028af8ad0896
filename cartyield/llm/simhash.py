"""Near-duplicates by SimHash, with an exact comparison of fingerprints in tiles.

Fingerprints that differ in at most r bits agree in one of r + 1 pieces. With few bits a piece is long, so fingerprints are sorted once
with each piece in front and compared only where that piece is equal: of n random ones each meets n / 2^w others per piece
of w bits. A piece that very many have in common is several blocks, whose pairs go to several tasks.

With many bits hardly a pair would be left out that way, and all pairs are compared. Distinct fingerprints are dealt out to blocks by hash, and sorted there by their population counts. Pairs of blocks
are compared tile by tile with numpy's exclusive-or and bit counts. A tile pair is skipped when the
population counts of its fingerprints (whole, or of their 16-bit quarters) differ by more than the
radius, which bounds the distance from below, so no link is lost.

Either way the cost grows with the square of the number of distinct fingerprints, with pieces of 12 bits (radius 4) by some 800 times less.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace, workspace_for
from .components import components

SEED = 42
#: Fingerprints in a block, if there are as many: half as many squared take a core about a second.
LEAST_BLOCK = 1 << 14
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_QUARTERS = [np.uint64(0xFFFF << s) for s in (0, 16, 32, 48)]


def fingerprint(text: str | None, words_per_shingle: int = 4) -> int:
    """64-bit SimHash of the word shingles of a text, repeats included; 0 for a text without words."""
    import xxhash

    words = (text or "").encode().lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    count = max(1, len(words) - words_per_shingle + 1)
    starts = (ends - lengths)[:count].tolist()
    stops = ends[-count:].tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(joined[i:j], SEED) for i, j in zip(starts, stops)], np.uint64)
    octets = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.concatenate([np.bincount(octets[:, k], minlength=256) @ _BITS for k in range(8)])
    return int(np.packbits(2 * ones > count, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = 4) -> DataFrame:
    """(id, fp) of every row of ``docs``, fp as a signed bigint."""
    schema = docs.select(F.col(id_col).alias("_id")).withColumn("fp", F.lit(0).cast("bigint")).schema

    def prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few texts at a time as Python strings, however many a batch has.
            values = np.fromiter((fingerprint(t.as_py(), words) for t in batch.column(1)), np.uint64, len(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values.view(np.int64))], names=["_id", "fp"])

    return docs.select(F.col(id_col).alias("_id"), F.col(text_col)).mapInArrow(prints, schema)


def _boxes(values: np.ndarray, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest population counts (whole, four quarters) of each tile."""
    counts = [np.bitwise_count(values)] + [np.bitwise_count(values & m) for m in _QUARTERS]
    starts = np.arange(0, len(values), tile)
    counts = np.array(counts, np.int16)
    return np.minimum.reduceat(counts, starts, axis=1), np.maximum.reduceat(counts, starts, axis=1)


def _linked(left: np.ndarray, right: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Labels of the connected parts of one tile pair, and whether a fingerprint has a link at all."""
    near = np.bitwise_count(left[:, None] ^ right[None, :]) <= radius
    if not near.any():
        return np.empty(0), np.empty(0), near
    rows = np.flatnonzero(near.any(1))
    cols = np.flatnonzero(near.any(0))
    return rows, cols, near[np.ix_(rows, cols)]


def _keys(values: np.ndarray, tile: int, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Smallest and largest first ``width`` bits in each tile."""
    keys, starts = values >> np.uint64(64 - width), np.arange(0, len(values), tile)
    return np.minimum.reduceat(keys, starts), np.maximum.reduceat(keys, starts)


def tile_links(left: np.ndarray, right: np.ndarray, radius: int, tile: int, same: bool, width: int = 0) -> list[tuple[int, int]]:
    """Links that connect all fingerprints within the radius: a forest, not all pairs.

    Both arrays are sorted alike; ``same`` says they are one block, whose tile pairs are taken once. With ``width``, links may
    be left out between fingerprints whose first ``width`` bits differ.
    """
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        root = x
        while parent.setdefault(root, root) != root:
            root = parent[root]
        while parent[x] != root:
            parent[x], x = root, parent[x]
        return root

    (low_a, high_a), (low_b, high_b) = _boxes(left, tile), _boxes(right, tile)
    if width:
        (first_a, last_a), (first_b, last_b) = _keys(left, tile, width), _keys(right, tile, width)
    for i in range(low_a.shape[1]):
        gap = np.maximum(low_a[:, i, None] - high_b, low_b - high_a[:, i, None]).clip(0)
        possible = (gap[0] <= radius) & (gap[1:].sum(0) <= radius)
        if width:
            possible &= (first_a[i] <= last_b) & (first_b <= last_a[i])
        for j in np.flatnonzero(possible).tolist():
            if same and j < i:
                continue
            a, b = left[i * tile : (i + 1) * tile], right[j * tile : (j + 1) * tile]
            rows, cols, near = _linked(a, b, radius)
            if not len(rows) or (same and i == j and len(rows) == near.sum()):
                continue  # nothing but each fingerprint with itself
            labels_a, labels_b = np.arange(len(rows)), np.full(len(cols), len(rows))
            while True:  # smallest label of what is linked, until nothing changes
                labels_b = np.minimum(labels_b, np.where(near, labels_a[:, None], len(rows)).min(0))
                lower = np.minimum(labels_a, np.where(near, labels_b[None, :], len(rows)).min(1))
                if (lower == labels_a).all():
                    break
                labels_a = lower
            names = a[rows]
            for x, label in zip(names.tolist(), labels_a.tolist()):
                parent[find(x)] = find(int(names[label]))
            for x, label in zip(b[cols].tolist(), labels_b.tolist()):
                parent[find(x)] = find(int(names[label]))
    return [(x, root) for x in list(parent) if (root := find(x)) != x]


def _blocks(grouped: DataFrame, size: int) -> DataFrame:
    """(block, part, first, last, fps): fingerprints ``fp`` sorted by ``part`` first, ``size`` to a block at most, one part in each."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, number, of, held = TaskContext.get().partitionId(), 0, -1, np.empty(0, np.uint64)

        def block(values: np.ndarray) -> pa.RecordBatch:
            nonlocal number
            number += 1
            ends = values[[0, -1]].view(np.int64).tolist()
            arrays = [pa.array([x]) for x in (task << 32 | number, of, *ends, values.tobytes())]
            return pa.RecordBatch.from_arrays([arrays[0], arrays[1].cast(pa.int32()), *arrays[2:]], names=["block", "part", "first", "last", "fps"])

        for batch in batches:
            parts, values = batch.column(0).to_numpy(), batch.column(1).to_numpy().view(np.uint64)
            for part in np.unique(parts).tolist():
                if part != of and len(held):
                    yield block(held)
                    held = held[:0]
                of, held = part, np.concatenate([held, values[parts == part]])
                while len(held) >= size:
                    yield block(held[:size])
                    held = held[size:]
        if len(held):
            yield block(held)

    return grouped.select("part", "fp").mapInArrow(cut, "block bigint, part int, first bigint, last bigint, fps binary")


def _all_blocks(prints: DataFrame, total: int, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """Blocks of all fingerprints, dealt out by hash and sorted by population counts, and all their pairs (a, b)."""
    # As few blocks as keep the tasks busy, 64 at most while they fit: each is sent to as many pairs.
    size = min(max(-(-total // 64), LEAST_BLOCK), 1 << 20)
    count = max(1, -(-total // size))
    order = [F.bit_count("fp")] + [F.bit_count(F.col("fp").bitwiseAND(m)) for m in (0xFFFFFFFF, 0xFFFF, 0xFFFF << 32)]
    dealt = prints.select(F.pmod(F.xxhash64("fp"), F.lit(count)).cast("int").alias("part"), "fp")
    # A hash does not deal out evenly, so a block may be somewhat larger than planned.
    blocks = workspace.store(_blocks(dealt.repartition(count, "part").sortWithinPartitions("part", *order, "fp"), 2 * size), "blocks")
    left = blocks.select(F.col("block").alias("a"), F.explode(F.sequence("part", F.lit(count - 1))).alias("part"))
    pairs = left.join(blocks.select(F.col("block").alias("b"), "part"), "part")
    return blocks, pairs.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def _banded_blocks(prints: DataFrame, total: int, radius: int, width: int, workspace: Workspace) -> tuple[DataFrame, DataFrame]:
    """Blocks of fingerprints turned so that one of radius + 1 pieces is in front, sorted by it, and the pairs (a, b) that share one.

    ``part`` is the number of bits by which the fingerprints of a block are turned to the left.
    """
    turns = [F.struct(F.lit(t).alias("part"), _turned("fp", t).alias("fp")) for t in range(0, (radius + 1) * width, width)]
    turned = prints.select(F.explode(F.array(*turns)).alias("turned")).select("turned.part", "turned.fp")
    size = min(max(-(-total * len(turns) // 64), LEAST_BLOCK), 1 << 18)
    dealt = turned.repartitionByRange(max(1, -(-total * len(turns) // size)), "part", "fp").sortWithinPartitions("part", "fp")
    blocks = workspace.store(_blocks(dealt, size), "blocks")
    # Blocks are sorted, so what two of them share is the last piece of one and the first of the other.
    left = blocks.select(F.col("block").alias("a"), "part", F.shiftrightunsigned("last", 64 - width).alias("piece"))
    right = blocks.select(F.col("block").alias("b"), "part", F.shiftrightunsigned("first", 64 - width).alias("piece"))
    across = left.join(right, ["part", "piece"]).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    return blocks, across.unionByName(blocks.select(F.col("block").alias("a"), F.col("block").alias("b"))).distinct()


def _turned(column: str, bits: int) -> Column:
    """A bigint with its bits turned to the left."""
    return F.shiftleft(column, bits).bitwiseOR(F.shiftrightunsigned(column, 64 - bits)) if bits else F.col(column)


def fingerprint_links(prints: DataFrame, radius: int = 4, tile: int = 512, workspace: Workspace | None = None) -> DataFrame:
    """(u, v): links between distinct fingerprints ``fp`` that connect all those within ``radius`` bits."""
    workspace = workspace_for(prints, workspace)
    total, width = prints.count(), 64 // (radius + 1)
    if 8 * (radius + 1) > 1 << width:  # pieces would leave an eighth of all pairs or more
        width = 0
    blocks, pairs = _banded_blocks(prints, total, radius, width, workspace) if width else _all_blocks(prints, total, workspace)
    pairs = workspace.store(pairs, "block-pairs")
    tasks = max(1, min(pairs.count(), 4096))
    contents_a = blocks.select(F.col("block").alias("a"), F.col("part").alias("part_a"), F.col("fps").alias("fps_a"))
    contents_b = blocks.select(F.col("block").alias("b"), F.col("fps").alias("fps_b"))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b, part, fps_a, fps_b in zip(*(batch.column(n) for n in ("a", "b", "part_a", "fps_a", "fps_b"))):
                sides = [np.frombuffer(x.as_py(), np.uint64) for x in (fps_a, fps_b)]
                links = np.array(tile_links(*sides, radius, tile, a == b, width), np.uint64).reshape(-1, 2)
                if width:
                    back = part.as_py()
                    links = links >> np.uint64(back) | links << np.uint64(-back % 64)
                links = links.view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(links[:, 0]), pa.array(links[:, 1])], names=["u", "v"])

    joined = pairs.join(contents_a, "a").join(contents_b, "b").select("a", "b", "part_a", "fps_a", "fps_b")
    return joined.repartition(tasks, "a", "b").mapInArrow(compare, "u bigint, v bigint")


def simhash_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    radius: int = 4,
    words: int = 4,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, fingerprint, component_id), one row per row of ``docs``.

    ``fingerprint`` is 16 lowercase hex digits; ``component_id`` the smallest id that can be reached
    over links of at most ``radius`` differing bits, itself included. Null and empty texts have
    fingerprint zero and are linked like others; a text with fewer words than a shingle counts as
    one shingle. Null ids are passed over when the smallest is sought. Repeated rows each get a row;
    other columns are not looked at; no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    found = workspace.store(fingerprints(docs, id_col, text_col, words), "fingerprints")
    distinct = workspace.store(found.groupBy("fp").agg(F.min("_id").alias("first")), "distinct")
    links = workspace.store(fingerprint_links(distinct, radius, workspace=workspace), "raw-links")
    roots = components(links, workspace)
    for name in ("blocks", "block-pairs", "raw-links"):
        workspace.discard(name)
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    rooted = workspace.store(rooted.select("fp", "first", F.coalesce("root", "fp").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(smallest, "root").select("fp", "component_id")
    return found.join(classes, "fp").select(
        F.col("_id").alias(id_col),
        F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
        "component_id",
    )
