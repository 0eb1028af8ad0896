"""Near copies by the Jaccard similarity of word shingles: an exact set-similarity self-join.

The shingles of a text are put into one order for all texts, rare ones first, by exact counts. Two sets can only be as similar
as asked if they share a shingle among the first n - ceil(s n) + 1 of the larger set and the first n - ceil(2s/(1+s) n) + 1 of the
smaller one (the prefixes), and the places of that shingle in both leave room for enough others (the positional filter). A
shingle that stands in one set only joins nothing and is not shuffled again.

Equal sets are one set from the start. Pairs within a group that is connected already need no comparison: all sets with a
prefix member in common are first compared with one of them, which links most of a large group by as many comparisons as it has
rows; then pairs from different groups are, unless the parities of their buckets tell that they differ in too many members. Every
link is confirmed on the whole sets.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from ..plans.workspace import Workspace, workspace_for
from .components import components

SEED = 42
_BUCKETS = 256
_PARITIES = 512
_ODD = [f"odd_{k}" for k in range(_PARITIES // 64)]


def shingles(text: str | None, words_per_shingle: int = 5) -> np.ndarray:
    """64-bit hashes of the different word shingles of a text, sorted.

    Words are parted by ASCII white space, A-Z in lower-case. A text with fewer words than a shingle, or none, is one.
    """
    import xxhash

    words = (text or "").encode().lower().split()
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.append(0, ends[:-1] + 1)[: max(1, len(words) - words_per_shingle + 1)].tolist()
    stops = ends[-len(starts) :].tolist() if len(words) else [0]
    digest = xxhash.xxh64_intdigest
    return np.unique(np.array([digest(joined[i:j], SEED) for i, j in zip(starts, stops)], np.uint64))


def sketch(found: np.ndarray) -> np.ndarray:
    """How many members of a set fall into each of 256 buckets; two sets share no more than the smaller counts."""
    return np.bincount((found >> np.uint64(56)).astype(np.int64), minlength=_BUCKETS).astype(np.uint32)


def parities(found: np.ndarray) -> np.ndarray:
    """Whether the number of members is odd in each of 512 buckets, as 8 integers; bits that differ are no more than members that do."""
    odd = np.bincount((found >> np.uint64(55)).astype(np.int64), minlength=_PARITIES) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _sets(docs: DataFrame, words: int) -> DataFrame:
    """(_id, node, size, members, sketch, parities) of every row of ``docs`` (_id, _text)."""
    numbered = docs.select("_id", F.monotonically_increasing_id().alias("node"), F.lit(0).alias("size"), "_text")
    schema = numbered.drop("_text").schema.add("members", ArrayType(LongType())).add("sketch", "binary").add("parities", ArrayType(LongType()))

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # A few rows at a time, however many a batch has: a set is larger than its text.
            for start in range(0, len(batch), 64):
                part = batch.slice(start, 64)
                sets = [shingles(t.as_py(), words) for t in part.column(3)]
                arrays = [
                    part.column(0),
                    part.column(1),
                    pa.array([len(found) for found in sets], pa.int32()),
                    pa.array([found.view(np.int64) for found in sets], pa.list_(pa.int64())),
                    pa.array([sketch(found).tobytes() for found in sets], pa.binary()),
                    pa.array([parities(found) for found in sets], pa.list_(pa.int64())),
                ]
                yield pa.RecordBatch.from_arrays(arrays, names=schema.names)

    return numbered.mapInArrow(gather, schema)


def _prefixes(sets: DataFrame, similarity: Fraction, workspace: Workspace) -> DataFrame:
    """(node, size, key, place, short): the members of the prefixes that other sets have too.

    ``place`` counts from 0 in the common order; ``short`` marks the prefix that is enough for the smaller of two sets.
    """
    members = sets.select("node", "size", F.explode("members").alias("key"))
    counts = members.groupBy("key").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = members.join(workspace.store(counts, "shared-counts"), "key")
    ordered = shared.groupBy("node", "size").agg(F.sort_array(F.collect_list(F.struct("n", "key"))).alias("ordered"))
    # What no other set has comes first.
    alone = F.col("size") - F.size("ordered")
    placed = ordered.select("node", "size", alone.alias("alone"), F.posexplode("ordered").alias("at", "member"))
    s, t = similarity.numerator, similarity.denominator

    def length(numerator: int, denominator: int) -> Column:
        """size - ceil(size x numerator / denominator) + 1"""
        return F.col("size") - F.expr(f"(size * {numerator}L + {denominator - 1}L) div {denominator}L") + 1

    placed = placed.select("node", "size", F.col("member.key").alias("key"), (F.col("alone") + F.col("at")).cast("int").alias("place"))
    return placed.filter(F.col("place") < length(s, t)).withColumn("short", F.col("place") < length(2 * s, s + t))


def _with_sides(pairs: DataFrame, sides: DataFrame) -> DataFrame:
    """(u, v, a, b): pairs with the ``side`` of both, from (node, side)."""
    left = sides.select(F.col("node").alias("u"), F.col("side").alias("a"))
    right = sides.select(F.col("node").alias("v"), F.col("side").alias("b"))
    return pairs.join(left, "u").join(right, "v").select("u", "v", "a", "b")


def _confirmed(pairs: DataFrame, sets: DataFrame, similarity: Fraction, workspace: Workspace) -> DataFrame:
    """Those of ``pairs`` (u, v) whose whole sets are similar.

    Most of the others fall by their sketches, so that only the sets of likely pairs are moved. These are compared where they are
    joined, one pair at a time.
    """
    s, t = similarity.numerator, similarity.denominator

    def possible(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts = [[np.frombuffer(x.as_buffer(), np.uint32) for x in batch.column(k)] for k in (2, 3)]
            kept = []
            for a, b in zip(*counts):
                most = int(np.minimum(a, b).sum(dtype=np.int64))
                kept.append(t * most >= s * (int(a.sum(dtype=np.int64)) + int(b.sum(dtype=np.int64)) - most))
            yield batch.select([0, 1]).filter(pa.array(kept, pa.bool_()))

    sketched = _with_sides(pairs, sets.select("node", F.col("sketch").alias("side")))
    likely = workspace.store(sketched.mapInArrow(possible, "u bigint, v bigint"), "likely")
    whole = _with_sides(likely, sets.select("node", F.col("members").alias("side")))
    whole = whole.select("u", "v", (F.size("a") + F.size("b")).alias("sizes"), F.size(F.array_intersect("a", "b")).alias("both"))
    return workspace.store(whole.filter(F.col("both") * (s + t) >= F.col("sizes") * s).select("u", "v"), "links-found")


def _pivot(node: Column, key: Column) -> Column:
    """``node`` in one of eight orders of nodes, by key; applied again it gives the node back."""
    return node.bitwiseXOR(F.xxhash64(F.pmod(key, F.lit(8))))


def _possible(similarity: Fraction) -> Column:
    """Whether sets of ``size`` and ``size_v`` with a member in common at ``place`` and ``place_v`` can be similar at all."""
    s, t = F.lit(similarity.numerator), F.lit(similarity.denominator)
    rest = F.least(F.col("size") - F.col("place"), F.col("size_v") - F.col("place_v"))
    room = (F.least("place", "place_v") + rest) * (s + t) >= s * (F.col("size") + F.col("size_v"))
    return room & (F.least("size", "size_v") * t >= F.greatest("size", "size_v") * s)


def _close(similarity: Fraction) -> Column:
    """Whether sets with parities ``odd_…`` and ``odd_…_v`` may differ in as few members as similar sets of their sizes do."""
    s, t = F.lit(similarity.numerator), F.lit(similarity.denominator)
    differ = reduce(Column.__add__, [F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_v"))) for c in _ODD])
    return differ * (s + t) <= (F.col("size") + F.col("size_v")) * (t - s)


def near_copy_groups(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    words: int = 5,
    similarity: Fraction = Fraction(4, 5),
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, component_id), one row per row of ``docs``; rows with null or repeated ids are rows of their own.

    ``component_id`` is the smallest id that can be reached over links, itself included; null ids are passed over. All pairs of rows
    are linked whose sets of shingles of ``words`` words have a Jaccard similarity of ``similarity`` at least.
    Texts without words are like each other and nothing else; a text with fewer words than a shingle counts as one
    shingle. Shingles are known by 64-bit hashes. Other columns are not looked at; no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    every = workspace.store(_sets(texts, words), "sets")
    # Equal sets, told by 128 bits of hashes.
    digest = [F.xxhash64("members").alias("h1"), F.xxhash64(F.lit(1), "members").alias("h2")]
    first = every.groupBy("size", *digest).agg(F.min("node").alias("node"))
    firsts = workspace.store(first, "first-sets")
    sets = every.join(firsts.select("node"), "node", "left_semi")
    same = every.select("node", "size", *digest).join(firsts.withColumnRenamed("node", "first"), ["size", "h1", "h2"])
    equal = workspace.store(same.filter("node <> first").select(F.col("first").alias("u"), F.col("node").alias("v")), "equal")

    prefixes = workspace.store(_prefixes(sets, similarity, workspace), "prefixes")
    key, node = F.col("key"), F.col("node")
    first = F.min(F.struct(_pivot(node, key).alias("pivot"), "size", "place")).alias("first")
    pivots = prefixes.groupBy("key").agg(first, F.count(F.lit(1)).alias("n")).filter("n > 1")
    pivots = pivots.select("key", _pivot(F.col("first.pivot"), key).alias("pivot"), F.col("first.size").alias("size_v"), F.col("first.place").alias("place_v"))
    shared = workspace.store(prefixes.join(workspace.store(pivots, "pivots"), "key"), "shared")
    stars = shared.filter(F.col("node") != F.col("pivot")).filter(_possible(similarity)).select(F.least("node", "pivot").alias("u"), F.greatest("node", "pivot").alias("v"))
    stars = workspace.store(stars.distinct(), "stars")
    links = _confirmed(stars, sets, similarity, workspace)

    pairs = workspace.store(_open_pairs(shared, components(links, workspace), similarity, workspace, sets), "pairs")
    more = _confirmed(pairs.join(stars, ["u", "v"], "left_anti"), sets, similarity, workspace)

    roots = components(links.unionByName(more).unionByName(equal), workspace)
    rooted = every.select("_id", "node").join(roots, "node", "left")
    rooted = workspace.store(rooted.select("_id", F.coalesce("root", "node").alias("root")), "rooted")
    smallest = rooted.groupBy("root").agg(F.min("_id").alias("component_id"))
    return rooted.join(smallest, "root").select(F.col("_id").alias(id_col), "component_id")


def _open_pairs(
    shared: DataFrame, grown: DataFrame, similarity: Fraction, workspace: Workspace, sets: DataFrame | None = None
) -> DataFrame:
    """(u, v), u < v: the pairs of sets from different groups that can be similar by sizes, prefixes, places and parities.

    Only keys that sets of different groups have are joined. The parities, if ``sets`` are given, are looked at in that join, so that
    of a large group of copies too far from each other hardly a pair comes out of it.
    """
    grouped = shared.select("key", "node", "size", "place", "short").join(grown, "node", "left")
    grouped = workspace.store(grouped.withColumn("root", F.coalesce("root", "node")), "grouped")
    mixed = grouped.groupBy("key").agg(F.min("root").alias("low"), F.max("root").alias("high")).filter("low < high")
    large, sides, possible = grouped.join(mixed.select("key"), "key"), ["node", "size", "place", "root"], _possible(similarity)
    if sets is not None:
        odd = sets.select("node", *(F.get("parities", F.lit(k)).alias(c) for k, c in enumerate(_ODD)))
        large, sides, possible = large.join(odd, "node"), sides + _ODD, possible & _close(similarity)
    large = workspace.store(large, "open")
    small = large.filter("short").select("key", *(F.col(c).alias(f"{c}_v") for c in sides))
    smaller = (F.col("size_v") < F.col("size")) | ((F.col("size_v") == F.col("size")) & (F.col("node_v") < F.col("node")))
    other = F.col("root") != F.col("root_v")
    pairs = large.join(small, "key").filter(smaller & other & possible)
    return pairs.select(F.least("node", "node_v").alias("u"), F.greatest("node", "node_v").alias("v")).distinct()
