"""Mixing sources to target weights by balanced sampling with the cube method.

A source's target divided by its size is the number of copies each of its documents is due: a whole
part, and a fraction that is an inclusion probability. The flight phase moves the probabilities of a
block of documents through the null space of the constraints (words and documents selected), so both
totals stay where they are, until at most two per block are left undecided. The undecided of all blocks of a
source form new blocks, until a single block remains, whose last one or two are settled in the
landing phase.
"""

from __future__ import annotations

import zlib
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.ordering import dense_index
from ..plans.workspace import Workspace, workspace_for
from .common import word_count

_CLOSE = 1e-9


def flight(sizes: np.ndarray, chances: np.ndarray, random: np.random.Generator) -> np.ndarray:
    """Inclusion probabilities moved to 0 or 1, all but two at most, with sums kept.

    Kept are the sum of the probabilities and their sum weighted by size. Three undecided documents
    at a time always leave a direction to move in; a random sign keeps every expectation.
    """
    chances = chances.tolist()
    sizes = sizes.tolist()
    draws = iter(random.random(len(sizes) + 1).tolist())
    held: list[int] = []
    for k in range(len(sizes)):
        if chances[k] <= _CLOSE or chances[k] >= 1 - _CLOSE:
            chances[k] = round(chances[k])
            continue
        held.append(k)
        if len(held) < 3:
            continue
        x, y, z = (sizes[i] for i in held)
        move = (y - z, z - x, x - y) if x != y or y != z else (1, -1, 0)
        up = down = float("inf")
        for i, m in zip(held, move):
            if m:
                to_one, to_zero = (1 - chances[i]) / abs(m), chances[i] / abs(m)
                up = min(up, to_one if m > 0 else to_zero)
                down = min(down, to_zero if m > 0 else to_one)
        step = up if next(draws) * (up + down) < down else -down
        for i, m in zip(held, move):
            chances[i] += step * m
            if chances[i] <= _CLOSE or chances[i] >= 1 - _CLOSE:
                chances[i] = round(chances[i])
        held = [i for i in held if 0 < chances[i] < 1]
    return np.array(chances, float)


def landing(sizes: np.ndarray, chances: np.ndarray) -> np.ndarray:
    """Settle the last undecided documents, two at most, where the words come nearest their sum."""
    open_ = np.flatnonzero((chances > 0) & (chances < 1))
    choices = (np.arange(1 << len(open_))[:, None] >> np.arange(len(open_))) & 1
    due = chances[open_]
    words = np.abs((choices - due) @ sizes[open_])
    documents = np.abs((choices - due).sum(1))
    chances = chances.copy()
    chances[open_] = choices[np.lexsort((documents, words))[0]]
    return chances


def _fly(key: tuple, group: pa.Table) -> pa.Table:
    """One block: a row per document with its probability after the flight."""
    group = group.take(pc.sort_indices(group, sort_keys=[("size", "ascending"), ("_key", "ascending")]))
    sizes = group["size"].to_numpy().astype(float)
    # The order of the flight is random, but the same whenever this block is seen again.
    random = np.random.default_rng(zlib.crc32(repr([k.as_py() for k in key]).encode()))
    order = random.permutation(len(sizes))
    chances = np.empty(len(sizes))
    chances[order] = flight(sizes[order], group["chance"].to_numpy()[order], random)
    if group["blocks"][0].as_py() == 1:
        chances = landing(sizes, chances)
    return group.set_column(group.schema.get_field_index("chance"), "chance", pa.array(chances, pa.float64()))


def cube_sample(units: DataFrame, workspace: Workspace, block: int = 1024) -> DataFrame:
    """``units`` (_id, _key, stratum, size, chance) with ``picked`` 0 or 1 for each, balanced by stratum.

    Per stratum the picked units and their sizes add up to the sums of the chances, alone and
    weighted by size, but for what the landing of two units makes.
    """
    decided = None
    undecided, level = units, 0
    while True:
        counts = workspace.store(
            undecided.groupBy("stratum").agg(F.ceil(F.count(F.lit(1)) / block).alias("blocks")), f"blocks-{level}"
        )
        placed = undecided.join(counts, "stratum").withColumn(
            "block", F.pmod(F.xxhash64(F.lit(level), "_key", "size"), F.col("blocks"))
        )
        schema = placed.schema
        flown = placed.groupBy("stratum", "block", F.lit(level).alias("level")).applyInArrow(_fly, schema)
        flown = workspace.store(flown.drop("blocks", "block"), f"flown-{level}")
        settled = flown.filter("chance in (0, 1)").select(
            "_id", "stratum", "size", F.col("chance").cast("int").alias("picked")
        )
        decided = settled if decided is None else decided.unionByName(settled)
        if counts.filter("blocks > 1").isEmpty():
            return decided
        undecided, level = flown.filter("chance > 0 and chance < 1"), level + 1


def source_targets(
    sources: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``sources`` (source, source_size) with ``target``: ``share`` of all sizes, dealt by weight.

    In order of code point, null last, sources get the weights in turn. No target exceeds ``most``
    times its source's size; what lies above is dealt to the others by weight until none is above.
    """
    workspace = workspace_for(sources, workspace)
    order = [F.col("source").asc_nulls_last()]
    ranked = dense_index(sources, "_place", order, workspace=workspace)
    kinds = F.array(*[F.lit(float(w)) for w in weights])
    weighed = ranked.withColumn("weight", F.element_at(kinds, (F.col("_place") % len(weights) + 1).cast("int")))
    weighed = workspace.store(weighed.drop("_place"), "weights")
    limit = F.col("source_size") * most
    total = weighed.agg(F.sum("source_size")).first()[0] or 0
    # Targets are min(limit, rate * weight); the rate rises as sources reach their limit.
    rate = 0.0
    while True:
        full = F.col("weight") * rate >= limit
        left, weight = weighed.agg(
            F.sum(F.when(full, limit).otherwise(0.0)), F.sum(F.when(~full, F.col("weight")).otherwise(0.0))
        ).first()
        raised = (total * share - left) / weight if weight else rate
        if not weight or raised <= rate:
            break
        rate = raised
    return weighed.select("source", "source_size", F.least(limit, F.col("weight") * rate).alias("target"))


def mix_sources(
    docs: DataFrame,
    weights: Sequence[float] = (3, 1, 2),
    share: float = 1.5,
    most: float = 2.0,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    key_col: str | None = None,
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, size, source_size, target, copies, taken), one row per row of ``docs``.

    ``size`` is the number of words (null and empty texts: 0), ``copies`` how often the mix takes the
    document, at most ``most`` rounded up, and ``taken`` the words of these copies. A null source is a
    source of its own, last in order. The same rows give the same result whatever their order; chance goes by
    ``key_col``, the id unless given, and rows alike in key and size are told apart at random. Other columns are not looked at; no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    sized = workspace.store(
        docs.select(
            F.col(id_col).alias("_id"),
            F.col(key_col or id_col).alias("_key"),
            F.col(source_col).alias("source"),
            word_count(F.col(text_col)).alias("size")
        ),
        "sizes",
    )
    sources = workspace.store(sized.groupBy("source").agg(F.sum("size").alias("source_size")), "sources")
    targets = source_targets(sources, weights, share, most, workspace)
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    # Strata are numbered by whole numbers, null included.
    targets = targets.withColumn("rate", rate).withColumn("stratum", F.struct("source"))
    targets = workspace.store(targets, "targets")
    units = sized.withColumn("stratum", F.struct("source")).join(targets.drop("source"), "stratum")
    units = units.select("_id", "_key", "stratum", "size", (F.col("rate") - F.floor("rate")).alias("chance"))
    picked = cube_sample(units, workspace)
    copies = (F.floor("rate") + F.col("picked")).cast("bigint")
    return picked.join(targets.drop("source"), "stratum").select(
        F.col("_id").alias(id_col),
        "size",
        "source_size",
        "target",
        copies.alias("copies"),
        (copies * F.col("size")).alias("taken"),
    )
