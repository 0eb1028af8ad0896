"""How large a search would be, from random walks down its tree.

The tree of a search is the empty itemset and, below each extendable itemset, the extendable itemsets of one item more. A walk
goes down from the root and takes one of the c children with equal chance each. What it meets counts as often as the product of
all the c so far, which makes the counts of a walk those of the whole tree on average (Knuth's estimator). All walks go down
together, one level per round: per receipt and walk one row is kept, so the work is that of as many itemsets as there are walks,
however large the tree.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.units import threshold_units
from ..plans.workspace import Workspace, workspace_for
from .mining import EXACT, _extend, _flagged, _node_sums, _search_order, _single_candidates, _utility_rows
from .ordering import dense_index
from .twu import receipt_totals, twu_sums, unit_lines

_COUNTED = ("extendable", "found", "rows")
_STEPS = 1 << 53


def _means(walked: DataFrame, walks: int) -> DataFrame:
    """Per level the mean over all walks and its standard error; walks that have ended count as nothing."""

    def mean(name: str) -> Column:
        return F.sum(F.col("weight") * F.col(name)) / walks

    def error(name: str) -> Column:
        seen = F.sum(F.pow(F.col("weight") * F.col(name), 2))
        return F.sqrt(F.greatest(seen - walks * mean(name) * mean(name), F.lit(0.0)) / (walks * max(walks - 1, 1)))

    columns = [c for name in _COUNTED for c in (mean(name).alias(name), error(name).alias(f"{name}_error"))]
    return walked.groupBy("size").agg(*columns)


def search_size(
    items: DataFrame, min_util, walks: int = 64, seed: int = 0, duplicates: str = "sum", workspace: Workspace | None = None
) -> DataFrame:
    """(size, extendable, found, rows and the standard error of each): what mining in exact mode would meet per size of itemsets.

    ``rows`` are the receipts of all candidates, before the bounds on siblings and pairs. Level 1 is known exactly. Estimates are
    unbiased, and repeat for the same items and ``seed``. The errors come from the walks themselves, so a rare large branch that none
    of them has met is not in them: more walks are the remedy. No items, or none that reach the threshold, give a row for size 1.
    """
    if walks < 2:
        raise ValueError(f"walks must be 2 at least, got {walks}")
    ws = workspace_for(items, workspace)
    limit = threshold_units(min_util, items.schema["utility"].dataType)
    lines = ws.store_clustered(unit_lines(items, duplicates), "lines", "tid")
    ranks = _search_order(ws.store(twu_sums(lines, receipt_totals(lines)), "twu"), limit, ws)
    rows = ws.store_clustered(_utility_rows(lines, ranks, EXACT), "utility-list", "tid")
    ws.discard("lines")

    walking = items.sparkSession.range(walks).select(F.col("id").alias("walk"), F.lit(0).cast("bigint").alias("prefix"), F.lit(1.0).alias("weight"))
    candidates, levels = _single_candidates(rows), []
    while True:
        size = len(levels) + 1
        sums = ws.store(_flagged(_node_sums(candidates, EXACT, safe=False), limit), "walk-sums")
        counts = sums.groupBy("prefix").agg(
            F.count_if("extendable").alias("extendable"), F.count_if("found").alias("found"), F.sum("transactions").alias("rows")
        )
        seen = walking.join(counts, "prefix", "left").fillna(0, list(_COUNTED)).withColumn("size", F.lit(size))
        levels.append(ws.store(seen, f"walked-{size}"))
        # The children of a prefix stand in line, and a walk takes one by its place.
        children = sums.filter("extendable").select("prefix", "last")
        placed = ws.store(dense_index(children, "place", [F.col("prefix"), F.col("last")], workspace=ws), "children")
        starts = placed.groupBy("prefix").agg(F.min("place").alias("start"))
        chance = F.pmod(F.xxhash64(F.lit(seed), F.lit(size), "walk"), F.lit(_STEPS)) / _STEPS
        place = F.col("start") + F.floor(chance * F.col("extendable"))
        chosen = levels[-1].join(starts, "prefix").select("walk", "weight", "extendable", place.alias("place"))
        chosen = ws.store(chosen.join(placed, "place"), "chosen")
        if chosen.isEmpty():
            break
        taken = chosen.select("prefix", "last", F.col("walk").alias("node"))
        parents = ws.store(candidates.join(taken, ["prefix", "last"]), f"walk-rows-{size}")
        candidates = _extend(parents, rows, None, EXACT)
        walking = chosen.select("walk", F.col("walk").alias("prefix"), (F.col("weight") * F.col("extendable")).alias("weight"))

    walked = levels[0]
    for level in levels[1:]:
        walked = walked.unionByName(level)
    return _means(walked, walks)
