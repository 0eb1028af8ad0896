"""High-utility itemset mining, level by level, as Spark jobs.

Level k holds the itemsets of k items. An itemset is a ``prefix``, the itemset without its last
item in search order, and that ``last`` item's rank. Receipts are held as arrays, projected to what is left after an
itemset (see ``projection``). Per level:

1. projected receipts yield a row per later item;
2. the sums over all receipts tell which of the new itemsets are results and which can be extended.
   The rows go directly into the map-side aggregation, so they are neither shuffled nor written;
3. receipts are projected to the extendable itemsets. Every few levels those in which the same items are left become one
   row, and what results is stored.

The input is read once: lines and utility lists are stored clustered by receipt, so receipt totals, windows and arrays shuffle
nothing. What is shuffled per level are sums by itemset, and by itemset and remaining items. Receipts with very many
items are not held as arrays: their rows are joined, dealt out over several keys.
"""

from __future__ import annotations

from dataclasses import dataclass, replace
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.itemsets import itemset_name
from ..functions.units import TOTAL, from_units, threshold_units, total
from ..plans.workspace import Workspace, workspace_for
from . import projection
from .ordering import dense_index, segmented_max_before
from .twu import promising_items, receipt_totals, twu_sums, unit_lines
from .utility_list import gain, segmented_utility_list, upper_bound, utility_list

# Longer receipts are not held as arrays but joined, each dealt out over tasks by so many items.
SPLIT_ITEMS = 1024
# Receipts are projected from the last stored ones, so many levels further, before they are merged and stored again: a level
# by itself is less work than writing it.
STORE_EVERY = 4
# Sums of which no part can exceed BIGINT.
_SAFE = Decimal(1 << 60)


@dataclass(frozen=True)
class Mode:
    """How itemsets are scored and bounded.

    ``exact`` follows the definition: an itemset is worth the sum of all its items. ``endpoints``
    counts only the first and last item in search order and bounds by printed position, with the
    receipt totals as stated; itemsets of three or more items score lower and some are missed.
    """

    name: str
    exact: bool


EXACT = Mode("exact", True)
ENDPOINTS = Mode("endpoints", False)


@dataclass(frozen=True)
class Mining:
    """What a run found; the tables behind it are in the workspace."""

    itemsets: DataFrame
    nodes: DataFrame
    ranks: DataFrame
    twu: DataFrame
    receipts: DataFrame

    def stats(self) -> DataFrame:
        """One row of search counters.

        They are taken from the stored tables of items, receipts and itemsets; the input is not read again.
        A depth-first search visits every single item and, below each extendable itemset, one node
        per item ranked after its last one, so the visits can be counted without searching.
        """

        def one(df: DataFrame, value: Column) -> Column:
            return df.agg(F.coalesce(value, F.lit(0)).cast("bigint").alias("value")).scalar()

        count = F.count(F.lit(1))
        promising = one(self.ranks, count)
        place = dense_index(self.ranks.select("rank"), "place", [F.col("rank")], start=1)
        below = (
            self.nodes.filter("extendable")
            .groupBy(F.col("last").alias("rank"))
            .agg(count.alias("itemsets"))
            .join(place, "rank")
        )
        visited = F.sum(F.col("itemsets") * (promising - F.col("place")))
        return self.twu.sparkSession.range(1).select(
            one(self.twu, count).alias("twu_candidates"),
            promising.alias("promising_items"),
            one(self.ranks, F.sum("occurrences")).alias("estimated_utility_entries"),
            promising.alias("utility_lists_built"),
            (promising + one(below, visited)).alias("dfs_nodes_explored"),
            one(self.nodes.filter("found"), count).alias("huis_found"),
            one(self.receipts, F.sum("receipts")).alias("total_transactions"),
        )


def _utility_rows(lines: DataFrame, ranks: DataFrame, mode: Mode, ws: Workspace | None = None) -> DataFrame:
    """(tid, rank, u, ru, reach, receipt_items) in BIGINT units, of the promising items; with ``ws``, of long receipts."""
    order = "rank" if mode.exact else "position"
    if ws:
        entries = segmented_utility_list(lines, ranks, order, whole=True, workspace=ws)
    else:
        entries = utility_list(lines, ranks, order, whole=True)
    return entries.select("tid", "rank", F.col("iu").alias("u"), "ru", "reach", "receipt_items")


def _single_candidates(rows: DataFrame) -> DataFrame:
    """Candidate rows of level 1: the empty prefix, numbered 0, and one item."""
    return rows.select(
        "tid",
        F.lit(0).cast("bigint").alias("prefix"),
        F.col("rank").alias("last"),
        F.col("u").alias("iu"),
        F.col("u").alias("head"),
        "ru",
        "reach",
        "receipt_items",
        F.lit(1).cast("bigint").alias("n"),
        F.col("reach").alias("whole"),
    )


_FLAGS = {"found": "utility", "extendable": "bound", "joinable": "reach", "paired": "whole"}


def _flagged(sums: DataFrame, limit: int, beside: int = 0) -> DataFrame:
    """Itemsets with what they are good for at a threshold; a bound that is not there is good for nothing."""

    def enough(bound: str) -> Column:
        least = F.lit(Decimal(limit - beside if bound == "whole" else limit))
        return F.col(bound) >= least if bound in sums.columns else F.lit(False)

    return sums.withColumns({flag: enough(bound) for flag, bound in _FLAGS.items()})


def _node_sums(candidates: DataFrame, mode: Mode, safe: bool) -> DataFrame:
    """Candidate itemsets with their sums over all receipts.

    ``reach`` of a row is what the whole branch of the prefix could earn in that receipt. Its sum
    bounds every itemset of the branch that holds the last item, at whatever place. The sum of ``whole``, which only
    pairs have, and of what receipts contribute of which not all pairs are made (``beside``), bounds every itemset that holds
    the pair. ``safe`` says that BIGINT holds all sums.
    """

    def added(value: Column | str) -> Column:
        return F.sum(value).cast(TOTAL) if safe else total(value)

    bounds = {"bound": upper_bound(signed=not mode.exact)}
    if mode.exact:
        bounds["reach"] = "reach"
        if "whole" in candidates.columns:
            bounds["whole"] = "whole"
    return candidates.groupBy("prefix", "last").agg(
        added("iu").alias("utility"), *(added(v).alias(k) for k, v in bounds.items()), F.sum("n").alias("transactions")
    )


def _extendable_rows(candidates: DataFrame, nodes: DataFrame) -> DataFrame:
    """Candidate rows of extendable itemsets, with the number of the itemset as ``node``."""
    extendable = nodes.filter("extendable").select("prefix", "last", "node")
    return candidates.join(extendable, ["prefix", "last"])


def _extend(
    parents: DataFrame, rows: DataFrame, siblings: DataFrame | None, mode: Mode, pairs: DataFrame | None = None
) -> DataFrame:
    """Candidate rows one item larger of long receipts: each row of a parent with the receipt's later items.

    ``siblings`` are the joinable itemsets of the parents' level: a parent takes on only items
    that its own prefix can be usefully joined with, and whose pair with its last item is among ``pairs``. The items of a receipt are
    dealt out over several join keys and its parents to each of them, so that no task has to pair up a whole receipt.
    (Pairs of single items are first thinned out, see below.)
    """
    left = parents.select(
        "tid", "prefix", "node", "last", "iu", "head", F.col("ru").alias("ru_parent"), "receipt_items", "n"
    )
    right = rows.select("tid", "rank", "u", "ru", "receipt_items")
    parts = F.ceil(F.col("receipt_items") / SPLIT_ITEMS).cast("int")
    left = left.withColumn("part", F.explode(F.sequence(F.lit(1), parts)))
    right = right.withColumn("part", F.pmod(F.hash("rank"), parts) + 1)
    dealt = left.join(right.drop("receipt_items"), ["tid", "part"]).drop("part")
    larger = dealt.filter(F.col("rank") > F.col("last"))
    if siblings is not None:
        larger = larger.join(
            siblings.select("prefix", F.col("last").alias("rank")), ["prefix", "rank"], "left_semi"
        )
    if pairs is not None:
        pairs = pairs.select(F.col("before").alias("last"), F.col("last").alias("rank"))
        larger = larger.join(pairs, ["last", "rank"], "left_semi")
    return _as_candidates(larger, mode)


def _as_candidates(larger: DataFrame, mode: Mode) -> DataFrame:
    """Candidate rows of parents (node, last, iu, …) put together with a later item (rank, u, ru)."""
    return larger.select(
        "tid",
        F.col("node").alias("prefix"),
        F.col("rank").alias("last"),
        ((F.col("iu") if mode.exact else F.col("head")) + F.col("u")).alias("iu"),
        "head",
        "ru",
        gain(F.col("iu") + F.col("ru_parent")).alias("reach"),
        "receipt_items",
        "n",
        # Not all pairs of long receipts are made, so these are counted as a whole.
        F.lit(0).cast("bigint").alias("whole"),
    )


def _with_best(rows: DataFrame, ws: Workspace) -> DataFrame:
    """Rows of long receipts with ``best``: the most that a later item of the receipt, and what is printed after that, can add."""
    valued = rows.withColumn("_adds", F.col("u") + gain("ru"))
    return segmented_max_before(valued, "tid", "_adds", "best", [F.desc("rank")], ws).drop("_adds")


def _long_pairs(parents: DataFrame, rows: DataFrame, short: DataFrame, limit: int, mode: Mode, ws: Workspace) -> DataFrame:
    """Candidate rows of itemsets x and a later item y in long receipts, without pairing up every one of them.

    In the long receipts a pair {x, y} can earn at most what x and all after it earn there, or, where only the ends of an
    itemset count, what the first item of x and the best later item (``best`` of ``rows``) do with all that is printed after that. Where
    that stays below the threshold, the pair needs the other receipts, whose candidate rows are ``short``: it is made in the long ones
    only if the sum of both still reaches the threshold, and found there by its two items. A pair not made has neither the
    utility nor the bound that would keep it.
    """
    least = F.lit(Decimal(limit))
    if mode.exact:
        most, there = upper_bound(), total("reach")
    else:
        parents = parents.join(rows.select("tid", F.col("rank").alias("last"), "best"), ["tid", "last"])
        most = F.greatest(F.col("head") + F.col("best"), F.lit(0))
        there = F.greatest(total("iu"), total(upper_bound(signed=True)))
    alone = parents.groupBy("node").agg(total(most).alias("alone"))
    alone = ws.store(alone, "long-sums")
    wanting = alone.filter(F.col("alone") < least)
    # Only items that long receipts hold need their pairs counted beforehand.
    others = short.join(wanting.select(F.col("node").alias("prefix")), "prefix", "left_semi")
    elsewhere = others.groupBy("prefix", "last").agg(there.alias("elsewhere"))
    needed = elsewhere.join(wanting, F.col("prefix") == F.col("node")).filter(
        F.col("elsewhere") + F.col("alone") >= least
    )
    needed = ws.store(needed.select("node", F.col("last").alias("rank")), "long-pairs")

    enough = alone.filter(F.col("alone") >= least).select("node")
    every = _extend(parents.join(enough, "node", "left_semi"), rows, None, mode)
    some = (
        parents.withColumnRenamed("ru", "ru_parent")
        .join(needed, "node")
        .join(rows.select("tid", "rank", "u", "ru"), ["tid", "rank"])
    )
    return every.unionByName(_as_candidates(some, mode))


def _named(nodes: DataFrame, ranks: DataFrame, dtype: T.DataType) -> DataFrame:
    """Results with item names for ranks."""
    found = nodes.filter("found").select("ranks", "utility", "transactions")
    members = found.withColumn("rank", F.explode("ranks")).join(
        ranks.select("rank", "item"), "rank"
    )
    itemsets = members.groupBy("ranks", "utility", "transactions").agg(
        F.array_sort(F.collect_list("item")).alias("itemset")
    )
    return itemsets.select(
        "itemset",
        itemset_name("itemset").alias("itemset_name"),
        from_units(F.col("utility"), dtype).alias("utility"),
        F.size("itemset").alias("size"),
        "transactions",
    )


def _search_order(twu: DataFrame, limit: int, ws: Workspace) -> DataFrame:
    """Promising items with ``rank``: ascending TWU, ties by name. Ranks rise but have gaps."""
    promising = promising_items(twu, limit).orderBy("twu", "item")
    return ws.store(promising.withColumn("rank", F.monotonically_increasing_id()), "ranks")


class _Threshold:
    """The utility asked for; with ``top``, that of the best ``top`` itemsets found so far, which rises."""

    def __init__(self, units: int, top: int | None = None):
        self.units = units
        self.top = top

    def rise(self, utilities: DataFrame) -> None:
        """Raise the threshold to what is left of the best ``top`` of these utilities."""
        best = utilities.orderBy(F.desc("utility")).limit(self.top).agg(F.min("utility"), F.count(F.lit(1))).first()
        if best[1] == self.top:
            self.units = max(self.units, int(best[0]))


def _store_nodes(
    candidates: DataFrame, levels: list[DataFrame], mode: Mode, limit: _Threshold, safe: bool, ws: Workspace, beside: int = 0
) -> bool:
    """Append a level's itemsets that are of further use to ``levels``; tell whether any can be extended."""
    level = len(levels) + 1
    sums = _flagged(_node_sums(candidates, mode, safe), limit.units, beside)
    useful = sums.filter("found or extendable or joinable or paired")
    if levels:
        parents = levels[-1].select(
            F.col("node").alias("prefix"), F.col("ranks").alias("before")
        )
        useful = useful.join(parents, "prefix").withColumn(
            "ranks", F.concat("before", F.array("last"))
        ).drop("before")
    else:
        useful = useful.withColumn("ranks", F.array("last"))
    # Counted while they are written.
    seen = Observation()
    numbered = useful.withColumn("node", F.monotonically_increasing_id())
    numbered = numbered.observe(seen, F.count_if("extendable").alias("extendable"))
    columns = ["prefix", "last", "utility", "transactions", *_FLAGS, "ranks", "node"]
    if not limit.top:
        levels.append(ws.store(numbered.select(*columns), f"nodes-{level}"))
        return seen.get["extendable"] > 0
    nodes = ws.store(numbered, f"nodes-{level}")
    found = reduce(DataFrame.unionByName, [n.select("utility") for n in (*levels, nodes)])
    limit.rise(found.filter(F.col("utility") >= F.lit(Decimal(limit.units))))
    levels.append(_flagged(nodes, limit.units, beside).select(*columns))
    return bool(levels[-1].agg(F.count_if("extendable")).first()[0])


def mine(
    items: DataFrame,
    min_util,
    mode: Mode = EXACT,
    duplicates: str = "sum",
    workspace: Workspace | None = None,
) -> Mining:
    """Find every itemset whose utility, added up over the receipts holding it, is ``min_util``+.

    ``items`` has one row per receipt line: ``tid``, ``item``, ``utility``, in ``ENDPOINTS`` mode
    also ``pos`` and optionally ``total_utility``. It is read once.
    """
    limit = _Threshold(threshold_units(min_util, items.schema["utility"].dataType))
    return _mine(items, limit, mode, duplicates, workspace)


def mine_top(items: DataFrame, count: int, duplicates: str = "sum", workspace: Workspace | None = None) -> Mining:
    """Find the ``count`` itemsets of highest utility, if as many are positive; ties go by name.

    No threshold is needed: it starts as the utility of the best ``count`` single items and rises with every level to that of
    the best itemsets found so far, which nothing below it can be among. Exact mode.
    """
    if count < 1:
        raise ValueError(f"count must be positive, got {count}")
    mining = _mine(items, _Threshold(1, count), EXACT, duplicates, workspace)
    best = mining.itemsets.orderBy(F.desc("utility"), F.asc("itemset_name")).limit(count)
    return replace(mining, itemsets=best)


def _mine(items: DataFrame, limit: _Threshold, mode: Mode, duplicates: str, workspace: Workspace | None) -> Mining:
    ws = workspace_for(items, workspace)
    dtype = items.schema["utility"].dataType
    totals = "positive"
    if not mode.exact:
        totals = "stated" if "total_utility" in items.columns else "signed"

    lines = unit_lines(items, duplicates, with_pos=not mode.exact, stated=totals == "stated")
    lines = ws.store_clustered(lines, "lines", "tid")
    of_receipts = receipt_totals(lines, totals)
    twu = ws.store(twu_sums(lines, of_receipts), "twu")
    sizes = lines.groupBy("tid").agg(F.count(F.lit(1)).alias("items"))
    receipts = ws.store(sizes.agg(F.count(F.lit(1)).alias("receipts"), F.max("items").alias("longest")), "receipts")
    if limit.top:
        limit.rise(twu.select("utility"))
    ranks = _search_order(twu, limit.units, ws)
    short_lines, long_rows = lines, None
    if (receipts.first()["longest"] or 0) > SPLIT_ITEMS:
        long = ws.store(sizes.filter(F.col("items") > SPLIT_ITEMS).select("tid"), "long-receipts")
        short_lines = lines.join(long, "tid", "left_anti")
        long_rows = ws.store(_utility_rows(lines.join(long, "tid", "left_semi"), ranks, mode, ws), "long-utility-list")
    seen = Observation()
    rows = _utility_rows(short_lines, ranks, mode)
    rows = rows.observe(seen, total(F.abs("u")).alias("amount"))
    rows = ws.store_clustered(rows, "utility-list", "tid")
    ws.discard("lines")

    amount, every = seen.get["amount"] or 0, rows
    if long_rows is not None:
        every = rows.unionByName(long_rows)
        amount += long_rows.agg(total(F.abs("u"))).first()[0] or 0
    safe = amount < _SAFE

    levels: list[DataFrame] = []
    stored = "utility-list"
    if _store_nodes(_single_candidates(every).drop("whole"), levels, mode, limit, safe, ws):
        # Items that no other can be usefully joined with are no one's later items.
        # All others begin pairs, if only to bound sets in which the pair comes last.
        begins = levels[0].filter("joinable" if mode.exact else "extendable").select(F.col("last").alias("rank"), "node")
        # Several levels are projected from these arrays, which are made once.
        receipts_left = ws.store(projection.baskets(rows.join(begins, "rank", "inner" if mode.exact else "left")), "baskets")
        ws.discard(stored)
        stored = "baskets"
        _search(projection.single_items(receipts_left), long_rows, levels, mode, limit, safe, ws)

    # Results and counters are read from the tables of itemsets, items and receipts alone.
    for table in [stored] + (["long-utility-list"] if long_rows is not None else []):
        ws.discard(table)
    nodes = reduce(DataFrame.unionByName, levels)
    if limit.top:
        nodes = nodes.withColumn("found", F.col("utility") >= F.lit(Decimal(limit.units)))
    return Mining(_named(nodes, ranks, dtype), nodes, ranks, twu, receipts)


def _search(
    projected: DataFrame, long_rows: DataFrame | None, levels: list[DataFrame], mode: Mode, limit: _Threshold, safe: bool, ws: Workspace
) -> None:
    """Append the levels from pairs on, given the projected receipts of single items."""
    pairs, long_candidates, beside, kept = None, None, 0, {}

    def replaced(kind: str, df: DataFrame, clustered: bool = False) -> DataFrame:
        """``df`` stored in place of the last level's table of its kind."""
        name = f"{kind}-{len(levels)}"
        df = ws.store_clustered(df, name, "tid") if clustered else ws.store(df, name)
        if kind in kept:
            ws.discard(kept[kind])
        kept[kind] = name
        return df

    if long_rows is not None:
        long_candidates = _single_candidates(long_rows)
        partners = long_rows
        if mode.exact:
            joined = levels[0].filter("joinable").select(F.col("last").alias("rank"))
            partners = long_rows.join(joined, "rank", "left_semi")
            beside = int(long_rows.select("tid", "reach").distinct().agg(total("reach")).first()[0] or 0)
        else:
            partners = replaced("best", _with_best(long_rows, ws), clustered=True)
    while True:
        level, last = len(levels), levels[-1]
        joinable = last.filter("joinable") if mode.exact and level > 1 else None
        candidates = projection.candidates(projected, joinable, pairs)
        if long_rows is not None:
            parents = _extendable_rows(long_candidates, last)
            if level > 1:
                parents = replaced("rows", parents, clustered=True)
            if level == 1 or not mode.exact:
                long_candidates = _long_pairs(parents, partners, candidates, limit.units, mode, ws)
            else:
                long_candidates = _extend(parents, partners, joinable, mode, pairs)
            candidates = candidates.unionByName(long_candidates.select(*candidates.columns))
        if not _store_nodes(candidates, levels, mode, limit, safe, ws, beside):
            break
        nodes = levels[-1]
        if level == 1 and mode.exact and beside < limit.units:
            # Receipts holding both items of any other pair earn too little, whatever else they hold.
            pairs = nodes.filter("paired").select(F.element_at("ranks", 1).alias("before"), "last")
        projected = projection.extended(projected, nodes, mode.exact)
        if len(levels) % STORE_EVERY == 0:
            projected = replaced("projected", projection.merged(projected) if safe else projected)
    for table in kept.values():
        ws.discard(table)
