"""Transaction-weighted utility, the promising items and their search order."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.units import from_units, receipt_sum, scale_of, threshold, to_units, total
from ..plans.workspace import Workspace, workspace_for
from ..sources.text import receipt_total
from .ordering import by_receipt, dense_index, running_sum


def merge_duplicates(items: DataFrame, keep: str = "sum") -> DataFrame:
    """One row per (tid, item): the summed, first or last utility, at the first position.

    Equal lines are added up before the shuffle, and the shuffle is on (tid, item), so a
    receipt holding a large share of all lines is spread out and shrinks to its distinct items.
    """
    utility = {
        "sum": F.sum("utility"),
        "first": F.min_by("utility", "pos"),
        "last": F.max_by("utility", "pos"),
    }[keep]
    columns = [utility.cast(items.schema["utility"].dataType).alias("utility")]
    if "pos" in items.columns:
        columns.append(F.min("pos").alias("pos"))
    if "total_utility" in items.columns:
        columns.append(F.max("total_utility").alias("total_utility"))
    return items.groupBy("tid", "item").agg(*columns)


def unit_lines(items: DataFrame, duplicates: str = "sum", with_pos: bool = False, stated: bool = False) -> DataFrame:
    """One row per (tid, item) with amounts in BIGINT units; lines without receipt or item are left out.

    ``pos`` is kept if asked for, and so is ``total_utility`` where receipts state their totals.
    """
    dtype = items.schema["utility"].dataType
    columns = ["tid", "item", to_units(F.col("utility"), dtype).alias("utility")]
    if with_pos or duplicates != "sum":
        columns.append("pos")
    if stated:
        stated_type = items.schema["total_utility"].dataType
        if scale_of(stated_type) != scale_of(dtype):
            raise ValueError("utility and total_utility must have the same scale")
        columns.append(to_units(F.col("total_utility"), stated_type).alias("total_utility"))
    return merge_duplicates(items.dropna(subset=["tid", "item"]).select(*columns), duplicates)


def receipt_totals(lines: DataFrame, totals: str = "positive") -> DataFrame:
    """(tid, total): what each receipt can contribute; ``lines`` are in units, one row per item.

    ``totals="positive"`` adds up the positive utilities, so that a bound does not shrink by what an
    itemset may leave out, ``"signed"`` all of them. ``"stated"`` takes ``total_utility`` and
    adds up the lines only where it is missing or zero.
    """
    utility = F.col("utility") if totals != "positive" else F.greatest("utility", F.lit(0))
    added = receipt_sum(utility)
    if totals == "stated":
        added = receipt_total(F.max("total_utility"), added)
    return lines.groupBy("tid").agg(added.alias("total"))


def twu_sums(lines: DataFrame, receipts: DataFrame) -> DataFrame:
    """(item, twu, utility, occurrences) of lines in units and their receipts' totals.

    A join with per-receipt sums streams a receipt through; a window would buffer all of it.
    """
    return lines.join(receipts, "tid").groupBy("item").agg(
        total("total").alias("twu"),
        total("utility").alias("utility"),
        F.count(F.lit(1)).alias("occurrences"),
    )


def twu_units(items: DataFrame, totals: str = "positive", duplicates: str = "sum") -> DataFrame:
    """(item, twu, utility, occurrences) of line items, sums in DECIMAL units."""
    lines = by_receipt(unit_lines(items, duplicates, stated=totals == "stated"))
    return twu_sums(lines, receipt_totals(lines, totals))


def twu(items: DataFrame, totals: str = "positive", duplicates: str = "sum") -> DataFrame:
    """(item, twu): the summed totals of the receipts holding each item."""
    dtype = items.schema["utility"].dataType
    units = twu_units(items, totals, duplicates)
    return units.select("item", from_units(F.col("twu"), dtype).alias("twu"))


def twu_contributions(items: DataFrame) -> DataFrame:
    """(tid, item, twu): what one receipt adds to the TWU of each of its items."""
    dtype = items.schema["utility"].dataType
    lines = by_receipt(unit_lines(items))
    contributed = lines.join(receipt_totals(lines), "tid")
    return contributed.select("tid", "item", from_units(F.col("total"), dtype).alias("twu"))


def merge_twu(*maps: DataFrame) -> DataFrame:
    """Add up (item, twu) tables of disjoint sets of receipts, such as a stored one and a new batch."""
    dtype = maps[0].schema["twu"].dataType
    union = maps[0].select("item", "twu")
    for other in maps[1:]:
        union = union.unionByName(other.select("item", "twu"))
    return union.groupBy("item").agg(F.sum("twu").cast(dtype).alias("twu"))


def promising_items(twu_map: DataFrame, min_util) -> DataFrame:
    """The items whose TWU reaches ``min_util``; no other item can be in a result."""
    return twu_map.filter(F.col("twu") >= threshold(min_util))


def item_rank(twu_map: DataFrame, min_util, workspace: Workspace | None = None) -> DataFrame:
    """Promising items ranked 1, 2, … by ascending TWU, ties by name: the search order."""
    promising = promising_items(twu_map, min_util)
    order = [F.col("twu"), F.col("item")]
    ranked = dense_index(promising, "rank", order, start=1, workspace=workspace)
    return ranked.withColumn("rank", F.col("rank").cast("int"))


def promising_transactions(items: DataFrame, promising: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Receipts cut to their promising items, with ``total_utility`` added up again.

    What is kept is stored, so that lines and totals come from one pass over the items.
    """
    kept = items.drop("total_utility").join(promising.select("item"), "item", "left_semi")
    kept = workspace_for(items, workspace).store(kept, "kept")
    dtype = items.schema["utility"].dataType
    totals = kept.groupBy("tid").agg(F.sum("utility").cast(dtype).alias("total_utility"))
    return kept.join(totals, "tid")


def item_occurrences(items: DataFrame, promising: DataFrame) -> DataFrame:
    """(item, occurrences): the number of lines of each promising item."""
    counts = items.groupBy("item").agg(F.count(F.lit(1)).alias("occurrences"))
    return promising.select("item").join(counts, "item", "left").fillna(0, ["occurrences"])


def estimated_entries(occurrences: DataFrame) -> DataFrame:
    """One row: how many utility-list rows mining would start from."""
    total = F.coalesce(F.sum("occurrences"), F.lit(0))
    return occurrences.agg(total.alias("estimated_entries"))


def suggest_min_util(
    twu_map: DataFrame,
    occurrences: DataFrame,
    max_entries: int,
    min_util,
    workspace: Workspace | None = None,
) -> DataFrame:
    """One row: a threshold keeping the utility-list rows within ``max_entries``.

    Going through the items by descending TWU, it lies one step above the TWU of the first item
    at which the rows exceed the budget, or is ``min_util`` when they never do.
    """
    dtype = twu_map.schema["twu"].dataType
    step = Decimal(1).scaleb(-scale_of(dtype))
    order = [F.desc("twu"), F.col("item")]
    items = occurrences.join(twu_map, "item").select("item", "twu", "occurrences")
    running = running_sum(items, "occurrences", "running", order, workspace)
    above = F.max("twu") + (int(step) if isinstance(dtype, T.IntegralType) else F.lit(step))
    return running.filter(F.col("running") > max_entries).agg(
        F.coalesce(above, threshold(min_util)).cast(dtype).alias("min_util")
    )
