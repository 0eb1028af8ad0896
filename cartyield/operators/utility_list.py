"""Utility lists: per item and receipt, its utility and what remains after it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from ..functions.units import TOTAL, threshold
from ..plans.workspace import Workspace, workspace_for
from .ordering import segmented_sum
from .twu import merge_duplicates


def gain(utility: Column | str, signed: bool = False) -> Column:
    """What a utility adds to a bound: losses count as nothing unless ``signed``."""
    utility = F.col(utility) if isinstance(utility, str) else utility
    return utility if signed else F.greatest(utility, F.lit(0))


def upper_bound(signed: bool = False) -> Column:
    """What an itemset and its extensions can earn in one receipt: iu + ru, or nothing."""
    return gain(F.col("iu") + F.col("ru"), signed)


def utility_list(
    items: DataFrame, ranks: DataFrame, remaining: str = "rank", whole: bool = False
) -> DataFrame:
    """(tid, item, rank, iu, ru) of the ranked items; ``items`` has one row per (tid, item).

    ``remaining="rank"`` counts the items later in the search order, and of these only positive
    utilities, so that iu + ru bounds every extension. ``"position"`` counts the items printed
    later on the receipt. ``whole`` adds ``reach``, what the receipt can contribute at all, and
    ``receipt_items``, the number of its ranked items.
    """
    kept = items.join(ranks.select("item", "rank"), "item")
    signed = remaining == "position"
    own = gain("utility", signed)
    # Everything later in the receipt. Read backwards it is a running frame, which costs one
    # pass; "all following rows" would be added up again for every row.
    receipt = Window.partitionBy("tid").orderBy(F.desc("pos" if signed else "rank"))
    later = F.sum(own).over(receipt.rowsBetween(Window.unboundedPreceding, -1))
    everything = receipt.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    of_receipt = [
        F.sum(own).over(everything).alias("reach"),
        F.count(F.lit(1)).over(everything).cast("int").alias("receipt_items"),
    ]
    dtype = items.schema["utility"].dataType
    return kept.select(
        "tid",
        "item",
        "rank",
        F.col("utility").alias("iu"),
        F.coalesce(later, F.lit(0)).cast(dtype).alias("ru"),
        *(of_receipt if whole else []),
    )


def segmented_utility_list(
    items: DataFrame,
    ranks: DataFrame,
    remaining: str = "rank",
    whole: bool = False,
    workspace: Workspace | None = None,
) -> DataFrame:
    """``utility_list`` for receipts of any length: one receipt is dealt out over several tasks.

    Sums per receipt are joined back from a stored table; there are few receipts of the length this is for.
    """
    workspace = workspace_for(items, workspace)
    signed = remaining == "position"
    dtype = items.schema["utility"].dataType
    kept = items.join(ranks.select("item", "rank"), "item").withColumn("_own", gain("utility", signed))
    order = F.desc("pos" if signed else "rank")
    ranked = segmented_sum(kept, "tid", "_own", "_running", [order], workspace)
    columns = ["tid", "item", "rank", F.col("utility").alias("iu"), (F.col("_running") - F.col("_own")).cast(dtype).alias("ru")]
    if not whole:
        return ranked.select(*columns)
    sums = kept.groupBy("tid").agg(F.sum("_own").alias("reach"), F.count(F.lit(1)).cast("int").alias("receipt_items"))
    return ranked.join(workspace.store(sums, "long-reach"), "tid").select(*columns, "reach", "receipt_items")


def build_utility_list(
    items: DataFrame,
    ranks: DataFrame,
    remaining: str = "rank",
    duplicates: str = "sum",
    segmented: bool = False,
) -> DataFrame:
    """Utility lists of line items; lines of the same item in a receipt are merged first.

    ``segmented`` spreads long receipts over tasks.
    """
    used = ["tid", "item", "utility"]
    if remaining == "position" or duplicates != "sum":
        used.append("pos")
    lines = items.dropna(subset=["tid", "item"]).select(*used)
    build = segmented_utility_list if segmented else utility_list
    return build(merge_duplicates(lines, duplicates), ranks, remaining)


def entry_totals(entries: DataFrame) -> DataFrame:
    """Utility-list rows with ``total`` = iu + ru."""
    return entries.withColumn("total", F.col("iu") + F.col("ru"))


def itemset_sums(entries: DataFrame, *key: str) -> DataFrame:
    """Per itemset: summed iu and ru, the upper bound of all extensions and the number of receipts.

    The bound takes each receipt by itself: one where the itemset loses more than later items can earn counts
    as nothing, since an extension need not occur there.
    """
    dtype = entries.schema["iu"].dataType

    def summed(amount: Column) -> Column:
        return F.sum(amount.cast(TOTAL) if isinstance(dtype, T.IntegralType) else amount)

    return entries.groupBy(*(key or ("item",))).agg(
        summed(F.col("iu")).alias("sum_iu"),
        summed(F.col("ru")).alias("sum_ru"),
        summed(upper_bound()).alias("upper_bound"),
        F.count(F.lit(1)).alias("transactions"),
    )


def high_utility(sums: DataFrame, min_util) -> DataFrame:
    """The itemsets whose utility reaches ``min_util``."""
    return sums.filter(F.col("sum_iu") >= threshold(min_util))


def extendable(sums: DataFrame, min_util) -> DataFrame:
    """The itemsets that may still have an extension reaching ``min_util``."""
    return sums.filter(F.col("upper_bound") >= threshold(min_util))


def prunable(sums: DataFrame, min_util) -> DataFrame:
    """The itemsets no extension of which can reach ``min_util``."""
    return sums.filter(F.col("upper_bound") < threshold(min_util))


def join_utility_lists(left: DataFrame, right: DataFrame, parent: DataFrame) -> DataFrame:
    """(tid, iu, ru) of the union of two itemsets sharing the prefix ``parent``.

    The prefix is in both utilities, so it is taken off once; ru is that of the later item.
    """
    p = left.select("tid", F.col("iu").alias("iu_left"))
    q = right.select("tid", F.col("iu").alias("iu_right"), "ru")
    shared = parent.select("tid", F.col("iu").alias("iu_parent"))
    utility = F.col("iu_left") + F.col("iu_right") - F.col("iu_parent")
    return p.join(q, "tid").join(shared, "tid").select("tid", utility.alias("iu"), "ru")


def empty_prefix_list(entries: DataFrame) -> DataFrame:
    """The list of the empty itemset over the same receipts: nothing used, all remaining."""
    iu = entries.schema["iu"].dataType
    return entries.select("tid", F.lit(0).cast(iu).alias("iu"), (F.col("iu") + F.col("ru")).alias("ru"))
