"""Projected receipts: what receipts still hold after an itemset has been taken from them.

A row is an itemset (``node``) in one receipt, with the later items of the receipt as an array in search order. Receipts in which
the same items are left are one row: their amounts are added up, and ``n`` counts them. That loses nothing, since a larger itemset
is in all of these receipts or in none, so deeper levels work on ever fewer rows. Columns:

    node, up, last  the itemset, the itemset without its last item, the last item's rank
    base            the utility that a further item's is added to
    ru              what the later items can add
    n               the number of receipts
    items           array of (rank, u, ru), the later items
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .utility_list import gain

# Receipts with up to so many items left are merged. Longer remainders hardly ever coincide.
MERGED_ITEMS = 4


def baskets(rows: DataFrame) -> DataFrame:
    """(items, nodes, whole), one row per receipt of rows (tid, rank, u, ru, reach, node).

    ``nodes`` numbers the items as itemsets of one item, null for those that no larger itemset begins with, and
    ``whole`` is what the receipt can contribute at all. No receipt may be longer than an array should be.
    """
    line = F.struct("rank", "u", "ru", "node")
    receipts = rows.groupBy("tid").agg(F.sort_array(F.collect_list(line)).alias("lines"), F.first("reach").alias("whole"))
    items = F.transform("lines", lambda x: F.struct(x["rank"].alias("rank"), x["u"].alias("u"), x["ru"].alias("ru")))
    return receipts.select(items.alias("items"), F.col("lines.node").alias("nodes"), "whole")


def _later(items: Column | str, at: Column | str) -> Column:
    return F.slice(items, F.col(at) + 2, F.size(items))


def single_items(receipts: DataFrame) -> DataFrame:
    """The projected receipts of single items, not merged, with ``whole``."""
    taken = receipts.select("items", "whole", F.posexplode("nodes").alias("at", "node")).filter("node is not null")
    item = F.get("items", F.col("at"))
    return taken.select(
        "node",
        F.lit(0).cast("bigint").alias("up"),
        item["rank"].alias("last"),
        item["u"].alias("base"),
        item["ru"].alias("ru"),
        F.lit(1).cast("bigint").alias("n"),
        _later("items", "at").alias("items"),
        "whole",
    ).filter(F.size("items") > 0)


def candidates(projected: DataFrame, joinable: DataFrame | None = None, pairs: DataFrame | None = None) -> DataFrame:
    """Itemsets one item larger: (prefix, last, iu, ru, reach, n), one row per projected receipt and later item.

    A later item counts only if the itemset without its last item can be joined with it (``joinable``: prefix, last) and if
    receipts holding it together with the last item earn enough (``pairs``: before, last).
    """
    whole = ["whole"] if "whole" in projected.columns else []
    larger = projected.select("node", "up", F.col("last").alias("before"), "base", F.col("ru").alias("ru_parent"), "n", F.explode("items").alias("x"), *whole)
    larger = larger.withColumn("rank", F.col("x.rank"))
    if joinable is not None:
        larger = larger.join(joinable.select(F.col("prefix").alias("up"), F.col("last").alias("rank")), ["up", "rank"], "left_semi")
    if pairs is not None:
        larger = larger.join(pairs.select("before", F.col("last").alias("rank")), ["before", "rank"], "left_semi")
    return larger.select(
        F.col("node").alias("prefix"),
        F.col("rank").alias("last"),
        (F.col("base") + F.col("x.u")).alias("iu"),
        F.col("x.ru").alias("ru"),
        gain(F.col("base") + F.col("ru_parent")).alias("reach"),
        "n",
        *whole,
    )


def extended(projected: DataFrame, nodes: DataFrame, whole_base: bool) -> DataFrame:
    """The projected receipts of the extendable ``nodes`` (prefix, last, node), not merged.

    With ``whole_base`` the base grows by every item, else it stays that of the first one.
    """
    taken = projected.select("node", "base", "n", "items", F.posexplode("items").alias("at", "x"))
    taken = taken.withColumnsRenamed({"node": "prefix"}).withColumn("last", F.col("x.rank"))
    extendable = nodes.filter("extendable").select("prefix", "last", "node")
    taken = taken.filter(F.col("at") + 1 < F.size("items")).join(extendable, ["prefix", "last"])
    return taken.select(
        "node",
        F.col("prefix").alias("up"),
        "last",
        (F.col("base") + F.col("x.u") if whole_base else F.col("base")).alias("base"),
        F.col("x.ru").alias("ru"),
        "n",
        _later("items", "at").alias("items"),
    )


def merged(projected: DataFrame, longest: int = MERGED_ITEMS) -> DataFrame:
    """``projected`` with rows of the same itemset and the same items left added up, if at most ``longest`` are left.

    Amounts of an item are added up in columns of their own, so that partial sums are made before the shuffle. All sums must fit BIGINT.
    """
    short = projected.filter(F.size("items") <= longest)

    def place(j: int) -> Column:
        return F.get("items", F.lit(j))

    amounts = [F.sum(place(j)[name]).alias(f"{name}_{j}") for j in range(longest) for name in ("u", "ru")]
    sums = short.groupBy("node", F.col("items.rank").alias("ranks")).agg(
        F.first("up").alias("up"),
        F.first("last").alias("last"),
        F.sum("base").alias("base"),
        F.sum("ru").alias("sum_ru"),
        F.sum("n").alias("n"),
        *amounts,
    )
    items = [F.struct(F.get("ranks", F.lit(j)).alias("rank"), F.col(f"u_{j}").alias("u"), F.col(f"ru_{j}").alias("ru")) for j in range(longest)]
    rows = sums.select("node", "up", "last", "base", F.col("sum_ru").alias("ru"), "n", F.slice(F.array(*items), F.lit(1), F.size("ranks")).alias("items"))
    return rows.unionByName(projected.filter(F.size("items") > longest))
