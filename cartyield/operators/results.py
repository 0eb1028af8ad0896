"""Ranking, searching and summarising mined itemsets.

All take the itemsets of a run: itemset, itemset_name, utility, size, transactions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.units import TOTAL
from ..plans.workspace import Workspace
from .ordering import dense_index

# Decimals of a utility in results, and the number of bars of the overview chart.
RESULT_DECIMALS = 4
CHART_BARS = 10


def by_utility() -> list[Column]:
    """The order of results: by utility, ties by name."""
    return [F.desc("utility"), F.asc("itemset_name")]


def result_rows(itemsets: DataFrame) -> DataFrame:
    """Results in order, with the utility as a double of four decimals."""
    rounded = F.round(F.col("utility").cast("double"), RESULT_DECIMALS)
    return itemsets.select(
        "itemset", "itemset_name", rounded.alias("utility"), "size", "transactions"
    ).orderBy(*by_utility())


def sort_itemsets(itemsets: DataFrame, by: str = "utility", descending: bool = True) -> DataFrame:
    """Results by ``utility`` or ``size``; ties by utility, then name."""
    if by not in ("utility", "size"):
        raise ValueError(f"cannot sort by {by}")
    return itemsets.orderBy(F.desc(by) if descending else F.asc(by), *by_utility())


def top_itemsets(itemsets: DataFrame, count: int = CHART_BARS) -> DataFrame:
    """The ``count`` itemsets of highest utility."""
    return itemsets.orderBy(*by_utility()).limit(count)


def search_itemsets(itemsets: DataFrame, text: str) -> DataFrame:
    """Itemsets whose name holds ``text``, in upper or lower case."""
    return itemsets.filter(F.contains(F.lower("itemset_name"), F.lower(F.lit(text))))


def ranked(
    itemsets: DataFrame, order: list[Column] | None = None, workspace: Workspace | None = None
) -> DataFrame:
    """Results with ``rank`` = 1, 2, … in order."""
    return dense_index(itemsets, "rank", order or by_utility(), start=1, workspace=workspace)


def bar_percent(itemsets: DataFrame) -> DataFrame:
    """Results with ``percent``: the utility as a share of the highest one, or of 1 if that is less."""
    highest = itemsets.agg(F.max("utility").cast("double").alias("highest")).scalar()
    share = F.col("utility").cast("double") / F.greatest(highest, F.lit(1.0)) * 100
    return itemsets.withColumn("percent", F.floor(share + 0.5).cast("bigint"))


def summary_stats(itemsets: DataFrame) -> DataFrame:
    """One row of counts, extremes and averages; only counts are set when there are no itemsets."""
    utility, count = F.col("utility"), F.count(F.lit(1))
    integral = isinstance(itemsets.schema["utility"].dataType, T.IntegralType)
    total = F.sum(utility.cast(TOTAL) if integral else utility).cast("double")
    return itemsets.agg(
        count.alias("count"),
        F.max(utility).alias("max_utility"),
        F.min(utility).alias("min_utility"),
        F.try_divide(total, count.cast("double")).alias("avg_utility"),
        F.max("size").alias("max_size"),
        F.try_divide(F.sum("size").cast("double"), count.cast("double")).alias("avg_size"),
        F.count_if(F.col("size") == 1).alias("single_items"),
        F.count_if(F.col("size") == 2).alias("pairs"),
        F.count_if(F.col("size") > 2).alias("larger"),
    )


def size_distribution(itemsets: DataFrame) -> DataFrame:
    """(size_class, itemsets): how many itemsets are single items, pairs, or larger."""
    counts = summary_stats(itemsets).select(
        F.col("single_items").alias("single"), "pairs", F.col("larger").alias("large")
    )
    return counts.withColumnRenamed("pairs", "pair").unpivot(
        [], ["single", "pair", "large"], "size_class", "itemsets"
    )
