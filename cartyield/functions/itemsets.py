"""Column expressions on itemsets and on amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def item_utility(quantity: Column | str, profit: Column | str) -> Column:
    """Utility of one receipt line: quantity x unit profit."""
    quantity, profit = (F.col(x) if isinstance(x, str) else x for x in (quantity, profit))
    return quantity * profit


def itemset_name(itemset: Column | str) -> Column:
    """``{a, b, c}`` with the items in name order."""
    names = F.array_join(F.array_sort(itemset), ", ")
    return F.concat(F.lit("{"), names, F.lit("}"))


def bare_name(name: Column | str) -> Column:
    """An itemset name without its braces, as chart labels show it."""
    return F.translate(name, "{}", "")


def size_class(size: Column | str) -> Column:
    """``single``, ``pair`` or ``large``."""
    size = F.col(size) if isinstance(size, str) else size
    return F.when(size == 1, "single").when(size == 2, "pair").otherwise("large")
