"""Line items from any table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.itemsets import item_utility


def _column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def items_from(
    table: DataFrame,
    tid: Column | str,
    item: Column | str,
    utility: Column | str | None = None,
    quantity: Column | str | None = None,
    profit: Column | str | None = None,
    pos: Column | str | None = None,
    total_utility: Column | str | None = None,
) -> DataFrame:
    """(tid, item, utility, …) from columns or expressions of ``table``.

    ``utility`` defaults to quantity x profit. Amounts should be integers or decimals; doubles are
    rounded to four places where they are added up. ``pos`` is the place of a line in its receipt.
    """
    if utility is None:
        if quantity is None or profit is None:
            raise ValueError("give utility, or quantity and profit")
        utility = item_utility(_column(quantity), _column(profit))
    given = {
        "tid": tid,
        "pos": pos,
        "item": _column(item).cast("string"),
        "quantity": quantity,
        "profit": profit,
        "utility": utility,
        "total_utility": total_utility,
    }
    return table.select(*(_column(v).alias(k) for k, v in given.items() if v is not None))
