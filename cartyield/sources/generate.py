"""Synthetic receipts."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import explode_items

# The item pool (name, lowest and highest unit profit) and the basket limits.
ITEM_POOL = [
    ("Pain", 0.5, 1.5),
    ("Riz", 1.0, 2.0),
    ("Lait", 0.5, 1.2),
    ("The", 2.0, 3.5),
    ("Oeufs", 2.5, 3.5),
    ("Beurre", 1.5, 2.5),
    ("Sucre", 0.8, 1.5),
    ("Huile", 3.0, 5.0),
    ("Fromage", 4.0, 7.0),
    ("Bissap", 1.0, 2.0),
    ("Poulet", 8.0, 15.0),
    ("Agneau", 20.0, 40.0),
    ("Miel", 15.0, 25.0),
    ("Dattes", 30.0, 60.0),
    ("Encens", 10.0, 20.0),
]
MAX_BASKET = 6
MAX_QUANTITY = 5

def _draw(digest: Column, part: int) -> Column:
    """One of the four 32-bit numbers in an MD5 digest."""
    return F.conv(F.substring(digest, 1 + 8 * part, 8), 16, 10).cast("bigint")


def _between(number: Column, low: Column, high: Column) -> Column:
    """A uniform integer from ``low`` to ``high`` inclusive, of a 32-bit number."""
    width = (high - low + 1).cast("bigint")
    return low + F.shiftright(number * width, 32)


def _line(entry: Column) -> Column:
    quantity = _between(_draw(entry["digest"], 1), F.lit(1), F.lit(MAX_QUANTITY)).cast("bigint")
    cents = _between(_draw(entry["digest"], 2), entry["low"], entry["high"])
    profit = (cents.cast("decimal(10,0)") * F.lit(Decimal("0.01"))).cast("decimal(18,4)")
    return F.struct(
        entry["item"].alias("item"),
        quantity.alias("quantity"),
        profit.alias("profit"),
        (quantity * profit).cast("decimal(28,4)").alias("utility"),
    )


def generate_transactions(receipts: DataFrame, seed: int = 42, tid: str = "tid") -> DataFrame:
    """Line items (tid, pos, item, quantity, profit, utility, total_utility), a receipt per id given.

    A receipt has one to six different items of the pool. Everything is drawn from digests of the
    seed, the id and the item, so rows depend neither on partitioning nor on retries. Shuffling the
    pool is sorting an array of fixed length by digest; no rows are shuffled.
    """
    key = F.concat_ws("/", F.lit(str(seed)), F.col(tid).cast("string"))
    size = _between(_draw(F.md5(key), 0), F.lit(1), F.lit(MAX_BASKET))
    pool = F.array(
        *(
            F.struct(
                F.md5(F.concat_ws("/", key, F.lit(item))).alias("digest"),
                F.lit(item).alias("item"),
                F.lit(round(low * 100)).alias("low"),
                F.lit(round(high * 100)).alias("high"),
            )
            for item, low, high in ITEM_POOL
        )
    )
    basket = F.slice(F.array_sort(pool), F.lit(1), size.cast("int"))
    zero = F.lit(0).cast("decimal(28,4)")
    total = F.aggregate("items", zero, lambda acc, i: (acc + i["utility"]).cast("decimal(28,4)"))
    drawn = receipts.select(F.col(tid).alias("tid"), F.transform(basket, _line).alias("items"))
    return explode_items(drawn.withColumn("total_utility", total))
