"""Receipts written as text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace

# The comment lines that open a file of receipts.
HEADER = ["# Format: item:quantity:profit item:quantity:profit ... : total_utility"]


def plain_number(amount: Column) -> Column:
    """A decimal without trailing zeros: ``900.1`` for 900.1000, ``3`` for 3.0000."""
    text = amount.cast("string")
    trimmed = F.rtrim(F.rtrim(text, F.lit("0")), F.lit("."))
    # Tiny amounts are printed with an exponent, whose zeros count.
    return F.when(text.contains(".") & ~text.contains("E"), trimmed).otherwise(text)


def render_lines(items: DataFrame) -> DataFrame:
    """(tid, value): the text line of each receipt, items in printed order, its total last.

    A line holds its whole receipt, as the format demands.
    """
    token = F.concat_ws(
        ":", "item", F.col("quantity").cast("string"), plain_number(F.col("profit"))
    )
    receipts = items.groupBy("tid").agg(
        F.array_sort(F.collect_list(F.struct("pos", token.alias("token")))).alias("lines"),
        F.max("total_utility").alias("total"),
    )
    total = F.concat(F.lit(":"), plain_number(F.col("total")))
    value = F.concat_ws(" ", F.col("lines.token"), total)
    return receipts.select("tid", value.alias("value"))


def _placed(lines: DataFrame) -> DataFrame:
    """Lines of receipts (tid, value) with their place after the header."""
    return lines.select(F.lit(1).alias("body"), F.col("tid").cast("bigint"), "value")


def _write_placed(lines: DataFrame, path: str, mode: str) -> None:
    first = lines.sparkSession.createDataFrame([(0, 0, line) for line in HEADER], "body int, tid bigint, value string")
    first.unionByName(lines).orderBy("body", "tid").select("value").write.mode(mode).text(path)


def write_transactions(items: DataFrame, path: str, mode: str = "error") -> None:
    """Write receipts as text files in order of their ids, the header line first.

    The lines are stored before they are sorted: the sort looks at its input twice, and they are made once.
    """
    with Workspace(items.sparkSession) as workspace:
        _write_placed(workspace.store(_placed(render_lines(items)), "lines"), path, mode)


def write_lines(lines: DataFrame, path: str, mode: str = "error") -> None:
    """Write stored receipts (tid, value), as ``render_lines`` makes them, as text files in order of their ids, the header line first."""
    _write_placed(_placed(lines), path, mode)
