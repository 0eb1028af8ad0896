"""Receipts in text form: ``item:quantity:profit item:quantity:profit … :total`` per line."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.units import DEFAULT_SCALE
from ..operators.ordering import dense_index, split_columns, split_index
from ..plans.workspace import Workspace

# Fixed value: what separates name, quantity and profit; a line opening with # is a comment.
FIELD_SEPARATOR = ":"

# White space besides the blank: what Unicode calls so, and four separators that count as such.
_SPACES = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x85\xa0" + "".join(map(chr, range(0x2000, 0x200B)))
_SPACES += "\u1680\u2028\u2029\u202f\u205f\u3000"
_NUMBER = r"[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?"
_ITEM = rf"[^: ]+:[+-]?[0-9]+:{_NUMBER}"
# A receipt: its first token opens no comment, another one follows, and some token is an item.
_RECEIPT = rf"^ *(?!#)(?=[^ ]+ +[^ ])(?:.* )?{_ITEM}(?: |$)"


def _number(text: Column, dtype: str) -> Column:
    # A well-formed number outside the type's range is an error, never a skipped line.
    too_large = F.raise_error(F.concat(F.lit("number out of range: "), text)).cast(dtype)
    return F.coalesce(text.try_cast(dtype), too_large)


def parse_lines(lines: DataFrame, column: str = "value", scale: int = DEFAULT_SCALE) -> DataFrame:
    """Turn a text column into receipts: ``items`` (item, quantity, profit, utility), ``total_utility``.

    Rows that hold no receipt (blank, a comment, no valid item, a single token) are left out; other
    columns are kept. Malformed tokens are skipped. The last well-formed total counts, and a missing
    or zero total is replaced by the sum of the items. Profits are kept to ``scale`` decimals.
    """
    profit_type, amount_type = f"decimal(18,{scale})", f"decimal(28,{scale})"

    def typed(fields: Column) -> Column:
        return F.struct(
            F.get(fields, F.lit(0)).alias("item"),
            _number(F.get(fields, F.lit(1)), "bigint").alias("quantity"),
            _number(F.get(fields, F.lit(2)), profit_type).alias("profit"),
        )

    def priced(line: Column) -> Column:
        utility = (line["quantity"] * line["profit"]).cast(amount_type)
        names = ("item", "quantity", "profit")
        return F.struct(*(line[n].alias(n) for n in names), utility.alias("utility"))

    def matching(pattern: str) -> Column:
        return F.filter("tokens", lambda token: token.rlike(f"^{pattern}$"))

    # All separators are made blanks, since splitting at one fixed character is the fast way.
    # Each lambda then works on what the one before it has computed.
    blanked = F.translate(column, _SPACES, " " * len(_SPACES))
    fields = F.transform(matching(_ITEM), lambda token: F.split(token, FIELD_SEPARATOR))
    items = F.transform(F.transform(fields, typed), priced)
    stated = F.substring(F.try_element_at(matching(f":{_NUMBER}"), F.lit(-1)), 2, 1 << 30)
    zero = F.lit(0).cast(amount_type)
    added = F.aggregate("items", zero, lambda acc, i: (acc + i["utility"]).cast(amount_type))
    others = [c for c in lines.columns if c != column]
    return (
        # Lines are told apart by their text alone: a filter on the parsed items would be pushed
        # below the parsing, and parse every line twice.
        lines.filter(blanked.rlike(_RECEIPT))
        .select(*others, F.split(blanked, " ").alias("tokens"))
        .select(*others, items.alias("items"), stated.alias("stated"))
        .withColumn("stated", F.when(F.col("stated").isNotNull(), _number(F.col("stated"), amount_type)))
        .select(*others, "items", receipt_total("stated", added).alias("total_utility"))
    )


def receipt_total(stated: Column | str, added: Column | str) -> Column:
    """A receipt's total: the stated one, or the items' sum where it is missing or zero."""
    stated = F.col(stated) if isinstance(stated, str) else stated
    added = F.col(added) if isinstance(added, str) else added
    return F.coalesce(F.nullif(stated, F.lit(0)), added)


def number_transactions(receipts: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """Add ``tid`` = 0, 1, … in scan order. ``read_transactions`` numbers files without storing their lines."""
    return dense_index(receipts, "tid", workspace=workspace)


def explode_items(receipts: DataFrame) -> DataFrame:
    """Line items (tid, pos, item, quantity, profit, utility, total_utility) of receipts."""
    # No receipt is empty. The outer form says so; the inner one would compute the items once more
    # to filter by their number.
    return receipts.select(
        "tid", F.posexplode_outer("items").alias("pos", "line"), "total_utility"
    ).select(
        "tid", "pos", "line.item", "line.quantity", "line.profit", "line.utility", "total_utility"
    )


def read_transactions(
    spark: SparkSession,
    path: str | list[str],
    scale: int = DEFAULT_SCALE,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Line items of a text file, or of all files in a folder, with dense transaction ids.

    Ids follow the files by path and the lines in them. The files are read twice, once to count receipts, and not stored.
    """
    files = spark.read.text(path)
    receipts = parse_lines(files.select("value", *split_columns(files)), scale=scale)
    return explode_items(split_index(receipts, "tid", workspace=workspace))
