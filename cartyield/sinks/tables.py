"""Result layouts and their writers.

Writers make folders of part files, each task writing its own; rows are in order within and across
the files. Nothing is gathered into a single task to get a single file.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, DataFrameWriter, SparkSession
from pyspark.sql import functions as F

from ..operators.results import RESULT_DECIMALS, by_utility, ranked, result_rows
from ..plans.workspace import Workspace

# Headers of the CSV layouts.
CSV_COLUMNS = ["itemset", "utility_mru", "size", "transactions"]
LEGACY_CSV_COLUMNS = ["itemset", "utility_eur", "size", "items", "min_util"]
RANKED_CSV_COLUMNS = ["Rang", "Itemset", "Utilite (MRU)", "Taille", "Transactions"]

RESULT_SCHEMA = "itemset_name string, utility double, size int, transactions bigint"


def csv_layout(itemsets: DataFrame) -> DataFrame:
    """One row per itemset in order: name, utility, size, receipts."""
    rows = result_rows(itemsets)
    return rows.select("itemset_name", "utility", "size", "transactions").toDF(*CSV_COLUMNS)


def legacy_csv_layout(itemsets: DataFrame, min_util) -> DataFrame:
    """The older layout: utility with two decimals, the item list and the threshold."""
    amount = F.col("utility").cast("decimal(38,6)")
    return (
        itemsets.orderBy(*by_utility())
        .select(
            "itemset_name",
            F.round(amount, 2).cast("decimal(38,2)").cast("string"),
            "size",
            F.array_join(F.array_sort("itemset"), ", "),
            F.lit(float(min_util)),
        )
        .toDF(*LEGACY_CSV_COLUMNS)
    )


def ranked_csv_layout(itemsets: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """The layout with a rank column."""
    rows = ranked(itemsets, workspace=workspace).orderBy("rank")
    utility = F.round(F.col("utility").cast("double"), RESULT_DECIMALS)
    return rows.select("rank", "itemset_name", utility, "size", "transactions").toDF(
        *RANKED_CSV_COLUMNS
    )


def _csv(df: DataFrame) -> DataFrameWriter:
    # A quote in a name is doubled, as CSV readers expect.
    return df.write.option("header", True).option("quote", '"').option("escape", '"')


def write_csv(layout: DataFrame, path: str, mode: str = "error") -> None:
    """Write one of the CSV layouts; names with commas are quoted."""
    _csv(layout).mode(mode).csv(path)


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """Read back what ``write_csv`` wrote of ``csv_layout``."""
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"')
    return reader.schema(RESULT_SCHEMA).csv(path)


def write_result(itemsets: DataFrame, path: str, mode: str = "error") -> None:
    """Keep itemsets for later sessions, types and all."""
    itemsets.write.mode(mode).parquet(path)


def read_result(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


