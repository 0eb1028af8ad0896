"""Results as JSON and as a text report."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.results import by_utility, ranked, result_rows, summary_stats
from ..functions.units import threshold
from ..plans.workspace import Workspace

# Lines of the report.
REPORT_TITLE = "RAPPORT HUIM — High Utility Itemset Mining"
REPORT_DATE = "Généré le : %s"
REPORT_MIN_UTIL = "Seuil MinUtil : %sMRU"
REPORT_TIME = "Temps d'exécution : %.3fs"
REPORT_COUNT = "Nombre de HUI : %d"
REPORT_RULE = "=" * 60
STAMP = "%Y-%m-%d %H:%M:%S"
REPORT_ENTRY = "#%d %s\n   Utilité totale : %sMRU\n   Taille : %d article(s)\n   Transactions : %d\n"

# The place of a document's last row, after any rank.
_LAST = (1 << 63) - 1


def json_lines(itemsets: DataFrame) -> DataFrame:
    """One JSON object per itemset, as ``json``, in order of utility."""
    fields = F.struct("itemset", "itemset_name", "utility", "size", "transactions")
    return itemsets.orderBy(*by_utility()).select(F.to_json(fields).alias("json"))


def write_json(itemsets: DataFrame, path: str, mode: str = "error") -> None:
    """Write results in order, one JSON object per line."""
    result_rows(itemsets).write.mode(mode).json(path)


def result_document(
    itemsets: DataFrame,
    counters: DataFrame,
    min_util,
    elapsed_seconds: float | None = None,
    mode: str = "exact",
    workspace: Workspace | None = None,
) -> DataFrame:
    """(place, json): the lines of a single JSON document with the whole result, in order of place.

    The first line opens the document, each itemset has a line, and the last one holds counts, statistics and
    counters. So the document may have any size.
    """
    fields = F.to_json(F.struct("itemset", "itemset_name", "utility", "size", "transactions"))
    lines = ranked(itemsets, workspace=workspace).select(
        F.col("rank").alias("place"), F.concat(F.when(F.col("rank") > 1, ",").otherwise(""), fields).alias("json")
    )
    opening = F.struct(
        F.lit(True).alias("success"),
        F.lit(mode).alias("mode"),
        threshold(min_util).alias("min_util"),
        F.round(F.lit(elapsed_seconds).cast("double"), 4).alias("elapsed_seconds"),
    )
    spark = itemsets.sparkSession
    first = spark.range(1).select(
        F.lit(0).cast("bigint").alias("place"),
        F.concat(F.rtrim(F.to_json(opening), F.lit("}")), F.lit(',"itemsets":[')).alias("json"),
    )
    stats = summary_stats(itemsets).select(F.struct("*").alias("stats"))
    counted = counters.select(F.struct("*").alias("algorithm_stats"))
    closing = F.struct(
        F.col("algorithm_stats.total_transactions").alias("total_transactions"),
        F.col("stats.count").alias("huis_found"),
        "stats",
        "algorithm_stats",
    )
    # Two tables of one row each, put side by side.
    one = [df.withColumn("_row", F.lit(1)) for df in (stats, counted)]
    last = one[0].join(one[1], "_row").select(
        F.lit(_LAST).alias("place"), F.concat(F.lit("],"), F.ltrim(F.to_json(closing), F.lit("{"))).alias("json")
    )
    return first.unionByName(lines).unionByName(last)


def write_document(document: DataFrame, path: str, mode: str = "error") -> None:
    """Write the lines of ``result_document`` in order; the part files one after another are the document."""
    document.orderBy("place").select("json").write.mode(mode).text(path)


def report_entries(itemsets: DataFrame, workspace: Workspace | None = None) -> DataFrame:
    """(rank, entry): the report's lines for each itemset."""
    amount = F.round(F.col("utility").cast("decimal(38,6)"), 2).cast("decimal(38,2)")
    entry: Column = F.format_string(
        REPORT_ENTRY, "rank", "itemset_name", amount.cast("string"), "size", "transactions"
    )
    return ranked(itemsets, workspace=workspace).select("rank", entry.alias("entry"))


def report_header(
    count: int, min_util, generated: str | datetime | None = None, elapsed_seconds: float | None = None
) -> str:
    """The report's first lines; ``generated`` is the time of the report, now unless given."""
    generated = datetime.now() if generated is None else generated
    if isinstance(generated, datetime):
        generated = generated.strftime(STAMP)
    lines = [REPORT_TITLE, REPORT_DATE % generated, REPORT_MIN_UTIL % float(min_util)]
    if elapsed_seconds:
        lines.append(REPORT_TIME % elapsed_seconds)
    return "\n".join([*lines, REPORT_COUNT % count, REPORT_RULE, ""])


def write_report(
    itemsets: DataFrame,
    path: str,
    min_util,
    generated: str | datetime | None = None,
    elapsed_seconds: float | None = None,
    mode: str = "error",
) -> None:
    """Write the text report: a header, then the itemsets by rank."""
    header = report_header(itemsets.count(), min_util, generated, elapsed_seconds)
    first = itemsets.sparkSession.range(1).select(
        F.lit(0).cast("bigint").alias("rank"), F.lit(header).alias("entry")
    )
    report = first.unionByName(report_entries(itemsets)).orderBy("rank").select("entry")
    report.write.mode(mode).text(path)
