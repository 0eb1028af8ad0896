"""End to end: a text file of receipts to its high-utility itemsets."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.units import DEFAULT_SCALE
from ..operators.mining import EXACT, Mining, Mode, mine
from ..operators.results import result_rows, summary_stats
from ..sources.text import explode_items, parse_lines
from .workspace import Workspace, workspace_for

# Fixed value: the threshold used when none is given.
DEFAULT_MIN_UTIL = 5.0


@dataclass(frozen=True)
class Run:
    """A finished run: ``itemsets`` in order, a one-row ``summary`` and one-row ``counters``."""

    itemsets: DataFrame
    summary: DataFrame
    counters: DataFrame
    min_util: object
    mode: str
    elapsed_seconds: float
    workspace: Workspace

    def close(self) -> None:
        """Delete the tables behind the results, which can be read no more."""
        self.workspace.close()


def run_items(
    items: DataFrame,
    min_util=DEFAULT_MIN_UTIL,
    mode: Mode = EXACT,
    duplicates: str = "sum",
    workspace: Workspace | None = None,
) -> Run:
    """Mine line items and shape the results."""
    workspace = workspace_for(items, workspace)
    started = time.monotonic()
    mining: Mining = mine(items, min_util, mode, duplicates, workspace)
    elapsed = time.monotonic() - started
    summary = summary_stats(mining.itemsets)
    return Run(
        result_rows(mining.itemsets), summary, mining.stats(), min_util, mode.name, elapsed, workspace
    )


def run(
    spark: SparkSession,
    path: str | list[str],
    min_util=DEFAULT_MIN_UTIL,
    mode: Mode = EXACT,
    duplicates: str = "sum",
    scale: int = DEFAULT_SCALE,
) -> Run:
    """Mine a text file, which is read and parsed once.

    Nothing of a result shows a receipt's id, so ids are only told apart, not made dense.
    """
    receipts = parse_lines(spark.read.text(path), scale=scale)
    receipts = receipts.withColumn("tid", F.monotonically_increasing_id())
    return run_items(explode_items(receipts), min_util, mode, duplicates, Workspace(spark))
