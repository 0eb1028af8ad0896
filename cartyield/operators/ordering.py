"""Global positions and running sums without passing all rows through one task.

``row_number() OVER (ORDER BY …)`` with no partition key sorts everything in a single
task. Here Spark range-partitions the sort; each row gets its place inside its own
partition, and only one row per partition (its size or its sum) is put in line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..plans.workspace import Workspace, workspace_for

# monotonically_increasing_id() keeps the partition above this bit, the row below it.
_PARTITION_SHIFT = 33
# Splits whose counts are broadcast, some 200 bytes each.
BROADCAST_SPLITS = 1 << 20


def by_receipt(df: DataFrame, key: str = "tid") -> DataFrame:
    """The rows of a receipt in one of ``spark.sql.shuffle.partitions`` partitions, none of which are put together.

    Partitions that adaptive execution puts together hold some 64 MB of compressed rows, which sorts and hash tables make twenty
    times as large. What goes by receipt afterwards needs no further shuffle.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _located(df: DataFrame, workspace: Workspace | None, name: str) -> DataFrame:
    """Store ``df`` with the place of each row: ``_part``, ``_row`` (0-based)."""
    numbered = df.withColumn("_place", F.monotonically_increasing_id())
    stored = workspace_for(df, workspace).store(numbered, name)
    return stored.select(
        *df.columns,
        F.shiftright("_place", _PARTITION_SHIFT).alias("_part"),
        F.col("_place").bitwiseAND((1 << _PARTITION_SHIFT) - 1).alias("_row"),
    )


def _offsets(parts: DataFrame, size: str, offset: str) -> DataFrame:
    """Sum of the partitions before each one; ``parts`` has one row per partition."""
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", F.coalesce(F.sum(size).over(before), F.lit(0)).alias(offset))


def dense_index(
    df: DataFrame,
    name: str,
    order: list[Column] | None = None,
    start: int = 0,
    workspace: Workspace | None = None,
) -> DataFrame:
    """Add ``name`` = start, start+1, … in the given order, or in scan order."""
    located = _located(df.orderBy(*order) if order else df, workspace, f"index-{name}")
    sizes = located.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    return located.join(_offsets(sizes, "_size", "_before"), "_part").select(
        *df.columns, (F.col("_before") + F.col("_row") + start).cast("bigint").alias(name)
    )


def split_columns(files: DataFrame) -> list[Column]:
    """What tells the splits of a file source apart: add them to its columns for ``split_index``."""
    metadata = files.metadataColumn("_metadata")
    return [metadata["file_path"].alias("_file"), metadata["file_block_start"].alias("_block")]


def split_index(df: DataFrame, name: str, start: int = 0, workspace: Workspace | None = None) -> DataFrame:
    """Add ``name`` = start, start+1, … in the order of the files, by path, and of the lines in them.

    ``df`` is a file source with ``split_columns`` and whatever filters and expressions, but no shuffle. A first pass counts
    its rows per split of a file, which is all that is written; a second one reads the files again. A scan that deals out the
    splits in another way than the first pass, or of files that changed in between, raises an error.
    """
    placed = df.withColumn("_place", F.monotonically_increasing_id())
    counted = placed.groupBy("_file", "_block", F.shiftright("_place", _PARTITION_SHIFT).alias("_part")).agg(
        F.min("_place").alias("_first"), F.count(F.lit(1)).alias("_size")
    )
    counted = workspace_for(df, workspace).store(counted, f"splits-{name}")
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    splits = counted.withColumn("_before", F.coalesce(F.sum("_size").over(before), F.lit(0)))
    # One row per split, which is 128 MB of files unless set otherwise.
    if counted.count() <= BROADCAST_SPLITS:
        splits = F.broadcast(splits)
    row = placed.withColumn("_part", F.shiftright("_place", _PARTITION_SHIFT)).join(splits, ["_file", "_block", "_part"], "left")
    inside = F.col("_place") - F.col("_first")
    moved = F.raise_error(F.lit("the files were dealt out anew between two reads")).cast("bigint")
    index = F.when((inside >= 0) & (inside < F.col("_size")), F.col("_before") + inside + start).otherwise(moved)
    return row.select(*(c for c in df.columns if c not in ("_file", "_block")), index.alias(name))


def running_sum(
    df: DataFrame,
    value: str,
    name: str,
    order: list[Column],
    workspace: Workspace | None = None,
) -> DataFrame:
    """Add ``name`` = sum of ``value`` up to and including the row, in the given order."""
    located = _located(df.orderBy(*order), workspace, f"running-{name}")
    sums = located.groupBy("_part").agg(F.sum(value).alias("_sum"))
    inside = Window.partitionBy("_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, 0)
    return located.join(_offsets(sums, "_sum", "_before"), "_part").select(
        *df.columns, (F.col("_before") + F.sum(value).over(inside)).alias(name)
    )


def _segmented(
    df: DataFrame, group: str, value: str, order: list[Column], aggregate, end: int, workspace: Workspace | None, name: str
) -> DataFrame:
    """``df`` with ``_before`` and ``_inside``: the aggregate of the row's group in earlier ranges and in its own up to ``end``."""
    located = _located(df.orderBy(group, *order), workspace, name)
    parts = located.groupBy(group, "_part").agg(aggregate(value).alias("_whole"))
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = parts.select(group, "_part", aggregate("_whole").over(before).alias("_before"))
    inside = Window.partitionBy(group, "_part").orderBy("_row").rowsBetween(Window.unboundedPreceding, end)
    return located.join(offsets, [group, "_part"]).select(*df.columns, "_before", aggregate(value).over(inside).alias("_inside"))


def segmented_sum(
    df: DataFrame,
    group: str,
    value: str,
    name: str,
    order: list[Column],
    workspace: Workspace | None = None,
) -> DataFrame:
    """Add ``name`` = sum of ``value`` up to and including the row, in order within its ``group``.

    A group may be of any size: rows are sorted by group and order into ranges, so that a large group spans several tasks. Each
    range adds up its own rows of a group, and only these sums, one per group and range, are put in line.
    """
    parts = _segmented(df, group, value, order, F.sum, 0, workspace, f"segments-{name}")
    return parts.select(*df.columns, (F.coalesce("_before", F.lit(0)) + F.col("_inside")).alias(name))


def segmented_max_before(
    df: DataFrame,
    group: str,
    value: str,
    name: str,
    order: list[Column],
    workspace: Workspace | None = None,
) -> DataFrame:
    """Add ``name`` = largest ``value`` before the row, in order within its ``group``; null for the first. Works as ``segmented_sum``."""
    parts = _segmented(df, group, value, order, F.max, -1, workspace, f"segments-{name}")
    return parts.select(*df.columns, F.greatest("_before", "_inside").alias(name))
