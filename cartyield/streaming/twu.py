"""TWU of a growing folder of receipts, as a streaming query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.units import DEFAULT_SCALE
from ..operators.twu import merge_twu
from ..sources.text import parse_lines


def stream_twu(spark: SparkSession, path: str, scale: int = DEFAULT_SCALE) -> DataFrame:
    """(item, twu) over all files that have arrived in ``path``; run it in complete or update mode.

    A receipt is a line, so it needs neither an id nor a shuffle: its different items each get its
    total. State is one sum per item.
    """
    receipts = parse_lines(spark.readStream.text(path), scale=scale)
    names = F.array_distinct(F.col("items.item"))
    lines = receipts.select(F.explode(names).alias("item"), "total_utility")
    return lines.groupBy("item").agg(F.sum("total_utility").alias("twu"))


class TwuStore:
    """A TWU that goes on: one small table of sums per batch at ``path``, added up when read.

    A batch is known by its number. Writing it again replaces what it wrote before, so a batch replayed after a failure changes
    nothing.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def put(self, batch: int, sums: DataFrame) -> None:
        """Store the (item, twu) sums of a batch of receipts that no other batch holds."""
        sums.select("item", "twu").write.mode("overwrite").parquet(f"{self.path}/batch={batch}")

    def read(self) -> DataFrame:
        """(item, twu) over all batches."""
        return merge_twu(self.spark.read.parquet(self.path))


def accumulate_twu(spark: SparkSession, source: str, store: TwuStore, checkpoint: str, scale: int = DEFAULT_SCALE) -> None:
    """Add the receipts of all files that are new in the folder ``source`` to a stored TWU, and stop.

    ``checkpoint`` remembers which files have been read, across runs and sessions. Each batch is summed up by item before it is
    stored; no state is held between batches.
    """
    files = parse_lines(spark.readStream.text(source), scale=scale)
    names = F.array_distinct(F.col("items.item"))
    lines = files.select(F.explode(names).alias("item"), "total_utility")

    def add(batch: DataFrame, number: int) -> None:
        store.put(number, batch.groupBy("item").agg(F.sum("total_utility").alias("twu")))

    query = lines.writeStream.foreachBatch(add).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
