"""Tables a job writes between its stages.

A mining run is a chain of Spark jobs, each reading what the one before it wrote.
Written tables cut the lineage and outlive the executors that made them, and their
real size on disk lets Spark itself decide what is small enough to broadcast.
"""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder named by the session; a temporary one only in local mode."""
    root = spark.conf.get(CHECKPOINT_DIR, None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors can reach")
    return tempfile.mkdtemp(prefix="cartyield-")


class Workspace:
    """One run's folder of intermediate tables below the checkpoint folder.

    Results that are read lazily need the tables they read; ``close`` deletes the folder once they are
    written elsewhere. It may be used in a ``with`` statement.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.id = uuid.uuid4().hex
        self.base = f"{checkpoint_root(spark)}/cartyield-{self.id}"
        self._paths: dict[str, str] = {}
        self._tables: dict[str, str] = {}
        self._count = 0

    def __enter__(self) -> Workspace:
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def path(self, name: str) -> str:
        """A new path for the table ``name``; a later one replaces an earlier one."""
        self._count += 1
        self._paths[name] = f"{self.base}/{self._count:03d}-{name}"
        return self._paths[name]

    def store(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` as Parquet and return it as read back."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def store_clustered(self, df: DataFrame, name: str, key: str) -> DataFrame:
        """Like ``store``, with the rows of a key in one bucket: joins and windows on it need no shuffle."""
        path = self.path(name)
        table = f"cartyield_{self.id}_{self._count}"
        buckets = int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        clustered = df.repartition(buckets, key)
        clustered.write.bucketBy(buckets, key).sortBy(key).option("path", path).saveAsTable(table)
        self._tables[name] = table
        return self.spark.table(table)

    def discard(self, name: str) -> None:
        """Delete a stored table that nothing will read again."""
        if name in self._tables:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._tables.pop(name)}")
        self._delete(self._paths.pop(name))

    def close(self) -> None:
        """Delete all tables of the run."""
        for table in self._tables.values():
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
        self._tables.clear()
        self._paths.clear()
        self._delete(self.base)

    def _delete(self, path: str) -> None:
        path = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def workspace_for(df: DataFrame, workspace: Workspace | None = None) -> Workspace:
    return workspace or Workspace(df.sparkSession)
