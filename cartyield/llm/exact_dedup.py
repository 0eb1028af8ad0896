"""Exact deduplication against a persistent index of text digests.

The index is a Parquet table bucketed and sorted by digest. New documents shrink to one row per
digest, are compared with the index by a sort-merge anti-join that shuffles only the new side,
and what is new is appended. A text already known stays represented by the row known first.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.workspace import Workspace, workspace_for


class DigestIndex:
    """The digests seen so far, at ``path``; the same path can be opened by later sessions.

    Args:
        path: a folder every executor can reach.
        id_type: SQL type of the documents' ids.
        buckets: number of buckets, fixed when the index is made: as many as shuffle partitions then unless given. The number
            lies beside the data, so that any session opens the index with it; asking for another one is an error.
    """

    def __init__(self, spark: SparkSession, path: str, id_type: str = "bigint", buckets: int | None = None):
        self.spark = spark
        self.path = path
        self.buckets = self._fixed(buckets)
        self.table = f"digest_index_{hashlib.md5(path.encode()).hexdigest()}"
        spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.table} (digest binary, keep_id {id_type}, group_size bigint) "
            f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {self.buckets} BUCKETS LOCATION '{path}'"
        )

    def _fixed(self, wanted: int | None) -> int:
        """The number of buckets named by a marker file of the index, which is made with the index."""
        jvm, mark = self.spark._jvm, "_buckets-"
        folder = jvm.org.apache.hadoop.fs.Path(self.path)
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        names = [f.getPath().getName() for f in files.listStatus(folder)] if files.exists(folder) else []
        marks = [int(name.removeprefix(mark)) for name in names if name.startswith(mark)]
        if marks:
            if wanted not in (None, marks[0]):
                raise ValueError(f"the index at {self.path} has {marks[0]} buckets, not {wanted}")
            return marks[0]
        if any(name.endswith(".parquet") for name in names) and wanted is None:
            raise ValueError(f"the index at {self.path} does not say how many buckets it has")
        wanted = wanted or int(self.spark.conf.get("spark.sql.shuffle.partitions"))
        files.create(jvm.org.apache.hadoop.fs.Path(folder, f"{mark}{wanted}"), True).close()
        return wanted

    def entries(self) -> DataFrame:
        """(digest, keep_id, group_size), read without regard to buckets.

        A join with these rows can then be dealt out anew where a digest is very frequent.
        """
        schema = self.spark.table(self.table).schema
        return self.spark.read.schema(schema).parquet(self.path)

    def unseen(self, groups: DataFrame) -> DataFrame:
        """The rows of ``groups`` whose digest the index lacks."""
        return groups.join(self.spark.table(self.table).select("digest").hint("merge"), "digest", "left_anti")

    def append(self, groups: DataFrame) -> None:
        """Add groups (digest, keep_id, group_size) that are not in the index yet."""
        self.unseen(groups).select("digest", "keep_id", "group_size").write.insertInto(self.table)


def digest(text: F.Column) -> F.Column:
    """SHA-256 of the text in UTF-8 as 32 bytes; null counts as empty."""
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def exact_dedup(
    docs: DataFrame,
    index: DigestIndex | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256), one row per row of ``docs``.

    Of equal texts the row with the largest id stays, unless an earlier batch brought the text into
    ``index``: then its row stays and no new one does. ``group_size`` counts the rows of the batch
    that brought the text in. Null texts count as empty; null ids are smaller than all others. Rows
    that share id and text are all marked alike. Other columns are not looked at. No rows give none.
    """
    workspace = workspace_for(docs, workspace)
    id_type = docs.schema[id_col].dataType.simpleString()
    new_index = index is None
    if new_index:
        index = DigestIndex(docs.sparkSession, workspace.path("digest-index"), id_type)
    hashed = workspace.store(
        docs.select(F.col(id_col).alias("_id"), digest(F.col(text_col)).alias("digest")), "digests"
    )
    groups = hashed.groupBy("digest").agg(
        F.max("_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")
    )
    # Stored, since the optimizer would else compare all rows with the index before they are grouped.
    groups = workspace.store(groups, "groups")
    fresh = None if new_index else workspace.store(index.unseen(groups).select("digest", F.lit(True).alias("_new")), "new")
    index.append(groups)
    marked = hashed.join(index.entries(), "digest")
    if fresh is None:
        new = F.lit(True)
    else:
        marked, new = marked.join(fresh, "digest", "left"), F.coalesce("_new", F.lit(False))
    return marked.select(
        F.col("_id").alias(id_col),
        "keep_id",
        "group_size",
        (new & F.col("_id").eqNullSafe(F.col("keep_id"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )
