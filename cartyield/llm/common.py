"""What the corpus operators share: reading tables, row identity and word counts."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.workspace import Workspace

WORD = r"[^\x20\x09-\x0D]+"


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, which need not have it installed."""
    application = spark.sparkContext.applicationId
    if application in _shipped:
        return
    package = Path(__file__).resolve().parents[1]
    archive = f"{tempfile.mkdtemp(prefix='cartyield-')}/{package.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(package.rglob("*.py")):
            packed.write(source, source.relative_to(package.parent))
    spark.sparkContext.addPyFile(archive)
    _shipped.add(application)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def identified(docs: DataFrame, workspace: Workspace) -> tuple[DataFrame, str]:
    """``docs`` with an identity for each row, so that repeated and null ids stay apart, and its column.

    Rows of files are known by their file and place in it, which any later scan finds again. Others are
    stored with numbers first.
    """
    name, taken = "_row", {c.lower() for c in docs.columns}
    while name in taken:
        name += "_"
    try:
        metadata = docs.metadataColumn("_metadata")
        return docs.withColumn(name, F.struct(metadata["file_path"], metadata["row_index"])), name
    except AnalysisException:
        numbered = docs.withColumn(name, F.struct(F.monotonically_increasing_id()))
        return workspace.store(numbered, "documents"), name


def remainder(doc_id: Column, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus``; a null id counts as empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % modulus


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")
