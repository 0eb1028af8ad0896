"""Compare queries with their SQL: ``python tests/oracle_check.py [folder] [query …]``."""

import sys
import time
from pathlib import Path

import duckdb
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
import __spark_entry__ as contract  # noqa: E402

TABLES = ("lineitem", "orders", "part", "documents", "embeddings")
SQL_TYPES = {"boolean": "boolean", "bigint": "bigint", "int": "integer", "string": "varchar", "double": "double"}


def normal(rows):
    return sorted((tuple(row) for row in rows), key=repr)


def connect(folder: str):
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return db


def compare(spark: SparkSession, db, folder: str, name: str) -> str | None:
    """None if query and SQL agree on columns, types of values and all rows, else what differs."""
    df = contract.queries()[name](spark, folder)
    columns = sorted(df.columns)
    ours = normal(df.select(*(f"`{c}`" for c in columns)).collect())
    result = db.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]).lower() for d in result.description}
    rows = result.fetchall()
    wanted = {c: SQL_TYPES[t] for c, t in df.dtypes}
    if types != wanted:
        return f"columns {wanted} and {types}"
    if not rows:
        return "no rows to compare"
    order = [names.index(c) for c in columns]
    theirs = normal(tuple(row[i] for i in order) for row in rows)
    if ours == theirs:
        return None
    differing = [(a, b) for a, b in zip(ours, theirs, strict=False) if repr(a) != repr(b)]
    return f"{len(ours)} and {len(theirs)} rows, first difference {differing[:1]}"


if __name__ == "__main__":
    folder = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.001"
    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    db, failed = connect(folder), 0
    for name in sys.argv[2:] or contract.oracle_sql():
        started = time.monotonic()
        try:
            problem = compare(spark, db, folder, name)
        except Exception as error:  # report all queries, whatever happens to one
            problem = f"{type(error).__name__}: {str(error)[:600]}"
        failed += problem is not None
        print(f"{name:28} {time.monotonic() - started:6.1f}s {problem or 'ok'}", flush=True)
    print("failed:", failed)
