import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

# Fixed value: the sample receipts.
FIXTURE = [
    "# Format: item:quantity:profit item:quantity:profit ... : total_utility",
    "Pain:1:1 Beurre:1:2 :3",
    "# a comment",
    "Pain:1:1 Lait:1:1 Oeufs:1:3 :5",
    "Beurre:1:2 Oeufs:1:3 Dattes:1:50 :55",
    "",
    "Pain:1:1 Oeufs:1:3 :4",
]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .appName("cartyield-tests")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def receipts_file(tmp_path_factory):
    path = tmp_path_factory.mktemp("receipts") / "sample.txt"
    path.write_text("\n".join(FIXTURE) + "\n", encoding="utf-8")
    return str(path)


@pytest.fixture(scope="session")
def items(spark, receipts_file):
    from cartyield import read_transactions

    return read_transactions(spark, receipts_file).cache()


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
