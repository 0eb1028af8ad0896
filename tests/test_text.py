from decimal import Decimal
from pathlib import Path

import pytest
from conftest import rows
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from cartyield.operators.mining import EXACT
from cartyield.plans import queries
from cartyield.plans.workspace import Workspace
from cartyield.sinks.text import plain_number, render_lines, write_transactions
from cartyield.sources.text import explode_items, parse_lines, read_transactions


def parse(spark, line):
    found = parse_lines(spark.createDataFrame([(line,)], "value string")).collect()
    if not found:
        return None
    items = [(i["item"], i["quantity"], float(i["profit"])) for i in found[0]["items"]]
    return items, float(found[0]["total_utility"])


@pytest.mark.parametrize(
    ("line", "expected"),
    [
        ("Pain:1:1 Beurre:1:2 :3", ([("Pain", 1, 1), ("Beurre", 1, 2)], 3)),
        ("  \t Pain:1:1  Beurre:1:2\t:3  ", ([("Pain", 1, 1), ("Beurre", 1, 2)], 3)),
        ("Pain:1:1 Beurre:1:2\x1c:3　", ([("Pain", 1, 1), ("Beurre", 1, 2)], 3)),
        ("# This is a comment", None),
        ("#Pain:1:1 Lait:1:1", None),
        ("  # Pain:1:1 Lait:1:1", None),
        ("", None),
        ("   ", None),
        ("Pain:1:1", None),
        (" Pain:1:1 ", None),
        ("Pain:1:1 Lait:2:3", ([("Pain", 1, 1), ("Lait", 2, 3)], 7)),
        ("Pain:1:1 Lait:2:3 :0", ([("Pain", 1, 1), ("Lait", 2, 3)], 7)),
        ("Pain:1:1 :99", ([("Pain", 1, 1)], 99)),
        (":99 Pain:1:1", ([("Pain", 1, 1)], 99)),
        ("Pain:1:1 :4 :9", ([("Pain", 1, 1)], 9)),
        ("Pain:1:1 :4 :x", ([("Pain", 1, 1)], 4)),
        ("Pain:1:1 :4 :", ([("Pain", 1, 1)], 4)),
        ("Pain:1:1 :1:2", ([("Pain", 1, 1)], 1)),
        ("Pain:1.5:1 Lait:1:2 :2", ([("Lait", 1, 2)], 2)),
        ("Pain:1:x Lait:1:2 :2", ([("Lait", 1, 2)], 2)),
        ("Pain:1 Lait:1:2:3 foo :5", None),
        ("Pain:1:1 foo", ([("Pain", 1, 1)], 1)),
        ("A:1:2 #b:1:3 :5", ([("A", 1, 2), ("#b", 1, 3)], 5)),
        ("A:1:nan :3", None),
        ("A:1:1_0 B:1:1.0d C:1:1 :3", ([("C", 1, 1)], 3)),
        ("A:-2:1.5 B:+1:-.5 :1", ([("A", -2, 1.5), ("B", 1, -0.5)], 1)),
        ("A:1:1e1 B:1:2. :1.2E1", ([("A", 1, 10), ("B", 1, 2)], 12)),
        ("Pâté:1:1 Œufs:2:0.25 :1.5", ([("Pâté", 1, 1), ("Œufs", 2, 0.25)], 1.5)),
        ("A:1:1 A:2:3 B:1:2 :9", ([("A", 1, 1), ("A", 2, 3), ("B", 1, 2)], 9)),
    ],
)
def test_parse_rules(spark, line, expected):
    assert parse(spark, line) == expected


def test_number_out_of_range_is_an_error(spark):
    with pytest.raises(PySparkException):
        parse(spark, "A:99999999999999999999:1 :5")
    with pytest.raises(PySparkException):
        parse(spark, "A:1:1e30 :5")


def test_read_numbers_receipts_in_order(spark, items):
    first = [(r["tid"], r["pos"], r["item"]) for r in items.orderBy("tid", "pos").collect()]
    assert first == [
        (0, 0, "Pain"),
        (0, 1, "Beurre"),
        (1, 0, "Pain"),
        (1, 1, "Lait"),
        (1, 2, "Oeufs"),
        (2, 0, "Beurre"),
        (2, 1, "Oeufs"),
        (2, 2, "Dattes"),
        (3, 0, "Pain"),
        (3, 1, "Oeufs"),
    ]
    totals = {r["tid"]: r["total_utility"] for r in items.collect()}
    assert totals == {0: Decimal(3), 1: Decimal(5), 2: Decimal(55), 3: Decimal(4)}


def test_missing_file_is_an_error(spark):
    with pytest.raises(PySparkException):
        read_transactions(spark, "/nowhere/receipts.txt")


def test_other_columns_are_kept(spark):
    lines = spark.createDataFrame([(7, "A:1:2 :2"), (8, "")], "tid bigint, value string")
    assert rows(explode_items(parse_lines(lines)).select("tid", "item")) == [(7, "A")]


def test_write_and_read_back(spark, items, tmp_path):
    path = str(tmp_path / "receipts")
    write_transactions(items, path)
    assert rows(read_transactions(spark, path)) == rows(items)
    assert [r["value"] for r in render_lines(items).orderBy("tid").collect()] == [
        "Pain:1:1 Beurre:1:2 :3",
        "Pain:1:1 Lait:1:1 Oeufs:1:3 :5",
        "Beurre:1:2 Oeufs:1:3 Dattes:1:50 :55",
        "Pain:1:1 Oeufs:1:3 :4",
    ]


def test_ids_are_dense_over_many_partitions(spark, tmp_path):
    lines = spark.range(0, 500, 1, 7).selectExpr("concat('A:', id, ':1 :', id + 1) AS value")
    lines.write.text(str(tmp_path / "many"))
    read = read_transactions(spark, str(tmp_path / "many"))
    assert sorted(r["tid"] for r in read.collect()) == list(range(500))


def test_ids_follow_files_and_lines_without_a_copy(spark, tmp_path):
    """One long file in many splits, short files, one without receipts; only counts are written."""
    folder, base = tmp_path / "in", tmp_path / "run"
    folder.mkdir()
    names = []
    for file, count in [("a.txt", 3), ("b.txt", 4000), ("c.txt", 0), ("d.txt", 5)]:
        lines = ["# comment", ""]
        for k in range(count):
            lines += [f"{file[0]}{k}:1:2 other:1:1 :3"] + ["no receipt"] * (k % 3)
            names.append(f"{file[0]}{k}")
        (folder / file).write_text("\n".join(lines) + "\n")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
    try:
        workspace = Workspace(spark)
        workspace.base = str(base)
        found = read_transactions(spark, str(folder), workspace=workspace).filter("pos = 0")
        assert found.rdd.getNumPartitions() > 4
        assert [r["item"] for r in sorted(found.collect(), key=lambda r: r["tid"])] == names
        assert sorted(r["tid"] for r in found.collect()) == list(range(len(names)))
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert [p.name.split("-", 1)[1] for p in base.iterdir()] == ["splits-tid"]
    assert spark.read.parquet(*map(str, base.iterdir())).count() < 40
    with pytest.raises(Exception, match="dealt out anew"):
        found.select("tid").collect()


def test_plain_numbers_of_any_scale(spark):
    small = spark.sql("SELECT 0.0000 a, 900.1000 b, 30.0000 c, CAST(100 AS decimal(10,0)) d, CAST('1.5E-10' AS decimal(20,12)) e, -0.5000 f")
    printed = small.select(*(plain_number(F.col(c)) for c in small.columns)).first()
    assert list(printed)[:4] == ["0", "900.1", "30", "100"] and Decimal(printed[4]) == Decimal("1.5E-10") and printed[5] == "-0.5"


def test_lines_are_stored_before_they_are_sorted(spark, items, tmp_path, monkeypatch):
    stored, store = [], Workspace.store
    monkeypatch.setattr(Workspace, "store", lambda self, df, name: stored.append(store(self, df, name)) or stored[-1])
    path = str(tmp_path / "receipts")
    write_transactions(items, path)
    assert [sorted(df.columns) for df in stored] == [["body", "tid", "value"]]
    assert not Path(stored[0].inputFiles()[0].removeprefix("file://")).exists()
    assert spark.read.text(path).count() == 5


def test_a_run_of_text_looks_at_the_lines_once(spark, monkeypatch):
    """The threshold is a share of what is written, so it is added up while writing."""
    calls, lines = [], queries.lines_with_part
    monkeypatch.setattr(queries, "lines_with_part", lambda *a: calls.append(a) or lines(*a))
    monkeypatch.setattr(queries, "run", lambda spark, path, limit, mode: limit)
    limit = queries.run_of_text(spark, "/root/testdata/sf0.001", EXACT)
    assert len(calls) == 1
    assert limit == int(queries.sold_lines(spark, "/root/testdata/sf0.001").agg(F.sum("utility")).first()[0]) // queries.SHARE
