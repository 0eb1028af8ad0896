import random
import re
from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartyield.functions.itemsets import bare_name, itemset_name, size_class
from cartyield.operators import baskets, twu, utility_list
from cartyield.operators.ordering import dense_index, running_sum
from cartyield.plans import queries
from cartyield.plans.queries import mean
from cartyield.plans.workspace import Workspace
from cartyield.sources.generate import ITEM_POOL, generate_transactions
from cartyield.sources.tables import items_from


@pytest.fixture(scope="module")
def one_receipt(spark):
    lines = [(0, 0, "Pain", 1, 1), (0, 1, "Beurre", 1, 2), (0, 2, "Dattes", 1, 50)]
    table = spark.createDataFrame(lines, "tid bigint, pos int, item string, q bigint, p bigint")
    return items_from(table, "tid", "item", quantity="q", profit="p", pos="pos").withColumns(
        {"quantity": F.col("quantity"), "profit": F.col("profit")}
    )


def test_item_utility(spark):
    table = spark.createDataFrame([("Dattes", 2, 50.0)], "item string, q int, p double")
    items = items_from(table, F.lit(1), "item", quantity="q", profit="p")
    assert items.first()["utility"] == 100.0
    with pytest.raises(ValueError, match="utility"):
        items_from(table, F.lit(1), "item", quantity="q")


def test_lookup(one_receipt):
    assert baskets.item_lookup(one_receipt, "Dattes").first()["profit"] == 50
    assert baskets.item_lookup(one_receipt, "Lait").first()["profit"] is None
    assert rows(baskets.item_utility_or_zero(one_receipt, "Dattes")) == [(0, 50)]
    assert rows(baskets.item_utility_or_zero(one_receipt, "Lait")) == [(0, 0)]


def test_contains_all(one_receipt, items):
    assert rows(baskets.contains_all(one_receipt, ["Pain", "Dattes", "Pain"])) == [(0,)]
    assert rows(baskets.contains_all(one_receipt, ["Pain", "Lait"])) == []
    assert rows(baskets.contains_all(items, ["Pain", "Oeufs"])) == [(1,), (3,)]
    assert rows(baskets.contains_all(items, [])) == [(0,), (1,), (2,), (3,)]


def test_remaining_after(items):
    after = baskets.remaining_after(items, ["Pain", "Lait"])
    assert [float(v) for _, v in rows(after)] == [2, 3, 0, 3]


def test_twu_and_rank(items):
    twu_map = twu.twu(items)
    expected = {"Lait": 5, "Pain": 12, "Dattes": 55, "Beurre": 58, "Oeufs": 64}
    assert {r["item"]: r["twu"] for r in twu_map.collect()} == expected
    assert {r["item"]: r["twu"] for r in twu.twu(items, totals="stated").collect()} == expected
    ranks = {r["item"]: r["rank"] for r in twu.item_rank(twu_map, 5).collect()}
    assert ranks == {"Lait": 1, "Pain": 2, "Dattes": 3, "Beurre": 4, "Oeufs": 5}
    assert {r["item"] for r in twu.promising_items(twu_map, 56).collect()} == {"Beurre", "Oeufs"}


def test_twu_counts_a_repeated_item_once(spark):
    lines = [(0, 0, "A", 1), (0, 1, "A", 6), (0, 2, "B", 2)]
    items = spark.createDataFrame(lines, "tid bigint, pos int, item string, utility bigint")
    assert rows(twu.twu(items)) == [("A", 9), ("B", 9)]
    merged = {how: rows(twu.merge_duplicates(items, how)) for how in ("sum", "first", "last")}
    assert [r[0][2] for r in merged.values()] == [7, 1, 6]
    assert merged["sum"] == [(0, "A", 7, 0), (0, "B", 2, 2)]


def test_twu_merges_incrementally(items):
    early, late = items.filter("tid < 2"), items.filter("tid >= 2")
    assert rows(twu.merge_twu(twu.twu(early), twu.twu(late))) == rows(twu.twu(items))
    summed = twu.twu_contributions(items).groupBy("item").agg(F.sum("twu"))
    assert rows(summed) == rows(twu.twu(items))


def test_promising_transactions(items):
    promising = twu.promising_items(twu.twu(items), 56)
    kept = twu.promising_transactions(items, promising)
    totals = {(r["tid"], float(r["total_utility"])) for r in kept.collect()}
    assert totals == {(0, 2.0), (1, 3.0), (2, 5.0), (3, 3.0)}


def test_cost_estimate_and_suggestion(items):
    twu_map = twu.twu(items)
    counts = twu.item_occurrences(items, twu.promising_items(twu_map, 5))
    expected = {"Oeufs": 3, "Pain": 3, "Beurre": 2, "Dattes": 1, "Lait": 1}
    assert {r["item"]: r["occurrences"] for r in counts.collect()} == expected
    assert twu.estimated_entries(counts).first()[0] == 10

    def suggestion(budget):
        return twu.suggest_min_util(twu_map, counts, budget, 5).first()["min_util"]

    assert suggestion(5) == Decimal("55.0001")
    assert suggestion(10) == Decimal(5)


RANKED = {
    "Lait": [(1, 1, 4)],
    "Pain": [(0, 1, 2), (1, 1, 3), (3, 1, 3)],
    "Dattes": [(2, 50, 5)],
    "Beurre": [(0, 2, 0), (2, 2, 3)],
    "Oeufs": [(1, 3, 0), (2, 3, 0), (3, 3, 0)],
}
PRINTED = {
    "Lait": [(1, 1, 3)],
    "Pain": [(0, 1, 2), (1, 1, 4), (3, 1, 3)],
    "Dattes": [(2, 50, 0)],
    "Beurre": [(0, 2, 0), (2, 2, 53)],
    "Oeufs": [(1, 3, 0), (2, 3, 50), (3, 3, 0)],
}


@pytest.mark.parametrize(("remaining", "expected"), [("rank", RANKED), ("position", PRINTED)])
def test_utility_lists(items, remaining, expected):
    lists = utility_list.build_utility_list(items, twu.item_rank(twu.twu(items), 5), remaining)
    found = {}
    for r in lists.orderBy("tid").collect():
        found.setdefault(r["item"], []).append((r["tid"], int(r["iu"]), int(r["ru"])))
    assert found == expected


def test_sums_bounds_and_joins(spark):
    entries = spark.createDataFrame(
        [("D", 0, 50, 5), ("D", 1, 50, 0), ("O", 0, 5, 0)],
        "item string, tid bigint, iu bigint, ru bigint",
    )
    sums = utility_list.itemset_sums(entries)
    assert rows(sums) == [("D", 100, 5, 105, 2), ("O", 5, 0, 5, 1)]
    assert rows(utility_list.high_utility(sums, 100).select("item")) == [("D",)]
    assert rows(utility_list.extendable(sums, 105).select("item")) == [("D",)]
    assert rows(utility_list.prunable(sums, 105).select("item")) == [("O",)]
    assert utility_list.entry_totals(entries).first()["total"] == 55
    d, o = (entries.filter(F.col("item") == i) for i in "DO")
    empty = utility_list.empty_prefix_list(d)
    assert rows(empty) == [(0, 0, 55), (1, 0, 50)]
    assert rows(utility_list.join_utility_lists(d, o, empty)) == [(0, 55, 0)]


def test_names(spark):
    df = spark.createDataFrame([(["Oeufs", "Dattes"],)], "i array<string>")
    name = df.select(itemset_name("i").alias("n"))
    assert name.first()[0] == "{Dattes, Oeufs}"
    assert name.select(bare_name("n")).first()[0] == "Dattes, Oeufs"
    classes = spark.range(1, 5).select(size_class("id"))
    assert [r[0] for r in classes.collect()] == ["single", "pair", "large", "large"]


def test_global_order_over_many_partitions(spark):
    values = spark.range(0, 1000, 1, 9).select((F.col("id") * 7919 % 1000).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        indexed = dense_index(values, "n", [F.desc("v")], start=1).collect()
        summed = running_sum(values, "v", "s", [F.col("v")]).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert {(r["v"], r["n"]) for r in indexed} == {(999 - i, i + 1) for i in range(1000)}
    assert {(r["v"], r["s"]) for r in summed} == {(i, i * (i + 1) // 2) for i in range(1000)}


def test_generated_receipts(spark):
    made = generate_transactions(spark.range(0, 2000, 1, 3), tid="id").collect()
    ranges = {name: (low, high) for name, low, high in ITEM_POOL}
    receipts = {}
    for r in made:
        low, high = ranges[r["item"]]
        assert low <= float(r["profit"]) <= high
        assert 1 <= r["quantity"] <= 5
        assert r["utility"] == r["quantity"] * r["profit"]
        receipts.setdefault(r["tid"], []).append(r)
    assert len(receipts) == 2000
    for lines in receipts.values():
        assert len({r["item"] for r in lines}) == len(lines)
        assert sum(r["utility"] for r in lines) == lines[0]["total_utility"]
    assert {len(lines) for lines in receipts.values()} == {1, 2, 3, 4, 5, 6}
    assert {r["item"] for r in made} == set(ranges)
    again = generate_transactions(spark.range(0, 2000, 1, 5), tid="id")
    assert rows(again) == sorted((tuple(r) for r in made), key=repr)
    other = generate_transactions(spark.range(0, 2000, 1, 3), seed=7, tid="id")
    assert rows(other) != rows(again)


def test_lists_held_by_receipts(spark):
    rng = random.Random(6)
    receipts = {t: set(rng.sample("ABCDEFGH", rng.randint(1, 6))) for t in range(60)}
    lists = {k: set(rng.sample("ABCDEFGHZ", rng.randint(1, 4))) for k in range(30)} | {90: {"Z"}, 91: {"A", "B"}, 92: {"A", "B"}}
    lines = [(t, i) for t, held in receipts.items() for i in held] * 2 + [(1, None), (None, "A")]
    wanted = [(k, i) for k, names in lists.items() for i in names] + [(91, "A"), (93, None)]
    items = spark.createDataFrame(lines, "tid bigint, item string")
    found = baskets.contains_lists(items, spark.createDataFrame(wanted, "list_id int, item string"))
    expected = [(k, t) for k, names in lists.items() for t, held in receipts.items() if names <= held]
    assert rows(found) == sorted(expected, key=repr)
    assert baskets.contains_lists(items, spark.createDataFrame([], "list_id int, item string")).count() == 0
    assert baskets.contains_lists(items.limit(0), spark.createDataFrame(wanted, "list_id int, item string")).count() == 0


def test_mean_of_amounts_whose_sum_exceeds_bigint(spark):
    large = (1 << 63) - 1
    table = spark.createDataFrame([(large,), (large,), (large - 3,), (None,)], "twu bigint")
    assert mean(table, "twu") == large - 1


def test_partitions_by_receipt_are_not_put_together(spark, items):
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert twu.twu_contributions(items).rdd.getNumPartitions() == wanted > 1
    assert "REPARTITION_BY_NUM" in twu.twu_units(items)._jdf.queryExecution().executedPlan().toString()


SMALL = "/root/testdata/sf0.001"


def shuffled_by_item(df):
    """Whether lines are shuffled by receipt and item after they have been brought together by receipt."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    return re.search(r"hashpartitioning\(tid#\w+, item#", plan) is not None


def test_merged_twu_takes_lines_by_receipt(spark):
    assert not shuffled_by_item(queries.twu_merge(spark, SMALL))


def test_stated_twu_takes_lines_by_receipt(spark):
    assert not shuffled_by_item(queries.twu_stated(spark, SMALL))


def test_stated_items_are_in_partitions_by_receipt(spark):
    wanted = int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert queries.stated_items(spark, SMALL).rdd.getNumPartitions() == wanted > 1


def test_orders_are_joined_without_sorting(spark):
    plan = queries.stated_items(spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan


def test_lists_are_looked_for_once_in_receipts_alike(spark):
    kinds = ["AB", "ABC", "C", "BD", "ABZ"]
    lines = [(t, i) for t in range(100) for i in kinds[t % 5]]
    lists = {0: "A", 1: "AB", 2: "ABC", 3: "BD", 4: "AD"}
    wanted = [(k, i) for k, names in lists.items() for i in names]
    with Workspace(spark) as workspace:
        items = spark.createDataFrame(lines, "tid bigint, item string")
        found = baskets.contains_lists(items, spark.createDataFrame(wanted, "list_id int, item string"), workspace)
        assert rows(found) == sorted([(k, t) for k, names in lists.items() for t in range(100) if set(names) <= set(kinds[t % 5])], key=repr)
        looked_at = spark.read.parquet(workspace._paths["held"])
        # AB and ABZ are alike, as no list has Z.
        assert sorted(r["tid"] for r in looked_at.select("tid").distinct().collect()) == [0, 1, 2, 3]
