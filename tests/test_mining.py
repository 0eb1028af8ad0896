import itertools
import random

import pytest
from conftest import rows
from pyspark.sql import functions as F

from cartyield import ENDPOINTS, EXACT, mine
from cartyield.operators import mining, results, twu, utility_list
from cartyield.operators.mining import mine_top
from cartyield.plans.workspace import Workspace

EXACT_AT_5 = {
    "{Beurre, Dattes, Oeufs}": (55, 1),
    "{Dattes, Oeufs}": (53, 1),
    "{Beurre, Dattes}": (52, 1),
    "{Dattes}": (50, 1),
    "{Oeufs}": (9, 3),
    "{Oeufs, Pain}": (8, 2),
    "{Beurre, Oeufs}": (5, 1),
    "{Lait, Oeufs, Pain}": (5, 1),
}
ENDPOINTS_AT_5 = {**EXACT_AT_5, "{Beurre, Dattes, Oeufs}": (53, 1)}
del ENDPOINTS_AT_5["{Lait, Oeufs, Pain}"]


def found(run):
    return {r["itemset_name"]: (int(r["utility"]), r["transactions"]) for r in run.itemsets.collect()}


@pytest.mark.parametrize(
    ("mode", "expected", "nodes"), [(EXACT, EXACT_AT_5, 19), (ENDPOINTS, ENDPOINTS_AT_5, 12)]
)
def test_fixture(items, mode, expected, nodes):
    run = mine(items, 5, mode)
    assert found(run) == expected
    assert run.stats().first().asDict() == {
        "twu_candidates": 5,
        "promising_items": 5,
        "estimated_utility_entries": 10,
        "utility_lists_built": 5,
        "dfs_nodes_explored": nodes,
        "huis_found": len(expected),
        "total_transactions": 4,
    }


@pytest.mark.parametrize(
    ("limit", "exact", "endpoints"), [(9, 5, 5), (50, 4, 4), (55, 1, 0), (1000, 0, 0), (4.5, 8, 7)]
)
def test_thresholds(items, limit, exact, endpoints):
    assert mine(items, limit).itemsets.count() == exact
    assert mine(items, limit, ENDPOINTS).itemsets.count() == endpoints


@pytest.mark.parametrize("limit", [0, -1, float("nan")])
def test_threshold_must_be_positive(items, limit):
    with pytest.raises(ValueError, match="positive"):
        mine(items, limit)


def test_no_receipts(spark):
    empty = spark.createDataFrame([], "tid bigint, pos int, item string, utility bigint")
    for mode in (EXACT, ENDPOINTS):
        run = mine(empty, 5, mode)
        assert run.itemsets.count() == 0
        assert run.stats().first()["dfs_nodes_explored"] == 0


def test_double_utilities(spark, items):
    doubles = items.withColumn("utility", F.col("utility").cast("double"))
    assert found(mine(doubles, 5)) == EXACT_AT_5


def make(seed, receipts=25, names="ABCDEFG", longest=7, losses=False):
    rng = random.Random(seed)
    lines = []
    for tid in range(receipts):
        basket = rng.sample(names, rng.randint(1, longest))
        for pos, item in enumerate(basket):
            lines.append((tid, pos, item, rng.randint(-9 if losses else 1, 30)))
    return lines


def frame(spark, lines):
    return spark.createDataFrame(lines, "tid bigint, pos int, item string, utility bigint")


def brute_force(lines, limit):
    receipts = {}
    for tid, _, item, utility in lines:
        receipts.setdefault(tid, {}).setdefault(item, 0)
        receipts[tid][item] += utility
    names = sorted({item for _, _, item, _ in lines})
    result = {}
    for size in range(1, len(names) + 1):
        for itemset in itertools.combinations(names, size):
            holding = [r for r in receipts.values() if all(i in r for i in itemset)]
            utility = sum(r[i] for r in holding for i in itemset)
            if holding and utility >= limit:
                result["{" + ", ".join(itemset) + "}"] = (utility, len(holding))
    return result


@pytest.mark.parametrize(("seed", "losses"), [(1, False), (2, True)])
def test_against_brute_force(spark, seed, losses):
    lines = make(seed, losses=losses)
    limit = sum(max(line[3], 0) for line in lines) // 8
    assert found(mine(frame(spark, lines), limit)) == brute_force(lines, limit)


def test_repeated_items_are_added_up(spark):
    lines = [(0, 0, "A", 1), (0, 1, "B", 2), (0, 2, "A", 6), (1, 0, "A", 2)]
    assert found(mine(frame(spark, lines), 2)) == brute_force(lines, 2)
    first = found(mine(frame(spark, lines), 1, duplicates="first"))
    assert first == {"{A}": (3, 2), "{B}": (2, 1), "{A, B}": (3, 1)}
    last = found(mine(frame(spark, lines), 1, duplicates="last"))
    assert last["{A, B}"] == (8, 1)


def test_every_way_of_running_gives_the_same(spark, monkeypatch):
    lines = make(5, receipts=30)
    limit = sum(line[3] for line in lines) // 8
    expected = brute_force(lines, limit)
    plain = found(mine(frame(spark, lines), limit, ENDPOINTS))
    shuffled = frame(spark, random.Random(0).sample(lines, len(lines))).repartition(5)
    assert found(mine(shuffled, limit)) == expected
    monkeypatch.setattr(mining, "SPLIT_ITEMS", 2)
    assert found(mine(frame(spark, lines), limit)) == expected
    assert found(mine(frame(spark, lines), limit, ENDPOINTS)) == plain


def test_without_broadcasts(spark):
    lines = make(6, receipts=30)
    limit = sum(line[3] for line in lines) // 8
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert found(mine(frame(spark, lines), limit)) == brute_force(lines, limit)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_endpoints_are_contained_in_exact(spark):
    lines = make(9, receipts=40)
    limit = sum(line[3] for line in lines) // 15
    exact = found(mine(frame(spark, lines), limit))
    other = found(mine(frame(spark, lines), limit, ENDPOINTS))
    assert other
    for name, (utility, support) in other.items():
        assert exact[name][1] == support
        assert utility <= exact[name][0]
        if name.count(",") < 2:
            assert utility == exact[name][0]


def test_higher_threshold_gives_a_subset(spark):
    items = frame(spark, make(11))
    low, high = (rows(mine(items, limit).itemsets.drop("itemset")) for limit in (400, 600))
    assert set(high) < set(low)
    assert {r for r in low if r[1] >= 600} == set(high)


def test_one_receipt_with_most_lines(spark, monkeypatch):
    """A third of all lines in one receipt, of cheap items that reach no threshold on their own."""
    monkeypatch.setattr(mining, "SPLIT_ITEMS", 8)
    names = [f"i{n:02d}" for n in range(60)]
    lines = [(0, n, name, 1) for n, name in enumerate(names)]
    rng = random.Random(3)
    for tid in range(1, 41):
        for pos, name in enumerate(rng.sample(names, 3)):
            lines.append((tid, pos, name, rng.randint(1, 50)))
    limit = 120
    receipts = {}
    for tid, _, item, utility in lines:
        receipts.setdefault(tid, {})[item] = utility
    expected = {}
    for size in (1, 2, 3):
        for itemset in itertools.combinations(names, size):
            holding = [r for r in receipts.values() if all(i in r for i in itemset)]
            utility = sum(r[i] for r in holding for i in itemset)
            if utility >= limit:
                expected["{" + ", ".join(itemset) + "}"] = (utility, len(holding))
    assert found(mine(frame(spark, lines), limit)) == expected


def test_only_small_tables_are_left(spark, items, tmp_path):
    workspace = mining.Workspace(spark)
    workspace.base = str(tmp_path / "run")
    run = mine(items, 5, workspace=workspace)
    left = {path.name.split("-", 1)[1] for path in (tmp_path / "run").iterdir()}
    small = {"receipts", "twu", "ranks"}
    assert left == small | {"nodes-1", "nodes-2", "nodes-3", "nodes-4"}
    assert found(run) == EXACT_AT_5
    workspace.close()
    assert not (tmp_path / "run").exists()
    assert not [t for t in spark.catalog.listTables() if workspace.id in t.name]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_sums_beyond_bigint(spark, ansi):
    big = 5 * 10**18
    lines = [(0, 0, "A", big), (1, 1, "A", big), (1, 0, "B", 7)]
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        for mode in (EXACT, ENDPOINTS):
            run = mine(frame(spark, lines), 10, mode)
            expected = {"{A}": (2 * big, 2), "{A, B}": (big + 7, 1)}
            assert found(run) == expected
            summary = results.summary_stats(run.itemsets).first()
            assert summary["max_utility"] == 2 * big
            assert summary["avg_utility"] == pytest.approx((3 * big + 7) / 2)
        with pytest.raises(Exception, match="exceed BIGINT"):
            mine(frame(spark, [(0, 0, "A", big), (0, 1, "B", big)]), 10)
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("stated", [None, 0])
def test_missing_stated_totals_are_added_up(spark, stated):
    lines = spark.createDataFrame(
        [(0, 0, "A", 50, stated), (0, 1, "B", 5, stated)],
        "tid bigint, pos int, item string, utility bigint, total_utility bigint",
    )
    assert found(mine(lines, 10, ENDPOINTS)) == {"{A}": (50, 1), "{A, B}": (55, 1)}


def test_counters_leave_out_what_mining_does(spark):
    lines = spark.createDataFrame(
        [(0, 0, "A", 9, 9), (1, 0, None, 9, 9), (None, 0, "B", 9, 9)],
        "tid bigint, pos int, item string, utility bigint, total_utility bigint",
    )
    for mode in (EXACT, ENDPOINTS):
        counters = mine(lines, 5, mode).stats().first()
        assert counters["twu_candidates"] == counters["promising_items"] == 1
        assert counters["total_transactions"] == 1


def test_nothing_pruned_has_a_result(spark):
    """With losses too, an item below the bound is the first of no itemset found."""
    rng = random.Random(4)
    names = "ABCDEF"
    lines = [(t, n, i, rng.randint(-20, 20)) for t in range(15) for n, i in enumerate(rng.sample(names, 4))]
    items = frame(spark, lines)
    limit = 30
    ranks = twu.item_rank(twu.twu(items), 1)
    order = {r["item"]: r["rank"] for r in ranks.collect()}
    sums = utility_list.itemset_sums(utility_list.build_utility_list(items, ranks))
    pruned = {r["item"] for r in utility_list.prunable(sums, limit).collect()}
    firsts = {
        min(r["itemset"], key=order.get) for r in mine(items, limit).itemsets.collect()
    }
    assert firsts and pruned
    assert not pruned & firsts


@pytest.mark.parametrize(("seed", "losses"), [(41, False), (42, True)])
def test_top_itemsets_without_a_threshold(spark, seed, losses):
    lines = make(seed, receipts=40, losses=losses)
    everything = brute_force(lines, 1)
    best = sorted(everything.items(), key=lambda e: (-e[1][0], e[0]))
    for count in (1, 12):
        assert found(mine_top(frame(spark, lines), count)) == dict(best[:count])
    top = mine_top(frame(spark, lines), 12)
    assert top.stats().first()["dfs_nodes_explored"] < mine(frame(spark, lines), 1).stats().first()["dfs_nodes_explored"]
    with pytest.raises(ValueError, match="positive"):
        mine_top(frame(spark, lines), 0)


def test_fewer_itemsets_than_asked_for(spark):
    lines = [(0, 0, "A", 5), (0, 1, "B", -2), (1, 0, "C", 1)]
    assert found(mine_top(frame(spark, lines), 100)) == brute_force(lines, 1)
    empty = spark.createDataFrame([], "tid bigint, pos int, item string, utility bigint")
    assert mine_top(empty, 3).itemsets.count() == 0


@pytest.mark.parametrize("mode", [EXACT, ENDPOINTS])
def test_receipts_are_made_into_arrays_once(spark, monkeypatch, mode):
    """However many levels there are, and nothing of them is left behind."""
    written, store = [], Workspace.store

    def seen(self, df, name):
        written.append(name)
        return store(self, df, name)

    monkeypatch.setattr(Workspace, "store", seen)
    rows = [(tid, k, f"i{k}", 5 + k) for tid in range(6) for k in range(5)]
    items = spark.createDataFrame(rows, "tid bigint, pos bigint, item string, utility bigint")
    with Workspace(spark) as workspace:
        assert mine(items, 1, mode, workspace=workspace).itemsets.count() == 31
        assert written.count("baskets") == 1 and "nodes-4" in written
        assert not {"baskets", "utility-list", "lines"} & (set(workspace._paths) | set(workspace._tables))
