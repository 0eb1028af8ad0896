import random

import pytest
from pyspark.sql import functions as F
from test_mining import brute_force, found, frame, make

from cartyield import ENDPOINTS, mine
from cartyield.operators import mining, projection
from cartyield.operators.ordering import segmented_max_before, segmented_sum
from cartyield.operators.search_size import search_size
from cartyield.operators.twu import item_rank, twu
from cartyield.operators.utility_list import build_utility_list
from conftest import rows

PROJECTED = (
    "node bigint, up bigint, last bigint, base bigint, ru bigint, n bigint, "
    "items array<struct<rank:bigint,u:bigint,ru:bigint>>"
)


def projected(spark, seed=1, count=400):
    rng = random.Random(seed)
    out = []
    for _ in range(count):
        node = rng.randrange(5)
        ranks = sorted(rng.sample(range(10, 15), rng.randint(1, 5)))
        items = [(r, rng.randint(-5, 20), rng.randint(0, 30)) for r in ranks]
        out.append((node, 0, node, rng.randint(0, 9), rng.randint(0, 50), rng.randint(1, 3), items))
    return spark.createDataFrame(out, PROJECTED)


def sums(candidates):
    return rows(candidates.groupBy("prefix", "last").agg(F.sum("iu"), F.sum("ru"), F.sum("reach"), F.sum("n")))


@pytest.mark.parametrize("longest", [1, 3, 8])
def test_merging_changes_no_sum(spark, longest):
    whole = projected(spark)
    merged = projection.merged(whole, longest)
    assert sums(projection.candidates(merged)) == sums(projection.candidates(whole))
    assert merged.count() < whole.count()
    assert merged.schema["items"].dataType == whole.schema["items"].dataType
    left = merged.filter(F.size("items") <= longest)
    assert left.select("node", "items.rank").distinct().count() == left.count()
    assert projection.merged(whole.limit(0)).count() == 0


def test_deep_search_in_stored_steps(spark, monkeypatch):
    """Sets of up to nine items, receipts of which many are alike, with every way of storing and merging."""
    rng = random.Random(8)
    kinds = [rng.sample("ABCDEFGHI", k) for k in (9, 9, 7, 5, 3, 8)]
    lines = [(t, p, i, rng.randint(1, 9)) for t in range(60) for p, i in enumerate(kinds[t % 6])]
    limit = sum(line[3] for line in lines) // 5
    expected = brute_force(lines, limit)
    assert max(name.count(",") for name in expected) >= 5
    plain = found(mine(frame(spark, lines), limit, ENDPOINTS))
    monkeypatch.setattr(mining, "STORE_EVERY", 2)
    assert found(mine(frame(spark, lines), limit)) == expected
    assert found(mine(frame(spark, lines), limit, ENDPOINTS)) == plain
    monkeypatch.setattr(mining, "_SAFE", 0)
    assert found(mine(frame(spark, lines), limit)) == expected


def test_pair_bound_spares_candidates(spark, monkeypatch):
    """Items that never meet often enough are not put together below another item."""
    rng = random.Random(2)
    lines = [(t, p, i, rng.randint(1, 30)) for t in range(120) for p, i in enumerate(["A", *rng.sample("BCDEFGHKLM", 4)])]
    limit = sum(line[3] for line in lines) // 9
    counted, candidates = [], projection.candidates

    def counting(*given):
        made = candidates(*given)
        if len(given) > 2 and given[2] is not None:
            counted.append((made.count(), candidates(given[0], given[1], None).count()))
        return made

    monkeypatch.setattr(projection, "candidates", counting)
    assert found(mine(frame(spark, lines), limit)) == brute_force(lines, limit)
    assert counted and all(a <= b for a, b in counted) and sum(a for a, _ in counted) < sum(b for _, b in counted)


@pytest.mark.parametrize("losses", [False, True])
def test_pair_bound_with_long_receipts(spark, monkeypatch, losses):
    monkeypatch.setattr(mining, "SPLIT_ITEMS", 5)
    lines = make(21, receipts=40, losses=losses)
    for share in (6, 12):
        limit = sum(max(line[3], 0) for line in lines) // share
        assert found(mine(frame(spark, lines), limit)) == brute_force(lines, limit)


def test_segmented_sum_of_one_large_group(spark):
    rng = random.Random(3)
    data = [("big" if k % 3 else f"g{k % 30}", k, rng.randint(-9, 9)) for k in range(5000)]
    df = spark.createDataFrame(data, "g string, k bigint, v bigint").repartition(6)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = segmented_sum(df, "g", "v", "s", [F.desc("k")])
        spread = out.filter("g = 'big'").groupBy(F.spark_partition_id()).count().count()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    running, expected = {}, []
    for g, k, v in sorted(data, key=lambda r: -r[1]):
        running[g] = running.get(g, 0) + v
        expected.append((g, k, v, running[g]))
    assert rows(out) == sorted(expected, key=repr)
    assert spread > 1


@pytest.mark.parametrize("remaining", ["rank", "position"])
def test_segmented_utility_list_equals_the_plain_one(spark, remaining):
    items = frame(spark, make(31, receipts=30, losses=True))
    ranks = item_rank(twu(items), 1)
    plain = build_utility_list(items, ranks, remaining)
    segmented = build_utility_list(items, ranks, remaining, segmented=True)
    assert segmented.dtypes == plain.dtypes
    assert rows(segmented) == rows(plain)


def test_segmented_max_before(spark):
    rng = random.Random(4)
    data = [("big" if k % 3 else f"g{k % 30}", k, rng.randint(-99, 99)) for k in range(3000)]
    df = spark.createDataFrame(data, "g string, k bigint, v bigint").repartition(6)
    best, expected = {}, []
    for g, k, v in sorted(data, key=lambda r: -r[1]):
        expected.append((g, k, v, best.get(g)))
        best[g] = max(best.get(g, v), v)
    assert rows(segmented_max_before(df, "g", "v", "b", [F.desc("k")])) == sorted(expected, key=repr)


@pytest.mark.parametrize("losses", [False, True])
def test_pairs_of_long_receipts_where_only_ends_count(spark, monkeypatch, losses):
    """Not all pairs of long receipts are made, and the results are those of a search that makes them."""
    rng = random.Random(6)
    names = [f"i{n:02d}" for n in range(40)]
    lines = [(0, p, name, -rng.randint(0, 4) if losses and p % 5 == 0 else rng.randint(1, 4)) for p, name in enumerate(rng.sample(names, 40))]
    lines += [(t, p, name, rng.randint(1, 60)) for t in range(1, 60) for p, name in enumerate(rng.sample(names, 4))]
    made, as_candidates = [], mining._as_candidates

    def counting(larger, mode):
        candidates = as_candidates(larger, mode)
        made.append(candidates.count())
        return candidates

    monkeypatch.setattr(mining, "_as_candidates", counting)
    limits = (150, 300)
    short = [found(mine(frame(spark, lines), limit, ENDPOINTS)) for limit in limits]
    assert not made and short[0]
    monkeypatch.setattr(mining, "SPLIT_ITEMS", 8)
    for limit, expected in zip(limits, short):
        made.clear()
        assert found(mine(frame(spark, lines), limit, ENDPOINTS)) == expected
    assert made[0] + made[1] < 40 * 39 // 4


@pytest.mark.parametrize("split", [1024, 3])
def test_search_size(spark, monkeypatch, split):
    """Estimates lie within their errors of what a search meets, and do not depend on how receipts are held."""
    monkeypatch.setattr(mining, "SPLIT_ITEMS", split)
    rng = random.Random(5)
    lines = [(t, p, i, rng.randint(1, 30)) for t in range(80) for p, i in enumerate(rng.sample("ABCDEFGHIJ", 5))]
    items, limit = frame(spark, lines), sum(line[3] for line in lines) // 25
    nodes = mine(items, limit).nodes.groupBy(F.size("ranks").alias("size")).agg(F.count_if("extendable"), F.count_if("found"))
    actual = {size: counts for size, *counts in nodes.collect()}
    estimate = {r["size"]: r for r in search_size(items, limit, walks=200, seed=3).collect()}
    assert len(estimate) >= 3 and set(estimate) <= set(actual) | {max(actual) + 1}
    assert [estimate[1]["extendable"], estimate[1]["found"]] == actual[1] and estimate[1]["extendable_error"] == 0
    assert estimate[1]["rows"] == len(lines)
    for size, (extendable, hits) in actual.items():
        if size in estimate:
            assert abs(estimate[size]["extendable"] - extendable) <= 4 * estimate[size]["extendable_error"]
            assert abs(estimate[size]["found"] - hits) <= 4 * estimate[size]["found_error"] + 1e-6
    again = {r["size"]: r for r in search_size(items.repartition(7), limit, walks=200, seed=3).collect()}
    assert {s: r["extendable"] for s, r in again.items()} == pytest.approx({s: r["extendable"] for s, r in estimate.items()})
    nothing = search_size(items.limit(0), limit).collect()
    assert [(r["size"], r["extendable"], r["found"], r["rows"]) for r in nothing] == [(1, 0, 0, 0)]
