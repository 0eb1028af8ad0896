import random

import numpy as np
import pytest

from cartyield.llm import topk
from cartyield.llm.topk import Best, search_blocks, top_k
from cartyield.plans.workspace import Workspace


def brute(rows, k, every):
    usable = [
        (n, i, [int(np.floor(256 * x)) for x in v])
        for n, (i, v) in enumerate(rows)
        if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)
    ]
    found = []
    for n, i, v in usable:
        if i % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), j) for m, j, w in usable if m != n)
            found += [(i, rank, j, -s) for rank, (s, j) in enumerate(scored[:k], 1)]
    return sorted(found)


@pytest.mark.parametrize(("block", "size"), [(4, 16), (64, 8192)])
def test_top_k_against_brute_force(spark, block, size):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 0.3) for _ in range(8)]) for k in range(120)]
    rows += [(200, None), (201, []), (202, [1.0, None]), (203, [float("nan")] * 8), (204, [float("inf")] * 8), (None, [0.5] * 8)]
    rows += [(300 + k, [0.25] * 8) for k in range(8)] + [(300, [0.25] * 8)]  # ties and a repeated row
    rows += [(401, [1.0, -2.0]), (-50, [3.0] * 8)]
    frame = spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], "vec_id bigint, embedding array<double>, score string, rank int")
    found = top_k(frame.repartition(3), k=5, every=50, block=block, range_size=size).collect()
    assert sorted(tuple(r) for r in found) == brute(rows, 5, 50)


def test_few_rows(spark):
    frame = spark.createDataFrame([(0, [1.0]), (50, [2.0])], "vec_id bigint, embedding array<float>")
    assert sorted(tuple(r) for r in top_k(frame).collect()) == [(0, 1, 50, 131072), (50, 1, 0, 131072)]
    assert top_k(frame.filter("vec_id = 0")).count() == 0
    assert top_k(frame.limit(0)).count() == 0


def test_blocks_below_the_bound_are_left_out():
    rng = np.random.default_rng(0)
    vectors = np.sort(rng.integers(0, 1000, (1000, 4)), axis=0)
    queries = np.ones((1, 4), np.int64)
    found, scored = search_blocks(queries, np.array([-1]), vectors, np.arange(1000), np.arange(1000), 5, 10)
    assert found[0][1].tolist() == sorted(range(1000), key=lambda k: (-vectors[k].sum(), k))[:5]
    assert scored < 5
    large = np.full((1, 4), 1 << 29, np.int64)
    found, _ = search_blocks(large, np.array([-1]), large, np.arange(1), np.arange(1), 5, 10)
    assert found[0][2].tolist() == [1 << 60]


def test_queries_of_several_passes(spark, monkeypatch):
    """No chunk of queries is paired with a range by a join, and what is broadcast at once does not grow with the vectors."""
    monkeypatch.setattr(topk, "QUERIES", 16)
    held, sent = topk._held, []
    monkeypatch.setattr(topk, "_held", lambda queries: sent.append(held(queries)) or sent[-1])
    rng = random.Random(2)
    rows = [(k % 190, [float(rng.randint(-3, 3)) for _ in range(4)]) for k in range(200)]
    frame = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>").repartition(3)
    with Workspace(spark) as workspace:
        found = top_k(frame, every=2, factor=1, block=4, range_size=32, workspace=workspace, at_once=100)
        assert sorted(tuple(r) for r in found.collect()) == sorted((i, r, j, s) for i, r, j, s in brute([(i, [x / 256 for x in v]) for i, v in rows], 5, 2))
        assert len(sent) > 3 and sum(len(rows) for chunks in sent for rows, _, _ in chunks) == 100
        assert max(sum(v.size for _, _, v in chunks) for chunks in sent) <= 100
        assert len(spark.read.parquet(workspace._paths["best"]).inputFiles()) >= len(sent)
        plan = found._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Generate" not in plan


def test_best_of_several_ranges():
    rng = np.random.default_rng(3)
    for low, high in ((-3, 3), (-2000, 2000), (-(1 << 22), 1 << 22), (1 << 28, 1 << 29)):
        vectors = rng.integers(low, high, (300, 6))
        vectors[100:140] = vectors[7]
        ids, rows = np.sort(rng.integers(0, 250, 300)), np.arange(300)
        chosen = np.arange(0, 300, 3)
        best = Best(len(chosen), 4)
        for part in np.array_split(rng.permutation(300), 5):
            part = np.sort(part)
            search_blocks(vectors[chosen], rows[chosen], vectors[part], rows[part], ids[part], 4, 8, best)
        for (q, found, scores), row in zip(best, chosen, strict=True):
            exact = sorted((-sum(int(a) * int(b) for a, b in zip(vectors[row], v)), int(i)) for r, (i, v) in enumerate(zip(ids, vectors)) if r != row)
            assert list(zip((-scores).tolist(), found.tolist())) == exact[:4]


def test_a_query_does_not_look_where_its_own_bound_is_low():
    """Queries looked for together leave out blocks each by its own bound."""
    rng = np.random.default_rng(4)
    vectors = np.repeat(np.diag([1000] * 4), 250, axis=0) + rng.integers(0, 9, (1000, 4))
    queries = np.eye(4, dtype=np.int64)
    found, scored = search_blocks(queries, np.full(4, -1), vectors, np.arange(1000), np.arange(1000), 5, 10)
    for q, ids, _ in found:
        assert ids.tolist() == sorted(range(1000), key=lambda k: (-vectors[k, q], k))[:5]
    assert scored <= 4 * 100 / 2
