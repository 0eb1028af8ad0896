import random
import zlib
from bisect import bisect_left, insort
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_cases import odd_documents, odd_frame, prose

from cartyield.llm.mixture import flight, landing, mix_sources
from cartyield.llm.packing import CapacityTree, best_fit_decreasing, pack_documents
from cartyield.llm.tokenize import TextEncoder, default_vocabulary


def slow_targets(sizes):
    """Shares dealt again and again until no target is above its limit."""
    ordered = sorted((s for s in sizes if s is not None)) + [s for s in sizes if s is None]
    weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(ordered)}
    left, open_, target = 1.5 * sum(sizes.values()), set(sizes), {}
    while open_:
        rate = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if rate * weight[s] >= 2 * sizes[s]}
        if not full:
            return target | {s: rate * weight[s] for s in open_}
        target |= {s: 2.0 * sizes[s] for s in full}
        left -= sum(2 * sizes[s] for s in full)
        open_ -= full
    return target


def test_mix_meets_targets(spark):
    rng = random.Random(1)
    docs = [(k, prose(rng, int(rng.paretovariate(1.2)) + 1), rng.choice(["a", "b", "ä", "z", None])) for k in range(4000)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string, source string")
    found = mix_sources(frame).collect()
    sizes = Counter()
    for _, text, source in docs:
        sizes[source] += len(text.split())
    targets = slow_targets(sizes)
    source_of = {d: s for d, _, s in docs}
    taken, copies = Counter(), Counter()
    for r in found:
        source = source_of[r["doc_id"]]
        assert r["size"] == len(docs[r["doc_id"]][1].split())
        assert r["source_size"] == sizes[source]
        assert r["target"] == pytest.approx(targets[source])
        assert r["taken"] == r["copies"] * r["size"] <= 2 * r["size"]
        taken[source] += r["taken"]
        copies[source] += r["copies"]
    assert len(found) == len(docs)
    for source, target in targets.items():
        largest = max(len(t.split()) for _, t, s in docs if s == source)
        assert abs(taken[source] - target) <= largest
        due = target / sizes[source] * sum(s == source for _, _, s in docs)
        assert abs(copies[source] - due) <= 2.5
    assert rows(mix_sources(frame.repartition(7))) == sorted((tuple(r) for r in found), key=repr)


def test_mix_of_odd_documents(spark):
    found = mix_sources(odd_frame(spark))
    assert found.count() == len(odd_documents())
    assert found.filter("taken > 2 * size or taken is null").count() == 0
    assert mix_sources(odd_frame(spark, [])).count() == 0
    wordless = [r for r in odd_documents() if not (r[1] or "").split()]
    assert {r["taken"] for r in mix_sources(odd_frame(spark, wordless)).collect()} == {0}


def test_flight_keeps_sums():
    rng = np.random.default_rng(0)
    sizes, chances = rng.integers(0, 1000, 500).astype(float), np.full(500, 0.37)
    moved = flight(sizes, chances, rng)
    assert ((moved > 0) & (moved < 1)).sum() <= 2
    assert moved.sum() == pytest.approx(chances.sum())
    assert moved @ sizes == pytest.approx(chances @ sizes)
    assert set(landing(sizes, moved)) <= {0.0, 1.0}
    many = np.mean([flight(sizes[:9], chances[:9], rng) for _ in range(3000)], 0)
    assert np.allclose(many, 0.37, atol=0.04)


def test_capacity_tree():
    rng = random.Random(2)
    tree, held = CapacityTree(50), set()
    for _ in range(500):
        room = rng.randint(0, 50)
        tree.set(room, room not in held)
        held ^= {room}
        length = rng.randint(0, 50)
        assert tree.tightest(length) == min((r for r in held if r >= length), default=None)


@pytest.mark.parametrize("seed", range(30))
def test_packing_is_best_fit_decreasing(seed):
    rng = random.Random(seed)
    capacity = rng.choice([5, 17, 64, 4096])
    lengths = [rng.randint(1, rng.choice([capacity, max(1, capacity // 6)])) for _ in range(rng.randint(0, 300))]
    rooms, bins = [], 0
    for length in sorted(lengths, reverse=True):
        k = bisect_left(rooms, length)
        bins += k == len(rooms)
        insort(rooms, (rooms.pop(k) if k < len(rooms) else capacity) - length)
    plan = best_fit_decreasing(Counter(lengths), capacity)
    assert len({b for row in plan.tolist() for b in [row[3]]}) <= bins
    used = Counter()
    for k, (length, first, each, start, offset) in enumerate(plan.tolist()):
        last = plan[k + 1][1] if k + 1 < len(plan) and plan[k + 1][0] == length else Counter(lengths)[length]
        for item in range(first, last):
            used[start + (item - first) // each] += length
            assert offset + (item - first) % each * length + length <= capacity
    assert len(used) == bins
    assert sum(used.values()) == sum(lengths)


def check_packing(docs, found, capacity):
    encode = TextEncoder(default_vocabulary())._whole
    expected = []
    for doc_id, text, *_ in docs:
        ids = encode(text or "") + (1).to_bytes(4, "little")
        for piece, at in enumerate(range(0, len(ids), 4 * capacity)):
            own = ids[at : at + 4 * capacity]
            expected.append((doc_id, piece, at // 4, len(own) // 4, zlib.crc32(own)))
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(expected, key=repr)
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for pieces in sequences.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= capacity
    return sequences


def test_packing_of_documents(spark):
    docs = odd_documents()
    found = pack_documents(odd_frame(spark), capacity=256).collect()
    sequences = check_packing(docs, found, 256)
    total = sum(r["length"] for r in found)
    assert len(sequences) <= -(-total // 256) + 1
    assert pack_documents(odd_frame(spark, [])).count() == 0
