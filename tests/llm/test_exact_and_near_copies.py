import hashlib
import itertools
import random
from pathlib import Path

import numpy as np
import pytest
import xxhash
from conftest import rows
from llm_cases import WORDS, odd_documents, odd_frame, prose
from pyspark.sql import functions as F

from cartyield.llm import simhash
from cartyield.llm.components import components
from cartyield.llm.exact_dedup import DigestIndex, exact_dedup
from cartyield.llm.simhash import _blocks, fingerprint, fingerprint_links, simhash_groups, tile_links
from cartyield.plans.workspace import Workspace


def test_exact_copies_against_brute_force(spark):
    docs = odd_documents()
    groups = {}
    for doc_id, text, *_ in docs:
        groups.setdefault(text or "", []).append(doc_id)
    expected = []
    for doc_id, text, *_ in docs:
        ids = groups[text or ""]
        keep = max((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256((text or "").encode()).hexdigest()
        expected.append((doc_id, keep, len(ids), doc_id == keep, sha))
    assert rows(exact_dedup(odd_frame(spark))) == sorted(expected, key=repr)


def test_no_documents(spark):
    none = odd_frame(spark, [])
    assert exact_dedup(none).count() == 0
    assert simhash_groups(none).count() == 0


def test_index_outlives_batches(spark, tmp_path):
    def batch(*pairs):
        return spark.createDataFrame(list(pairs), "doc_id bigint, text string")

    path = str(tmp_path / "index")
    index = DigestIndex(spark, path, buckets=3)
    first = exact_dedup(batch((1, "a"), (2, "b"), (3, "a")), index)
    assert {(r["doc_id"], r["kept"]) for r in first.collect()} == {(1, False), (2, True), (3, True)}
    spark.sql(f"DROP TABLE {index.table}")  # another session knows nothing of the table
    again = DigestIndex(spark, path, buckets=3)
    second = exact_dedup(batch((9, "a"), (8, "c"), (7, "c")), again)
    found = {r["doc_id"]: (r["keep_id"], r["kept"]) for r in second.collect()}
    assert found == {9: (3, False), 8: (8, True), 7: (8, False)}
    assert again.entries().count() == 3
    plan = again.unseen(batch((1, "x")).selectExpr("unhex(sha2(text, 256)) digest"))._jdf.queryExecution().toString()
    assert "SortMergeJoin" in plan


def slow_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    shingles = [words[k : k + 4] for k in range(max(1, len(words) - 3))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(nodes, links):
    low = {n: n for n in nodes}
    changed = True
    while changed:
        changed = False
        for a, b in links:
            m = min(low[a], low[b])
            changed |= low[a] != m or low[b] != m
            low[a] = low[b] = m
    return low


def test_fingerprint():
    rng = random.Random(2)
    texts = ["", None, "A b\tC", "a b c", "a b c d", "É É é x \x1c y"] + [prose(rng, n) for n in (3, 4, 5, 50)]
    assert [fingerprint(t) for t in texts] == [slow_fingerprint(t) for t in texts]


def test_simhash_against_brute_force(spark):
    rng = random.Random(3)
    texts = [r[1] for r in odd_documents()]
    base = prose(rng, 300).split()
    for k in range(15):  # a chain of near copies
        base[rng.randrange(300)] = rng.choice(WORDS)
        texts.append(" ".join(base))
    docs = list(enumerate(texts, 100))
    prints = {d: slow_fingerprint(t) for d, t in docs}
    links = [(a, b) for a, b in itertools.combinations(prints, 2) if (prints[a] ^ prints[b]).bit_count() <= 4]
    low = slow_components(prints, links)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(5)
    found = {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in simhash_groups(frame).collect()}
    assert found == {d: (f"{prints[d]:016x}", low[d]) for d in prints}
    assert simhash_groups(odd_frame(spark)).count() == len(odd_documents())


@pytest.mark.parametrize("tile", [3, 64])
def test_tiles_lose_no_link(tile):
    rng = random.Random(5)
    values = {rng.getrandbits(64) for _ in range(60)}
    for v in list(values)[:20]:
        for _ in range(6):
            values.add(v ^ sum(1 << rng.randrange(64) for _ in range(rng.randint(1, 5))))
    values = sorted(values, key=lambda v: (v.bit_count(), v))
    half = len(values) // 2
    left, right = (np.array(v, np.uint64) for v in (values[:half], values[half:]))
    found = (
        tile_links(left, left, 4, tile, True) + tile_links(right, right, 4, tile, True) + tile_links(left, right, 4, tile, False)
    )
    near = [(a, b) for a, b in itertools.combinations(values, 2) if (a ^ b).bit_count() <= 4]
    assert slow_components(values, found) == slow_components(values, near)
    assert len(found) < 3 * len(values)


def test_components(spark):
    rng = random.Random(6)
    links = [(k, k + 1) for k in range(0, 40)] + [(200, 100 + k) for k in range(50)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7)]
    frame = spark.createDataFrame(links, "u bigint, v bigint")
    nodes = {n for a, b in links if a != b for n in (a, b)}
    expected = slow_components(nodes, [x for x in links if x[0] != x[1]])
    assert {r["node"]: r["root"] for r in components(frame, Workspace(spark)).collect()} == expected
    assert components(frame.limit(0), Workspace(spark)).count() == 0


@pytest.mark.parametrize("partitions", ["2", "9"])
def test_index_is_opened_with_its_own_buckets(spark, tmp_path, partitions):
    path, before = str(tmp_path / "index"), spark.conf.get("spark.sql.shuffle.partitions")
    texts = spark.createDataFrame([(k, f"text {k}") for k in range(200)], "doc_id bigint, text string")
    index = DigestIndex(spark, path)
    assert exact_dedup(texts, index).filter("kept").count() == 200
    spark.sql(f"DROP TABLE {index.table}")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        again = DigestIndex(spark, path)
        assert again.buckets == int(before)
        second = exact_dedup(texts, again).collect()
        assert len(second) == 200 and not any(r["kept"] for r in second)
        assert again.entries().count() == 200
        with pytest.raises(ValueError, match="buckets"):
            DigestIndex(spark, path, buckets=int(before) + 1)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_blocks_of_fingerprints_do_not_follow_the_partitions(spark):
    links = fingerprint_links(spark.range(-5000, 5000, 1, 40).toDF("fp"), 12)
    assert links.rdd.getNumPartitions() == 1  # 10,000 fingerprints are one block, which is compared with itself
    assert {x for r in links.collect() for x in r} == set(range(-5000, 5000))
    frame = spark.range(-600, 600, 1, 40).toDF("fp")
    several = _blocks(frame.withColumn("part", F.pmod("fp", F.lit(3))).repartition(2, "part").sortWithinPartitions("part"), 150)
    held = [(r["part"], list(np.frombuffer(r["fps"], np.int64))) for r in several.collect()]
    assert all(len(fps) <= 150 and {x % 3 for x in fps} == {part} for part, fps in held)
    assert sorted(x for _, fps in held for x in fps) == list(range(-600, 600))


def test_components_keep_only_their_last_table(spark):
    with Workspace(spark) as workspace:
        chain = spark.range(300).selectExpr("id AS u", "id + 1 AS v")
        found = components(chain, workspace)
        assert [p.name[4:] for p in Path(workspace.base).iterdir()] == ["links"]
        assert {tuple(r) for r in found.collect()} == {(k, 0) for k in range(301)}


@pytest.mark.parametrize("block", [64, 1 << 14])
def test_pieces_leave_out_no_link_and_most_pairs(spark, monkeypatch, block):
    monkeypatch.setattr(simhash, "LEAST_BLOCK", block)
    rng = random.Random(block)
    prints = {rng.getrandbits(64) for _ in range(1500)} | {rng.getrandbits(52) for _ in range(500)} | {0, 1, (1 << 64) - 1}
    for x in rng.sample(sorted(prints), 300):  # chains of up to 4 bits a step, anywhere in the word
        for _ in range(3):
            for bit in rng.sample(range(64), rng.randint(1, 5)):
                x ^= 1 << bit
            prints.add(x)
    prints = sorted(prints)
    values = np.array(prints, np.uint64)
    near = np.bitwise_count(values[:, None] ^ values[None, :]) <= 4
    label = list(range(len(prints)))
    for i in range(len(prints)):
        for j in np.flatnonzero(near[i, :i]).tolist():
            low, high = sorted((label[i], label[j]))
            if low != high:
                label = [low if x == high else x for x in label]
    frame = spark.createDataFrame([(int(np.uint64(x).view(np.int64)),) for x in prints], "fp bigint")
    with Workspace(spark) as workspace:
        total = frame.count()
        blocks, pairs = simhash._banded_blocks(frame, total, 4, 12, workspace)
        n, compared = blocks.count(), pairs.count()
        assert n >= 5 and compared < 0.2 * n * n or block > total
    links = [(r["u"] % (1 << 64), r["v"] % (1 << 64)) for r in fingerprint_links(frame, 4).collect()]
    places = {x: k for k, x in enumerate(prints)}
    joined = list(range(len(prints)))
    for u, v in links:
        low, high = sorted((joined[places[u]], joined[places[v]]))
        if low != high:
            joined = [low if x == high else x for x in joined]
    assert joined == label
