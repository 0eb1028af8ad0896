import itertools
import random
from fractions import Fraction

import corpus_pipeline
import numpy as np
import pytest
from llm_cases import WORDS, odd_documents, prose
from test_exact_and_near_copies import slow_components

from cartyield.llm import near_copies
from cartyield.llm.near_copies import near_copy_groups
from cartyield.plans.workspace import Workspace


def slow_shingles(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for space in "\t\n\x0b\x0c\r":
        words = words.replace(space, " ")
    words = [w for w in words.split(" ") if w]
    return {tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))}


def slow_groups(texts, similarity):
    sets = [slow_shingles(t) for t in texts]
    links = [
        (a, b) for a, b in itertools.combinations(range(len(texts)), 2)
        if len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    return slow_components(range(len(texts)), links), links


def edited(rng, text, edits):
    words = text.split()
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(WORDS) + "x"
    return " ".join(words)


def planted(rng):
    """Copies with a few words changed per hundred, chains of copies, one large group, a common passage."""
    texts = [r[1] for r in odd_documents()]
    for k in range(40):
        base = prose(rng, rng.choice([8, 30, 100, 300]))
        texts += [base, edited(rng, base, rng.randint(1, 4)), base + " " + prose(rng, rng.randint(1, 30))]
    chain = prose(rng, 200)
    for k in range(10):
        texts.append(chain := edited(rng, chain, 2))
    base, passage = prose(rng, 150), prose(rng, 60)
    texts += [edited(rng, base, rng.randint(1, 3)) for _ in range(40)]
    texts += [passage + " " + prose(rng, rng.randint(5, 60)) for _ in range(40)]
    return texts


@pytest.mark.parametrize("similarity", [Fraction(4, 5), Fraction(1, 2), Fraction(1)])
def test_groups_against_brute_force(spark, similarity):
    texts = planted(random.Random(11))
    expected, links = slow_groups(texts, similarity)
    assert len(links) > 50
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(5)
    found = {r["doc_id"]: r["component_id"] for r in near_copy_groups(frame, similarity=similarity).collect()}
    assert found == expected
    assert near_copy_groups(frame.limit(0)).count() == 0


def test_stage_drops_all_near_copies(spark, tmp_path):
    texts = sorted({t for t in planted(random.Random(12)) if t})
    docs = [(None if k == 5 else k, t, "en", "s") for k, t in enumerate(texts)]
    spark.createDataFrame(docs, "doc_id bigint, text string, lang string, source string").write.parquet(str(tmp_path / "docs"))
    kept = corpus_pipeline.drop_near_copies(spark, spark.read.parquet(str(tmp_path / "docs")), None).collect()
    low, links = slow_groups([t for _, t, *_ in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0))], Fraction(4, 5))
    assert links and len(kept) == len(set(low.values()))
    assert not slow_groups([r["text"] for r in kept], Fraction(4, 5))[1]


def open_pairs(spark, texts, workspace):
    """How many pairs are left to compare if nothing is linked yet."""
    frame = spark.createDataFrame(list(enumerate(texts)), "_id bigint, _text string").repartition(4)
    sets = workspace.store(near_copies._sets(frame, 5), "sets")
    prefixes = workspace.store(near_copies._prefixes(sets, Fraction(4, 5), workspace), "prefixes")
    nothing = spark.createDataFrame([], "node bigint, root bigint")
    return near_copies._open_pairs(prefixes, nothing, Fraction(4, 5), workspace).count()


@pytest.mark.parametrize("edits", [10, 30])
def test_pairs_to_compare_grow_with_the_rows(spark, edits):
    """A passage in all texts, and copies of one text too far from each other."""
    counts = []
    for n in (1000, 2000):
        rng = random.Random(5)
        passage, base = prose(rng, 60), " ".join(f"w{k}" for k in range(300))
        texts = [passage + " " + " ".join(f"{k}x{j}" for j in range(10)) for k in range(n // 2)]
        for k in range(n // 2):
            words = base.split()
            for j, place in enumerate(rng.sample(range(300), edits)):
                words[place] = f"{k}y{j}"
            texts.append(" ".join(words))
        with Workspace(spark) as workspace:
            counts.append(open_pairs(spark, texts, workspace))
    assert counts[1] <= max(2.5 * counts[0], 4000)


def test_copies_too_far_from_each_other_make_no_pairs(spark, monkeypatch):
    """Copies of one text with three words changed in each: at every place in common, two of them could still be similar."""
    counts, store = {}, Workspace.store

    def counted(self, df, name):
        stored = store(self, df, name)
        counts.setdefault(name, stored.count())
        return stored

    monkeypatch.setattr(Workspace, "store", counted)
    rng, texts = random.Random(7), []
    for k in range(300):
        words = [f"w{j}" for j in range(150)]
        for place in rng.sample(range(5, 145), 3):
            words[place] = f"{k}y{place}"
        texts.append(" ".join(words))
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string").repartition(4)
    expected, _ = slow_groups(texts, Fraction(4, 5))
    assert {r["doc_id"]: r["component_id"] for r in near_copy_groups(frame).collect()} == expected
    assert counts["pairs"] <= 600


def test_parities_never_differ_more_than_the_sets():
    rng = random.Random(8)
    for _ in range(200):
        a = {rng.getrandbits(64) for _ in range(rng.randint(1, 400))}
        b = {x for x in a if rng.random() < 0.9} | {rng.getrandbits(64) for _ in range(rng.randint(0, 40))}
        odd = [near_copies.parities(np.array(sorted(x), "u8")) for x in (a, b)]
        assert sum(int(x).bit_count() for x in (odd[0] ^ odd[1]).view("u8")) <= len(a ^ b)


def test_null_and_repeated_ids_are_rows(spark):
    base = " ".join(f"w{k}" for k in range(60))
    rows = [(None, base), (5, base + " end"), (7, base.replace("w59", "x")), (7, "another text"), (7, None), (None, ""), (8, base.upper())]
    found = near_copy_groups(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3))
    assert sorted(found.collect(), key=repr) == sorted([(None, 5), (5, 5), (7, 5), (8, 5), (7, 7), (7, 7), (None, 7)], key=repr)
