import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import rows
from llm_cases import WORDS, odd_documents, odd_frame, prose

from cartyield.llm import codes, quality, queries, spelling
from cartyield.plans.workspace import Workspace


def spaced(text):
    for space in "\t\n\x0b\x0c\r":
        text = text.replace(space, " ")
    return [w for w in text.split(" ") if w]


# Operator 11


def slow_words(docs):
    letters = set("abcdefghijklmnopqrstuvwxyz") | {chr(c) for c in range(0xC0, 0x100)}
    counts = Counter()
    for doc_id, text, *_ in docs:
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for run in "".join(c if c in letters else " " for c in lowered).split(" "):
            if run:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % 199 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
                counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 6 and n >= 5}


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1 :] == short for k in range(len(long)))


def slow_forms(words):
    found = {}
    for word, n in words.items():
        near = sorted((-words[w], w) for w in words if one_edit(word, w))
        form = near[0] if near and -near[0][0] >= 5 * n else None
        found[word] = (form and form[1], n, len(near), form and -form[0])
    expected = []
    for word, (form, n, n_near, form_n) in found.items():
        root = word
        while found[root][0]:
            root = found[root][0]
        expected.append((word, form, root, n, n_near, form_n))
    return sorted(expected, key=repr)


def misspelt(rng):
    """Words in many spellings, chains of forms, equal counts, copies of a text, long words."""
    texts = []
    for word, n in [("kitchens", 700), ("kitchenz", 120), ("kitchanz", 22), ("kutchanz", 5), ("ktchens", 9), ("kittchens", 9)]:
        texts += [word] * n
    texts += ["brother ", "brothers "] * 20 + ["Éclairs", "éclairs", "ÉCLAIRS", "eclairs"] * 6 + ["x" * 3000] * 5 + ["x" * 2999 + "y"] * 6
    texts += ["".join(rng.choice("abcé") for _ in range(6)) for _ in range(20_000)]
    rng.shuffle(texts)
    docs = [(None if k % 50 == 0 else k // 2, " ".join(texts[k * 7 : k * 7 + 7]) + ".", "en", "s") for k in range(len(texts) // 7 + 1)]
    return [(i, t, lang, s, len(t), "c", "c", "c", "c", "c") for i, t, lang, s in docs] + odd_documents()


def test_spelling_forms_against_brute_force(spark):
    docs = misspelt(random.Random(3))
    words = slow_words(docs)
    expected = slow_forms(words)
    assert any(r[1] and r[2] != r[1] for r in expected) and len(expected) > 500
    assert rows(spelling.spelling_forms(odd_frame(spark, docs))) == expected


def test_near_words_with_a_filter_in_slices(spark):
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(3, 7))) for _ in range(600)} | {"東京都", "東京府", "b"})
    frame = spark.createDataFrame([(w, 1) for w in words], "word string, n int")
    found = spelling.near_words(frame, slice_blocks=5)
    expected = sorted((a, 1, b, 1) for a in words for b in words if one_edit(a, b))
    assert rows(found) == sorted(expected, key=repr)


def test_the_filter_lets_few_others_through(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("abcdefghijklmnop") for _ in range(8)) for _ in range(3000)]
    lanes = np.zeros((150, 8), np.uint64)
    known, others = (spelling.word_hashes(spelling._points(w, 8)) for w in (words, [w[::-1] + "z" for w in words] and [w[::-1] for w in words]))
    np.bitwise_or.at(lanes, spelling._block(known, 0, 150), spelling._bits(known))
    passed = [((lanes[spelling._block(h, 0, 150)] & spelling._bits(h)) == spelling._bits(h)).all(1).mean() for h in (known, others)]
    assert passed[0] == 1 and passed[1] < 0.01


def test_no_words(spark):
    assert spelling.spelling_forms(odd_frame(spark, [])).count() == 0
    assert spelling.spelling_forms(odd_frame(spark, [r for r in odd_documents() if not r[1]])).count() == 0


# Operator 12

VECTORS = "vec_id bigint, embedding array<float>, label int, row string, entry string, _label string, _id string"


def odd_vectors(rng, n=300, length=16):
    out = [(k * 3 % 1009, [rng.gauss(0, 0.3) for _ in range(length)], rng.choice([None, 0, 1, 2])) for k in range(n)]
    same = [0.5] * length
    out += [(5000 + k, same, 7) for k in range(150)]
    out += [(1, out[0][1], 3), (1, out[0][1], 3), (None, out[5][1], 1), (None, out[6][1], None)]
    out += [(9001, None, 1), (9002, [None] + same[1:], 1), (9003, [math.nan] + same[1:], 1), (9004, [math.inf] + same[1:], 1)]
    out += [(9005, [], 1), (9006, same[1:], 1), (None, None, None)]
    return [(*v, "c", "c", "c", "c") for v in out]


def slow_codes(vectors, parts=8, entries=16, rounds=6):
    kept = [v for v in vectors if v[1] and all(x is not None and math.isfinite(x) for x in v[1])]
    units = lambda v: [math.floor(float(np.float32(x)) * 4096) for x in v[1]]
    order = sorted(kept, key=lambda v: (v[0] is None, v[0] or 0, units(v)))
    if not order:
        return [], []
    kept = [v for v in kept if len(v[1]) == len(order[0][1])]
    order = [v for v in order if len(v[1]) == len(order[0][1])]
    length = len(order[0][1])
    cuts = [p * length // parts for p in range(parts + 1)]
    cut = lambda v: [units(v)[a:b] for a, b in zip(cuts, cuts[1:])]
    books = [[cut(v)[p] for v in order[:entries]] for p in range(parts)]
    members = [cut(v) for v in kept]

    def best(part, book):
        return min((sum((x - y) ** 2 for x, y in zip(part, e)), k) for k, e in enumerate(book))

    moves, before = [], {}
    for _ in range(rounds):
        owner = {(i, p): best(m[p], books[p])[1] for i, m in enumerate(members) for p in range(parts)}
        moves.append(sum(before.get(key) != e for key, e in owner.items()))
        before = owner
        for p in range(parts):
            for e in range(len(books[p])):
                held = [members[i][p] for (i, q), k in owner.items() if q == p and k == e]
                if held:
                    books[p][e] = [sum(c) // len(held) for c in zip(*held)]
    found = []
    for v, m in zip(kept, members):
        chosen = [best(m[p], books[p]) for p in range(parts)]
        found.append((v[0], "".join(f"{k:02x}" for _, k in chosen), sum(d for d, _ in chosen), v[2]))
    errors = Counter()
    for _, _, error, label in found:
        errors[label] += error
    digest = codes.Codebooks([np.array(b, np.int64) for b in books], []).digest()
    return sorted([(i, c, e, errors[label], digest) for i, c, e, label in found], key=repr), moves


@pytest.mark.parametrize("n, length", [(300, 16), (7, 16), (60, 13)])
def test_vector_codes_against_brute_force(spark, n, length):
    vectors = odd_vectors(random.Random(6), n, length)
    expected, moves = slow_codes(vectors)
    frame = spark.createDataFrame(vectors, VECTORS).repartition(5)
    assert rows(codes.vector_codes(frame)) == expected
    _, books = codes.train_codes(frame)
    assert books.moves == moves and moves[0] == 8 * len(expected)


def test_only_members_that_change_entry_are_shuffled(spark):
    frame = spark.createDataFrame(odd_vectors(random.Random(7)), VECTORS)
    _, books = codes.train_codes(frame, rounds=4)
    assert all(moved < books.moves[0] / 2 for moved in books.moves[1:])
    assigned = codes._assigned(codes._parts(codes.usable(frame, "vec_id", "embedding").filter("size(_units) = 16").selectExpr("1L _row", "_units"), 8).selectExpr("*", "0 entry"), books.entries)
    with Workspace(spark) as workspace:
        members, _ = codes._settled(workspace.store(assigned, "assigned"), "moved", 4, workspace)
        assert "Exchange" not in members._jdf.queryExecution().executedPlan().toString()


def test_no_vectors(spark):
    nothing = spark.createDataFrame([v for v in odd_vectors(random.Random(8)) if v[0] in (9001, 9002, 9005)], VECTORS)
    assert codes.vector_codes(nothing).count() == 0
    with pytest.raises(Exception, match="2\\^27"):
        codes.vector_codes(spark.createDataFrame([(1, [1e9] * 8, 1, "", "", "", "")], VECTORS)).collect()


# Operator 13


def slow_measures(text):
    text = text or ""
    words = spaced(text)
    windows = Counter(tuple(words[k : k + 3]) for k in range(len(words) - 2))
    again = {k + j for k in range(len(words) - 2) if windows[tuple(words[k : k + 3])] > 1 for j in range(3)}
    lines = [line for line in text.split("\n") if spaced(line)]
    dup = sum(line in lines[:k] for k, line in enumerate(lines))
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, len(again), len(lines), max(Counter(words).values(), default=0)


def bad_documents():
    rng = random.Random(9)
    texts = [prose(rng, 80), "ab " * 60, "# " * 100, prose(rng, 60) + " | " * 50, "\n".join([prose(rng, 12)] * 9), "a b " * 40, "x" * 5000 + " " + prose(rng, 60)]
    texts += [" \n".join(prose(rng, 3) for _ in range(40)), prose(rng, 200) + "\r\n\n\r\n\n", ("z" * 30 + " ") * 60, "東京 " + prose(rng, 70)]
    return odd_documents() + [(500 + k, t, "en", "s", len(t), "c", "c", "c", "c", "c") for k, t in enumerate(texts)]


def test_measures_and_bits_against_brute_force(spark):
    docs = bad_documents()
    expected = []
    for doc_id, text, *_ in docs:
        n, chars, symbols, dup, repeat, lines, top = measured = slow_measures(text)
        failed = [n < 50, 2 * repeat > n, 10 * symbols > n, 100 * dup > 30 * lines, chars < 2 * n, chars > 20 * n, 100 * top > 30 * n]
        expected.append((doc_id, *measured, sum(1 << k for k, f in enumerate(failed) if f)))
    entries = quality.ledger(odd_frame(spark, docs))
    assert rows(entries) == sorted(expected, key=repr)
    assert all(any(r[-1] >> k & 1 for r in expected) for k in range(len(quality.RULES)))


def test_many_different_words_in_one_text():
    rng = random.Random(10)
    words = [str(rng.randrange(6)) for _ in range(500)]
    ids = np.array([int(w) for w in words])
    assert quality._repeated(ids, 6) == quality._repeated(ids, 1 << 22) == slow_measures(" ".join(words))[4] > 0


def test_policies_and_ablations_read_the_ledger_alone(spark):
    entries = quality.ledger(odd_frame(spark, bad_documents())).cache()
    bits = [r["failed"] for r in entries.collect()]
    for policy in quality.POLICIES.values():
        kept = quality.apply_policy(entries, policy)
        assert sorted(r["kept"] for r in kept.collect()) == sorted(b & policy.mask == 0 for b in bits)
        for r in quality.ablations(entries, policy).collect():
            bit = quality.Policy("", (r["rule"],)).mask
            assert r["failed"] == sum(b & bit > 0 for b in bits)
            assert r["failed_alone"] == sum(b & policy.mask == bit for b in bits)
            assert r["kept"] == sum(b & policy.mask == 0 for b in bits)
            assert r["kept_without"] == sum(b & policy.mask & ~bit == 0 for b in bits)
    none = quality.ledger(odd_frame(spark, []))
    assert none.count() == 0
    assert {(r["failed"], r["kept"]) for r in quality.ablations(none, quality.POLICIES["strict"]).collect()} == {(0, 0)}


# The queries themselves, on a table of odd rows


def test_queries_over_odd_tables(spark, tmp_path):
    docs = misspelt(random.Random(3))[-900:] + bad_documents()
    odd_frame(spark, docs).write.parquet(str(tmp_path / "documents.parquet"))
    vectors = odd_vectors(random.Random(6), 100)
    spark.createDataFrame(vectors, VECTORS).repartition(3).write.parquet(str(tmp_path / "embeddings.parquet"))
    folder = str(tmp_path)
    assert rows(queries.op11_spelling_forms(spark, folder)) == slow_forms(slow_words(docs))
    assert rows(queries.op12_vector_codes(spark, folder)) == slow_codes(vectors)[0]
    found = queries.op13_quality_rules(spark, folder).collect()
    measured = sorted(((i, *slow_measures(t)) for i, t, *_ in docs), key=repr)
    assert sorted((tuple(r)[:6] for r in found), key=repr) == sorted((m[:6] for m in measured), key=repr)
    for r in found:
        assert r["base_failed"] == (r["n_words"] < 50 or 100 * r["n_repeat_words"] > 50 * r["n_words"])
        assert r["kept"] == (r["failed"] == 0) and not (r["base_failed"] and r["kept"])
