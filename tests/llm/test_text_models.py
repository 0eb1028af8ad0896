import itertools
import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from llm_cases import odd_documents, odd_frame, prose
from pyspark.sql import functions as F

from cartyield.llm import backoff_lm, langid, licenses, pii
from cartyield.llm.common import remainder
from cartyield.llm.license_terms import NOTICES
from cartyield.llm.pii_labels import SENTENCES


# Language model


def slow_scores(docs, held, orders, strength, added=0.1):
    def tokens(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x20\x09-\x0D]+", lower) + ["</s>"]

    counts, contexts = Counter(), Counter()
    for (_, text, *_), h in zip(docs, held):
        if not h:
            padded = ["<s>"] * (orders - 1) + tokens(text)
            for at in range(orders - 1, len(padded)):
                for n in range(1, orders + 1):
                    counts[tuple(padded[at - n + 1 : at + 1])] += 1
                    contexts[tuple(padded[at - n + 1 : at])] += 1
    total = contexts[()]
    types = sum(len(g) == 1 for g in counts)

    def chance(gram):
        if len(gram) == 1:
            return (counts[gram] + added) / (total + added * (types + 1))
        return (counts[gram] + strength * chance(gram[1:])) / (contexts[gram[:-1]] + strength)

    found = []
    for (doc_id, text, *_), h in zip(docs, held):
        padded = ["<s>"] * (orders - 1) + tokens(text)
        places = range(orders - 1, len(padded))
        base = sum(math.log10(chance((padded[at],))) for at in places)
        score = sum(math.log10(chance(tuple(padded[at - orders + 1 : at + 1]))) for at in places)
        known = sum(counts[padded[at],] > 0 for at in places)
        found.append((repr(doc_id), h, len(places), known, total, round(base, 6), round(score, 6)))
    vocabulary = [g[0] for g in counts if len(g) == 1] + ["never seen"]
    for context in [("<s>",) * (orders - 1), tuple(vocabulary[: orders - 1])]:
        assert sum(chance((*context, w)) for w in vocabulary) == pytest.approx(1)
    return sorted(found)


@pytest.mark.parametrize(("orders", "block"), [(1, 100), (2, 1 << 20), (3, 150)])
def test_scores_against_brute_force(spark, orders, block):
    docs = odd_documents()
    held = [len(d[1] or "") % 3 == 0 for d in docs]
    frame = odd_frame(spark)
    found = backoff_lm.score_texts(frame, F.length(F.coalesce("text", F.lit(""))) % 3 == 0, orders, 7.0, block_tokens=block)
    found = sorted((repr(r[0]), *r[1:5], round(r[5], 6), round(r[6], 6)) for r in found.collect())
    expected = slow_scores(docs, held, orders, 7.0)
    assert [f[:5] for f in found] == [e[:5] for e in expected]
    for f, e in zip(found, expected):
        assert f[5:] == pytest.approx(e[5:])


def test_model_beats_single_words_on_held_out_texts(spark):
    rng = random.Random(1)
    docs = []
    for k in range(200):  # every word is followed by one of three
        word, words = rng.randrange(19), []
        for _ in range(60):
            words.append(f"w{word}")
            word = (word * 3 + rng.randrange(3)) % 19
        docs.append((k, " ".join(words)))
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = backoff_lm.score_texts(frame, remainder(F.col("doc_id"), 10) == 0).filter("held_out")
    means = found.agg(F.avg("base_score"), F.avg("score")).first()
    assert means[1] > means[0] + 30


def test_nothing_to_learn_from(spark):
    found = backoff_lm.score_texts(odd_frame(spark), F.lit(True)).collect()
    assert {(r["base_score"], r["score"], r["n_known"], r["train_tokens"]) for r in found} == {(0.0, 0.0, 0, 0)}
    assert backoff_lm.score_texts(odd_frame(spark, []), F.lit(False)).count() == 0


# Language identification


def language_rows(n=160):
    rng = random.Random(3)
    letters = {"aa": "etaoinshr", "bb": "xqzjkvwyp", "cc": "äöüßéèçñø"}
    rows = []
    for k in range(n):
        lang = rng.choice(list(letters))
        words = ["".join(rng.choice(letters[lang]) for _ in range(rng.randint(2, 7))) for _ in range(rng.randint(3, 60))]
        rows.append((k, " ".join(words), lang if k % 13 else None, "clash"))
    return rows


def test_languages(spark):
    rows = language_rows()
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, score string")
    held = remainder(F.col("doc_id"), 4) == 2
    model = langid.train_language_model(frame.filter(~held))
    assert model.languages == ["aa", "bb", "cc"]
    found = langid.identify_language(frame.withColumn("held", held), model).filter("held and lang is not null").collect()
    assert len(found) > 20
    assert sum(r["lang"] == r["lang_pred"] for r in found) / len(found) > 0.95
    assert all(0 < r["score"] <= 1 for r in found)
    assert 0.05 < model.temperature < 20
    odd = spark.createDataFrame([(1, None), (2, ""), (3, "12 !?"), (4, "a")], "doc_id bigint, text string")
    predicted = [tuple(r) for r in langid.identify_language(odd, model, keep=["doc_id"]).orderBy("doc_id").collect()]
    assert predicted[:3] == [(k, "und", 0.0) for k in (1, 2, 3)]
    assert predicted[3][1] in model.languages
    again = langid.train_language_model(frame.filter(~held).repartition(7))
    assert np.array_equal(again.weights, model.weights)
    assert langid.identify_language(odd_frame(spark), model).columns[-2:] == ["lang_pred", "score"]


def test_no_labels(spark):
    frame = odd_frame(spark)
    for labelled in (frame.limit(0), frame.withColumn("lang", F.lit(None).cast("string")), frame.filter("text is null")):
        model = langid.train_language_model(labelled)
        assert {r["lang_pred"] for r in langid.identify_language(frame, model).collect()} == {"und"}


def test_ngrams():
    s = langid.LanguageSettings(dimensions=1 << 20)
    counts = dict(zip(*langid.ngrams("Ab  1 aB", s)))
    # " ab ab ": its letters, pairs and triples
    plain = " ab ab "
    expected = Counter(plain[k : k + n] for n in (1, 2, 3) for k in range(len(plain) - n + 1))
    assert sorted(counts.values()) == sorted(expected.values())
    assert len(langid.ngrams("12 -", s)[0]) == len(langid.ngrams(None, s)[0]) == 0


def test_temperature():
    rng = np.random.default_rng(1)
    logits = rng.normal(size=(4000, 3))
    languages = np.array([rng.choice(3, p=p) for p in langid.softmax(logits)])
    assert langid.fit_temperature(logits * 4, languages) == pytest.approx(4, rel=0.1)


# Licences


def slow_licenses(text, notices, frequency, threshold):
    words = licenses.words_of(text)
    found = []
    for number, (label, notice) in enumerate(notices):
        tokens, size = set(licenses.words_of(notice)), len(licenses.words_of(notice))
        for start in range(0, len(words), size):
            share = len(tokens & set(words[start : start + 2 * size])) / len(tokens)
            if share >= threshold:
                found.append((label, number, start, share))
    return sorted(found)


@pytest.mark.parametrize("threshold", [0.5, 0.8, 0.9, 1.0])
def test_licenses_against_brute_force(spark, threshold):
    rng = random.Random(4)
    words = [w for _, n in NOTICES for w in n.split()]
    docs = []
    for k in range(60):
        notice = rng.choice(NOTICES)[1].split()
        for _ in range(rng.randint(0, 3)):
            notice[rng.randrange(len(notice))] = rng.choice(words)
        docs.append((k, " ".join([prose(rng, rng.randint(0, 30)), *notice, prose(rng, rng.randint(0, 90)).upper()])))
    docs += [(k, " ".join(rng.choice(words) for _ in range(rng.randint(0, 200)))) for k in range(60, 90)]
    frame = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = licenses.scan_licenses(frame, threshold=threshold).collect()
    some = 0
    for r in found:
        expected = slow_licenses(docs[r["doc_id"]][1], NOTICES, {}, threshold)
        assert sorted((b["label"], b["template"], b["word"], b["containment"]) for b in r["blocks"]) == expected
        some += len(expected)
    assert some


def test_phrases_and_odd_texts(spark):
    texts = ["The MIT license, mit-License! MITlicense", None, "", "GNU general public\nLicense Apache License", "license mit"]
    found = licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string"))
    by_id = {r["doc_id"]: (r["n_words"], [tuple(p) for p in r["phrases"]]) for r in found.collect()}
    assert by_id == {
        0: (6, [("mit", 1), ("mit", 3)]),
        1: (0, []),
        2: (0, []),
        3: (6, [("gpl", 1), ("apache", 4)]),
        4: (2, []),
    }
    clean = licenses.scan_licenses(odd_frame(spark)).collect()
    assert len(clean) == len(odd_documents())
    assert not any(r["blocks"] or r["phrases"] for r in clean)
    assert licenses.scan_licenses(odd_frame(spark, [])).count() == 0


# Personal data


def slow_spans(text):
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = re.sub("[^0-9]", "", m.group())
        doubled = [int(c) * (1 + k % 2) for k, c in enumerate(reversed(digits))]
        if 13 <= len(digits) <= 19 and sum(d // 10 + d % 10 for d in doubled) % 10 == 0:
            found.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="ab.@-+ 0123459()%_é\n", max_size=60))
def test_patterns_against_plain_expressions(text):
    assert pii.base_spans(text) == slow_spans(text)


def test_patterns_are_linear():
    for text in ("a" * 200_000, "1" * 200_000, "1 " * 100_000, "+1" * 100_000, "a.a" * 70_000 + "@", "1." * 100_000):
        pii.base_spans(text)


@pytest.fixture(scope="module")
def field():
    return pii.train_field(map(pii.labelled_sentence, SENTENCES))


def test_field_knows_its_table(field):
    classes = field.classes()
    for words, labels in map(pii.labelled_sentence, SENTENCES):
        numbers = np.array([classes[w] for w in words])
        assert pii.viterbi(field, classes.weights(), numbers, np.array([len(words)])).tolist() == labels


def test_viterbi_against_brute_force(field):
    rng = random.Random(5)
    classes = field.classes()
    vocabulary = [w for s in SENTENCES for w in pii.labelled_sentence(s)[0]]
    lines = [[rng.choice(vocabulary) for _ in range(rng.randint(1, 4))] for _ in range(25)]
    numbers = [[classes[w] for w in line] for line in lines]
    weights = classes.weights()
    found = pii.viterbi(field, weights, np.array(sum(numbers, [])), np.array([len(n) for n in numbers]))
    own, before, after = (w.astype(float) for w in weights)
    at = 0
    for line in numbers:
        def score(labels, line=line):
            total = field.first[labels[0]]
            for t, (label, number) in enumerate(zip(labels, line)):
                total += own[number, label] + (before[line[t - 1], label] if t else 0)
                total += (after[line[t + 1], label] if t + 1 < len(line) else 0) + (field.moves[labels[t - 1], label] if t else 0)
            return total

        best = max(itertools.product(range(len(pii.LABELS)), repeat=len(line)), key=score)
        assert score(best) == pytest.approx(score(tuple(found[at : at + len(line)])), abs=1e-3)
        at += len(line)


def test_personal_data_in_documents(spark, field):
    texts = [
        "Please phone (555) 010-4466 after ten.\nOr write to jane.doe@mail.example.org, thanks.",
        "Nothing here but 2024-05-17, version 2.0.14 and order 88213.",
        None,
        "",
        "🙂 at 10.0.0.1 and 4111 1111 1111 1111; +1 (212) 555-0123 and 999.1.1.1",
    ]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = {r["doc_id"]: r for r in pii.find_pii(frame, field, batch_words=5).collect()}
    shown = {d: [(s["kind"], texts[d][s["start"] : s["end"]]) for s in r["spans"]] for d, r in found.items()}
    assert shown[0] == [("email", "jane.doe@mail.example.org"), ("phone", "(555) 010-4466")]
    assert shown[1] == shown[2] == shown[3] == []
    assert shown[4] == [("ip", "10.0.0.1"), ("card", "4111 1111 1111 1111"), ("phone", "+1 (212) 555-0123")]
    for r in found.values():
        assert [tuple(s) for s in r["base"]] == slow_spans(texts[r["doc_id"]] or "")
        assert set(map(tuple, r["base"])) <= set(map(tuple, r["spans"]))
    clean = pii.find_pii(odd_frame(spark), field).collect()
    assert len(clean) == len(odd_documents())
    assert not any(r["spans"] for r in clean)
    assert pii.find_pii(odd_frame(spark, []), field).count() == 0


def test_rare_languages_are_learned(spark):
    """Two languages in some 1,000 rows, of which a sample of 100 by hash alone has none; rows without letters take no place."""
    rows = [(k, f"{a} {b} {a}", "aa") for k, (a, b) in enumerate((f"bada{i % 7}k", f"gado{i % 5}m") for i in range(900))]
    rows += [(2000 + k, "12 3", "aa") for k in range(300)]
    rows += [(3000 + k, "zyxw wxyz vuvu zzyx", "rare") for k in range(3)] + [(None, "qqrr rrqq qrqr", "once")] * 2
    frame = spark.createDataFrame(rows, "doc_id bigint, text string, lang string").repartition(5)
    settings = langid.LanguageSettings(max_train=100)
    model = langid.train_language_model(frame, settings)
    assert model.languages == ["aa", "once", "rare"]
    assert [model.predict(t)[0] for t in ("zyxw wxyz", "bada gado")] == ["rare", "aa"]
    lettered = frame.selectExpr("xxhash64(cast(doc_id as string), text) _hash", "text _text", "lang _lang").filter("_text <> '12 3'")
    sample = langid._sample(lettered, settings)
    for lang, n in {"aa": 99, "rare": 3, "once": 1}.items():
        hashes = sorted({r["_hash"] for r in lettered.filter(lettered["_lang"] == lang).collect()})
        assert [r[0] for r in sample if r[1] == lang] == hashes[:n]


def test_no_more_rows_than_the_quotas_are_sent_to_the_driver(spark):
    wanted = langid.LanguageSettings(max_train=40, least_train=1)
    rows = spark.range(60_000).selectExpr(
        "if(id % 7 = 0, 'fr', 'en') _lang", "xxhash64(id) _hash", "concat('text ', id) _text"
    )
    shift, edges, quotas = langid._cutoffs(rows, wanted)
    passed = rows.join(langid._per_language(rows, edges), "_lang").filter(F.shiftright("_hash", shift) <= F.col("_edge"))
    counts = {r["_lang"]: r["count"] for r in passed.groupBy("_lang").count().collect()}
    assert all(quotas[k] <= n <= quotas[k] + 1 for k, n in counts.items())
    sample = langid._sample(rows, wanted)
    smallest = {}
    for r in sorted(rows.collect(), key=lambda r: r["_hash"]):
        if len(smallest.setdefault(r["_lang"], [])) < quotas[r["_lang"]]:
            smallest[r["_lang"]].append(r["_hash"])
    assert sorted(h for found in smallest.values() for h in found) == [s[0] for s in sample]


@pytest.mark.parametrize("length", [45, 60, 100, 5000])
def test_addresses_inside_long_words(spark, field, length):
    word = "a" * length + ",jörg@mail.example.com," + "b" * length
    frame = spark.createDataFrame([(1, f"write to {word} now")], "doc_id bigint, text string")
    assert [s["kind"] for s in pii.find_pii(frame).first()["spans"]][:1] == ["email"]


def test_language_sample_comes_as_packed_numbers(spark):
    docs = spark.createDataFrame([(1, "un deux trois", "fr"), (2, "one two three", "en")], "doc_id bigint, text string, lang string")
    rows = docs.select(F.col("doc_id").alias("_hash"), F.col("text").alias("_text"), F.col("lang").alias("_lang"))
    settings = langid.LanguageSettings()
    sample = langid._sample(rows, settings)
    texts = dict(docs.select("doc_id", "text").collect())
    for number, _, features, counts in sample:
        assert features.dtype == counts.dtype == np.dtype("<i4")
        wanted = langid.ngrams(texts[number], settings)
        assert np.array_equal(features, wanted[0]) and np.array_equal(counts, wanted[1])
    assert len(sample) == 2
