"""The registered queries themselves, on a table of odd rows, against slow versions of their contracts."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from conftest import rows
from llm_cases import odd_documents, odd_frame, prose
from test_exact_and_near_copies import slow_components, slow_fingerprint
from test_mix_and_packing import slow_targets
from test_new_operators import VECTORS, odd_vectors
from test_text_models import slow_spans

from cartyield.llm import queries

TEXTS = [
    "Under the MIT License. mit  license! mit-license, but not mit licensed",
    "Apache License and GNU General Public License\nand the apache\tLICENSE",
    "write to a.b@example.com or +49 (171) 234-5678, card 4111 1111 1111 1111, host 10.0.0.255 or 10.0.0.256",
    "é4111-1111-1111-1111 x@y.z x@y +1 2",
]


@pytest.fixture(scope="module")
def docs():
    rng = random.Random(21)
    extra = [(700 + k, text, "en", "s1") for k, text in enumerate(TEXTS)]
    extra += [(800 + k, prose(rng, rng.randint(3, 80)), rng.choice(["en", "fr", None]), rng.choice(["s1", "s9", "ä"])) for k in range(120)]
    return odd_documents() + [(*r, len(r[1]), "c", "c", "c", "c", "c") for r in extra]


@pytest.fixture(scope="module")
def folder(spark, docs, tmp_path_factory):
    path = tmp_path_factory.mktemp("tables")
    odd_frame(spark, docs).write.parquet(str(path / "documents.parquet"))
    spark.createDataFrame(odd_vectors(random.Random(6), 120), VECTORS).write.parquet(str(path / "embeddings.parquet"))
    return str(path)


def lowered(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def remainder(doc_id, modulus):
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % modulus


def by_id(frame, *columns):
    return sorted((tuple(r) for r in frame.select("doc_id", *columns).collect()), key=repr)


def test_op1_base_columns(spark, docs, folder):
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", lowered(t)) + [None] for _, t, *_ in docs]
    held = [remainder(i, 10) == 0 for i, *_ in docs]
    counts = Counter(w for ws, h in zip(tokens, held) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    expected = []
    for (i, *_), ws, h in zip(docs, tokens, held):
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws)
        expected.append((i, h, len(ws), sum(w in counts for w in ws), n, round(base, 6)))
    found = queries.op1_backoff_lm(spark, folder).collect()
    assert sorted(((*tuple(r)[:5], round(r["base_score"], 6)) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in found)


def test_op2_sizes_and_targets(spark, docs, folder):
    sizes = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, *_ in docs]
    of_source = Counter()
    for (_, _, _, source, *_), size in zip(docs, sizes):
        of_source[source] += size
    targets = slow_targets(of_source)
    expected = [(r[0], size, of_source[r[3]], round(targets[r[3]], 6)) for r, size in zip(docs, sizes)]
    found = queries.op2_source_mix(spark, folder).collect()
    assert sorted(((*tuple(r)[:3], round(r["target"], 6)) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(0 <= r["taken"] <= 2 * r["size"] for r in found)
    assert sorted(map(tuple, queries.op2_source_mix(spark, folder).collect()), key=repr) == sorted(map(tuple, found), key=repr)


def test_op3_base_columns(spark, docs, folder):
    expected = []
    for doc_id, text, *_ in docs:
        words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered(text))
        places = []
        for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
            wanted = phrase.split()
            places += [(k, label) for k in range(len(words)) if words[k : k + len(wanted)] == wanted]
        starts = [k for k, _ in places]
        labels = ",".join(sorted({label for _, label in places}))
        expected.append((doc_id, len(words), len(places), min(starts, default=None), max(starts, default=None), labels))
    frame = queries.op3_license_scan(spark, folder)
    assert by_id(frame, "n_words", "n_base", "first_word", "last_word", "base_labels") == sorted(expected, key=repr)
    for r in frame.collect():
        assert set(filter(None, r["base_labels"].split(","))) <= set(r["labels"].split(","))
        assert r["labels"].split(",") == sorted(set(r["labels"].split(","))) and 0 <= r["score"] <= 1


def test_op5_base_columns(spark, docs, folder):
    kinds = ["email", "ip", "card", "phone"]
    expected, wanted = [], defaultdict(list)
    for doc_id, text, *_ in docs:
        spans = sorted(slow_spans(text or ""), key=lambda s: (kinds.index(s[0]), s[1]))
        listed = ",".join(f"{k}:{a}:{b}" for k, a, b in spans)
        expected.append((doc_id, *(sum(s[0] == k for s in spans) for k in kinds), hashlib.sha256(listed.encode()).hexdigest()))
        wanted[doc_id].append(set(filter(None, listed.split(","))))
    frame = queries.op5_pii(spark, folder)
    assert by_id(frame, "n_email", "n_ip", "n_card", "n_phone", "base_sha256") == sorted(expected, key=repr)
    for r in frame.collect():
        assert any(base <= set(r["spans"].split(",")) | {""} for base in wanted[r["doc_id"]])


def test_op6_learns_from_training_rows_alone(spark, docs, folder):
    found = queries.op6_language_id(spark, folder).collect()
    assert sorted(((r["doc_id"], r["held_out"]) for r in found), key=repr) == sorted(((i, remainder(i, 4) == 2) for i, *_ in docs), key=repr)
    learned = {lang for i, _, lang, *_ in docs if remainder(i, 4) != 2 and lang}
    assert {r["lang_pred"] for r in found} <= learned | {"und"}
    without = sum(not any(c.isalpha() for c in t or "") for _, t, *_ in docs)
    assert sum(r["lang_pred"] == "und" for r in found) == without
    assert all(0 <= r["score"] <= 1 for r in found)


def test_op7_fingerprints_and_groups(spark, docs, folder):
    prints = [slow_fingerprint(t) for _, t, *_ in docs]
    links = [(a, b) for a in range(len(docs)) for b in range(a) if (prints[a] ^ prints[b]).bit_count() <= 4]
    parts = slow_components(range(len(docs)), links)
    smallest = {}
    for k, (i, *_) in enumerate(docs):
        if i is not None:
            smallest[parts[k]] = min(i, smallest.get(parts[k], i))
    expected = [(i, f"{prints[k]:016x}", smallest.get(parts[k])) for k, (i, *_) in enumerate(docs)]
    assert rows(queries.op7_simhash(spark, folder)) == sorted(expected, key=repr)


def encoded(docs):
    from tokenizers import Tokenizer

    from cartyield.llm.tokenize import default_vocabulary

    encode = Tokenizer.from_file(default_vocabulary()).encode
    return [np.array(encode(t or "", add_special_tokens=False).ids + [1], "<u4") for _, t, *_ in docs]


def test_op8_pieces(spark, docs, folder):
    expected = []
    for (doc_id, *_), ids in zip(docs, encoded(docs)):
        for piece, start in enumerate(range(0, len(ids), 4096)):
            part = ids[start : start + 4096]
            expected.append((doc_id, piece, start, len(part), zlib.crc32(part.tobytes())))
    frame = queries.op8_best_fit_packing(spark, folder)
    assert by_id(frame, "piece", "start", "length", "ids_crc32") == sorted(expected, key=repr)
    sequences = defaultdict(list)
    for r in frame.collect():
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for placed in sequences.values():
        ends = [0]
        for offset, length in sorted(placed):
            assert offset == ends[-1]
            ends.append(offset + length)
        assert ends[-1] <= 4096


def test_op10_documents_from_files(spark, docs, folder):
    expected = [(i, len(ids), zlib.crc32(ids.tobytes())) for (i, *_), ids in zip(docs, encoded(docs))]
    frame = queries.op10_token_files(spark, folder)
    assert by_id(frame, "n_tokens", "ids_crc32") == sorted(expected, key=repr)
    total, last = 0, None
    for r in sorted(frame.collect(), key=lambda r: r["start"]):
        assert r["start"] == total
        total += r["n_tokens"]
        if r["doc_id"] is not None:
            assert last is None or last <= r["doc_id"]
            last = r["doc_id"]


@pytest.mark.parametrize("name", ["op4_block_top_k", "op9_exact_dedup", "op13_quality_rules"])
def test_queries_agree_with_their_sql(spark, folder, name):
    db = duckdb.connect()
    for table in ("documents", "embeddings"):
        db.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet/*.parquet'")
    result = db.execute(queries.oracle_sql()[name])
    names = [d[0] for d in result.description]
    frame = queries.queries()[name](spark, folder).select(*names)
    theirs = sorted(result.fetchall(), key=repr)
    if name == "op9_exact_dedup":  # null ids compare as unknown there
        k = names.index("kept")
        theirs = sorted(((*r[:k], bool(r[k]) or r[0] is None and r[1] is None, *r[k + 1 :]) for r in theirs), key=repr)
    assert rows(frame) == theirs
