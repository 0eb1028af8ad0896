import io
import random
import zlib

import numpy as np
import pytest
import zstandard
from llm_cases import odd_documents, odd_frame, prose

from cartyield.llm.tokenfile import DamagedFile, TokenFileReader, TokenFileWriter, tokenize_to_files, write_token_files
from cartyield.llm.tokenize import TextEncoder, default_vocabulary
from cartyield.plans.workspace import Workspace


def made(documents, frame_tokens=50):
    stream = io.BytesIO()
    writer = TokenFileWriter(stream, frame_tokens)
    for doc_id, ids in documents:
        writer.add(doc_id, np.array(ids, "<u4").tobytes())
    writer.close()
    return stream


def documents():
    rng = random.Random(1)
    return [(None, [5]), (None, [])] + [(3 * k, [rng.getrandbits(32) for _ in range(rng.randint(0, 90))]) for k in range(-20, 60)]


def test_round_trip_and_single_documents():
    stream = made(documents())
    reader = TokenFileReader(stream)
    assert [(d, t.tolist()) for d, t in reader.documents()] == documents()
    frames = len(reader.frames)
    assert frames > 20
    reader = TokenFileReader(stream)
    assert [(d, t.tolist()) for d, t in reader.documents([30])] == [(d, t) for d, t in documents() if d == 30]
    assert 0 < reader.frames_read <= 2
    assert list(reader.documents([31, 10**15])) == []
    # The seek table and the spans are skippable, so any zstandard reader unpacks the file as it is.
    whole = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(stream.getvalue()), read_across_frames=True).read()
    assert len(whole) == sum(f.unpacked for f in reader.frames)


def test_empty_file():
    assert list(TokenFileReader(made([])).documents()) == []


def test_damage_is_noticed():
    data = bytearray(made(documents()).getvalue())
    reader = TokenFileReader(io.BytesIO(bytes(data)))
    frame = reader.frames[4]
    data[frame.offset + frame.packed - 3] ^= 1
    with pytest.raises(DamagedFile):
        list(TokenFileReader(io.BytesIO(bytes(data))).documents())
    untouched = TokenFileReader(io.BytesIO(bytes(data))).documents([reader.frames[6].first])
    assert list(untouched)
    with pytest.raises(DamagedFile):
        TokenFileReader(io.BytesIO(bytes(data[:-5])))


def test_files_of_documents(spark, tmp_path):
    encode = TextEncoder(default_vocabulary())._whole
    docs = [(d, encode(t or "") + b"\1\0\0\0") for d, t, *_ in odd_documents()]
    found = sorted(tokenize_to_files(odd_frame(spark), Workspace(spark)).collect(), key=lambda r: (r["start"], r["n_tokens"]))
    key = lambda d: (d is not None, d or 0)
    assert [r["doc_id"] for r in found] == sorted((d for d, _ in docs), key=key)
    assert sorted((key(r["doc_id"]), r["ids_crc32"]) for r in found) == sorted((key(d), zlib.crc32(i)) for d, i in docs)
    starts = np.cumsum([0] + [r["n_tokens"] for r in found])
    assert [r["start"] for r in found] == starts[:-1].tolist()
    manifest = write_token_files(odd_frame(spark), str(tmp_path / "files")).collect()
    assert sum(r["documents"] for r in manifest) == len(docs)
    assert {p.name for p in (tmp_path / "files").glob("*.zst")} == {r["file"] for r in manifest}
    assert tokenize_to_files(odd_frame(spark, []), Workspace(spark)).count() == 0


def test_encoder_gives_what_the_library_gives():
    rng = random.Random(2)
    encode = TextEncoder(default_vocabulary(), limit=20)
    letters = "aAbB zZ.,'09éÉßİΣσς \x1c\x85\xa0ªﬁ東<|endoftext|>\n\t-_"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randint(0, 60))) for _ in range(400)]
    texts += ["Don't, it's. <|endoftext|> x<|startoftext|>, é É. ΟΔΥΣΣΕΥΣ.", prose(rng, 300)]
    for text in texts:
        assert encode(text) == encode._whole(text), text
    byte_level = TextEncoder(default_vocabulary().replace("word_bpe_49k", "byte_bpe_50k"))
    assert not byte_level._by_word
    assert all(byte_level(t) == byte_level._whole(t) for t in texts[:50])
