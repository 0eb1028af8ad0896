"""Scoring of texts by a weighted backoff automaton over smoothed word n-grams.

The automaton's states are the contexts seen in training. A seen n-gram is an arc from its context,
weighted with its smoothed log-probability; a failure arc leads from each context to the next shorter
one, weighted with what the context leaves to words it was not seen with. Probabilities are

    p1(w) = (c(w) + a) / (N + a (V + 1)),    pk(w | h) = (c(hw) + m p(k-1)(w | h')) / (c(h) + m)

where h' is h without its first word; each is a distribution over the V known tokens and one unknown.

No machine holds the whole automaton. Documents are tokenised once into blocks. A block sends the
hashes of its different n-grams with their training counts to buckets of hashes; a bucket adds up the
counts of all blocks and returns the totals in the order they came, so each block gets the part of
the automaton that its texts can reach and is traversed on its own. N-grams are known by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace, workspace_for

# No word holds a blank, so these are no words.
_END, _START = b" end", b" start"
_BLOCK = "block bigint, ids array<{id}>, held binary, lengths binary, tokens binary, types binary, n_tokens bigint, train_tokens bigint, train_docs bigint"


def _hash(word: bytes) -> int:
    import xxhash

    return xxhash.xxh64_intdigest(word)


class _Numbers(dict):
    """Numbers words as they come."""

    def __missing__(self, word: bytes) -> int:
        self[word] = number = len(self)
        return number


def _pack(values: np.ndarray) -> bytes:
    """Bytes of equal weight together, which compress well, packed by zstandard."""
    import zstandard

    octets = values.view(np.uint8).reshape(-1, values.dtype.itemsize)
    return zstandard.ZstdCompressor(level=1).compress(octets.T.tobytes())


def _unpack(data: bytes, dtype: str) -> np.ndarray:
    import zstandard

    octets = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    return np.ascontiguousarray(octets.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def tokenized_blocks(docs: DataFrame, held: Column, block_tokens: int, id_col: str, text_col: str) -> DataFrame:
    """Documents as blocks of some ``block_tokens`` tokens, words numbered within the block."""
    used = docs.select(F.col(id_col).alias("_id"), held.alias("_held"), F.col(text_col).alias("_text"))
    kind = used.schema["_id"].dataType.simpleString()

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        words, ids, held, lengths, tokens, total = _Numbers(), [], [], [], [], 0

        def block() -> pa.RecordBatch:
            all_lengths, all_held = np.array(lengths, np.int64), np.array(held, np.uint8)
            trained = all_held == 0
            types = np.array([_hash(w) for w in words], np.uint64)
            all_ids = pa.concat_arrays(ids)
            columns = [
                pa.array([part << 32 | number]),
                pa.ListArray.from_arrays(pa.array([0, len(all_ids)], pa.int32()), all_ids),
                *[pa.array([_pack(a)], pa.binary()) for a in (all_held, all_lengths, np.concatenate(tokens), types)],
                *[pa.array([int(n)], pa.int64()) for n in (total, all_lengths[trained].sum(), trained.sum())],
            ]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for k, text in enumerate(batch.column(2)):
                if not lengths:
                    words[_END]
                found = (text.as_py() or "").encode().lower().split()
                found.append(_END)
                tokens.append(np.fromiter(map(words.__getitem__, found), np.uint32, len(found)))
                ids.append(batch.column(0).slice(k, 1))
                held.append(bool(batch.column(1)[k].as_py()))
                lengths.append(len(found))
                total += len(found)
                if total >= block_tokens:
                    yield block()
                    number += 1
                    words, ids, held, lengths, tokens, total = _Numbers(), [], [], [], [], 0
        if lengths:
            yield block()

    schema = _BLOCK.format(id=kind)
    names = [c.split()[0] for c in schema.split(", ")]
    return used.mapInArrow(cut, schema)


def ngram_keys(tokens: np.ndarray, starts: np.ndarray, types: np.ndarray, order: int) -> np.ndarray:
    """Hash of the n-gram of ``order`` tokens that ends at each position; before a text stands the start."""
    hashes = types[tokens]
    place = np.arange(len(tokens)) - starts
    keys = np.zeros(len(tokens), np.uint64)
    for back in range(order - 1, -1, -1):
        word = np.full(len(tokens), _hash(_START), np.uint64)
        word[back:] = hashes[: len(hashes) - back] if back else hashes
        if back:
            word[place < back] = _hash(_START)
        keys = (keys ^ word) * np.uint64(0x9E3779B97F4A7C15)
        keys ^= keys >> np.uint64(32)
    return keys * np.uint64(0xD6E8FEB86659FD93) ^ np.uint64(order)


def _opened(row: dict) -> tuple[np.ndarray, ...]:
    held, lengths = _unpack(row["held"], "u1"), _unpack(row["lengths"], "i8")
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    return held, lengths, starts, _unpack(row["tokens"], "u4"), _unpack(row["types"], "u8")


def _edges(unique: np.ndarray, bits: int) -> np.ndarray:
    """Where each bucket begins in sorted keys."""
    lows = np.arange(1 << bits, dtype=np.uint64) << np.uint64(64 - bits)
    return np.append(np.searchsorted(unique, lows), len(unique))


def _sent(blocks: DataFrame, orders: int, bits: int) -> DataFrame:
    """(n, bucket, block, keys, counts): the different n-grams of each block by bucket."""

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                held, lengths, starts, tokens, types = _opened(row)
                trained = np.repeat(held == 0, lengths)
                for n in range(1, orders + 1):
                    unique, inverse = np.unique(ngram_keys(tokens, starts, types, n), return_inverse=True)
                    counts = np.bincount(inverse, trained, len(unique)).astype(np.uint32)
                    edges = _edges(unique, bits)
                    used = np.flatnonzero(np.diff(edges))
                    keys = [_pack(np.diff(unique[edges[b] : edges[b + 1]], prepend=np.uint64(0))) for b in used]
                    sums = [_pack(counts[edges[b] : edges[b + 1]]) for b in used]
                    size = len(used)
                    columns = [pa.array([n] * size, pa.int32()), pa.array(used.astype(np.int32))]
                    columns += [pa.array([row["block"]] * size, pa.int64()), pa.array(keys, pa.binary()), pa.array(sums, pa.binary())]
                    yield pa.RecordBatch.from_arrays(columns, names=["n", "bucket", "block", "keys", "counts"])

    used = blocks.select("block", "held", "lengths", "tokens", "types")
    return used.mapInArrow(send, "n int, bucket int, block bigint, keys binary, counts binary")


def _add_up(group: pa.Table) -> pa.Table:
    """Totals over all blocks of one bucket, returned to each block in its own order."""
    keys = [np.cumsum(_unpack(k.as_py(), "u8"), dtype=np.uint64) for k in group["keys"]]
    counts = np.concatenate([_unpack(c.as_py(), "u4") for c in group["counts"]])
    _, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    sums = np.bincount(inverse, counts).astype(np.int64)
    edges = np.cumsum([len(k) for k in keys])[:-1]
    totals = [_pack(part) for part in np.split(sums[inverse], edges)]
    known = [int((sums > 0).sum())] + [0] * (len(keys) - 1)
    return pa.table([group["n"], group["bucket"], group["block"], pa.array(totals, pa.binary()), pa.array(known, pa.int64())], names=["n", "bucket", "block", "totals", "known"])


def traverse(counts: list[np.ndarray], contexts: list[np.ndarray], unigram: np.ndarray, strength: float) -> np.ndarray:
    """Log10-probability of each token, walking the automaton from left to right.

    ``counts[k]`` and ``contexts[k]`` are the training counts of the n-gram of k + 1 tokens ending at each
    position and of its context, which is the state reached there if it was seen. All texts of a
    block are walked at once: at each position the walk tries the arc of the longest context, and while there is
    none it adds the weight of the failure arc and goes on from the shorter context.
    """
    chances = [unigram]
    for k in range(1, len(counts)):
        chances.append((counts[k] + strength * chances[-1]) / (contexts[k] + strength))
    score = np.zeros(len(unigram))
    waiting = np.arange(len(unigram))
    for k in range(len(counts) - 1, 0, -1):
        has_arc = counts[k][waiting] > 0
        taken, failed = waiting[has_arc], waiting[~has_arc]
        score[taken] += np.log10(chances[k][taken])
        score[failed] += np.log10(strength / (contexts[k][failed] + strength))
        waiting = failed
    score[waiting] += np.log10(unigram[waiting])
    return score


def score_texts(
    docs: DataFrame,
    held: Column,
    orders: int = 2,
    strength: float = 40.0,
    added: float = 0.1,
    block_tokens: int = 1 << 20,
    id_col: str = "doc_id",
    text_col: str = "text",
    workspace: Workspace | None = None,
) -> DataFrame:
    """(id, held_out, n_tokens, n_known, train_tokens, base_score, score), one row per row of ``docs``.

    Learns from the rows where ``held`` is false and scores all. A text's tokens are its words in
    lower-case A-Z and one end; null and empty texts are an end alone. ``base_score`` is the log10-probability by
    single tokens, ``score`` that by the automaton, whose order is ``orders``; ``strength`` is m above, ``added`` a.
    Null ``held`` counts as false. Repeated rows are learnt from and scored each. With nothing to learn from, every
    token has probability 1. Other columns are not looked at; no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    blocks = workspace.store(tokenized_blocks(docs, held, block_tokens, id_col, text_col), "blocks")
    n_tokens, train_tokens, train_docs = (
        int(x or 0) for x in blocks.agg(F.sum("n_tokens"), F.sum("train_tokens"), F.sum("train_docs")).first()
    )
    # Some 2^20 different n-grams to a bucket.
    bits = max(4, (n_tokens >> 20).bit_length())
    sent = _sent(blocks, orders, bits)
    replies = sent.groupBy("n", "bucket").applyInArrow(_add_up, "n int, bucket int, block bigint, totals binary, known bigint")
    replies = workspace.store(replies, "totals")
    types = int(replies.filter("n = 1").agg(F.sum("known")).first()[0] or 0)
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
    names = [id_col, "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]

    def score(block: pa.Table, totals: pa.Table) -> pa.Table:
        row = block.drop_columns(["ids"]).to_pylist()[0]
        held, lengths, starts, tokens, hashes = _opened(row)
        first = np.arange(len(tokens)) == starts
        sums = {(r["n"], r["bucket"]): r["totals"] for r in totals.select(["n", "bucket", "totals"]).to_pylist()}
        counts, contexts = [], []
        for n in range(1, orders + 1):
            unique, inverse = np.unique(ngram_keys(tokens, starts, hashes, n), return_inverse=True)
            parts = [_unpack(sums[n, b], "i8") for b in np.flatnonzero(np.diff(_edges(unique, bits))).tolist()]
            # The context of n tokens is the shorter n-gram one position back; at the start it is all texts.
            context = np.append(0, counts[-1][:-1]) if counts else np.zeros(len(tokens), np.int64)
            contexts.append(np.where(first, train_docs, context))
            counts.append(np.concatenate(parts)[inverse])
        unigram = (counts[0] + added) / (train_tokens + added * (types + 1))
        cuts = np.cumsum(lengths) - lengths
        by_text = [
            np.add.reduceat(x, cuts) for x in ((counts[0] > 0).astype(np.int64), np.log10(unigram), traverse(counts, contexts, unigram, strength))
        ]
        ids = block["ids"].combine_chunks()
        columns = [ids.flatten() if isinstance(ids, pa.ListArray) else pa.concat_arrays([c.flatten() for c in ids.chunks])]
        columns += [pa.array(held == 1), pa.array(lengths), pa.array(by_text[0])]
        columns += [pa.array(np.full(len(lengths), train_tokens)), pa.array(by_text[1]), pa.array(by_text[2])]
        return pa.table(columns, names=names)

    both = blocks.drop("n_tokens", "train_tokens", "train_docs").groupBy("block").cogroup(replies.groupBy("block"))
    return both.applyInArrow(score, schema)
