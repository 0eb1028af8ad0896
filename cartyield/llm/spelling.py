"""Spelling variants: words one edit apart, found by probing generated edits against Bloom filters.

All words one deletion or one replacement away from a word are generated as hashes, in numpy, and looked up in a blocked
Bloom filter of the vocabulary, which has a range of blocks per word length. Only what the filter lets through is spelled
out and shuffled, to a join with the vocabulary that removes what was let through wrongly. An insertion is the other word's
deletion, so each pair is looked for from one side.

The filter is broadcast in slices of a fixed size, one pass over the vocabulary per slice, so what is broadcast does
not grow with the vocabulary.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..plans.workspace import Workspace, workspace_for

RUN = r"([A-Za-zÀ-ÿ]+)"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LENGTH, LEAST_COUNT, LEAST_RATIO = 6, 5, 5
DAMAGE = 199

#: A block has eight lanes of 64 bits, and a word one bit in each; 20 words to a block let some 0.1 % through wrongly.
_LANES = 8
_WORDS_PER_BLOCK = 20
#: Blocks broadcast at once: 32 MB.
SLICE_BLOCKS = 1 << 19
#: Edits looked up at once.
_AT_ONCE = 1 << 21

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)


def _mixed(x: np.ndarray) -> np.ndarray:
    """64 well-mixed bits of each number (the finaliser of SplitMix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _values(points: np.ndarray) -> np.ndarray:
    """A fixed random number for each code point."""
    return _mixed((points.astype(np.uint64) + np.uint64(1)) * np.uint64(_BASE))


def _powers(length: int) -> np.ndarray:
    return np.cumprod(np.array([1] + [_BASE] * length, np.uint64), dtype=np.uint64)


def _points(words: list[str], length: int) -> np.ndarray:
    """Code points of words of equal length, one row each."""
    return np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(len(words), length)


def word_hashes(points: np.ndarray) -> np.ndarray:
    """The hash of each word: a polynomial in its code points, so that edits need no new start."""
    with np.errstate(over="ignore"):
        return (_values(points) * _powers(points.shape[1])[:-1]).sum(1, dtype=np.uint64)


def _bits(hashes: np.ndarray) -> np.ndarray:
    """(n, 8): the bit of each lane."""
    mixed = _mixed(hashes)
    shifts = np.arange(_LANES, dtype=np.uint64) * np.uint64(6)
    return np.uint64(1) << (mixed[:, None] >> shifts & np.uint64(63))


def _block(hashes: np.ndarray, first: int, blocks: int) -> np.ndarray:
    """The block of each hash among the ``blocks`` blocks of its length."""
    return np.int64(first) + (_mixed(hashes ^ np.uint64(_BASE)) % np.uint64(blocks)).astype(np.int64)


class Shards:
    """Which blocks of the filter hold the words of a length: ``counts`` maps lengths to numbers of words."""

    def __init__(self, counts: dict[int, int]):
        self.of: dict[int, tuple[int, int]] = {}
        self.blocks = 0
        for length in sorted(counts):
            needed = -(-counts[length] // _WORDS_PER_BLOCK)
            self.of[length] = (self.blocks, needed)
            self.blocks += needed


def _by_length(words: list[str]) -> Iterator[tuple[int, list[int]]]:
    places: dict[int, list[int]] = {}
    for k, word in enumerate(words):
        places.setdefault(len(word), []).append(k)
    yield from places.items()


def _filter_rows(vocabulary: DataFrame, shards: Shards) -> DataFrame:
    """(block, l0 … l7): the filter's blocks, from all words."""
    names = ["block", *(f"l{k}" for k in range(_LANES))]

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words = batch.column(0).to_pylist()
            for length, places in _by_length(words):
                hashes = word_hashes(_points([words[k] for k in places], length))
                blocks = _block(hashes, *shards.of[length])
                order = np.argsort(blocks, kind="stable")
                used, starts = np.unique(blocks[order], return_index=True)
                lanes = np.bitwise_or.reduceat(_bits(hashes)[order], starts, axis=0).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(used), *(pa.array(np.ascontiguousarray(c)) for c in lanes.T)], names=names)

    rows = vocabulary.select("word").mapInArrow(build, ", ".join(f"{n} bigint" for n in names))
    return rows.groupBy("block").agg(*(F.bit_or(n).alias(n) for n in names[1:]))


def _edits(points: np.ndarray, alphabet: np.ndarray, start: int, stop: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, hashes, places) of edits at code points ``start`` to ``stop``: deletions, then replacements.

    ``places`` are (word, place, letter) with letter -1 for a deletion. A replacement is by a letter that sorts after the old
    one, since the other word finds the rest.
    """
    n, length = points.shape
    values, powers = _values(points), _powers(length)
    terms = values * powers[:-1]
    before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    total = before[:, -1:]
    span = np.arange(start, stop)
    shortened = before[:, span] + (total - before[:, span + 1]) * np.uint64(_INVERSE)
    word, place = np.indices(shortened.shape).reshape(2, -1)
    yield length - 1, shortened.ravel(), np.stack([word, place + start, np.full(word.size, -1)], 1)
    letters = _values(alphabet)
    replaced = (total - terms[:, span])[:, :, None] + letters[None, None, :] * powers[span][None, :, None]
    later = alphabet[None, None, :] > points[:, span, None]
    word, place, letter = np.nonzero(later)
    yield length, replaced[later], np.stack([word, place + start, letter], 1)


def _candidates(vocabulary: DataFrame, shards: Shards, alphabet: str, workspace: Workspace, slice_blocks: int) -> DataFrame:
    """(word, n, near): edits of words that the filter lets through, in one pass for each slice of it."""
    context = vocabulary.sparkSession.sparkContext
    rows = workspace.store(_filter_rows(vocabulary, shards), "filter")
    letters = np.array([ord(c) for c in alphabet], np.uint32)
    found = None
    for low in range(0, shards.blocks, slice_blocks):
        high = min(low + slice_blocks, shards.blocks)
        # At most slice_blocks rows of fixed size.
        part = rows.filter((F.col("block") >= low) & (F.col("block") < high)).toArrow()
        lanes = np.zeros((high - low, _LANES), np.uint64)
        lanes[part["block"].to_numpy() - low] = np.stack([part[f"l{k}"].to_numpy() for k in range(_LANES)], 1).view(np.uint64)
        sent = context.broadcast(lanes)

        def probe(batches: Iterator[pa.RecordBatch], sent=sent, low=low, high=high) -> Iterator[pa.RecordBatch]:
            held = sent.value
            with np.errstate(over="ignore"):
                for batch in batches:
                    for near in _probed(batch, held, low, high, shards, letters):
                        yield near

        passed = workspace.store(vocabulary.select("word", "n").mapInArrow(probe, "word string, n bigint, near string"), f"candidates-{low}")
        found = passed if found is None else found.unionByName(passed)
    return found


def _probed(batch: pa.RecordBatch, lanes: np.ndarray, low: int, high: int, shards: Shards, letters: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The edits of a batch's words that may be words, as far as their blocks lie in the slice."""
    words, counts = batch.column(0).to_pylist(), batch.column(1).to_numpy()
    for length, places in _by_length(words):
        step = max(1, _AT_ONCE // (length * (len(letters) + 1)))
        span = min(length, max(1, _AT_ONCE // (len(letters) + 1)))
        for k in range(0, len(places), step):
            chosen = places[k : k + step]
            points = _points([words[p] for p in chosen], length)
            for start in range(0, length, span):
                for size, hashes, where in _edits(points, letters, start, min(start + span, length)):
                    if size not in shards.of:
                        continue
                    blocks = _block(hashes, *shards.of[size])
                    inside = np.flatnonzero((blocks >= low) & (blocks < high))
                    bits = _bits(hashes[inside])
                    kept = inside[((lanes[blocks[inside] - low] & bits) == bits).all(1)]
                    sources, near = [], []
                    for w, at, letter in where[kept].tolist():
                        word = words[chosen[w]]
                        sources.append(chosen[w])
                        near.append(word[:at] + ("" if letter < 0 else chr(letters[letter])) + word[at + 1 :])
                    yield pa.RecordBatch.from_arrays(
                        [batch.column(0).take(pa.array(sources, pa.int64())), pa.array(counts[sources] if sources else [], pa.int64()), pa.array(near, pa.string())],
                        names=["word", "n", "near"],
                    )


def damaged(doc_id: Column, run: Column) -> Column:
    """``run``, or ``run`` without one code point where crc32 of ``<doc_id>:<run>`` is a multiple of 199."""
    h = F.crc32(F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), run))
    at = (h % F.length(run)).cast("int")
    cut = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
    return F.when(h % DAMAGE == 0, cut).otherwise(run)


def vocabulary(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): the words of six code points or more that occur five times or more, of all whole texts.

    Words are runs of letters of Latin-1, A-Z in lower case. As spelling errors of known rate, one run in 199 lacks a letter.
    """
    lowered = F.translate(F.col(text_col), UPPER, LOWER)
    runs = docs.select(F.col(id_col).alias("_id"), F.explode(F.regexp_extract_all(lowered, F.lit(RUN))).alias("_run"))
    words = runs.select(damaged(F.col("_id"), F.col("_run")).alias("word"))
    return words.filter(F.length("word") >= LEAST_LENGTH).groupBy("word").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") >= LEAST_COUNT)


def near_words(words: DataFrame, workspace: Workspace | None = None, slice_blocks: int = SLICE_BLOCKS) -> DataFrame:
    """(word, n, near, near_n): all pairs of ``words`` (word, n) one edit apart, each in both directions.

    One edit inserts, deletes or replaces one code point. Words must differ from each other and not be empty or null.
    """
    workspace = workspace_for(words, workspace)
    words = workspace.store(words.select("word", F.col("n").cast("bigint").alias("n")), "vocabulary")
    lengths = {r[0]: r[1] for r in words.groupBy(F.length("word")).count().collect()}
    letters = words.select(F.explode(F.split("word", "")).alias("letter")).filter("letter <> ''").distinct()
    # At most one row per code point; letters that no word has need not be tried.
    alphabet = "".join(sorted(r[0] for r in letters.collect()))
    if not lengths:
        return words.select("word", "n", F.col("word").alias("near"), F.col("n").alias("near_n"))
    edits = _candidates(words, Shards(lengths), alphabet, workspace, slice_blocks).distinct()
    known = words.select(F.col("word").alias("near"), F.col("n").alias("near_n"))
    pairs = workspace.store(edits.join(known, "near").select("word", "n", "near", "near_n"), "pairs")
    other = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    return pairs.unionByName(other)


def _roots(forms: DataFrame, workspace: Workspace) -> DataFrame:
    """(word, root) of words with a form, by following two steps at a time: counts rise fivefold, so there are few."""
    roots, pointing = forms, forms.count()
    number = 0
    while pointing:
        nexts = roots.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        followed = roots.join(nexts, "root", "left").select("word", F.coalesce("beyond", "root").alias("root"), F.col("beyond").isNotNull().alias("went"))
        followed = workspace.store(followed, f"roots-{number}")
        roots, pointing = followed.select("word", "root"), followed.filter("went").count()
        number += 1
    return roots


def spelling_forms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", workspace: Workspace | None = None) -> DataFrame:
    """(word, form, root, n, n_near, form_n), one row per word of the vocabulary.

    ``form`` is the near word of largest n, the smallest in code-point order among equals, if that n is at least five times
    the word's. ``root`` is where following forms ends. Null and empty texts hold no words, a null id counts as empty text,
    repeated rows count again, other columns are not looked at, and no rows give none.
    """
    workspace = workspace_for(docs, workspace)
    words = workspace.store(vocabulary(docs, id_col, text_col), "words")
    near = near_words(words, workspace)
    # Strings compare by their UTF-8 bytes, which is the order of their code points.
    best = near.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"), F.min(F.struct(-F.col("near_n"), "near")).alias("best"))
    found = words.join(best, "word", "left").withColumn("_n", -F.col("best.col1"))
    chosen = F.col("_n") >= LEAST_RATIO * F.col("n")
    found = found.select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.when(chosen, F.col("best.near")).alias("form"),
        F.when(chosen, F.col("_n")).alias("form_n"),
    )
    found = workspace.store(found, "forms")
    roots = _roots(workspace.store(found.filter("form is not null").select("word", F.col("form").alias("root")), "roots"), workspace)
    return found.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
