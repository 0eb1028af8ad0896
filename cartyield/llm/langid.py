"""Language identification: multinomial logistic regression on TF-IDF of character n-grams.

Document frequencies are counted over all training rows. The model is fitted on a bounded sample
of them by follow-the-regularised-leader with elastic-net penalties, one pass of numpy updates per
document, and its probabilities are then calibrated by one temperature on rows it was not fitted on.
"""

from __future__ import annotations

import functools
import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

UNDETERMINED = "und"


@dataclass(frozen=True)
class LanguageSettings:
    """Parameters of the model.

    The classifier is fitted on some ``max_train`` of the labelled rows with letters. Each language has its share of
    them, but ``least_train`` rows at least, or all it has: those with the smallest hashes of id and text, rows
    alike in both once. Everything else covers all rows.
    """

    orders: tuple[int, ...] = (1, 2, 3)
    dimensions: int = 1 << 15
    max_train: int = 3000
    least_train: int = 50
    passes: int = 3
    alpha: float = 0.5
    beta: float = 1.0
    l1: float = 1e-4
    l2: float = 1e-4


@functools.cache
def _letters() -> np.ndarray:
    """Lower-cased letter for each code point, a space for what is no letter."""
    table = np.full(0x110000, 32, np.uint32)
    for point in range(0x20000):
        char = chr(point)
        if char.isalpha():
            lower = char.lower()
            table[point] = ord(lower) if len(lower) == 1 else point
    # Beyond the first two planes there are only ideographs and private use.
    table[0x20000:0x32400] = np.arange(0x20000, 0x32400)
    return table


def ngrams(text: str | None, settings: LanguageSettings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed character n-grams of a whole text, and how often each occurs.

    Letters are lower-cased; each run of anything else is one space, also around the text.
    No letter gives no n-gram.
    """
    points = _letters()[np.frombuffer((" " + (text or "") + " ").encode("utf-32-le"), np.uint32)]
    kept = points != 32
    if not kept.any():
        return np.empty(0, np.int64), np.empty(0, np.int64)
    kept[1:] |= points[:-1] != 32
    kept[0] = True
    points = points[kept]
    shift = np.uint32(32 - (settings.dimensions.bit_length() - 1))
    hashes, found = np.zeros(len(points), np.uint32), []
    for n in range(1, max(settings.orders) + 1):
        if n > len(points):
            break
        hashes = (hashes[: len(points) - n + 1] ^ (points[n - 1 :] + np.uint32(n))) * np.uint32(0x9E3779B1)
        if n in settings.orders:
            found.append((hashes * np.uint32(0x85EBCA6B)) >> shift)
    counts = np.bincount(np.concatenate(found), minlength=settings.dimensions)
    features = np.flatnonzero(counts)
    return features, counts[features]


@dataclass
class LanguageModel:
    """Weights by feature and language, with what turns counts into features."""

    settings: LanguageSettings
    languages: list[str]
    idf: np.ndarray
    weights: np.ndarray
    bias: np.ndarray
    temperature: float = 1.0

    def features(self, text: str | None) -> tuple[np.ndarray, np.ndarray]:
        return self.weighed(*ngrams(text, self.settings))

    def weighed(self, found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Features with their TF-IDF weights, scaled to length 1."""
        values = (1 + np.log(counts)) * self.idf[found]
        norm = np.sqrt(values @ values)
        return found, values / norm if norm else values

    def logits(self, text: str | None) -> np.ndarray | None:
        """One number per language, or None for a text without letters."""
        found, values = self.features(text)
        return values @ self.weights[found] + self.bias if len(found) else None

    def predict(self, text: str | None) -> tuple[str, float]:
        logits = self.logits(text) if self.languages else None
        if logits is None:
            return UNDETERMINED, 0.0
        chances = softmax(logits / self.temperature)
        best = int(chances.argmax())
        return self.languages[best], float(chances[best])


def softmax(logits: np.ndarray) -> np.ndarray:
    powers = np.exp(logits - logits.max(-1, keepdims=True))
    return powers / powers.sum(-1, keepdims=True)


def fit_ftrl(model: LanguageModel, rows: list[tuple[np.ndarray, np.ndarray, int]]) -> None:
    """Fit the weights to rows (features, values, language) by FTRL-proximal updates, in the given order."""
    s = model.settings
    z = np.zeros((s.dimensions + 1, len(model.languages)))
    squares = np.zeros_like(z)

    def current(active: np.ndarray) -> np.ndarray:
        own = z[active]
        step = (s.beta + np.sqrt(squares[active])) / s.alpha + s.l2
        return np.where(np.abs(own) > s.l1, (np.sign(own) * s.l1 - own) / step, 0.0)

    for turn in range(s.passes):
        for k in np.random.default_rng(turn).permutation(len(rows)):
            features, values, language = rows[k]
            active, inputs = np.append(features, s.dimensions), np.append(values, 1.0)
            weights = current(active)
            error = softmax(inputs @ weights)
            error[language] -= 1
            gradient = inputs[:, None] * error
            grown = squares[active] + gradient**2
            z[active] += gradient - (np.sqrt(grown) - np.sqrt(squares[active])) / s.alpha * weights
            squares[active] = grown
    weights = current(np.arange(s.dimensions + 1)).astype(np.float32)
    model.weights, model.bias = weights[:-1], weights[-1]


def fit_temperature(logits: np.ndarray, languages: np.ndarray) -> float:
    """The temperature at which the true languages are likeliest, by golden-section search on its logarithm.

    As in Platt's scaling the target is (n + 1) / (n + 2) rather than 1, so that rows without any error do
    not make the model certain.
    """
    if not len(logits):
        return 1.0

    def loss(log_t: float) -> float:
        chances = softmax(logits / np.exp(log_t))[np.arange(len(languages)), languages].clip(1e-300, 1 - 1e-16)
        return -(target * np.log(chances) + (1 - target) * np.log1p(-chances)).mean()

    target = (len(languages) + 1) / (len(languages) + 2)
    low, high, ratio = np.log(0.01), np.log(100.0), (np.sqrt(5) - 1) / 2
    while high - low > 1e-3:
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def _document_frequencies(texts: DataFrame, settings: LanguageSettings) -> tuple[np.ndarray, int]:
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, rows = np.zeros(settings.dimensions + 1, np.int64), 0
        for batch in batches:
            for text in batch.column(0):
                seen[ngrams(text.as_py(), settings)[0]] += 1
            rows += len(batch)
        seen[-1] = rows
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(seen[used])], names=["feature", "df"])

    # At most one row per dimension comes back.
    totals = texts.mapInArrow(count, "feature bigint, df bigint").groupBy("feature").agg(F.sum("df").alias("df"))
    frequencies = np.zeros(settings.dimensions + 1, np.int64)
    for feature, df in totals.collect():
        frequencies[feature] = df
    return frequencies[:-1], int(frequencies[-1])


def _quotas(counts: dict[str, int], settings: LanguageSettings) -> dict[str, int]:
    """How many rows of each language the classifier is fitted on."""
    total = sum(counts.values())
    if total <= settings.max_train:
        return counts
    return {k: min(n, max(settings.max_train * n // total, settings.least_train)) for k, n in counts.items()}


def _per_language(rows: DataFrame, edges: dict[str, int]) -> DataFrame:
    return F.broadcast(rows.sparkSession.createDataFrame(list(edges.items()), "_lang string, _edge bigint"))


def _cutoffs(rows: DataFrame, settings: LanguageSettings) -> tuple[int, dict[str, int], dict[str, int]]:
    """(shift, edge by language, quota by language): rows whose hash, shifted, is up to the edge hold the quota, and few more."""
    keys = rows.select("_lang", "_hash").distinct()
    shift, quotas, before, edges = 52, None, {}, {}
    while True:
        ranges: dict[str, dict[int, int]] = {}
        for language, k, n in keys.groupBy("_lang", F.shiftright("_hash", shift)).count().collect():
            ranges.setdefault(language, {})[k] = n
        if quotas is None:
            quotas = _quotas({language: sum(found.values()) for language, found in ranges.items()}, settings)
        wide = 0
        for language, found in ranges.items():
            seen = before.get(language, 0)
            for k in sorted(found):
                if seen + found[k] >= quotas[language]:
                    break
                seen += found[k]
            before[language], edges[language] = seen, k
            wide = max(wide, found[k])
        if wide <= max(settings.least_train, 1) or not shift:
            return shift, edges, quotas
        last = rows.select("_lang", "_hash").join(_per_language(rows, edges), "_lang")
        keys = last.filter(F.shiftright("_hash", shift) == F.col("_edge")).select("_lang", "_hash").distinct()
        shift -= 13


def _sample(rows: DataFrame, settings: LanguageSettings) -> list[tuple[int, str, np.ndarray, np.ndarray]]:
    """(hash, language, features, counts) of the rows with the smallest hashes of each language, by hash.

    Hashes are counted by language in 2^12 ranges, and the range where a language has enough again in 2^13 ranges, and so on
    until few rows of a language are in its last range: what is sent to the driver is the quotas and these few, at any size.
    """
    shift, edges, quotas = _cutoffs(rows, settings)
    if not edges:
        return []

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list] = {}
        known = set()
        for batch in batches:
            for number, language, text in zip(*(batch.column(k) for k in range(3))):
                number, language = number.as_py(), language.as_py()
                heap = held.setdefault(language, [])
                if (number, language) in known or len(heap) == quotas[language] and number >= -heap[0][0]:
                    continue
                known.add((number, language))
                item = (-number, [x.astype("<i4").tobytes() for x in ngrams(text.as_py(), settings)])
                # Hashes in a heap differ, so n-grams are never compared.
                heapq.heappush(heap, item) if len(heap) < quotas[language] else heapq.heapreplace(heap, item)
        for language, heap in held.items():
            arrays = [pa.array([-h for h, _ in heap], pa.int64()), pa.array([language] * len(heap), pa.string())]
            arrays += [pa.array([found[k] for _, found in heap], pa.binary()) for k in (0, 1)]
            yield pa.RecordBatch.from_arrays(arrays, names=["_hash", "_lang", "features", "counts"])

    # One row per language.
    near = rows.join(_per_language(rows, edges), "_lang").filter(F.shiftright("_hash", shift) <= F.col("_edge"))
    near = near.select("_hash", "_lang", "_text")
    # Bytes stay bytes on the driver; a list of numbers would be some 36 bytes for each there, and as many before that in the JVM.
    found = near.mapInArrow(smallest, "_hash bigint, _lang string, features binary, counts binary").collect()
    taken: dict[str, int] = {}
    sample = []
    for key, row in sorted({(r["_hash"], r["_lang"]): r for r in found}.items()):
        taken[key[1]] = taken.get(key[1], 0) + 1
        if taken[key[1]] <= quotas[key[1]]:
            sample.append((*key, *(np.frombuffer(row[k], "<i4") for k in ("features", "counts"))))
    return sample


def train_language_model(labelled: DataFrame, settings: LanguageSettings | None = None, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> LanguageModel:
    """Fit the model to the rows of ``labelled`` that have a language.

    Every language is learned, however rare it is: the sample is filled for each on its own. Rows without a
    language or a letter teach nothing. Without any row left, the model has no language and predicts ``und``.
    """
    settings = settings or LanguageSettings()
    rows = labelled.filter(F.col(lang_col).isNotNull()).select(
        F.xxhash64(F.col(id_col).cast("string"), F.col(text_col)).alias("_hash"), F.col(text_col).alias("_text"), F.col(lang_col).alias("_lang")
    )
    frequencies, total = _document_frequencies(rows.select("_text"), settings)
    # Only n-gram counts of the sample leave the executors, at most one per dimension, however long a text is.
    sample = [r for r in _sample(rows.filter(F.regexp_like("_text", F.lit(r"\p{L}"))), settings) if len(r[2])]
    languages = sorted({r[1] for r in sample})
    idf = np.log((1 + total) / (1 + frequencies)) + 1
    model = LanguageModel(settings, languages, idf, np.zeros((0, 0)), np.zeros(0))
    if not sample:
        return model
    # A language's every fifth row is held back, so that each has rows to be learned from.
    used, held, met = [], [], dict.fromkeys(languages, 0)
    for _, language, features, counts in sample:
        met[language] += 1
        features, values = model.weighed(features, counts)
        (used if met[language] % 5 else held).append((features, values, languages.index(language)))
    fit_ftrl(model, used)
    logits = np.array([values @ model.weights[features] + model.bias for features, values, _ in held])
    model.temperature = fit_temperature(logits, np.array([r[2] for r in held]))
    return model


def identify_language(docs: DataFrame, model: LanguageModel, text_col: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``, the calibrated probability of that language.

    Texts that are null or have no letter get ``und`` and 0. ``keep`` names the columns to pass on, all
    unless given; a column named ``lang_pred`` or ``score`` is replaced. Only the text is used. No rows give none.
    """
    kept = [c for c in (docs.columns if keep is None else keep) if c not in ("lang_pred", "score")]
    schema = docs.select(*kept).schema.add("lang_pred", "string").add("score", "double")
    others = [c for c in kept if c != text_col]
    source = docs.select(text_col, *others)
    places = [0 if c == text_col else 1 + others.index(c) for c in kept]

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [model.predict(t.as_py()) for t in batch.column(0)]
            passed = [batch.column(k) for k in places]
            names = [pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64())]
            yield pa.RecordBatch.from_arrays(passed + names, names=schema.names)

    return source.mapInArrow(predict, schema)
