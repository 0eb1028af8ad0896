"""Personal data: exact patterns, and a linear-chain conditional random field over word shapes.

The patterns are regular expressions written so that no text makes them quadratic. The field is trained
on a small labelled table and labels the words of each line; its best labelling is found by Viterbi over
many lines at once. Spans that it finds apart from those of the patterns are added to them.
"""

from __future__ import annotations

import itertools
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")
#: Outside, then begin and inside of each kind.
LABELS = ("O",) + tuple(f"{p}-{k}" for k in KINDS for p in "BI")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL_CHARS = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
# A match never begins inside a run of digits: what fails at its first digit fails at the others.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"(?<![0-9])[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    total = 0
    for place, digit in enumerate(reversed(digits)):
        value = int(digit) * (1 + place % 2)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL_CHARS:
            start -= 1
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        # What stands before this sign belongs to no later address.
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def base_spans(text: str | None) -> list[Span]:
    """Personal data by pattern, by kind and then start; ends are exclusive."""
    text = text or ""
    found: list[Span] = [("email", *span) for span in _emails(text)]
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m.group().split(".")):
            found.append(("ip", *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 13:
            digits = _NO_DIGIT.sub("", m.group())
            if 13 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", *m.span()))
    for m in _PHONE.finditer(text):
        if 9 <= len(_NO_DIGIT.sub("", m.group())) <= 15:
            found.append(("phone", *m.span()))
    return found


_MARK = re.compile(r"<(email|ip|card|phone):([^>]*)>")


def labelled_sentence(marked: str) -> tuple[list[str], list[int]]:
    """Words and label numbers of a sentence with its spans marked as ``<kind:...>``."""
    text, spans, at = "", [], 0
    for m in _MARK.finditer(marked):
        text += marked[at : m.start()]
        spans.append((m.group(1), len(text), len(text) + len(m.group(2))))
        text += m.group(2)
        at = m.end()
    text += marked[at:]
    words, labels = [], []
    for m in re.finditer(r"\S+", text):
        words.append(m.group())
        label = 0
        for kind, start, end in spans:
            if m.start() < end and m.end() > start:
                label = 1 + 2 * KINDS.index(kind) + (m.start() > start)
        labels.append(label)
    return words, labels


class _Shapes(dict):
    """What stands for a character in a shape: d, X, x, itself if it is another ASCII one, or u."""

    def __missing__(self, point: int) -> str:
        c = chr(point)
        self[point] = found = "d" if "0" <= c <= "9" else "X" if c.isupper() else "x" if c.isalpha() else c if c < "\x80" else "u"
        return found


_SHAPES = _Shapes()
_LONG = 256
_EDGES = ".,;:!?\"'"


def shape_features(word: str) -> list[str]:
    """Features of a whole word's shape: which kinds of characters, in which runs, and how many digits."""
    shape = word.translate(_SHAPES)
    bare = shape.strip(_EDGES)
    runs = [(kind, sum(1 for _ in run)) for kind, run in itertools.groupby(bare)]
    digits = bare.count("d")
    groups = sum(kind == "d" for kind, _ in runs)
    found = ["shape=" + "".join(kind for kind, _ in runs)]
    found += ["digits=" + "".join(f"{kind}{n}" if kind == "d" else kind for kind, n in runs), "end=" + shape[-1:]]
    if digits:
        found += [f"count={next((n for n in (20, 13, 9, 5) if digits >= n), digits)}", f"groups={min(groups, 5)}"]
        found.append("all-digits" if digits == len(bare) else "some-digits")
    else:
        found.append("no-digit")
    found += [f"has{c}" for c in "@+()-:[]" if c in shape] + [f"dots={min(shape.strip('.').count('.'), 4)}"]
    return found


@dataclass
class ShapeField:
    """Weights of a linear-chain conditional random field.

    ``features`` numbers the known features of a word; ``own``, ``before`` and ``after`` have a row of label
    weights for each: of the word itself, as the word before, and as the word after. Row 0 is the bias.
    """

    features: dict[str, int]
    words: frozenset[str]
    own: np.ndarray
    before: np.ndarray
    after: np.ndarray
    moves: np.ndarray
    first: np.ndarray

    def known(self, word: str) -> list[int]:
        found = shape_features(word)
        if (lower := word.lower().strip(_EDGES)) in self.words:
            found.append("word=" + lower)
        return [0] + [self.features[f] for f in found if f in self.features]

    def classes(self) -> "_Classes":
        return _Classes(self)


class _Classes(dict):
    """Number of a word's class; words with the same known features are of one class."""

    def __init__(self, model: ShapeField, limit: int = 1 << 20):
        super().__init__()
        self.model, self.limit = model, limit
        self.shapes: dict[str, int] = {}
        self.numbers: dict[tuple, int] = {}
        self.rows: list[tuple] = []

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        if len(word) > _LONG:
            # Long words hardly ever recur, and are not worth the memory.
            return self._number(word)
        # Unless the word itself is a feature, its shape says all.
        if word.lower().strip(_EDGES) in self.model.words:
            number = self._number(word)
        else:
            shape = word.translate(_SHAPES)
            number = self.shapes.get(shape)
            if number is None:
                if len(self.shapes) >= self.limit:
                    self.shapes.clear()
                number = self.shapes[shape] = self._number(word)
        self[word] = number
        return number

    def _number(self, word: str) -> int:
        known = tuple(self.model.known(word))
        number = self.numbers.setdefault(known, len(self.numbers))
        if number == len(self.rows):
            self.rows.append(known)
            self.tables = None
        return number

    tables = None

    def weights(self) -> tuple[np.ndarray, ...]:
        """Label weights by class: own, as the word before, as the word after."""
        if self.tables is None:
            m = self.model
            self.tables = tuple(
                np.array([w[list(r)].sum(0) for r in self.rows], np.float32) for w in (m.own, m.before, m.after)
            )
        return self.tables


def _logsumexp(x: np.ndarray, axis: int) -> np.ndarray:
    most = x.max(axis, keepdims=True)
    return (most + np.log(np.exp(x - most).sum(axis, keepdims=True))).squeeze(axis)


def allowed_moves() -> np.ndarray:
    """Penalty 0 or -inf: an inside label follows only its own kind."""
    moves = np.zeros((len(LABELS), len(LABELS)))
    for k in range(len(KINDS)):
        inside = 2 + 2 * k
        moves[:, inside] = -np.inf
        moves[[inside - 1, inside], inside] = 0
    return moves


def train_field(sentences: Iterable[tuple[list[str], list[int]]], passes: int = 250, rate: float = 0.1, l2: float = 0.02) -> ShapeField:
    """Fit the field to labelled sentences by gradient ascent (Adam) on their likelihood.

    The table is meant to be small: all sentences are held in memory and gone through at once.
    """
    sentences = [s for s in sentences if s[0]]
    features: dict[str, int] = {"bias": 0}
    vocabulary = frozenset(w.lower().strip(_EDGES) for words, _ in sentences for w in words if w.isalpha())
    for words, _ in sentences:
        for word in words:
            for f in shape_features(word):
                features.setdefault(f, len(features))
            lower = word.lower().strip(_EDGES)
            if lower in vocabulary:
                features.setdefault("word=" + lower, len(features))
    size, labels = len(features), len(LABELS)
    barred = allowed_moves()
    first_barred = np.where([name.startswith("I") for name in LABELS], -np.inf, 0.0)
    model = ShapeField(features, vocabulary, *(np.zeros((size, labels)) for _ in range(3)), barred.copy(), first_barred.copy())
    if not sentences:
        return model
    longest, count = max(len(s[0]) for s in sentences), len(sentences)
    present = np.zeros((count, longest), bool)
    inputs = np.zeros((count, longest, size), np.float32)
    gold = np.zeros((count, longest), int)
    for k, (words, own) in enumerate(sentences):
        present[k, : len(words)] = True
        gold[k, : len(words)] = own
        for t, word in enumerate(words):
            inputs[k, t, model.known(word)] = 1
    earlier, later = np.zeros_like(inputs), np.zeros_like(inputs)
    earlier[:, 1:], later[:, :-1] = inputs[:, :-1], inputs[:, 1:]
    views = [v.reshape(-1, size) for v in (inputs, earlier, later)]
    onehot = np.eye(labels)[gold] * present[..., None]
    both = present[:, 1:] & present[:, :-1]
    gold_moves = np.einsum("kti,ktj->ij", onehot[:, :-1] * both[..., None], onehot[:, 1:] * both[..., None])
    params = [np.zeros((size, labels)) for _ in views] + [np.zeros((labels, labels)), np.zeros(labels)]
    momentum, square = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    lengths = present.sum(1)
    for step in range(1, passes + 1):
        scores = sum(v @ p for v, p in zip(views, params)).reshape(count, longest, labels)
        moves, start = params[3] + barred, params[4] + first_barred
        forward, backward = np.full_like(scores, -np.inf), np.zeros_like(scores)
        forward[:, 0] = scores[:, 0] + start
        for t in range(1, longest):
            ahead = scores[:, t] + _logsumexp(np.maximum(forward[:, t - 1, :, None] + moves, -1e30), 1)
            forward[:, t] = np.where(present[:, t, None], ahead, forward[:, t - 1])
        for t in range(longest - 2, -1, -1):
            behind = _logsumexp(np.maximum(moves + (scores[:, t + 1] + backward[:, t + 1])[:, None, :], -1e30), 2)
            backward[:, t] = np.where(present[:, t + 1, None], behind, 0)
        total = _logsumexp(np.maximum(forward[np.arange(count), lengths - 1], -1e30), 1)
        marginal = np.exp(np.maximum(forward + backward - total[:, None, None], -700)) * present[..., None]
        pair = forward[:, :-1, :, None] + moves + (scores[:, 1:] + backward[:, 1:])[:, :, None, :] - total[:, None, None, None]
        expected = (np.exp(np.maximum(pair, -700)) * both[..., None, None]).sum((0, 1))
        error = (onehot - marginal).reshape(-1, labels)
        gradients = [v.T @ error for v in views] + [gold_moves - expected, (onehot[:, 0] - marginal[:, 0]).sum(0)]
        for p, g, m, s in zip(params, gradients, momentum, square):
            g = g - l2 * p
            m += 0.1 * (g - m)
            s += 0.001 * (g * g - s)
            p += rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)
    model.own, model.before, model.after = params[:3]
    model.moves, model.first = params[3] + barred, params[4] + first_barred
    return model


def viterbi(model: ShapeField, weights: tuple[np.ndarray, ...], classes: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The likeliest label of each word of many lines at once.

    ``classes`` has the word classes of all lines one after another, ``lengths`` the words of each line (at least one).
    """
    own, before, after = weights
    scores = own[classes]
    ends = np.cumsum(lengths)
    starts = ends - lengths
    inner = np.ones(len(classes), bool)
    inner[starts] = False
    scores[inner] += before[classes[np.flatnonzero(inner) - 1]]
    inner[starts], inner[ends - 1] = True, False
    scores[inner] += after[classes[np.flatnonzero(inner) + 1]]
    labels = np.zeros(len(classes), np.uint8)
    # Where no word can gain by another label than outside, whatever stands beside it, all are outside.
    moves = np.maximum(model.moves, -1e9)
    stay, first = moves[0, 0], np.maximum(model.first, -1e9)
    enter = max((moves[0, 1:] - stay).max(), (first[1:] - first[0]).max()) + max((moves[1:, 0] - stay).max(), 0)
    least = max(enter, (moves[1:, 1:] - stay).max()) + 1e-3
    doubtful = (scores[:, 1:].max(1) - scores[:, 0]) + least >= 0
    lines = np.flatnonzero(np.logical_or.reduceat(doubtful, starts))
    if not len(lines):
        return labels
    lines = lines[np.argsort(-lengths[lines], kind="stable")]
    starts, lengths = starts[lines], lengths[lines]
    active = np.searchsorted(-lengths, -np.arange(lengths[0]), "left")  # lines longer than t
    moves = moves.astype(np.float32).T[None]
    came = np.zeros((len(classes), len(LABELS)), np.uint8)
    state = scores[starts] + first.astype(np.float32)
    for t in range(1, lengths[0]):
        k = active[t]
        through = state[:k, None, :] + moves
        best = through.argmax(2)
        at = starts[:k] + t
        came[at] = best
        state[:k] = np.take_along_axis(through, best[..., None], 2)[..., 0] + scores[at]
    label = state.argmax(1)
    for t in range(lengths[0] - 1, -1, -1):
        k = active[t]
        at = starts[:k] + t
        labels[at] = label[:k]
        label[:k] = came[at, label[:k]]
    return labels


def _field_spans(text: str, line_labels: list[np.ndarray | None]) -> list[Span]:
    """Character spans of the labelled words of a text, line by line."""
    found: list[Span] = []
    offset = 0
    for line, labels in zip(text.split("\n"), line_labels):
        if labels is not None and labels.any():
            words = list(re.finditer(r"\S+", line))
            k = 0
            while k < len(words):
                if not labels[k]:
                    k += 1
                    continue
                kind, begin = KINDS[(labels[k] - 1) // 2], k
                k += 1
                while k < len(words) and labels[k] == 2 + 2 * KINDS.index(kind):
                    k += 1
                start, end = words[begin].start(), words[k - 1].end()
                while start < end and line[start] in "\"'<[,;:":
                    start += 1
                while end > start and line[end - 1] in ".,;:!?\"'>]*#&%$":
                    end -= 1
                if start < end:
                    found.append((kind, offset + start, offset + end))
        offset += len(line) + 1
    return found


def plausible(kind: str, span: str) -> bool:
    """Whether a span that only the field found can be what it says."""
    digits = sum("0" <= c <= "9" for c in span)
    if kind == "email":
        return "." in span and ("@" in span or "at)" in span or "at]" in span)
    if kind == "ip":
        return digits >= 4 and (span.count(":") >= 2)
    if kind == "card":
        return 13 <= digits <= 19 and luhn(_NO_DIGIT.sub("", span))
    return 7 <= digits <= 15 and not any(c.isalpha() for c in span)


def merged_spans(text: str, base: list[Span], added: list[Span]) -> list[Span]:
    """Base spans and those of the field that overlap none of them, by kind and then start."""
    taken = sorted((s, e) for _, s, e in base)
    starts = [s for s, _ in taken]
    kept = list(base)
    for kind, start, end in added:
        k = np.searchsorted(starts, end)
        clear = all(e <= start for _, e in taken[max(0, k - len(KINDS)) : k])
        if clear and plausible(kind, text[start:end]):
            kept.append((kind, start, end))
    return sorted(kept, key=lambda s: (KINDS.index(s[0]), s[1], s[2]))


def find_pii(
    docs: DataFrame,
    model: ShapeField | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_words: int = 1 << 18,
) -> DataFrame:
    """One row per row of ``docs``: id, ``base`` and ``spans``, arrays of (kind, start, end).

    Places are code points, ends exclusive; spans are sorted by kind, as listed in ``KINDS``, then start.
    ``base`` has what the patterns find, ``spans`` also what the field adds beside it. Without a
    model one is trained from the table in ``pii_labels``. Null and empty texts have no spans. Repeated rows each
    get a row; other columns are not looked at; no rows give none.
    """
    if model is None:
        from .pii_labels import SENTENCES

        model = train_field(map(labelled_sentence, SENTENCES))
    used = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = used.schema["_id"].dataType.simpleString()
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = model.classes()
        number = classes.__getitem__

        def flush(ids: pa.Array, texts: list[str], words: list[int], lengths: list[int]) -> pa.RecordBatch:
            lengths_, filled = np.array(lengths, np.int64), np.flatnonzero(lengths)
            labels = np.empty(0, np.uint8)
            if len(filled):
                labels = viterbi(model, classes.weights(), np.array(words, np.int64), lengths_[filled])
            parts = np.split(labels, np.cumsum(lengths_)[:-1]) if len(lengths_) else []
            base, spans, at = [], [], 0
            for text in texts:
                lines = text.count("\n") + 1
                own = base_spans(text)
                base.append(own)
                spans.append(merged_spans(text, own, _field_spans(text, parts[at : at + lines])))
                at += lines
            rows = [[[{"kind": k, "start": s, "end": e} for k, s, e in r] for r in x] for x in (base, spans)]
            return pa.RecordBatch.from_arrays([ids, *(pa.array(r, span) for r in rows)], names=[id_col, "base", "spans"])

        for batch in batches:
            texts, words, lengths, begun = [], [], [], 0
            for row, text in enumerate(batch.column(1)):
                text = text.as_py() or ""
                texts.append(text)
                for line in text.split("\n"):
                    numbers = list(map(number, line.split()))
                    words += numbers
                    lengths.append(len(numbers))
                if len(words) >= batch_words or row == len(batch) - 1:
                    yield flush(batch.column(0).slice(begun, len(texts)), texts, words, lengths)
                    texts, words, lengths, begun = [], [], [], row + 1

    struct = "array<struct<kind:string,start:bigint,end:bigint>>"
    return used.mapInArrow(find, f"`{id_col}` {kind}, base {struct}, spans {struct}")
