"""Licence scan: an exact set-similarity join of text blocks with licence notices.

A template of n words is compared with blocks of 2n words that begin at every nth word of a text, so
any n words in a row lie whole in some block. A block matches when it holds at least ``threshold`` of the
template's different words. Words are ordered by how many documents hold them, over the whole corpus, the
rarest first. A matching block must hold one of a template's first words (prefix filter), enough words of
the template at all (length filter), and at each word they share enough must be left to come (positional filter); what
passes is verified. The filters only skip what cannot match.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_WORDS = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
# The phrases that count as they stand.
PHRASES = (
    ("mit", ("mit", "license")),
    ("apache", ("apache", "license")),
    ("gpl", ("general", "public", "license")),
)


def words_of(text: str | None) -> list[bytes]:
    """Words of a text, A-Z in lower case, as bytes in UTF-8."""
    return _WORDS.findall((text or "").encode().lower())


@dataclass(frozen=True)
class Template:
    """A notice: its label, its different words from rare to frequent, and how many must be met."""

    label: str
    number: int
    size: int
    tokens: tuple[bytes, ...]
    needed: int

    @property
    def prefix(self) -> tuple[bytes, ...]:
        """A block without these has too few of the others."""
        return self.tokens[: len(self.tokens) - self.needed + 1]


def ordered_templates(notices: Iterable[tuple[str, str]], frequency: dict[bytes, int], threshold: float) -> list[Template]:
    """Templates with words by global frequency; notices without words are left out."""
    templates = []
    for number, (label, text) in enumerate(notices):
        words = words_of(text)
        tokens = sorted(set(words), key=lambda w: (frequency.get(w, 0), w))
        if tokens:
            # Containment is compared in whole numbers of words; the margin is for the product's rounding.
            needed = max(1, ceil(threshold * len(tokens) - 1e-9))
            templates.append(Template(label, number, len(words), tuple(tokens), needed))
    return templates


def token_frequencies(docs: DataFrame, tokens: set[bytes], text_col: str = "text") -> dict[bytes, int]:
    """In how many documents each of the given words occurs."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[bytes, int] = {}
        for batch in batches:
            for text in batch.column(0):
                for word in tokens.intersection(words_of(text.as_py())):
                    seen[word] = seen.get(word, 0) + 1
        yield pa.RecordBatch.from_pydict(
            {"word": list(seen), "df": list(seen.values())}, pa.schema([("word", pa.binary()), ("df", pa.int64())])
        )

    counted = docs.select(text_col).mapInArrow(count, "word binary, df bigint").groupBy("word").agg(F.sum("df").alias("df"))
    # As many rows as the templates have words.
    return {bytes(r["word"]): r["df"] for r in counted.collect()}


class LicenseMatcher:
    """Finds the template blocks and phrases of single texts."""

    def __init__(self, templates: list[Template]):
        self.templates = templates
        self.by_prefix: dict[bytes, list[Template]] = {}
        for template in templates:
            for token in template.prefix:
                self.by_prefix.setdefault(token, []).append(template)
        self.prefixes = frozenset(self.by_prefix)
        self.rank = {t: {w: k for k, w in enumerate(t.tokens)} for t in templates}

    def blocks(self, words: list[bytes]) -> list[tuple[Template, int, float]]:
        """(template, first word of the block, containment) of every matching block."""
        if self.prefixes.isdisjoint(words):
            return []
        candidates = set()
        for place, word in enumerate(words):
            for template in self.by_prefix.get(word, ()):
                block = place // template.size
                candidates.add((template, block))
                if block:
                    candidates.add((template, block - 1))
        found = []
        for template, block in sorted(candidates, key=lambda c: (c[0].number, c[1])):
            start = block * template.size
            met = self._overlap(template, words[start : start + 2 * template.size])
            if met >= template.needed:
                found.append((template, start, met / len(template.tokens)))
        return found

    def _overlap(self, template: Template, block: list[bytes]) -> int:
        """How many of the template's words the block holds, or a smaller number if too few."""
        rank = self.rank[template]
        shared = sorted({rank[w] for w in block if w in rank})
        if len(shared) < template.needed:
            return 0
        for met, place in enumerate(shared):
            # What the template and the block have from here on bounds what they can share.
            if met + min(len(template.tokens) - place, len(shared) - met) < template.needed:
                return 0
        return len(shared)

    @staticmethod
    def phrases(words: list[bytes]) -> list[tuple[str, int]]:
        """(label, first word) of every place where a phrase stands."""
        found = []
        place = -1
        while True:
            try:
                place = words.index(b"license", place + 1)
            except ValueError:
                return found
            for label, phrase in PHRASES:
                start = place - len(phrase) + 1
                if start >= 0 and all(w.encode() == words[start + k] for k, w in enumerate(phrase)):
                    found.append((label, start))


def scan_licenses(
    docs: DataFrame,
    notices: Iterable[tuple[str, str]] | None = None,
    threshold: float = 0.9,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """One row per row of ``docs``: phrases, and all blocks that contain a notice.

    Columns: id, n_words, phrases array<struct<label, word>>, blocks array<struct<label, template, word,
    words, containment>>, both in the order of the text. ``notices`` are (label, text) rows of a small table, those of
    ``license_terms`` unless given. Null and empty texts have no words and no matches. Repeated rows
    each get a row; other columns are not looked at; no rows give none.
    """
    if notices is None:
        from .license_terms import NOTICES as notices
    notices = list(notices)
    vocabulary = {w for _, text in notices for w in words_of(text)}
    matcher = LicenseMatcher(ordered_templates(notices, token_frequencies(docs, vocabulary, text_col), threshold))
    used = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    kind = used.schema["_id"].dataType.simpleString()
    phrase = pa.list_(pa.struct([("label", pa.string()), ("word", pa.int64())]))
    block = pa.list_(
        pa.struct([("label", pa.string()), ("template", pa.int32()), ("word", pa.int64()), ("words", pa.int64()), ("containment", pa.float64())])
    )

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, phrases, blocks = [], [], []
            for text in batch.column(1):
                words = words_of(text.as_py())
                sizes.append(len(words))
                phrases.append([{"label": label, "word": word} for label, word in matcher.phrases(words)])
                blocks.append(
                    [
                        {"label": t.label, "template": t.number, "word": start, "words": min(2 * t.size, len(words) - start), "containment": share}
                        for t, start, share in sorted(matcher.blocks(words), key=lambda m: (m[1], m[0].number))
                    ]
                )
            columns = [batch.column(0), pa.array(np.array(sizes, np.int64)), pa.array(phrases, phrase), pa.array(blocks, block)]
            yield pa.RecordBatch.from_arrays(columns, names=[id_col, "n_words", "phrases", "blocks"])

    return used.mapInArrow(
        scan,
        f"`{id_col}` {kind}, n_words bigint, phrases array<struct<label:string,word:bigint>>, "
        "blocks array<struct<label:string,template:int,word:bigint,words:bigint,containment:double>>",
    )
