"""Quality rules as a ledger of failure bits.

Every text is measured once, and every rule evaluated once on its measurements: rule k sets bit k of ``failed``. The
ledger, bits and measurements, is stored. A policy is a versioned choice of rules, a mask of bits; applying another one, or
asking what a rule contributes, reads the ledger and never a text again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"
WINDOW = 3
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_top_word")


@dataclass(frozen=True)
class Rule:
    """``fails`` is an SQL condition on the measurements, in whole numbers, true for a text that fails."""

    name: str
    fails: str


#: The place of a rule is its bit for good: new rules are added at the end, old ones never change.
RULES = (
    Rule("few_words", "n_words < 50"),
    Rule("repeated_words", "100 * n_repeat_words > 50 * n_words"),
    Rule("many_symbols", "100 * n_symbols > 10 * n_words"),
    Rule("repeated_lines", "100 * n_dup_lines > 30 * n_lines"),
    Rule("short_words", "word_chars < 2 * n_words"),
    Rule("long_words", "word_chars > 20 * n_words"),
    Rule("one_word", "100 * n_top_word > 30 * n_words"),
)


@dataclass(frozen=True)
class Policy:
    """A version's rules: a text is kept if it fails none of them."""

    version: str
    rules: tuple[str, ...]

    @property
    def mask(self) -> int:
        bits = {rule.name: 1 << k for k, rule in enumerate(RULES)}
        return sum(bits[name] for name in self.rules)


POLICIES = {
    "base": Policy("base", ("few_words", "repeated_words")),
    "strict": Policy("strict", tuple(rule.name for rule in RULES)),
}


def _repeated(ids: np.ndarray, different: int) -> int:
    """How many words stand in a window of three that occurs twice or more; ``ids`` number the words."""
    if len(ids) < WINDOW:
        return 0
    keys = ids[:-2] * different + ids[1:-1]
    if different**3 >= 1 << 63:
        keys = np.unique(keys, return_inverse=True)[1]
    _, place, counts = np.unique(keys * different + ids[2:], return_inverse=True, return_counts=True)
    again = counts[place] > 1
    covered = np.zeros(len(ids), bool)
    for k in range(WINDOW):
        covered[k : k + len(again)] |= again
    return int(covered.sum())


def measure(text: str | None) -> tuple[int, ...]:
    """The measurements of one whole text, in the order of ``MEASURES``; null counts as empty."""
    text = text or ""
    words = text.encode().split()
    numbers: dict[bytes, int] = {}
    ids = np.fromiter((numbers.setdefault(w, len(numbers)) for w in words), np.int64, len(words))
    lines = [line for line in text.split("\n") if line.strip(SPACES)]
    return (
        len(words),
        len(text) - sum(map(text.count, SPACES)),
        sum(map(text.count, SYMBOLS)),
        len(lines) - len(set(lines)),
        _repeated(ids, len(numbers)),
        len(lines),
        int(np.bincount(ids).max()) if len(ids) else 0,
    )


def _bits() -> Column:
    bits = [F.when(F.expr(rule.fails), F.lit(1 << k)).otherwise(F.lit(0)) for k, rule in enumerate(RULES)]
    found = F.lit(0).cast("bigint")
    for bit in bits:
        found = found.bitwiseOR(bit.cast("bigint"))
    return found


def ledger(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, the measurements, failed), one row per row of ``docs``, repeated ids and rows included; store it.

    Words are what stands between ASCII white space. ``word_chars`` are the code points in words, ``n_symbols`` the
    characters of ``#*$%&|<>``, ``n_lines`` the lines with a word, ``n_dup_lines`` those of them equal to an earlier line,
    ``n_repeat_words`` the words in windows of three words found twice or more, ``n_top_word`` the occurrences
    of the commonest word. Bit k of ``failed`` is set if rule k fails. Null and empty texts measure 0 and fail
    ``few_words`` alone. Other columns are not looked at; no rows give none.
    """
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    schema = rows.select("_id", *(F.lit(0).cast("bigint").alias(m) for m in MEASURES)).schema

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = np.array([measure(t.as_py()) for t in batch.column(1)], np.int64).reshape(-1, len(MEASURES))
            columns = [pa.array(np.ascontiguousarray(c)) for c in found.T]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=schema.names)

    return rows.mapInArrow(measured, schema).select(F.col("_id").alias(id_col), *MEASURES, _bits().alias("failed"))


def apply_policy(entries: DataFrame, policy: Policy, name: str = "kept") -> DataFrame:
    """Ledger rows with the policy's verdict in a column ``name``."""
    return entries.withColumn(name, F.col("failed").bitwiseAND(F.lit(policy.mask)) == 0)


def ablations(entries: DataFrame, policy: Policy) -> DataFrame:
    """What each rule of a policy contributes: (version, rule, failed, failed_alone, kept, kept_without).

    ``failed_alone`` are the texts no other rule of the policy fails, which ``kept_without`` would keep in addition. The ledger
    shrinks to one row per pattern of bits first, 2^rules at most; an empty ledger gives zeros.
    """
    patterns = entries.groupBy(F.col("failed").bitwiseAND(F.lit(policy.mask)).alias("bits")).agg(F.count(F.lit(1)).alias("n"))
    bits = {rule.name: 1 << k for k, rule in enumerate(RULES)}
    rules = F.explode(F.array(*(F.struct(F.lit(r).alias("rule"), F.lit(bits[r]).cast("bigint").alias("bit")) for r in policy.rules)))
    none = entries.sparkSession.range(1).select(F.lit(0).cast("bigint").alias("bits"), F.lit(0).cast("bigint").alias("n"))
    rows = patterns.unionByName(none).select("bits", "n", rules.alias("r")).select("bits", "n", "r.*")

    def where(condition: Column) -> Column:
        return F.sum(F.when(condition, F.col("n")).otherwise(F.lit(0).cast("bigint")))

    alone = where(F.col("bits") == F.col("bit"))
    kept = where(F.col("bits") == 0)
    return rows.groupBy("rule").agg(
        F.lit(policy.version).alias("version"),
        where(F.col("bits").bitwiseAND(F.col("bit")) != 0).alias("failed"),
        alone.alias("failed_alone"),
        kept.alias("kept"),
        (kept + alone).alias("kept_without"),
    )
