"""One query per corpus operator: its production parameters over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.workspace import Workspace
from . import backoff_lm, codes, exact_dedup, langid, licenses, mixture, packing, pii, quality, simhash, spelling, tokenfile, topk
from .common import remainder, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_backoff_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return backoff_lm.score_texts(table(spark, sf_dir, "documents"), remainder(F.col("doc_id"), 10) == 0)


def op2_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture.mix_sources(table(spark, sf_dir, "documents")).drop("copies")


def op3_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = licenses.scan_licenses(table(spark, sf_dir, "documents"))
    starts = F.col("phrases.word")
    base = F.col("phrases.label")
    return found.select(
        "doc_id",
        "n_words",
        F.size("phrases").cast("bigint").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        F.array_join(F.array_sort(F.array_distinct(base)), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_union(base, F.col("blocks.label"))), ",").alias("labels"),
        F.when(F.size("phrases") > 0, 1.0)
        .otherwise(F.coalesce(F.array_max(F.col("blocks.containment")), F.lit(0.0)))
        .alias("score"),
    )


def op4_block_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"))


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_pii(table(spark, sf_dir, "documents"))

    def count(kind: str) -> Column:
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    def listed(spans: str) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    return found.select(
        "doc_id",
        *[count(kind) for kind in pii.KINDS],
        F.sha2(listed("base"), 256).alias("base_sha256"),
        listed("spans").alias("spans"),
    )


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("held_out", remainder(F.col("doc_id"), 4) == 2)
    model = langid.train_language_model(docs.filter("not held_out"))
    found = langid.identify_language(docs, model, keep=["doc_id", "held_out"])
    return found.select("doc_id", "held_out", "lang_pred", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_groups(table(spark, sf_dir, "documents"))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.tokenize_to_files(table(spark, sf_dir, "documents"), Workspace(spark))


def op11_spelling_forms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_forms(table(spark, sf_dir, "documents"))


def op12_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return codes.vector_codes(table(spark, sf_dir, "embeddings"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    entries = Workspace(spark).store(quality.ledger(table(spark, sf_dir, "documents")), "ledger")
    judged = quality.apply_policy(entries, quality.POLICIES["base"], "base_kept")
    judged = quality.apply_policy(judged, quality.POLICIES["strict"])
    base = ("word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select("doc_id", "n_words", *base, (~F.col("base_kept")).alias("base_failed"), "kept", "failed")


OP4_SQL = """
WITH usable AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id,
         list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
  FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id
)
SELECT query_id, rank::INTEGER AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP9_SQL = """
SELECT doc_id,
       max(doc_id) OVER same AS keep_id,
       count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW same AS (PARTITION BY coalesce(text, ''))
"""

# crc32 by its table of 256 remainders; the words; pairs one edit apart share what is left after a deletion.
OP11_SQL = """
WITH RECURSIVE crc AS MATERIALIZED (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce([i, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, k:
             CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c FROM range(256) r(i))
), runs AS (
  SELECT id, run, count(*) AS n FROM (
    SELECT coalesce(doc_id::VARCHAR, '') AS id, unnest(regexp_extract_all(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-zÀ-ÿ]+')) AS run
    FROM documents)
  GROUP BY ALL
), keyed AS (
  SELECT run, n, hex(id || ':' || run) AS h FROM runs
), hashed AS (
  SELECT run, n, xor(4294967295, list_reduce(
           list_prepend(4294967295, list_transform(range(0, len(h) // 2), lambda j: ('0x' || substr(h, 2 * j + 1, 2))::BIGINT)),
           lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1]))) AS h
  FROM keyed, crc
), spelled AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n
  FROM hashed
), words AS MATERIALIZED (
  SELECT word, sum(n)::BIGINT AS n FROM spelled WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
), cut AS MATERIALIZED (
  SELECT word, i, substr(word, 1, i - 1) || substr(word, i + 1) AS rest
  FROM words, unnest(generate_series(1, length(word))) g(i)
), pairs AS (
  SELECT a.word, b.word AS near FROM cut a JOIN cut b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT word, rest FROM cut WHERE rest IN (SELECT word FROM words)
  UNION SELECT rest, word FROM cut WHERE rest IN (SELECT word FROM words)
), ranked AS (
  SELECT p.word, p.near, w.n AS near_n, count(*) OVER (PARTITION BY p.word) AS n_near,
         row_number() OVER (PARTITION BY p.word ORDER BY w.n DESC, p.near) AS place
  FROM pairs p JOIN words w ON w.word = p.near
), forms AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 5 * w.n THEN near END AS form,
         CASE WHEN near_n >= 5 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1
), followed AS (
  SELECT word, word AS root FROM forms
  UNION ALL SELECT f.word, g.form FROM followed f JOIN forms g ON g.word = f.root AND g.form IS NOT NULL
)
SELECT forms.word, form, followed.root, forms.n, n_near, form_n
FROM forms JOIN followed USING (word)
WHERE followed.root NOT IN (SELECT word FROM forms WHERE form IS NOT NULL)
"""

_ROUND = """
a{k} AS MATERIALIZED (
  SELECT r, p, x, min({{'d': list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT, 'e': e}}) AS best
  FROM parts JOIN c{k} USING (p) GROUP BY ALL
)"""
_UPDATE = """,
s{k} AS (
  SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS x FROM (
    SELECT p, best.e AS e, i, sum(x[i])::BIGINT AS s, count(*) AS n
    FROM a{k}, unnest(range(1, len(x) + 1)) g(i) GROUP BY ALL)
  GROUP BY ALL
), c{next} AS MATERIALIZED (
  SELECT p, e, coalesce(s{k}.x, c) AS c FROM c{k} LEFT JOIN s{k} USING (p, e)
),"""
OP12_SQL = (
    """
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, p, v[p * len(v) // 8 + 1 : (p + 1) * len(v) // 8] AS x FROM kept, range(8) g(p)
), c0 AS MATERIALIZED (
  SELECT p, e, x AS c FROM (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept) JOIN parts USING (r) WHERE e < 16
),"""
    + "".join(_ROUND.format(k=k) + _UPDATE.format(k=k, next=k + 1) for k in range(6))
    + _ROUND.format(k=6)
    + """, coded AS (
  SELECT r, string_agg(format('{:02x}', best.e), '' ORDER BY p) AS code, sum(best.d)::BIGINT AS error FROM a6 GROUP BY r
)
SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error,
       (SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) FROM c6, unnest(range(1, len(c) + 1)) g(i)) AS codebooks_sha256
FROM coded JOIN kept USING (r)
"""
)

_RULES = " | ".join(f"CASE WHEN {rule.fails} THEN {1 << k} ELSE 0 END" for k, rule in enumerate(quality.RULES))
OP13_SQL = rf"""
WITH rows AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), lines AS (
  SELECT r, count(*) AS n_lines, count(*) - count(DISTINCT line) AS n_dup_lines
  FROM (SELECT r, unnest(string_split(t, chr(10))) AS line FROM rows)
  WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r
), windows AS (
  SELECT r, i, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] AS words FROM rows, unnest(range(1, len(w) - 1)) g(i)
), again AS (
  SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, words) AS n FROM windows) WHERE n > 1
), repeated AS (
  SELECT r, count(DISTINCT i + k) AS n_repeat_words FROM again, range(3) g(k) GROUP BY r
), tops AS (
  SELECT r, max(n) AS n_top_word FROM (SELECT r, word, count(*) AS n FROM (SELECT r, unnest(w) AS word FROM rows) GROUP BY ALL) GROUP BY r
), measured AS (
  SELECT doc_id, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(n_dup_lines, 0) AS n_dup_lines,
         coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(n_lines, 0) AS n_lines, coalesce(n_top_word, 0) AS n_top_word
  FROM rows LEFT JOIN lines USING (r) LEFT JOIN repeated USING (r) LEFT JOIN tops USING (r)
), judged AS (SELECT *, ({_RULES})::BIGINT AS failed FROM measured)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       failed & {quality.POLICIES["base"].mask} <> 0 AS base_failed, failed & {quality.POLICIES["strict"].mask} = 0 AS kept, failed
FROM judged
"""


def queries() -> dict[str, Query]:
    found = (
        op1_backoff_lm,
        op2_source_mix,
        op3_license_scan,
        op4_block_top_k,
        op5_pii,
        op6_language_id,
        op7_simhash,
        op8_best_fit_packing,
        op9_exact_dedup,
        op10_token_files,
        op11_spelling_forms,
        op12_vector_codes,
        op13_quality_rules,
    )
    return {f.__name__: f for f in found}


def oracle_sql() -> dict[str, str]:
    return {
        "op4_block_top_k": OP4_SQL,
        "op9_exact_dedup": OP9_SQL,
        "op11_spelling_forms": OP11_SQL,
        "op12_vector_codes": OP12_SQL,
        "op13_quality_rules": OP13_SQL,
    }
