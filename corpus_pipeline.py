"""From raw documents to packed training sequences in five stages.

Every stage works on all that the one before it kept and is written before the next one reads it.
Stages mark rows, not ids: null and repeated ids are rows of their own.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cartyield.llm import exact_dedup, langid, mixture, near_copies, packing, simhash
from cartyield.llm.common import identified, ship_package
from cartyield.plans.workspace import Workspace

#: A document is rejected if no language is this likely. Short texts of a known language score 0.35 and more.
LEAST_SCORE = 0.3
#: Fingerprints of texts with a Jaccard similarity of 0.8 differ in 10 of 64 bits on average, those of unrelated texts in 32.
NEAR_BITS = 12
#: SQL can express neither the classifier, the sampling nor the packing.
ORACLE_SQL = None


class _Rows:
    """Documents with an identity for each row; operators know a row as (doc_id, identity)."""

    def __init__(self, docs: DataFrame):
        ship_package(docs.sparkSession)
        self.workspace = Workspace(docs.sparkSession)
        self.rows, self.identity = identified(docs, self.workspace)

    def marked(self) -> DataFrame:
        return self.rows.select(F.struct("doc_id", F.col(self.identity).alias("row")).alias("_id"), "doc_id", "text", "source")

    def chosen(self, ids: DataFrame) -> DataFrame:
        """The documents among ``ids``, each as often as it is there."""
        ids = ids.select(F.col("_id.row").alias(self.identity))
        # Identities are small, so they are hashed, and the texts need not be sorted.
        return self.rows.join(ids.hint("shuffle_hash"), self.identity).drop(self.identity)

    def without(self, ids: DataFrame) -> DataFrame:
        """The documents not among ``ids``."""
        ids = ids.select(F.col("_id.row").alias(self.identity))
        return self.rows.join(ids.hint("shuffle_hash"), self.identity, "left_anti").drop(self.identity)


def identify_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents without a letter.

    Gibberish and languages that were not learned stay if they have letters: the score is the largest of L
    probabilities, so LEAST_SCORE rejects nothing with three languages or fewer and hardly anything with more.
    The model learns from the given documents' own ``lang``. Without any such label nothing is known
    of languages, and only documents without a letter go.
    """
    ship_package(spark)
    model = langid.train_language_model(docs)
    if not model.languages:
        return docs.filter(F.regexp_like(F.col("text"), F.lit(r"\p{L}")))
    found = langid.identify_language(docs, model)
    return found.filter((F.col("lang_pred") != langid.UNDETERMINED) & (F.col("score") >= LEAST_SCORE)).select(*docs.columns)


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id stays."""
    rows = _Rows(docs)
    decisions = exact_dedup.exact_dedup(rows.marked(), id_col="_id", workspace=rows.workspace)
    return rows.chosen(decisions.filter("kept"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies, the row with the smallest doc_id stays.

    SimHash finds the rows that have another one within ``NEAR_BITS`` bits, by shingles of five words. Among these, rows are linked
    whose sets of shingles have a Jaccard similarity of at least 0.8, by an exact join, so that no row goes for its fingerprint
    alone. Of two rows just at 0.8 the fingerprints are further apart in about a sixth of all cases, of two at 0.9 hardly ever.
    """
    rows = _Rows(docs)
    marked = rows.marked()
    found = simhash.simhash_groups(marked, "_id", radius=NEAR_BITS, words=5, workspace=rows.workspace)
    found = rows.workspace.store(found.select("_id", "component_id"), "fingerprint-groups")
    several = found.groupBy("component_id").agg(F.count("*").alias("n")).filter("n > 1").select("component_id")
    near = rows.workspace.store(found.join(several, "component_id", "left_semi").select("_id"), "with-partners")
    # As in chosen(): the same plan for few ids and many, and no sorting of texts.
    texts = marked.join(near.hint("shuffle_hash"), "_id", "left_semi")
    groups = near_copies.near_copy_groups(texts, "_id", workspace=rows.workspace)
    copies = rows.workspace.store(groups.filter("_id <> component_id").select("_id"), "copies")
    return rows.without(copies)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    rows = _Rows(docs)
    mixed = mixture.mix_sources(rows.marked(), id_col="_id", key_col="doc_id", workspace=rows.workspace)
    taken = mixed.filter("copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return rows.chosen(taken)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document lies in the sequences."""
    ship_package(spark)
    return packing.pack_documents(docs)


STAGES = [
    ("language_id", identify_languages),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("source_mix", mix_sources),
    ("best_fit_packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply all stages to the table ``documents``."""
    workspace = Workspace(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = workspace.store(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
