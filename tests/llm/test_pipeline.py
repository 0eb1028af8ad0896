import corpus_pipeline
from llm_cases import odd_documents, odd_frame
from pyspark.sql import functions as F
from test_exact_and_near_copies import slow_fingerprint


def test_stages_one_after_another(spark, tmp_path):
    docs = odd_frame(spark)
    columns = docs.columns
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language_id", "exact_dedup", "simhash_near_dedup", "source_mix", "best_fit_packing"]
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, None).write.parquet(str(tmp_path / name))
        docs = spark.read.parquet(str(tmp_path / name))
        kept[name] = docs.collect()
        if name != names[-1]:
            assert docs.columns == columns
    texts = [r["text"] for r in kept["language_id"]]
    lettered = [t for _, t, *_ in odd_documents() if t and any(c.isalpha() for c in t)]
    assert set(texts) <= set(lettered)
    unique = [r["text"] for r in kept["exact_dedup"]]
    assert sorted(unique) == sorted(set(texts))
    prints = [slow_fingerprint(r["text"]) for r in kept["simhash_near_dedup"]]
    assert len(prints) == len(set(prints)) <= len(unique)
    assert all((a ^ b).bit_count() > 4 for k, a in enumerate(prints) for b in prints[:k])
    mixed = [r["text"] for r in kept["source_mix"]]
    assert all(mixed.count(t) <= 2 for t in mixed)
    assert set(mixed) <= {r["text"] for r in kept["simhash_near_dedup"]}
    packed = kept["best_fit_packing"]
    assert len([r for r in packed if r["piece"] == 0]) == len(mixed)


def test_nothing_in_nothing_out(spark):
    none = odd_frame(spark, [])
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, none, None)
        assert found.count() == 0
        assert name == "best_fit_packing" or found.columns == none.columns


def test_documents_without_labels(spark):
    docs = odd_frame(spark).withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.identify_languages(spark, docs, None)
    assert kept.count() == sum(1 for _, t, *_ in odd_documents() if t and any(c.isalpha() for c in t))
