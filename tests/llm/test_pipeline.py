"""The pipeline's stages on a small corpus: their decisions take effect, and clean rows stay."""

import random

import corpus_pipeline
from pyspark.sql import functions as F

from tests.llm.corpus import documents, sentence


def small_corpus(spark, folder):
    rng = random.Random(8)
    item, line = sentence(rng, 30), sentence(rng, 15)
    clean = [sentence(rng, rng.randint(30, 60)) for _ in range(40)]
    rows = [(i, t) for i, t in enumerate(clean)]
    rows += [(100, clean[0]), (101, clean[1] + " so"), (102, f"{sentence(rng, 20)} {item} {sentence(rng, 20)}")]
    rows += [(103 + i, f"{sentence(rng, 25)}\n{line}\n{sentence(rng, 25)}") for i in range(3)]
    rows += [(110, None), (111, ""), (112, "12 34"), (113, sentence(rng, 30) + " vile vile " + sentence(rng, 5))]
    docs = spark.createDataFrame([(i, t, "xx", "s", len(t or "")) for i, t in rows], "doc_id bigint, text string, lang string, source string, n_chars bigint")
    docs = docs.withColumn("score", F.lit("kept"))
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{folder}/benchmark.parquet")
    labels = [(i, 1, 0) for i in range(0, 40, 2)] + [(113, 1, 1)]
    spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return docs, set(range(40))


def test_stages_take_effect_and_keep_clean_documents(spark, tmp_path):
    docs, clean = small_corpus(spark, str(tmp_path))
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        out = f"{tmp_path}/out-{name}"
        stage(spark, docs, str(tmp_path)).write.parquet(out)
        docs = spark.read.parquet(out)
        kept[name] = {r.doc_id for r in docs.collect()}
        if name != "source_mixing":
            assert docs.columns == columns
        assert clean <= kept[name]
    assert kept["language_id"] == clean | {100, 101, 102, 103, 104, 105, 113}
    assert 100 not in kept["line_dedup"]
    lengths = spark.read.parquet(f"{tmp_path}/out-line_dedup")
    assert lengths.where("n_chars <> char_length(text)").isEmpty()
    assert 101 not in kept["simhash_near_dedup"] or 1 in kept["simhash_near_dedup"]
    assert 102 in kept["simhash_near_dedup"] and 102 not in kept["benchmark_decontamination"]
    rows = docs.collect()
    assert {"rate", "copies", "p_toxic", *columns} <= set(docs.columns) and len(rows) == len(kept["benchmark_decontamination"])
    whole = corpus_pipeline.run(spark, str(tmp_path))
    assert {r.doc_id for r in whole.collect()} == kept["source_mixing"]


def test_stages_take_awkward_rows_and_empty_tables(spark, tmp_path):
    small_corpus(spark, str(tmp_path))
    awkward = documents(spark).withColumn("lang", F.lit("xx"))
    for name, stage in corpus_pipeline.STAGES:
        found = stage(spark, awkward, str(tmp_path))
        assert set(awkward.columns) <= set(found.columns) or name == "source_mixing"
        ids = [r.doc_id for r in found.select("doc_id").collect()]
        given = [r.doc_id for r in awkward.select("doc_id").collect()]
        assert ids and all(ids.count(i) <= given.count(i) for i in set(ids))  # nulls and repeats are never multiplied
        empty = stage(spark, awkward.limit(0), str(tmp_path))
        assert empty.columns == found.columns and empty.collect() == []
