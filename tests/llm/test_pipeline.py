import brute
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from alertloom.llm import langid
from alertloom.llm.common import stored


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, []
    for name, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "stage")
        seen.append(docs)
        assert name == pipeline.STAGES[-1][0] or docs.columns == columns
    language, toxic, unique, mixed, packed = seen
    assert toxic.count() <= language.count()
    texts = [(r.doc_id, r.text) for r in toxic.collect()]
    root = brute.near_components(texts)
    assert sorted(r.doc_id for r in unique.collect()) == sorted(i for i, r in root.items() if i == r)
    words = unique.select(F.sum(F.regexp_count("text", F.lit(brute.WORD.pattern)))).first()[0]
    taken = mixed.select(F.sum(F.regexp_count("text", F.lit(brute.WORD.pattern)))).first()[0]
    assert words - 60 <= taken <= words
    per = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert per.filter("n > 2048").count() == 0


def test_hard_rows(spark, docs, sf_dir):
    given = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for _, stage in pipeline.STAGES:
        given = stored(stage(spark, given, sf_dir), "hard")
    assert given.count() > 0


def test_empty_table(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").limit(0)
    for _, stage in pipeline.STAGES:
        docs = stored(stage(spark, docs, sf_dir), "none")
    assert docs.count() == 0


def test_language_without_labels_goes_by_letters(spark, sf_dir):
    rows = [(1, "some words", None), (2, "12 34", None), (3, None, None), (4, "日本", None)]
    docs = spark.createDataFrame([(*r, "s", 3) for r in rows], "doc_id long, text string, lang string, source string, n_chars long")
    assert sorted(r.doc_id for r in pipeline.language(spark, docs, sf_dir).collect()) == [1, 4]


def test_language_takes_languages_and_score(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").withColumn("score", F.lit("clash"))
    every = langid.accepted(docs)
    some = langid.accepted(docs, languages=["fr"])
    assert every.columns == docs.columns and every.filter("score = 'clash'").count() == every.count() > 190
    assert 0 < some.count() < every.count() and some.filter("lang = 'fr'").count() > 0.9 * some.count()
    assert langid.accepted(docs, least_score=1.01).count() == 0
