import brute
import checker
from pyspark.sql import functions as F

from alertloom.llm import catalog, mixing


def test_query(spark, sf_dir):
    assert checker.compare(mixing.op5_mixing(spark, sf_dir), checker.connect(sf_dir), catalog.ORACLES["op5_mixing"]) == []


def test_plan_on_edges(docs, rows):
    queue, mix = mixing.mix_plan(docs)
    assert queue.count() == len(rows)
    targets = {r.source: (r.source_size, r.target) for r in queue.collect()}
    total = sum(len(brute.words(t)) for _, t, *_ in rows)
    assert abs(sum(t for _, t in targets.values()) - total) < 1e-6
    assert all(t <= 3 * n + 1e-9 for n, t in targets.values()) and None in targets
    taken = {r.source: r.n for r in mix.groupBy("source").agg(F.sum("mix_words").alias("n")).collect()}
    for source, (size, target) in targets.items():
        assert abs(taken.get(source, 0) - target) < 1 or size == 0
    ordered = sorted(mix.collect(), key=lambda r: r.mix_start)
    at = 0
    for r, after in zip(ordered, ordered[1:] + [None], strict=True):
        assert r.mix_start == at
        at += r.mix_words
        assert after is None or after.mix_finish >= r.mix_finish
    assert at <= total


def test_documents_follow_the_plan(docs):
    mixed = mixing.mix_documents(docs)
    assert mixed.filter(F.regexp_count("text", F.lit(mixing.WORD)) != F.col("mix_words")).count() == 0
    _, mix = mixing.mix_plan(docs)
    one, two = (x.groupBy("doc_id").agg(F.sum("mix_words").alias("n")).collect() for x in (mixed, mix))
    assert sorted(map(str, one)) == sorted(map(str, two))
    assert {"score", "kept"} <= set(mixed.columns) and "Size" in mixed.columns or "size" not in mixed.columns


def test_hot_source_and_empty(spark):
    rows = [(i, "w " * (i % 7), "hot" if i % 3 else f"s{i % 40}") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    first, again = (sorted(map(str, mixing.mix_plan(d)[1].collect())) for d in (df, df.repartition(17)))
    assert first == again
    assert mixing.mix_documents(df.limit(0)).count() == 0
    blank = df.withColumn("text", F.lit(None).cast("string"))
    assert mixing.mix_documents(blank).count() == 0
