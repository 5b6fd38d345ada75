import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from alertloom.llm import langid
from alertloom.llm.common import text_bytes


def test_windows_cover_whole_texts():
    texts = ["a" * 1000, "", "b" * 192, "c" * 193]
    x, counts = langid.windows_of(*text_bytes(pa.array(texts)))
    assert counts.tolist() == [6, 1, 1, 2]
    assert (x[:6, :192] == 97).sum() == 1000 and (x[6] == 0).all()


def test_pair_tables_give_the_convolution():
    net = langid.train([b"abc def", b"xyz uvw"] * 20, ["p", "q"] * 20, epochs=1)
    x, _ = langid.windows_of(*text_bytes(pa.array(["some text, of bytes"])))
    pooled = net.pooled(x, net.pair_tables())[0]
    k = 0
    for w in langid.WIDTHS:
        conv = [sum(net.filters[w][j][x[0, i + j]] for j in range(w)) for i in range(x.shape[1] - w + 1)]
        want = np.maximum(np.max(conv, axis=0) + net.offsets[w], 0)
        assert np.allclose(pooled[k : k + len(want)], want, atol=1e-5)
        k += len(want)


def test_held_out_accuracy(spark, sf_dir):
    path = f"{sf_dir}/../sf0.01"
    docs = spark.read.parquet(f"{path}/documents.parquet").select("doc_id", "lang")
    found = langid.op10_language(spark, path).join(docs, "doc_id").filter("held_out")
    assert found.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.97


def test_edges(docs, rows, spark):
    found = langid.with_language(docs)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["held_out", "lang_pred", "score"]
    got = {}
    for r in found.collect():
        got.setdefault(r.doc_id, []).append(r)
    assert sum(map(len, got.values())) == len(rows)
    assert all(got[i][0].lang_pred == "und" and got[i][0].score == 0 for i in (5, 6, 7, 10))
    assert all(got[i][0].lang_pred in ("en", "de") for i in (1, 8, 11, 13, 15))
    assert got[16][0] == got[16][1]
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    assert {r.lang_pred for r in langid.with_language(unlabelled).collect()} == {"und"}
    assert langid.with_language(docs.limit(0)).count() == 0
