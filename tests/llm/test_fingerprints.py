import hashlib

from pyspark.sql import functions as F

from alertloom.llm import order_minhash as om


def _expected(rows):
    """(doc_id, hash of the edited text) of each (doc_id, text), by descending doc_id, null last."""
    ordered = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0)))
    out = []
    for k, (i, text) in enumerate(ordered):
        follow = ordered[(k + 1) % len(ordered)][1] or ""
        text = text or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + follow[:half]
        out.append((i, hashlib.sha256(edited.encode()).hexdigest()))
    return out


def test_edited_texts_and_likeness(docs, rows):
    found = om.fingerprints(docs).collect()
    assert len(found) == len(rows)
    edited = _expected([(i, t) for i, t, *_ in rows])
    assert sorted((str(r.doc_id), r.edited_sha256) for r in found) == sorted((str(i), h) for i, h in edited)
    texts = {i: t or "" for i, t, *_ in rows}
    for r in found:
        assert r.n_chars == len(texts[r.doc_id])
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
    prints = {r.doc_id: r.fingerprint for r in found}
    assert prints[1] == prints[2] and prints[5] == prints[6] == "" and prints[3] != prints[4]
    by_id = {r.doc_id: r for r in found}
    assert by_id[2].near_next == 1.0  # its next is its copy
    assert 0 < by_id[4].near_next < 1


def test_blocks_agree_with_one_block(docs):
    one = om.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ("text",), blocks=1)
    many = om.with_next(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")), ("text",), blocks=40)
    assert sorted(map(str, one.collect())) == sorted(map(str, many.collect()))


def test_signature_keeps_order_and_counts(spark):
    base = " ".join(f"w{i}" for i in range(400))
    halves = base.split()
    swapped = " ".join(halves[200:] + halves[:200])
    backwards = " ".join(reversed(halves))
    repeated = " ".join(["w0 w1 w2 w3"] * 100)
    once = "w0 w1 w2 w3"
    df = spark.createDataFrame([(1, base, swapped, backwards, repeated, once)], "id int, a string, b string, c string, d string, e string")
    for c in "abcde":
        df = om.with_signature(df, c, f"s{c}")
    near = df.select(*[om.likeness(f"s{x}", f"s{y}").alias(x + y) for x, y in ("aa", "ab", "ac", "de")]).first()
    assert near.aa == 1.0
    assert 0.2 < near.ab < 0.9  # the same items, half of the pairs in another order
    assert near.ac == 0.0
    assert near.de < 0.3  # occurrences are numbered, so repeats are items of their own


def test_single_and_empty(spark):
    one = om.fingerprints(spark.createDataFrame([(3, "a b c d")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert om.fingerprints(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_short_texts_keep_order(spark):
    """Swapped halves of short texts: likeness of 64 independent functions, not of mostly single items."""
    rows = []
    for n in (20, 40, 80, 130):
        for k in range(25):
            w = [f"t{n}x{k}y{j}" for j in range(n)]
            rows.append((n, " ".join(w), " ".join(w[n // 2 :] + w[: n // 2]), " ".join([*w[:-1], "other"])))
    df = spark.createDataFrame(rows, "n int, a string, b string, c string").repartition(4)
    for c in "abc":
        df = om.with_signature(df, c, f"s{c}")
    per = df.groupBy("n").agg(F.avg(om.likeness("sa", "sb")).alias("swapped"), F.avg(om.likeness("sa", "sc")).alias("edited"), F.min(F.size("sa")).alias("slots"))
    found = {r.n: r for r in per.collect()}
    print({n: (round(r.swapped, 3), round(r.edited, 3)) for n, r in sorted(found.items())})
    for n, model in ((20, 0.29), (40, 0.42), (80, 0.45), (130, 0.47)):
        assert found[n].slots == om.SLOTS
        assert abs(found[n].swapped - model) < 0.08
        assert found[n].edited > found[n].swapped + 0.2


def test_every_function_of_few_items(spark):
    texts = ["a", "a b", "a b c", "a b c d", "b c d a b c", "c d a b"]
    df = om.with_signature(spark.createDataFrame(list(enumerate(texts)), "id int, text string"), "text", "s")
    found = {r.text: r.s for r in df.collect()}
    assert all(len(s) == om.SLOTS == len({x >> om.TUPLE_BITS for x in s}) for s in found.values())
    assert len({tuple(s) for s in found.values()}) == len(texts)
