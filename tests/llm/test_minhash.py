import random

import brute
import numpy as np
import pyarrow as pa

from alertloom.llm import minhash
from alertloom.llm.common import text_bytes
from alertloom.llm.components import components


def _compare(spark, docs):
    found = minhash.near_duplicates(spark.createDataFrame(docs, "doc_id long, text string").repartition(6)).collect()
    expected = brute.near_components(docs)
    assert len(found) == len(docs)
    texts = dict(docs)
    for r in found:
        assert (r.n_shingles, r.component_id) == (len(brute.shingles(texts[r.doc_id])), expected[r.doc_id]), r
        assert r.kept == (r.doc_id == r.component_id)


def _near(rng, words, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = f"e{rng.randrange(10**9)}"
    return " ".join(words)


def test_against_all_pairs(spark):
    rng = random.Random(3)
    docs, base = [], [f"v{rng.randrange(300)}" for _ in range(200)]
    for i in range(240):  # a large group of near copies at and around the limit, all different
        docs.append((i, _near(rng, base, rng.randrange(9))))
    passage = " ".join(f"p{i}" for i in range(60))
    for i in range(240, 300):  # a passage that many share
        docs.append((i, passage + " " + " ".join(f"t{rng.randrange(10**6)}" for _ in range(rng.choice([4, 10, 60, 200])))))
    chain = [f"c{i}" for i in range(120)]
    for i in range(300, 340):  # each like the one before, the ends unlike
        docs.append((i, " ".join(chain)))
        chain = chain[3:] + [f"c{i}-{k}" for k in range(3)]
    docs += [(400, "one two"), (401, "One TWO"), (402, "one"), (403, ""), (404, None), (405, " \n"), (406, "É é"), (407, "é é")]
    _compare(spark, docs)


def test_edges(docs, rows):
    found = minhash.near_duplicates(docs).collect()
    assert len(found) == len(rows)
    by = {}
    for r in found:
        by.setdefault(r.doc_id, []).append(r)
    assert by[1][0].component_id == by[2][0].component_id == 1 and not by[2][0].kept
    assert by[5][0].n_shingles == 0 and by[5][0].kept and by[None][0].component_id is None
    assert len(by[16]) == 2
    left = minhash.one_of_each(docs)
    ids = sorted(r.doc_id for r in left.filter("doc_id IS NOT NULL").collect())
    assert len(ids) == len(set(ids)) and 16 in ids and 2 not in ids and left.columns == docs.columns
    assert left.filter("doc_id IS NULL").count() == 1
    assert minhash.near_duplicates(docs.limit(0)).count() == 0


def test_sketch_is_full_and_fair():
    rng = random.Random(5)
    pool = [f"s{i}" for i in range(3000)]
    a = set(rng.sample(pool, 500))
    b = set(rng.sample(sorted(a), 400)) | set(rng.sample(pool, 100))
    keys = {w: np.uint64(int.from_bytes(rng.randbytes(8), "little")) for w in a | b | {"alone"}}
    flat = np.concatenate([np.sort(np.array([keys[w] for w in s], np.uint64)) for s in (a, b, {"alone"})])
    s = minhash.sketches(flat, np.array([0, len(a), len(a) + len(b), len(flat)]), 400)
    assert (s != np.iinfo(np.uint64).max).all()
    assert abs((s[0] == s[1]).mean() - len(a & b) / len(a | b)) < 0.1


def test_shingles_of_chunks_equal_single_texts():
    texts = ["a b c d", "", "A B", "x", " a  b\tc\nd e ", "a b c a b c a b c"]
    data, offsets = text_bytes(pa.array(texts))
    keys, bounds = minhash.shingles(data, offsets)
    for i, t in enumerate(texts):
        alone, b = minhash.shingles(*text_bytes(pa.array([t])))
        assert keys[bounds[i] : bounds[i + 1]].tolist() == alone[b[0] : b[1]].tolist()
        assert len(alone) == len(brute.shingles(t))


def test_parities_bound_the_difference():
    rng = np.random.default_rng(6)
    a = np.unique(rng.integers(0, 1 << 63, 300).astype(np.uint64))
    for d in (0, 1, 7, 40, 200):
        b = np.unique(np.concatenate([a[d:], rng.integers(0, 1 << 63, d).astype(np.uint64)]))
        x = minhash.parities(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        bits = sum(int(v).bit_count() for v in (x[0] ^ x[1]).view(np.uint64))
        differ = len(np.setxor1d(a, b))
        assert bits <= differ and bits >= 0.6 * differ and bits % 2 == differ % 2


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 60)] + [(100, k) for k in range(101, 180)] + [(500, 400), (400, 500), (7, 7)]
    found = {r.a: r.b for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 1 for i in range(2, 61)}, **{k: 100 for k in range(101, 180)}, 500: 400}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_one_id_with_several_texts(spark):
    """Rows are documents of their own: links go by text, and components by the least id among their rows."""
    a, b = (" ".join(f"{c}{i}" for i in range(80)) for c in "ab")
    rows = [(1, a), (1, b), (2, a + " word"), (3, b + " word"), (5, b.upper()), (5, a), (5, a), (0, "other words"), (2, "")]
    expected = brute.near_components(list(enumerate(t for _, t in rows)))
    least = {}
    for n, (i, _) in enumerate(rows):
        least[expected[n]] = min(i, least.get(expected[n], i))
    want = sorted((i, len(brute.shingles(t)), least[expected[n]] if t else i) for n, (i, t) in enumerate(rows))
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, root string").repartition(3)
    found = minhash.near_duplicates(df).collect()
    assert sorted((r.doc_id, r.n_shingles, r.component_id) for r in found) == want
    kept = minhash.one_of_each(df)
    assert sorted((r.doc_id, r.text) for r in kept.collect()) == [(0, "other words"), (1, a), (1, b), (2, "")]
    assert kept.columns == df.columns
