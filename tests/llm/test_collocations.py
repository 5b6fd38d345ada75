import random
import re
from collections import Counter, defaultdict

import checker
import numpy as np
import pytest

from alertloom.llm import catalog, collocations

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top):
    f, n = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = set()
    for lang, counts in f.items():
        cands = {p: a for p, a in counts.items() if len(p) > 1 and a >= least}
        kept = []
        for p, a in cands.items():
            if any(len(q) > len(p) and 100 * b >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q))) for q, b in cands.items()):
                continue
            score, k = min((2000000 * a // (counts[p[:k]] + counts[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), counts[p[:k]], counts[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(kept)[:top], 1):
            out.add((lang, rank, phrase.decode(), -a, left, right, n[lang], -score))
    return out


def rows():
    draw = random.Random(5)
    vocabulary = ["the", "The", "of", "new", "york", "city", "é", "日本", "a-b", "x\x1fy"] + [f"w{i}" for i in range(30)]
    texts = []
    for k in range(300):
        words = [draw.choice(vocabulary[: draw.choice([4, 10, 40])]) for _ in range(draw.randrange(0, 40))]
        if k % 3 == 0:
            words += ["hot", "pair"] * 10
        if k % 4 == 0:
            words += ["only", "ever", "whole"]
        texts.append((draw.choice(["en", "de", None, "", "en"]), "".join(w + draw.choice([" ", "  ", "\t", " ", ". ", "\n", ",", " "]) for w in words)))
    return texts + [("en", None), (None, ""), ("fr", " .,\n"), ("en", "deep phrase " * 300), ("en", "deep phrase " * 300)]


@pytest.mark.parametrize("sizes", [{}, {"most": 50, "burst": 4, "block": 7}])
def test_against_brute_force(spark, sizes):
    data = rows()
    docs = spark.createDataFrame(data, "lang string, text string").withColumn("phrase", collocations.F.lit("clash")).repartition(3)
    found = collocations.collocations(docs, least=5, top=20, **sizes).collect()
    assert {tuple(r[c] for c in ("lang", "rank", "phrase", "a", "l", "r", "n", "score")) for r in found} == brute(data, 5, 20)
    assert len(found) > 40


def test_empty(spark):
    empty = spark.createDataFrame([], "lang string, text string")
    assert collocations.collocations(empty).collect() == []


def test_containers_burst_by_prefix_and_spill_whole_ranges():
    draw = np.random.default_rng(3)
    trie, want = collocations.HatTrie(burst=16), Counter()
    for _ in range(50):
        prefix, rest = draw.integers(1, 40, 100).astype(np.uint64), draw.integers(0, 9, 100).astype(np.uint64)
        want.update(zip(prefix.tolist(), rest.tolist()))
        trie.add(prefix, rest)
    assert len(trie.containers) > 10 and trie.entries == len(want)
    owned = [set(collocations.unpacked(c)[0].tolist()) for c in trie.containers]
    assert sum(map(len, owned)) == len(set().union(*owned))  # a prefix is never in two containers
    got = Counter()
    for container in [*trie.spill(100), *trie.spill(0)]:
        got.update(dict(zip(zip(*(x.tolist() for x in collocations.unpacked(container))), container.values())))
    assert got == want and trie.entries == 0


def test_full_filter_changes_nothing(spark, monkeypatch):
    # a table whose bits are all set keeps every phrase, and results are the same
    every = np.full(1 << (collocations.FILTER_BITS - 6), (1 << 64) - 1, np.uint64)
    monkeypatch.setattr(collocations, "phrase_filter", lambda frequent, words: collocations.PhraseFilter(words, every))
    data = rows()
    found = collocations.collocations(spark.createDataFrame(data, "lang string, text string"), least=5, top=20).collect()
    assert {tuple(r) for r in found} == brute(data, 5, 20)


def test_query(spark, sf_dir):
    assert checker.compare(catalog.QUERIES["op11_collocations"](spark, "/root/testdata/sf0.01"), checker.connect("/root/testdata/sf0.01"), catalog.ORACLES["op11_collocations"]) == []
