import hashlib
import random
import re
import time

import checker
import pytest

from alertloom.llm import catalog, decontaminate

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def split(text):
    return WORD.findall((text or "").translate(LOWER))


def brute(text, items):
    w, hit, named = split(text), set(), set()
    for item, question in items:
        q = split(question)
        for i in range(max(1, len(q) - 9) if q else 0):
            window = q[i : i + 10]
            for k in range(len(w) - len(window) + 1):
                if w[k : k + len(window)] == window:
                    hit.update(range(k, k + len(window)))
                    named |= {str(item)} - {"None"}
    ids = ",".join(sorted(named))
    return len(w), len(hit), len(named), hashlib.sha256(ids.encode()).hexdigest(), bool(hit)


def cases():
    draw = random.Random(11)
    vocabulary = [f"w{i}" for i in range(12)] + ["Été", "日本語", "x9"]
    say = lambda n: " ".join(draw.choice(vocabulary) for _ in range(n))
    items = [(k, say(draw.choice([9, 10, 11, 25]))) for k in range(2, 14)]
    items += [(1, "one short"), (20, "Short"), (21, ""), (22, None), (None, "no id at all here"), (23, "..."), (2, "second text of item two"), (1, "one short")]
    docs = [(k, say(draw.randrange(0, 60))) for k in range(40)]
    for k, (_, q) in enumerate(items):
        docs.append((100 + k, f"{say(5)} {(q or '').upper().replace(' ', '-- ')}; {say(3)} {q}"))
    docs += [(200, None), (201, ""), (202, " .. "), (None, items[0][1]), (203, items[0][1]), (203, items[0][1]), (204, "one, SHORT one short")]
    return docs, items


@pytest.mark.parametrize("shard_words", [10**6, 20])
def test_against_brute_force(spark, shard_words):
    docs, items = cases()
    rows = spark.createDataFrame([(i, t, 1, "x") for i, t in docs], "doc_id long, text string, n_hit int, Items string").repartition(4)
    found = decontaminate.with_contamination(rows, spark.createDataFrame(items, "item_id long, text string"), shard_words=shard_words)
    assert found.columns == ["doc_id", "text", *decontaminate.ADDED]
    got = sorted((str(r.doc_id), r.text or "", (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in found.collect())
    assert got == sorted((str(i), t or "", brute(t, items)) for i, t in docs)
    assert sum(r[2][4] for r in got) > 10


def test_several_shards(spark):
    items = spark.createDataFrame(cases()[1], "item_id long, text string")
    assert len(decontaminate.store_items(items, 20)) > 3


def test_passages_are_cut_at_their_places(spark):
    docs = [(1, "Ähm, the QUICK brown - fox! End"), (2, None), (3, "clean"), (4, "the quick brown fox the quick brown fox")]
    items = spark.createDataFrame([(7, "The quick brown fox")], "item_id long, text string")
    rows = spark.createDataFrame([(i, t, "kept") for i, t in docs], "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in decontaminate.cleaned(rows, items).collect()}
    assert got[1].text == "Ähm, ! End" and [tuple(s) for s in got[1].spans] == [(5, 26)] and got[1].lang == "kept"
    assert docs[0][1][5:26] == "the QUICK brown - fox"
    assert got[2].text is None and got[3].text == "clean" and got[4].text == "" and got[3].spans == []


def test_no_items_and_no_documents(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [(r.n_words, r.contaminated) for r in decontaminate.with_contamination(docs, none).collect()] == [(2, False)]
    assert decontaminate.with_contamination(docs.limit(0), docs.withColumnRenamed("doc_id", "item_id")).collect() == []


def test_long_text_is_scanned_in_linear_time():
    windows = decontaminate.Windows([("1", [b"a"] * 30), ("2", [b"a"])])
    symbols = windows.read(decontaminate.span_hash(*spans(b"a " * 200_000)))
    start = time.perf_counter()
    inside, items = windows.scan(symbols, lambda k: b"a")
    assert inside.all() and items == {"1", "2"} and time.perf_counter() - start < 10


def spans(data):
    import numpy as np

    data = np.frombuffer(data, np.uint8)
    return data, *decontaminate.words_of(data, np.array([0, len(data)]))[:2]


def test_query(spark, sf_dir):
    assert checker.compare(catalog.QUERIES["op12_decontaminate"](spark, "/root/testdata/sf0.01"), checker.connect("/root/testdata/sf0.01"), catalog.ORACLES["op12_decontaminate"]) == []
