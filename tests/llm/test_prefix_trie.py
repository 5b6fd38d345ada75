import hashlib
import random
import zlib
from collections import defaultdict

import checker
import pytest

from alertloom.llm import catalog, prefix_trie


def brute(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            own[conv].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    full = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        full[c] = tuple(own.get(c - c % 100, [])[:h] + turns[h:])
    members = defaultdict(list)
    for c, t in full.items():
        for d in range(len(t) + 1):
            members[t[:d]].append(c)
    children = defaultdict(list)
    for path in members:
        if path:
            children[path[:-1]].append(path)

    totals = {}
    for path in sorted(members, key=len, reverse=True):
        kids = children[path]
        leaves = sum(totals[k][0] for k in kids) if kids else 1
        saved = sum(totals[k][1] for k in kids) + ((len(members[path]) - 1) * len(path[-1][1]) if path else 0)
        totals[path] = leaves, saved
    out = []
    for path, who in members.items():
        ends = ",".join(str(c) for c in sorted(c for c in who if len(full[c]) == len(path)))
        parent = min(members[path[:-1]]) if path else None
        out.append((min(who), len(path), parent, len(who), len(children[path]), *totals[path], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows():
    draw = random.Random(2)
    out = []
    for c in [*range(0, 330), 1000, 1001, 2500, 2599, 10**12]:
        hot = draw.random() < 0.4
        n = draw.choice([0, 1, 2, 3, 5, 8, 12])
        for t in range(n):
            text = "same first turn é" if t == 0 and hot else draw.choice(["yes", "no", "日本", ""])
            out.append((c, t, draw.choice(["user", "user", None]), draw.choice([text, text, text, None])))
    out += [(700, t, "user", f"copied {t}") for t in range(40)] + [(c, t, "user", f"copied {t}") for c in range(701, 760) for t in range(40)]
    out += [(None, 0, "user", "lost"), (5, None, "system", "null turn first"), (5, 3, "user", "tie b"), (5, 3, "user", "tie a"), (5, 3, "user", "tie a")]
    return out


def run(spark, data, shard_rows):
    turns = spark.createDataFrame([(*r, 9) for r in data], "conv_id long, turn long, role string, text string, depth int").repartition(4)
    found = prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(turns)), shard_rows).select(*prefix_trie.COLUMNS).collect()
    return sorted(map(tuple, found), key=str)


@pytest.mark.parametrize("shard_rows", [10**6, 64, 7])
def test_against_brute_force(spark, shard_rows):
    data = rows()
    assert run(spark, data, shard_rows) == brute(data)


def test_identical_conversations_span_shards(spark, monkeypatch):
    # most conversations end in one node, whose ids come from many shards and in many pieces
    monkeypatch.setattr(prefix_trie, "IDS_CHARS", 20)
    data = [(c, t, "user", "copy") for c in range(0, 60000, 100) for t in range(6)] + [(7, 0, "user", "else")]
    assert run(spark, data, 20) == brute(data)


def test_splitters_are_bounded(spark):
    turns = spark.createDataFrame([(c, 0, "u", str(c)) for c in range(500)], "conv_id long, turn long, role string, text string")
    own = prefix_trie.paths(turns)
    cuts = prefix_trie.splitters(own, 10)
    assert 30 <= len(cuts) < 50 and cuts == sorted(cuts)
    assert prefix_trie.splitters(own, 1000) == []


def test_empty(spark):
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.paths(empty))).collect() == []


def test_query(spark, sf_dir):
    assert checker.compare(catalog.QUERIES["op13_prefix_trie"](spark, "/root/testdata/sf0.01"), checker.connect("/root/testdata/sf0.01"), catalog.ORACLES["op13_prefix_trie"]) == []
