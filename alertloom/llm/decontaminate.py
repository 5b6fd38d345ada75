"""Benchmark decontamination: one Aho-Corasick automaton over normalised test texts, one scan per text.

Texts are normalised to words (letters a-z after lower-casing A-Z, digits, and all beyond ASCII);
a window is ten consecutive words of an item, or the whole item if it has fewer. The automaton
reads words: a word of the test texts is a symbol, any other word is symbol 0, which no window
holds. A match is compared with the words themselves before it counts, as words are looked up by
64-bit hash. Word places are mapped back to characters of the original text.

The items are normalised by Spark and stored in the shared folder, dealt into shards of about
``SHARD_WORDS`` words; workers build a shard's automaton from there and keep it. Each text passes
the shards one after the other and carries its hits along, so there is no shuffle and no limit on
the number of items; usual test sets are one shard.

Nulls: a null text has no words and is never hit; words of an item without id are hit but name no
item. Empty items have no window. Items of equal id count once. Repeated rows give equal results.
No items: nothing is hit. Texts are scanned whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import LOWER, span_hash, spans, text_bytes, text_chunks, without, worker_state
from alertloom.llm.files import located
from alertloom.session import scratch_path

WINDOW = 10
#: Words of items in one automaton; ten times as many states at most.
SHARD_WORDS = 200_000
ADDED = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated", "items", "hits")

_WORD = np.ones(256, bool)
_WORD[:128] = False
_WORD[[*range(48, 58), *range(97, 123)]] = True


def words_of(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and the first word of each text of lower-cased bytes."""
    return spans(_WORD[data], offsets)


class Windows:
    """Automaton over the windows of a shard's items."""

    def __init__(self, items: list[tuple[str | None, list[bytes]]], window: int = WINDOW) -> None:
        self.window = window
        ids: dict[bytes, int] = {}
        found: dict[tuple[int, ...], set[str]] = {}
        for item, words in items:
            symbols = [ids.setdefault(w, len(ids) + 1) for w in words]
            for k in range(max(1, len(symbols) - window + 1) if symbols else 0):
                found.setdefault(tuple(symbols[k : k + window]), set()).update([] if item is None else [item])
        self.words = [b"", *ids]
        data = np.frombuffer(b"".join(ids), np.uint8)
        at = np.cumsum([0, *map(len, ids)])
        hashes = span_hash(data, at[:-1], at[1:])
        order = np.argsort(hashes)
        self.hashes, self.symbols = hashes[order], order + 1
        self.patterns = list(found)
        self.items = [found[p] for p in self.patterns]
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        for k, p in enumerate(self.patterns):
            self.automaton.add_word(p, k)
        if self.patterns:
            self.automaton.make_automaton()

    def read(self, hashes: np.ndarray) -> np.ndarray:
        """Symbols of words."""
        if not len(self.hashes):
            return np.zeros(len(hashes), np.int64)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return np.where(self.hashes[at] == hashes, self.symbols[at], 0)

    def scan(self, symbols: np.ndarray, word) -> tuple[np.ndarray, set[str]]:
        """Which words are inside an occurrence of a window, and the items of these windows."""
        hit = np.zeros(len(symbols) + 1, np.int64)
        seen: set[int] = set()
        if self.patterns and symbols.any():
            for end, k in self.automaton.iter(tuple(symbols.tolist())):
                pattern = self.patterns[k]
                begin = end + 1 - len(pattern)
                if all(word(begin + j) == self.words[s] for j, s in enumerate(pattern)):
                    hit[begin] += 1
                    hit[end + 1] -= 1
                    seen.add(k)
        return np.cumsum(hit[:-1]) > 0, set().union(*(self.items[k] for k in seen))


def store_items(items: DataFrame, shard_words: int = SHARD_WORDS) -> list[str]:
    """Normalises ``items(item_id, text)`` and stores them by shard; returns the folder of each."""

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches):
            data = LOWER[data]
            starts, ends, first = words_of(data, offsets)
            texts = [" ".join(data[starts[k] : ends[k]].tobytes().decode() for k in range(a, b)) for a, b in zip(first, first[1:])]
            columns = [batch.column("item_id"), pa.array(texts, pa.string()), pa.array(np.diff(first), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["item_id", "words", "n"])

    spark = items.sparkSession
    rows = items.select(F.col("item_id").cast("string").alias("item_id"), "text")
    rows = rows.mapInArrow(normalise, "item_id string, words string, n long").filter("n > 0").distinct()
    whole = scratch_path(spark, "items")
    rows.write.parquet(whole)
    normal = spark.read.schema("item_id string, words string, n long").parquet(whole)
    total = normal.agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // shard_words))
    if shards == 1:
        return [whole]
    path = scratch_path(spark, "item-shards")
    shard = F.pmod(F.xxhash64("words", "item_id"), F.lit(shards))
    normal.withColumn("shard", shard).repartition("shard").write.partitionBy("shard").parquet(path)
    return [f"{path}/shard={k}" for (k,) in spark.read.parquet(path).select("shard").distinct().orderBy("shard").collect()]


def _load(folder: str, window: int) -> Windows:
    """The automaton of a stored shard, built in a worker."""
    store, path = located(folder)
    table = pq.read_table(path, filesystem=store, columns=["item_id", "words"], partitioning=None)
    return Windows([(i, w.encode().split(b" ")) for i, w in zip(*(table.column(c).to_pylist() for c in ("item_id", "words")), strict=True)], window)


SCAN_SCHEMA = "n_words long, hits array<struct<begin:long,end:long>>, items array<string>"


def _scanner(folder: str, window: int, first_pass: bool):
    """For ``mapInArrow``: adds ``n_words, hits, items``, or adds to them. Hits are ranges of words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = worker_state("windows", dict)  # a worker keeps the last automaton only
        if (folder, window) not in held:
            held.clear()
            held[folder, window] = _load(folder, window)
        windows = held[folder, window]
        for batch, data, offsets in text_chunks(batches):
            lower = LOWER[data]
            starts, ends, first = words_of(lower, offsets)
            symbols = windows.read(span_hash(lower, starts, ends))
            hits, items = [], []
            before = [None] * batch.num_rows if first_pass else batch.column("hits").to_pylist()
            named = [None] * batch.num_rows if first_pass else batch.column("items").to_pylist()
            for k, (a, b) in enumerate(zip(first[:-1].tolist(), first[1:].tolist())):
                inside, found = windows.scan(symbols[a:b], lambda j, a=a: lower[starts[a + j] : ends[a + j]].tobytes())
                for r in before[k] or ():
                    inside[r["begin"] : r["end"]] = True
                edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.astype(np.int8), [0]])))
                hits.append([{"begin": x, "end": y} for x, y in edges.reshape(-1, 2).tolist()])
                items.append(sorted(found.union(named[k] or ())))
            kept = [c for c in batch.schema.names if c not in ("n_words", "hits", "items")]
            columns = [*[batch.column(c) for c in kept], pa.array(np.diff(first), pa.int64())]
            span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
            columns += [pa.array(hits, span), pa.array(items, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*kept, "n_words", "hits", "items"])

    return scan


def scanned(docs: DataFrame, items: DataFrame, window: int = WINDOW, shard_words: int = SHARD_WORDS) -> DataFrame:
    """``docs`` with ``n_words``, ``hits`` (ranges of words inside an occurrence of a window) and ``items`` (their ids)."""
    rows = without(docs, ("n_words", "hits", "items"))
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields)
    for k, folder in enumerate(store_items(items, shard_words)):
        rows = rows.mapInArrow(_scanner(folder, window, k == 0), f"{schema}, {SCAN_SCHEMA}")
    return rows


def with_contamination(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """All columns of ``docs`` with the counts, the items and the hit ranges of words."""
    rows = without(docs, ADDED)
    ids = F.concat_ws(",", "items")
    hit = F.aggregate("hits", F.lit(0).cast("long"), lambda acc, h: acc + h["end"] - h["begin"])
    return scanned(rows, items, **options).select(
        *[f"`{c}`" for c in rows.columns],
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(ids, 256).alias("items_sha256"),
        (F.size("hits") > 0).alias("contaminated"),
        "items",
        "hits",
    )


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        spans_of, texts = [], []
        for text, hits in zip(batch.column("text").to_pylist(), batch.column("hits").to_pylist(), strict=True):
            data, offsets = text_bytes(pa.array([text or ""]))
            starts, ends, _ = words_of(LOWER[data], offsets)
            place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
            found = [(int(place[starts[h["begin"]]]), int(place[ends[h["end"] - 1]])) for h in hits]
            at, parts = 0, []
            for a, b in found:
                parts.append((text or "")[at:a])
                at = b
            spans_of.append([{"begin": a, "end": b} for a, b in found])
            texts.append("".join([*parts, text[at:]]) if text is not None else None)
        span = pa.list_(pa.struct([("begin", pa.int64()), ("end", pa.int64())]))
        kept = [c for c in batch.schema.names if c not in ("text", "hits")]
        columns = [*[batch.column(c) for c in kept], pa.array(texts, pa.string()), pa.array(spans_of, span)]
        yield pa.RecordBatch.from_arrays(columns, names=[*kept, "text", "spans"])


def cleaned(docs: DataFrame, items: DataFrame, **options: int) -> DataFrame:
    """``docs`` with the hit passages cut out of ``text`` and their places in the original as ``spans`` of code points."""
    rows = without(docs, ("spans", "hits", "items", "n_words"))
    found = scanned(rows, items, **options).drop("n_words", "items")
    others = [f for f in rows.schema.fields if f.name != "text"]
    schema = ", ".join([*[f"`{f.name}` {f.dataType.simpleString()}" for f in others], "text string, spans array<struct<begin:long,end:long>>"])
    return found.mapInArrow(_cut, schema).select(*[f"`{c}`" for c in rows.columns], "spans")


def op12_decontaminate(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    found = with_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


OP12_SQL = r"""
WITH d AS (
  SELECT row_number() OVER () AS row_id, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), i AS (
  SELECT DISTINCT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark
), windows AS (
  SELECT DISTINCT item_id, array_to_string(w[k:k + 9], ' ') AS win, least(len(w), 10) AS size
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS k FROM i WHERE len(w) > 0)
), sizes AS (SELECT DISTINCT size FROM windows
), places AS (
  SELECT row_id, k, s.size, array_to_string(w[k:k + s.size - 1], ' ') AS win
  FROM (SELECT row_id, w, size, unnest(range(1, len(w) - size + 2)) AS k FROM d, sizes WHERE len(w) >= size) s
), found AS (
  SELECT row_id, k, p.size, item_id FROM places p JOIN windows w ON w.win = p.win AND w.size = p.size
), hit AS (
  SELECT row_id, count(DISTINCT place) AS n_hit FROM (SELECT row_id, unnest(range(k, k + size)) AS place FROM found) GROUP BY row_id
), named AS (
  SELECT row_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
  FROM (SELECT DISTINCT row_id, item_id FROM found WHERE item_id IS NOT NULL) GROUP BY row_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (row_id) LEFT JOIN named USING (row_id)
"""
