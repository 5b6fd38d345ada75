"""Phrase collocations counted in HAT-tries: bursting hash containers, spilled subtrees, merged runs.

A task counts phrases in a trie over ids of languages and words that is three levels deep
(language, first word, second word). Its leaves are hash containers, each owning a range of
prefixes; a full container bursts into two at the middle prefix of its own, until it holds a
single prefix. When a task holds too many entries it spills its largest subtrees as runs sorted by
phrase. The runs of all tasks are dealt out by ranges of (language, phrase), so a partition holds
the subtrees of a range of prefixes and a hot prefix is cut into several, and are merged there.

A phrase is no more frequent than any part of it. So words are counted first, then pairs of
frequent words, then phrases of three and four words made of frequent pairs. The frequent parts
are told apart by a bit table of fixed size (``FILTER_BITS``): a clash in it only counts a phrase
that is dropped later, so results are exact whatever the number of parts.

Words are told apart by 64-bit hashes within a task. Nulls: a null text is empty, a null language
is ``und``. Repeated rows count again; no row gives an empty result. Texts are counted whole, a
block of words at a time.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.common import LOWER, mix64, span_hash, spans, stored, text_bytes, text_chunks

LEAST = 30
LONGEST = 4
SCALE = 2_000_000
#: A candidate is redundant if a longer one reaches this share (percent) of its count.
COVERED = 80
TOP = 2000

#: Words counted at once, entries of a container before it bursts, entries of a task before it spills.
BLOCK, BURST, MOST_ENTRIES = 200_000, 16_384, 1_500_000
LANG_BITS, WORD_BITS = 18, 23
FILTER_BITS = 26
#: Copies of a one-word part, so that a hot word's lookups go to several tasks; buckets ranked before the last ranking.
SALTS, RANK_BUCKETS = 16, 64

_PIECE = np.zeros(256, bool)
_PIECE[list(b".,;:!?\n\x0b\x0c\r")] = True
_GAP = _PIECE.copy()
_GAP[list(b" \t")] = True

#: Above all prefixes.
NO_PREFIX = np.uint64((1 << 64) - 1)

RUN_SCHEMA = "lang string, phrase string, words int, n long"


class HatTrie:
    """Counts of (prefix, rest) keys in containers that own ranges of prefixes. If not ``wide``, all rests are 0."""

    def __init__(self, burst: int = BURST, wide: bool = True) -> None:
        self.burst, self.wide = burst, wide
        self.bounds = np.zeros(1, np.uint64)
        self.containers: list[Counter] = [Counter()]
        self.limits = [burst]
        self.entries = 0

    def add(self, prefix: np.ndarray, rest: np.ndarray) -> None:
        if not len(prefix):
            return
        if self.wide:
            order = np.argsort(prefix)
            prefix = prefix[order]
            pairs = np.empty((len(order), 2), ">u8")
            pairs[:, 0], pairs[:, 1] = prefix, rest[order]
            self._count(prefix, pairs.view("V16").ravel().tolist(), None)
        else:
            keys, n = np.unique(prefix, return_counts=True)
            once = n == 1
            self._count(keys[once], keys[once].tolist(), None)
            self._count(keys[~once], keys[~once].tolist(), n[~once].tolist())
        for k in range(len(self.containers) - 1, -1, -1):
            if len(self.containers[k]) > self.limits[k]:
                self._burst(k)

    def _count(self, prefix: np.ndarray, keys: list, counts: list[int] | None) -> None:
        """Adds keys, sorted by prefix, to the containers that own them."""
        edges = [*np.searchsorted(prefix, self.bounds).tolist(), len(keys)]
        for container, a, b in zip(self.containers, edges, edges[1:]):
            if a < b:
                before = len(container)
                if counts is None:
                    container.update(keys[a:b])
                else:
                    for key, n in zip(keys[a:b], counts[a:b]):
                        container[key] = container.get(key, 0) + n
                self.entries += len(container) - before

    def _burst(self, k: int) -> None:
        """Cuts a container in two at the middle prefix; one with a single prefix may grow to twice its size."""
        container = self.containers[k]
        prefixes = unpacked(container)[0]
        middle = np.partition(prefixes, len(prefixes) // 2)[len(prefixes) // 2]
        cut = middle if middle > prefixes.min() else prefixes[prefixes > middle].min(initial=NO_PREFIX)
        above = prefixes >= cut
        if cut == NO_PREFIX:
            self.limits[k] = 2 * len(container)
            return
        items = np.empty(len(container), object)
        items[:] = list(container.items())
        self.containers[k : k + 1] = [Counter(dict(items[~above])), Counter(dict(items[above]))]
        self.limits[k : k + 1] = [self.burst, self.burst]
        self.bounds = np.insert(self.bounds, k + 1, cut)

    def spill(self, left: int) -> Iterator[Counter]:
        """Takes out the largest subtrees until at most ``left`` entries remain."""
        for k in sorted(range(len(self.containers)), key=lambda k: -len(self.containers[k])):
            if self.entries <= left or not self.containers[k]:
                return
            out, self.containers[k] = self.containers[k], Counter()
            self.entries -= len(out)
            yield out


def unpacked(container: Counter) -> tuple[np.ndarray, np.ndarray]:
    if isinstance(next(iter(container), b""), int):
        return np.fromiter(container, np.uint64, len(container)), np.zeros(len(container), np.uint64)
    keys = np.frombuffer(b"".join(container), ">u8").reshape(-1, 2).astype(np.uint64)
    return keys[:, 0], keys[:, 1]


class Names:
    """Ids from 1 for what is met, by 64-bit hash: an open-addressing table looked up for many at once."""

    def __init__(self) -> None:
        self.names: list[bytes] = [b""]
        self._grow(1 << 12)

    def _grow(self, size: int) -> None:
        known = (self.keys[self.ids > 0], self.ids[self.ids > 0]) if len(self.names) > 1 else None
        self.keys, self.ids = np.zeros(size, np.uint64), np.zeros(size, np.uint32)
        if known is not None:
            self._put(*known)

    def _find(self, hashes: np.ndarray) -> np.ndarray:
        """Slot of each hash, or the empty slot where its search ends."""
        mask = np.uint64(len(self.keys) - 1)
        slot = hashes & mask
        open_ = np.arange(len(hashes))
        while len(open_):
            at = slot[open_]
            open_ = open_[(self.ids[at] > 0) & (self.keys[at] != hashes[open_])]
            slot[open_] = (slot[open_] + np.uint64(1)) & mask
        return slot

    def _put(self, hashes: np.ndarray, ids: np.ndarray) -> None:
        """Adds distinct new hashes; of those that want one slot the first gets it, the others search on."""
        while len(hashes):
            slot = self._find(hashes)
            taken, first = np.unique(slot, return_index=True)
            self.keys[taken], self.ids[taken] = hashes[first], ids[first]
            left = np.ones(len(hashes), bool)
            left[first] = False
            hashes, ids = hashes[left], ids[left]

    def of(self, hashes: np.ndarray, name) -> np.ndarray:
        out = self.ids[self._find(hashes)]
        missing = np.flatnonzero(out == 0)
        if len(missing):
            new, first = np.unique(hashes[missing], return_index=True)
            ids = np.arange(len(self.names), len(self.names) + len(new), dtype=np.uint32)
            self.names += [name(k) for k in missing[first].tolist()]
            if 2 * len(self.names) > len(self.keys):
                self._grow(1 << (4 * len(self.names)).bit_length())
            self._put(new, ids)
            out[missing] = self.ids[self._find(hashes[missing])]
        return out.astype(np.uint64)


def gram_keys(lang: np.ndarray, *hashes: np.ndarray) -> np.ndarray:
    """64-bit keys of phrases of a language from the hashes of their words."""
    key = lang
    for h in hashes:
        key = mix64(key ^ h)
    return key


class PhraseFilter:
    """Bit table of the frequent phrases of one length."""

    def __init__(self, words: int, bits: np.ndarray) -> None:
        self.words, self.bits = words, bits

    def holds(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - FILTER_BITS)
        return (self.bits[(at >> np.uint64(6)).astype(np.int64)] >> (at & np.uint64(63))) & np.uint64(1) == 1


def phrase_filter(frequent: DataFrame, words: int) -> PhraseFilter:
    """Bit table of ``frequent(lang, phrase)``, all of so many words; at most 2 ** FILTER_BITS / 64 rows are collected."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column("phrase"))
            starts, ends, _ = spans(data != 32, offsets)
            h = span_hash(data, starts, ends).reshape(-1, words)
            langs, at = text_bytes(batch.column("lang"))
            keys = gram_keys(span_hash(langs, at[:-1], at[1:]), *h.T)
            place = keys >> np.uint64(64 - FILTER_BITS)
            cell, bit = (place >> np.uint64(6)).astype(np.int64), (np.uint64(1) << (place & np.uint64(63))).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(bit)], names=["cell", "bit"])

    cells = frequent.select("lang", "phrase").mapInArrow(places, "cell long, bit long").groupBy("cell").agg(F.bit_or("bit").alias("bit"))
    found = cells.toArrow()
    bits = np.zeros(1 << (FILTER_BITS - 6), np.uint64)
    bits[found.column("cell").to_numpy()] = found.column("bit").to_numpy().view(np.uint64)
    return PhraseFilter(words, bits)


class Counting:
    """The trie of a task with its ids."""

    def __init__(self, lengths: Sequence[int], known: PhraseFilter | None, most: int, burst: int) -> None:
        self.lengths, self.known, self.most, self.burst = lengths, known, most, burst
        self._clear()

    def _clear(self) -> None:
        self.trie, self.langs, self.words = HatTrie(self.burst, max(self.lengths) > 2), Names(), Names()

    def runs(self, left: int = 0) -> Iterator[pa.RecordBatch]:
        langs, words = (pa.array(n.names, pa.binary()).cast(pa.string()) for n in (self.langs, self.words))
        mask = np.uint64((1 << WORD_BITS) - 1)
        for container in self.trie.spill(left):
            prefix, rest = unpacked(container)
            wide = np.uint64(WORD_BITS)
            ids = [prefix >> wide & mask, prefix & mask, rest >> wide & mask, rest & mask]
            parts = [words.take(pa.array(i.astype(np.int64), mask=i == 0)) for i in ids]
            phrase = pc.binary_join_element_wise(*parts, " ", null_handling="skip")
            lang = langs.take(pa.array((prefix >> np.uint64(2 * WORD_BITS)).astype(np.int64)))
            length = pa.array(sum((i > 0).astype(np.int32) for i in ids))
            n = pa.array(np.fromiter(container.values(), np.int64, len(container)))
            run = pa.RecordBatch.from_arrays([lang, phrase, length, n], names=["lang", "phrase", "words", "n"])
            yield run.take(pc.sort_indices(run, sort_keys=[("lang", "ascending"), ("phrase", "ascending")]))

    def block(self, row, langs, h, joined, take, name, lang_name) -> Iterator[pa.RecordBatch]:
        """Counts the phrases that begin at the first ``take`` words; ``joined`` tells whether a word continues a piece.

        ``row`` is the text of each word, from 0, and ``langs`` has the hash of each text's language.
        """
        if len(self.langs.names) + len(langs) >= 1 << LANG_BITS or len(self.words.names) + len(h) >= 1 << WORD_BITS:
            yield from self.runs()
            self._clear()
        w, g, lang = self.words.of(h, name), self.langs.of(langs, lang_name)[row], langs[row]
        size = len(h)
        follows = [np.zeros(size, bool) for _ in range(LONGEST)]  # the k-th next word is of the same piece, parts known so far
        if self.known is None:
            ok = np.ones(size, bool)
        elif self.known.words == 1:
            ok = self.known.holds(gram_keys(lang, h))
        else:
            ok = np.zeros(size, bool)
            if size > 1:
                ok[:-1] = joined[1:] & self.known.holds(gram_keys(lang[:-1], h[:-1], h[1:]))
        step = self.known.words if self.known is not None else 1
        follows[0] = ok if step == 1 else np.ones(size, bool)
        for k in range(1, LONGEST):
            if size > k:
                # a phrase of one word more: its first part is fine, and so is the part that ends with the new word
                follows[k][: size - k] = follows[k - 1][: size - k] & joined[k:] & ok[k - step + 1 : size - step + 1]
        head = g << np.uint64(2 * WORD_BITS) | w << np.uint64(WORD_BITS)
        later = [np.concatenate([w[k:], np.zeros(min(k, size), np.uint64)]) for k in range(LONGEST)]
        for n in self.lengths:
            at = np.flatnonzero(follows[n - 1][:take])
            second = later[1][at] if n > 1 else np.uint64(0)
            rest = (later[2][at] << np.uint64(WORD_BITS)) | (later[3][at] if n > 3 else np.uint64(0)) if n > 2 else np.zeros(len(at), np.uint64)
            self.trie.add(head[at] | second, rest)
        if self.trie.entries > self.most:
            yield from self.runs(self.most // 2)


def phrase_runs(docs: DataFrame, lengths: Sequence[int], known: PhraseFilter | None = None, most: int = MOST_ENTRIES, burst: int = BURST, block: int = BLOCK) -> DataFrame:
    """Stored sorted runs ``lang, phrase, words, n`` of phrases of the given lengths; of known parts only, where these are given."""
    # plain values, as executors need not have this package
    shared = docs.sparkSession.sparkContext.broadcast((known.words, known.bits) if known else None)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counting = Counting(lengths, PhraseFilter(*shared.value) if shared.value else None, most, burst)
        for batch, data, offsets in text_chunks(batches):
            data = LOWER[data]
            starts, ends, first = spans(~_GAP[data], offsets)
            if not len(starts):
                continue
            langs, at = text_bytes(batch.column("lang"))
            row = np.repeat(np.arange(batch.num_rows), np.diff(np.append(first[:-1], len(starts))))
            lang = span_hash(langs, at[:-1], at[1:])
            breaks = np.cumsum(_PIECE[data], dtype=np.int32)[starts]
            joined = np.zeros(len(starts), bool)
            joined[1:] = (breaks[1:] == breaks[:-1]) & (row[1:] == row[:-1])
            h = span_hash(data, starts, ends)
            for a in range(0, len(starts), block):
                b = min(a + block, len(starts))
                c = min(b + LONGEST - 1, len(starts))
                top = row[a]
                yield from counting.block(
                    row[a:c] - top,
                    lang[top : row[c - 1] + 1],
                    h[a:c],
                    joined[a:c],
                    b - a,
                    lambda k, a=a: data[starts[a + k] : ends[a + k]].tobytes(),
                    lambda k, top=top: langs[at[top + k] : at[top + k + 1]].tobytes(),
                )
        yield from counting.runs()

    rows = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), "text")
    return stored(rows.mapInArrow(count, RUN_SCHEMA), "phrase-runs")


def merged(runs: DataFrame, least: int) -> DataFrame:
    """Stored ``lang, phrase, words, n`` with n of ``least`` or more, merged per range of prefixes."""
    dealt = runs.repartitionByRange("lang", "phrase")
    counts = dealt.groupBy("lang", "phrase").agg(F.first("words").alias("words"), F.sum("n").alias("n"))
    return stored(counts.filter(F.col("n") >= least), "phrases")


def _scored(candidates: DataFrame, parts: DataFrame) -> DataFrame:
    """``lang, phrase, words, a, l, r, score`` of the lowest-scoring cut of each candidate."""
    w = F.split("phrase", " ", -1)
    cut = F.explode(F.expr("sequence(1, words - 1)"))
    salt = F.pmod(F.xxhash64("phrase"), F.lit(SALTS)).cast("int")
    cuts = candidates.select("lang", "phrase", "words", F.col("n").alias("a"), cut.alias("k"), salt.alias("salt"), w.alias("w"))
    for name, part, size in (("l", F.expr("slice(w, 1, k)"), F.col("k")), ("r", F.expr("slice(w, k + 1, words - k)"), F.col("words") - F.col("k"))):
        copies = F.when(F.col("words") == 1, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
        table = parts.select("lang", F.col("phrase").alias("_part"), F.col("n").alias(name), F.explode(copies).alias("_salt"))
        looked = cuts.withColumns({"_part": F.array_join(part, " "), "_salt": F.when(size == 1, F.col("salt")).otherwise(0)})
        cuts = looked.join(table, ["lang", "_part", "_salt"]).drop("_part", "_salt")
    score = F.expr(f"CAST(a AS DECIMAL(20, 0)) * {SCALE} div (CAST(l AS DECIMAL(20, 0)) + r)").cast("long")
    best = F.min_by(F.struct("l", "r", "score"), F.struct("score", "k")).alias("best")
    lowest = cuts.withColumn("score", score).groupBy("lang", "phrase", "words", "a").agg(best)
    return lowest.select("lang", "phrase", "words", "a", "best.*")


def _covered(candidates: DataFrame) -> DataFrame:
    """``lang, phrase, most``: the count of the most frequent longer candidate that holds the phrase."""
    inner = "flatten(transform(sequence(2, words - 1), n -> transform(sequence(1, words - n + 1), i -> array_join(slice(w, i, n), ' '))))"
    longer = candidates.filter("words > 2").withColumn("w", F.split("phrase", " ", -1))
    return longer.select("lang", F.explode(F.expr(inner)).alias("phrase"), "n").groupBy("lang", "phrase").agg(F.max("n").alias("most"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, **sizes: int) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score`` of the ``top`` phrases of each language of ``docs(lang, text)``."""
    word_runs = phrase_runs(docs, (1,), **sizes)
    words = merged(word_runs, least)
    pairs = merged(phrase_runs(docs, (2,), phrase_filter(words, 1), **sizes), least)
    longer = merged(phrase_runs(docs, (3, 4), phrase_filter(pairs, 2), **sizes), least)
    candidates = pairs.unionByName(longer)
    parts = words.unionByName(pairs).unionByName(longer.filter("words = 3"))
    totals = word_runs.groupBy("lang").agg(F.sum("n").alias("n"))
    kept = _scored(candidates, parts).join(_covered(candidates), ["lang", "phrase"], "left")
    # decimals, as the products may pass 64 bits
    covered = F.expr(f"CAST(most AS DECIMAL(20, 0)) * 100 >= CAST(a AS DECIMAL(20, 0)) * {COVERED}")
    kept = kept.filter(~F.coalesce(covered, F.lit(False)))
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    # ranked within buckets first, so that a language is not ranked whole in one task
    bucket = F.pmod(F.xxhash64("phrase"), F.lit(RANK_BUCKETS))
    first = kept.withColumn("_b", bucket).withColumn("_place", F.row_number().over(Window.partitionBy("lang", "_b").orderBy(*order)))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(*order))
    ranked = first.filter(F.col("_place") <= top).withColumn("rank", place.cast("long")).filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op11_collocations(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet").select("lang", "text"))


OP11_SQL = r"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(string_split_regex(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece
  FROM documents
), split AS (
  SELECT lang, list_filter(string_split_regex(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces
), phrases AS (
  SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS phrase
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM split, range(1, 5) t(k))
), f AS MATERIALIZED (
  SELECT lang, phrase, any_value(k) AS words, count(*) AS n FROM phrases GROUP BY lang, phrase
), totals AS (
  SELECT lang, CAST(sum(n) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang
), candidates AS MATERIALIZED (
  SELECT lang, phrase, words, n AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND n >= 30
), cuts AS (
  SELECT c.lang, c.phrase, c.a, k, l.n AS l, r.n AS r,
         CAST(c.a::HUGEINT * 2000000 // (l.n + r.n) AS BIGINT) AS score
  FROM (SELECT *, array_to_string(w[1:k], ' ') AS first_part, array_to_string(w[k + 1:], ' ') AS rest
        FROM (SELECT *, unnest(range(1, words)) AS k FROM candidates)) c
  JOIN f l ON l.lang = c.lang AND l.phrase = first_part
  JOIN f r ON r.lang = c.lang AND r.phrase = rest
), lowest AS (
  SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1
), inner_phrases AS (
  SELECT lang, array_to_string(w[i:i + m - 1], ' ') AS phrase, max(a) AS most
  FROM (SELECT *, unnest(range(1, words - m + 2)) AS i FROM (SELECT *, unnest(range(2, words)) AS m FROM candidates))
  GROUP BY ALL
), kept AS (
  SELECT x.* FROM lowest x LEFT JOIN inner_phrases i USING (lang, phrase)
  WHERE i.most IS NULL OR 100::HUGEINT * i.most < 80::HUGEINT * x.a
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept
)
SELECT x.lang, rank, phrase, a, l, r, t.n, score FROM ranked x JOIN totals t ON t.lang = x.lang WHERE rank <= 2000
"""
