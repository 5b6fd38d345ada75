"""Near-duplicate documents by fast similarity sketches, banding and exact verification.

Sketch: in round i every shingle is hashed to one of ``size`` bins with a value in [i, i + 1);
a bin keeps its least value, so only the first round that reaches a bin counts. After ``size``
rounds a shingle goes to one fixed bin per round, so every bin is filled after twice as many
rounds at most; usually a few rounds do. Coordinates of two sketches agree with the probability
of the sets' Jaccard similarity, with the concentration of independent minima.

Equal sets are one class, known by a 128-bit digest, from the start, and numbered. Classes that agree in a
band share a bucket. Not all pairs of a bucket are made: first each class is compared with the
least class it shares a bucket with, then with the least of each of its buckets, and last, in
buckets that still hold several components, the classes outside the largest component with all
others of other components, inside the join, so that only links
leave it; parity sketches, an exact bound, rule most of them out first. Whatever is left out is connected already, so every pair that
shares a bucket is compared or connected, with no cap. Comparisons are exact on full sets of
64-bit shingle hashes.

Recall: bands miss a pair of similarity 0.85 with probability (1 - 0.85 ** rows) ** bands, 4e-8
with the defaults. Nulls: null and wordless texts have an empty set and are linked with nothing;
a null doc_id forms no component (its component_id is null, kept is true). Repeated rows are equal sets. Rows
of one doc_id with different texts are documents of their own, linked by their texts alone.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.common import LOWER, mix64, runs_of, span_hash, stored, text_chunks, words
from alertloom.llm.components import components

SHINGLE = 3
SIMILAR_PERCENT = 85
BANDS, ROWS = 36, 6
#: Bits of the parity sketch, and the words that hold them.
PARITY_BITS = 1024
PARITY_WORDS = PARITY_BITS // 64
_STEP = np.uint64(0x9E3779B97F4A7C15)
SETS_SCHEMA = "id long, shingles array<long>, odd array<long>"


def shingles(data: np.ndarray, offsets: np.ndarray, width: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct 64-bit shingle hashes of each text, and the offsets of the texts in them."""
    low = LOWER[data]
    starts, ends, first = words(low, offsets)
    counts = np.diff(first)
    hashes = span_hash(low, starts, ends)
    grams = np.where(counts > 0, np.maximum(counts - width + 1, 1), 0)
    text = np.repeat(np.arange(len(counts)), grams)
    at = first[text] + runs_of(grams)
    last = np.minimum(at + width, first[text + 1])
    keys = np.zeros(len(at), np.uint64)
    for j in range(width):
        live = at + j < last
        keys[live] = mix64(keys[live] + _STEP) ^ hashes[at[live] + j]
    keys = mix64(keys)
    order = np.lexsort((keys, text))
    keys, text = keys[order], text[order]
    fresh = np.ones(len(keys), bool)
    fresh[1:] = (keys[1:] != keys[:-1]) | (text[1:] != text[:-1])
    keys, text = keys[fresh], text[fresh]
    return keys, np.searchsorted(text, np.arange(len(counts) + 1))


def sketches(keys: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """Sketch of every non-empty set; rows of empty sets stay at the largest value."""
    n = len(bounds) - 1
    bins = np.full(n * size, np.iinfo(np.uint64).max, np.uint64)
    lengths = np.diff(bounds)
    open_sets = np.flatnonzero(lengths > 0)
    for i in range(2 * size):
        if not len(open_sets):
            break
        count = lengths[open_sets]
        at = np.repeat(bounds[open_sets], count) + runs_of(count)
        row = np.repeat(open_sets, count)
        h = mix64(keys[at] + np.uint64((i + 1) * int(_STEP) % (1 << 64)))
        # 53 bits for the value within the round, the round above them
        value = (np.uint64(i) << np.uint64(53)) | (h >> np.uint64(11))
        place = (mix64(h ^ _STEP) % np.uint64(size)).astype(np.int64) if i < size else i - size
        np.minimum.at(bins, row * size + place, value)
        full = (bins.reshape(n, size)[open_sets] != np.iinfo(np.uint64).max).all(axis=1)
        open_sets = open_sets[~full]
    return bins.reshape(n, size)


def _signed(batches: Iterator[pa.RecordBatch], bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_chunks(batches):
        keys, bounds = shingles(data, offsets)
        sizes = np.diff(bounds)
        per_band = sketches(keys, bounds, bands * rows).reshape(len(sizes), bands, rows)
        band = np.repeat(np.arange(1, bands + 1, dtype=np.uint64)[None, :], len(sizes), axis=0)
        for j in range(rows):
            band = mix64(band + _STEP) ^ per_band[:, :, j]
        band = mix64(band)
        # sums of two mixes over a set of distinct keys tell sets apart
        total = [np.append(np.uint64(0), np.cumsum(mix64(keys ^ np.uint64(s)))) for s in (0x51ED27, 0xA0761D)]
        digest = [t[bounds[1:]] - t[bounds[:-1]] for t in total]
        filled = np.flatnonzero(sizes)
        yield pa.RecordBatch.from_arrays(
            [
                *[batch.column(c).take(pa.array(filled)) for c in ("doc_id", "text_hash")],
                pa.array(sizes[filled], pa.int64()),
                *[pa.array(d[filled].view(np.int64)) for d in digest],
                pa.FixedSizeListArray.from_arrays(pa.array(band[filled].ravel().view(np.int64)), bands).cast(
                    pa.list_(pa.int64())
                ),
            ],
            names=["doc_id", "text_hash", "n_shingles", "low", "high", "bands"],
        )


def parities(keys: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Odd sketch of each set: the parity of its number of shingles in each part of their universe.

    Two sets differ in at least as many shingles as their sketches differ in bits.
    """
    n = len(bounds) - 1
    place = np.repeat(np.arange(n), np.diff(bounds)) * PARITY_BITS + (keys % np.uint64(PARITY_BITS)).astype(np.int64)
    odd = (np.bincount(place, minlength=n * PARITY_BITS) & 1).astype(np.uint8)
    return np.packbits(odd, bitorder="little").view("<i8").reshape(n, PARITY_WORDS)


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, data, offsets in text_chunks(batches):
        keys, bounds = shingles(data, offsets)
        lists = pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(keys.view(np.int64)))
        words_of = pa.array((np.arange(len(bounds)) * PARITY_WORDS).astype(np.int32))
        odd = pa.ListArray.from_arrays(words_of, pa.array(parities(keys, bounds).ravel()))
        yield pa.RecordBatch.from_arrays([batch.column("id"), lists, odd], names=["id", "shingles", "odd"])


def _verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` whose full sets are similar."""
    left = sets.select(F.col("id").alias("a"), F.col("shingles").alias("_a"))
    right = sets.select(F.col("id").alias("b"), F.col("shingles").alias("_b"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("_a", "_b"))
    union = F.size("_a") + F.size("_b") - shared
    return both.filter(100 * shared >= percent * union).select("a", "b")


def _labelled(members: DataFrame, links: DataFrame) -> DataFrame:
    """Bucket members with the component that ``links`` give them so far."""
    found = components(links).select(F.col("a").alias("id"), F.col("b").alias("_root"))
    return members.join(found, "id", "left").withColumn("root", F.coalesce("_root", "id")).drop("_root")


def linked_classes(classes: DataFrame, docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """Verified links between classes ``id, doc_id, text_hash, n_shingles, bands``, enough to connect all similar ones.

    A class is known by its id; the text of its set is the row with its doc_id and text_hash.
    """
    buckets = classes.select("id", "n_shingles", F.posexplode("bands").alias("band", "key"))
    sizes = buckets.groupBy("band", "key").agg(F.count("*").alias("n"), F.min("id").alias("least"))
    members = buckets.join(sizes.filter("n > 1").drop("n"), ["band", "key"])
    members = stored(members.select("band", "key", "id", "n_shingles", "least"), "buckets")
    wanted = classes.join(members.select("id").distinct(), "id", "left_semi").select("id", "doc_id", "text_hash")
    texts = docs.join(wanted, ["doc_id", "text_hash"]).dropDuplicates(["doc_id", "text_hash"]).select("id", "text")
    sets = stored(texts.mapInArrow(_sets, SETS_SCHEMA), "shingle-sets")

    def fits(a: str, b: str):
        return 100 * F.least(a, b) >= percent * F.greatest(a, b)

    pivots = members.filter("id <> least").select("id", "least", "n_shingles").distinct()
    pivots = pivots.join(classes.select(F.col("id").alias("least"), F.col("n_shingles").alias("_n")), "least")
    pivots = stored(pivots.filter(fits("n_shingles", "_n")).select(F.col("least").alias("a"), F.col("id").alias("b")), "pivots")
    first = pivots.groupBy("b").agg(F.min("a").alias("a")).select("a", "b")
    links = stored(_verified(first, sets, percent), "links")

    root = components(links).select(F.col("a").alias("_n"), F.col("b").alias("_root"))
    rest = pivots.join(first, ["a", "b"], "left_anti")
    for side in ("a", "b"):
        rest = rest.join(root.withColumnRenamed("_n", side).withColumnRenamed("_root", f"_{side}"), side, "left")
    rest = rest.filter(F.coalesce("_a", "a") != F.coalesce("_b", "b")).select("a", "b")
    links = stored(links.unionByName(_verified(rest, sets, percent)), "links")

    named = stored(_labelled(members, links), "named")
    roots = named.groupBy("band", "key", "root").agg(F.count("*").alias("n"))
    several = roots.groupBy("band", "key").agg(
        F.count("*").alias("k"), F.max(F.struct("n", "root")).getField("root").alias("main")
    )
    split = named.join(several.filter("k > 1").drop("k"), ["band", "key"])
    split = split.join(sets, "id").join(classes.select("id", "bands"), "id")
    columns = ("id", "n_shingles", "root", "shingles", "odd", "bands")
    outside = split.filter("root <> main").select("band", "key", *[F.col(c).alias(f"_{c}") for c in columns])
    # two outsiders meet once; everyone else meets each outsider
    once = (F.col("root") == F.col("main")) | (F.col("id") < F.col("_id"))
    # of all buckets that two share, the one of the first band compares them
    agree = F.zip_with("bands", "_bands", lambda a, b: a == b)
    first_band = F.array_position(agree, F.lit(True)) == F.col("band") + 1
    shared = F.size(F.array_intersect("shingles", "_shingles"))
    # named once: an expression used twice would be computed before the cheap checks
    similar = (100 + percent) * shared >= percent * (F.col("n_shingles") + F.col("_n_shingles"))
    # similar sets of sizes a and b differ in (a + b) * (100 - percent) / (100 + percent) shingles at most
    apart = sum((F.bit_count(F.get("odd", F.lit(i)).bitwiseXOR(F.get("_odd", F.lit(i)))) for i in range(PARITY_WORDS)), F.lit(0))
    near = (100 + percent) * apart <= (100 - percent) * (F.col("n_shingles") + F.col("_n_shingles"))
    # the sets are compared within the join, so only links leave it
    checks = (F.col("root") != F.col("_root")) & once & fits("n_shingles", "_n_shingles") & near
    last = split.join(outside, ["band", "key"]).filter(F.when(checks & first_band, similar).otherwise(False))
    last = last.select(F.least("id", "_id").alias("a"), F.greatest("id", "_id").alias("b"))
    return stored(links.unionByName(last), "links")


def _hashed(docs: DataFrame) -> DataFrame:
    return docs.withColumn("text_hash", F.xxhash64(F.coalesce("text", F.lit(""))))


def _has_words():
    return F.coalesce(F.col("text").rlike(r"[^\x20\x09-\x0D]"), F.lit(False))


def assigned(docs: DataFrame, percent: int = SIMILAR_PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, text_hash, n_shingles, root, component_id`` of the rows with words; ``root`` names the component."""
    docs = _hashed(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _signed(batches, bands, rows)

    schema = "doc_id long, text_hash long, n_shingles long, low long, high long, bands array<long>"
    signed = stored(docs.mapInArrow(sign, schema), "signatures")
    same = ["low", "high", "n_shingles"]
    classes = signed.filter("doc_id IS NOT NULL").groupBy(*same).agg(
        F.min(F.struct("doc_id", "text_hash")).alias("first"), F.first("bands").alias("bands")
    )
    # numbered when written: one doc_id may have several texts, so it cannot name a class
    classes = classes.select(F.monotonically_increasing_id().alias("id"), *same, "first.*", "bands")
    classes = stored(classes, "classes")
    links = linked_classes(classes.drop("low", "high"), docs, percent)
    found = components(links).select(F.col("a").alias("id"), F.col("b").alias("root"))
    named = classes.drop("bands", "text_hash").join(found, "id", "left").withColumn("root", F.coalesce("root", "id"))
    least = named.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = named.join(least, "root").select(*same, "root", "component_id")
    filled = signed.drop("bands").join(named, same, "left").drop("low", "high")
    return filled.withColumns({c: F.when(F.col("doc_id").isNotNull(), F.col(c)) for c in ("root", "component_id")})


def near_duplicates(docs: DataFrame, percent: int = SIMILAR_PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` of every row of ``docs``."""
    filled = assigned(docs, percent, bands, rows).select("doc_id", "n_shingles", "component_id")
    # rows without words never left the first pass
    empty = docs.filter(~_has_words()).select(F.col("doc_id").cast("long").alias("doc_id"))
    empty = empty.select("doc_id", F.lit(0).cast("long").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return filled.unionByName(empty).select(
        "doc_id", "n_shingles", "component_id", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)).alias("kept")
    )


def one_of_each(docs: DataFrame, percent: int = SIMILAR_PERCENT) -> DataFrame:
    """``docs`` without near copies: of each component one row, that of its least doc_id (and least text hash).

    Rows without words or doc_id are linked with nothing and stay.
    """
    found = assigned(docs, percent).filter("root IS NOT NULL")
    first = found.groupBy("root").agg(F.min(F.struct("doc_id", "text_hash")).alias("first")).select("first.*")
    linked = F.col("doc_id").isNotNull() & _has_words()
    keyed = docs.filter(linked).withColumns({"_id": F.col("doc_id").cast("long"), "_hash": F.xxhash64("text")})
    rows = keyed.join(first, (F.col("_id") == first["doc_id"]) & (F.col("_hash") == first["text_hash"]), "left_semi")
    repeats = Window.partitionBy("_id", "_hash").orderBy("_hash")
    rows = rows.withColumn("_nth", F.row_number().over(repeats)).filter("_nth = 1").drop("_id", "_hash", "_nth")
    return rows.unionByName(docs.filter(~linked))


def op3_near_dedup(spark, sf_dir: str) -> DataFrame:
    return near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
