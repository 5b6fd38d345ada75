"""Quality rules: text statistics of a document, and lines repeated across documents of a host.

Lines are normalised (ASCII lower case, digits as one sign, single spaces) and hashed. A line
found in more than ``LINE_SHARE`` of a host's distinct documents, and in more than
``LINE_FLOOR`` of them, is boilerplate there and is removed; a document of which too little is left is depleted and rejected.

A pass in numpy writes the texts with their statistics and line hashes to a stored table; later
steps read only the columns they need. Lines per host are counted without texts and summed before
the shuffle's end. Then ``cleaned`` joins the numbers of the lines hit to the stored rows by row
number (Spark broadcasts them if they are few) and cuts those lines out; statistics are not made again.

Nulls: a null text has no words, so it fails the base rules; a null host is a host of its own;
a null doc_id is an id like others. Repeated rows with one doc_id count as one document in
line counts and give one row each. Empty lines are never boilerplate.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import LOWER, mix64, runs_of, span_hash, spans, stored, text_chunks, without, words

#: Share of a host's distinct documents that may hold a line, and documents that always may: a
#: handful of copies on a small host is no boilerplate. The share makes the verdict independent of
#: the table's size; the floor decides on hosts of up to LINE_FLOOR / LINE_SHARE = 100 documents.
LINE_SHARE = 0.05
LINE_FLOOR = 5
#: Words and share of words a document must keep.
LEAST_WORDS_LEFT = 10
LEAST_SHARE_LEFT = 0.3
SYMBOLS = b"#*$%&|<>"
WINDOW = 5
STATISTICS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

ADDED = (*STATISTICS, "removed_words", "base_failed", "kept")

_SYMBOL = np.isin(np.arange(256), list(SYMBOLS))
_NORMAL = LOWER.copy()
_NORMAL[48:58] = 48


def _repeated(keys: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True where the key occurs twice or more in its group."""
    both = mix64(keys ^ mix64(group.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    same = both[order][1:] == both[order][:-1]
    out = np.zeros(len(keys), bool)
    out[order[1:][same]] = True
    out[order[:-1][same]] = True
    return out


def _later(keys: np.ndarray, group: np.ndarray) -> np.ndarray:
    """True where the key occurs earlier in its group."""
    both = mix64(keys ^ mix64(group.astype(np.uint64)))
    order = np.argsort(both, kind="stable")
    out = np.zeros(len(keys), bool)
    out[order[1:][both[order][1:] == both[order][:-1]]] = True
    return out


def statistics(data: np.ndarray, offsets: np.ndarray) -> dict[str, np.ndarray]:
    """Per text the base statistics; per line with a word its text, normalised hash and words."""
    n = len(offsets) - 1
    starts, ends, first = words(data, offsets)
    per_text = np.diff(first)
    of_word = np.repeat(np.arange(n), per_text)
    upto = np.append(0, np.cumsum((data & 0xC0) != 0x80))
    chars = upto[ends] - upto[starts]
    symbols = np.append(0, np.cumsum(_SYMBOL[data]))
    hashes = span_hash(data, starts, ends)

    covered = np.zeros(len(starts), np.int64)
    windows = np.flatnonzero(runs_of(per_text) + WINDOW <= np.repeat(per_text, per_text)) if len(starts) else starts
    if len(windows):
        keys = hashes[windows]
        for j in range(1, WINDOW):
            keys = mix64(keys + np.uint64(0x9E3779B97F4A7C15)) ^ hashes[windows + j]
        again = windows[_repeated(keys, of_word[windows])]
        steps = np.zeros(len(starts) + 1, np.int64)
        np.add.at(steps, again, 1)
        np.add.at(steps, again + WINDOW, -1)
        covered = (np.cumsum(steps[:-1]) > 0).astype(np.int64)

    line_starts, line_ends, first_line = spans(data != 10, offsets)
    of_line = np.repeat(np.arange(n), np.diff(first_line))
    left, right = np.searchsorted(starts, line_starts), np.searchsorted(starts, line_ends)
    real = right > left
    line_starts, line_ends, of_line, left, right = (v[real] for v in (line_starts, line_ends, of_line, left, right))
    duplicate = _later(span_hash(data, line_starts, line_ends), of_line)
    # a line's normalised words, hashed in order: h = mix(h) ^ word, for all lines in step
    normal = span_hash(_NORMAL[data], starts, ends)
    norm = np.zeros(len(left), np.uint64)
    rows, at = np.arange(len(left)), left
    while len(rows):
        norm[rows] = mix64(norm[rows] + np.uint64(0x9E3779B97F4A7C15)) ^ normal[at]
        more = at + 1 < right[rows]
        rows, at = rows[more], at[more] + 1

    def per(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
        total = np.append(0, np.cumsum(values))
        return total[bounds[1:]] - total[bounds[:-1]]

    lines = np.searchsorted(of_line, np.arange(n + 1))
    return {
        "n_words": per_text,
        "word_chars": per(chars, first),
        "n_symbols": symbols[offsets[1:]] - symbols[offsets[:-1]],
        "n_dup_lines": per(duplicate.astype(np.int64), lines),
        "n_repeat_words": per(covered, first),
        "lines": lines,
        "line_hash": norm.view(np.int64),
        "line_words": right - left,
    }


def _measure(keep: list[str]):
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, data, offsets in text_chunks(batches):
            s = statistics(data, offsets)
            at = pa.array(s["lines"].astype(np.int32))
            lists = [pa.ListArray.from_arrays(at, pa.array(s[k], pa.int64())) for k in ("line_hash", "line_words")]
            columns = [batch.column(c) for c in keep] + [pa.array(s[k], pa.int64()) for k in STATISTICS] + lists
            yield pa.RecordBatch.from_arrays(columns, names=[*keep, *STATISTICS, "_line_hash", "_line_words"])

    return measure


def measured(docs: DataFrame, host: str = "source") -> DataFrame:
    """Stored columns of ``docs`` with STATISTICS, ``_host, _line_hash, _line_words, _row``."""
    rows = without(docs.withColumn("_host", F.col(host).cast("string")), ADDED)
    statistic = ", ".join(f"{c} long" for c in STATISTICS)
    schema = ", ".join(f"`{c}` {rows.schema[c].dataType.simpleString()}" for c in rows.columns)
    done = rows.mapInArrow(_measure(rows.columns), f"{schema}, {statistic}, _line_hash array<long>, _line_words array<long>")
    return stored(done.withColumn("_row", F.monotonically_increasing_id()), "quality-lines")


def frequent_lines(
    rows: DataFrame, line_limit: int | None = None, line_share: float = LINE_SHARE, line_floor: int = LINE_FLOOR
) -> DataFrame:
    """``host, line`` of lines in more distinct documents of the host than its limit.

    The limit is ``line_share`` of the host's distinct documents, ``line_floor`` at least, or the
    fixed ``line_limit`` if one is given. Most lines fall to the floor before host counts are joined.
    """
    lines = rows.select("doc_id", F.col("_host").alias("host"), F.explode(F.array_distinct("_line_hash")).alias("line"))
    once = lines.groupBy("host", "line", "doc_id").agg(F.lit(1).alias("one"))
    counted = once.groupBy("host", "line").agg(F.count("one").alias("documents"))
    if line_limit is not None:
        return counted.filter(F.col("documents") > line_limit).select("host", "line")
    each = rows.groupBy("_host", "doc_id").agg(F.lit(1).alias("one"))
    sizes = each.groupBy("_host").agg(F.count("one").alias("_size"))
    near = counted.filter(F.col("documents") > line_floor)
    sized = near.join(sizes.filter(F.col("_size") > line_floor), near["host"].eqNullSafe(F.col("_host")))
    return sized.filter(F.col("documents") > line_share * F.col("_size")).select("host", "line")


def _verdict(found: DataFrame, least_words: int, least_share: float) -> DataFrame:
    """Adds ``base_failed`` and ``kept`` to statistics and ``removed_words``."""
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    left = F.col("n_words") - F.col("removed_words")
    depleted = (F.col("removed_words") > 0) & ((left < least_words) | (left < least_share * F.col("n_words")))
    return found.withColumn("base_failed", failed).withColumn("kept", ~failed & ~depleted)


def without_lines(text: bytes, numbers: set[int]) -> bytes:
    """The text without the lines of these numbers, counted from 0 over lines with a word."""
    out, n = [], 0
    for line in text.split(b"\n"):
        real = bool(line.strip(b" \t\x0b\x0c\r"))
        if not (real and n in numbers):
            out.append(line)
        n += real
    return b"\n".join(out)


def _cutter(keep: list[str]):
    """Cuts the lines numbered in the column ``_hits``."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits, line_words = batch.column("_hits").fill_null([]), batch.column("_line_words")
            at, to = (np.append(0, np.cumsum(v.value_lengths().to_numpy(zero_copy_only=False))) for v in (line_words, hits))
            numbers, size = hits.flatten().to_numpy(), line_words.flatten().to_numpy()
            hit = np.zeros(len(size), bool)
            hit[np.repeat(at[:-1], np.diff(to)) + numbers] = True
            removed = np.diff(np.append(0, np.cumsum(size * hit))[at])
            text = batch.column("text")
            # in runs, so that rows without a hit are not touched
            parts, done = [], 0
            for i in np.flatnonzero(np.diff(to)).tolist():
                rest = without_lines(text[i].as_py().encode(), set(numbers[to[i] : to[i + 1]].tolist()))
                parts += [text.slice(done, i - done), pa.array([rest], pa.binary()).cast(text.type)]
                done = i + 1
            texts = pa.concat_arrays([*parts, text.slice(done)])
            columns = [texts if c == "text" else batch.column(c) for c in keep]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(removed.astype(np.int64))], names=[*keep, "removed_words"])

    return cut


def cleaned(
    docs: DataFrame,
    host: str = "source",
    line_limit: int | None = None,
    least_words: int = LEAST_WORDS_LEFT,
    least_share: float = LEAST_SHARE_LEFT,
) -> DataFrame:
    """``docs`` with the frequent lines cut out of ``text``, and ``ADDED``; statistics are of the text as given."""
    rows = measured(docs, host)
    frequent = stored(frequent_lines(rows, line_limit), "frequent-lines")
    lines = rows.select("_row", "_host", F.posexplode("_line_hash").alias("number", "line"))
    same = lines["_host"].eqNullSafe(frequent["host"]) & (lines["line"] == frequent["line"])
    hit = lines.join(frequent, same, "left_semi").groupBy("_row").agg(F.collect_list("number").alias("_hits"))
    given = rows.join(stored(hit, "line-hits"), "_row", "left")
    keep = [*without(docs, ADDED).columns, *STATISTICS]
    given = given.select(*[f"`{c}`" for c in keep], "_line_words", "_hits")
    schema = ", ".join(f"`{c}` {given.schema[c].dataType.simpleString()}" for c in keep)
    return _verdict(given.mapInArrow(_cutter(keep), f"{schema}, removed_words long"), least_words, least_share)


def op7_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "source", "text")
    return cleaned(docs).select("doc_id", *STATISTICS, "base_failed", "kept", "removed_words", "text")
