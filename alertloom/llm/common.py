"""Helpers shared by the operators: columns, stored tables, worker state, text as bytes."""

from __future__ import annotations

import sys
import types
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from alertloom.session import scratch_path

#: A word of the contracts: a run without ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"

WHITE = np.zeros(256, bool)
WHITE[[9, 10, 11, 12, 13, 32]] = True

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Bytes of text worked on at once; bounds the temporary arrays of a task.
CHUNK = 1 << 21


def without(df: DataFrame, names: Iterable[str]) -> DataFrame:
    """Drops the columns an operator is about to add, whatever their case."""
    taken = {n.lower() for n in names}
    return df.select([df[f"`{c}`"] for c in df.columns if c.lower() not in taken])


def stored(df: DataFrame, name: str) -> DataFrame:
    """Writes ``df`` below the shared folder and reads it back: computed once, safe from lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(StructType.fromJson(df.schema.jsonValue())).parquet(path)


def label_sample(rows: DataFrame, label: str, per_label: int) -> DataFrame:
    """``doc_id`` and label of at most ``per_label`` rows of each label, those of least id hash.

    Each label is first thinned to about four times as many rows as wanted, by
    hash against its count, so ranking meets few rows whatever the table's size.
    Counts have one row per label, so they are broadcast.
    """
    counts = rows.groupBy(label).agg(F.count("*").alias("_n")).withColumnRenamed(label, "_label")
    key = F.pmod(F.xxhash64(F.col("doc_id").cast("string")), F.lit(1 << 32)) / float(1 << 32)
    keyed = rows.select("doc_id", label, key.alias("_key"))
    near = keyed.join(F.broadcast(counts), F.col(label) == F.col("_label"))
    near = near.filter(F.col("_key") * F.col("_n") < 4 * per_label)
    place = F.row_number().over(Window.partitionBy(label).orderBy("_key", "doc_id"))
    return near.withColumn("_place", place).filter(F.col("_place") <= per_label).select("doc_id", label).distinct()


def worker_state(key: Any, make: Callable[[], Any]) -> Any:
    """An object kept by a Python worker from task to task."""
    kept = sys.modules.setdefault("_alertloom_worker_state", types.ModuleType("_alertloom_worker_state")).__dict__
    if key not in kept:
        kept[key] = make()
    return kept[key]


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and the offsets of its values; null is empty."""
    if not (pa.types.is_string(column.type) or pa.types.is_binary(column.type)):
        column = column.cast(pa.string())
    if column.null_count:
        column = column.fill_null("" if pa.types.is_string(column.type) else b"")
    n = len(column)
    _, offsets, data = column.buffers()
    if n == 0 or data is None:
        return np.zeros(0, np.uint8), np.zeros(n + 1, np.int64)
    at = np.frombuffer(offsets, np.int32, n + 1, column.offset * 4).astype(np.int64)
    return np.frombuffer(data, np.uint8)[at[0] : at[-1]], at - at[0]


def chunks(offsets: np.ndarray, size: int = CHUNK) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``size`` bytes each; one longer text is a range of its own."""
    n, first = len(offsets) - 1, 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last
        first = last


def text_chunks(
    batches: Iterable[pa.RecordBatch], column: str = "text"
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of batches with the bytes and offsets of their texts."""
    for batch in batches:
        data, offsets = text_bytes(batch.column(column))
        for first, last in chunks(offsets):
            at = offsets[first : last + 1]
            yield batch.slice(first, last - first), data[at[0] : at[-1]], at - at[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the runs of True, cut at text ends, and the first run of each text."""
    n = len(inside)
    if n == 0:
        none = np.zeros(0, np.int64)
        return none, none, np.zeros(len(offsets), np.int64)
    fresh = np.empty(n + 1, bool)
    fresh[0] = fresh[n] = True
    np.logical_not(inside[:-1], out=fresh[1:n])
    fresh[offsets] = True
    over = np.empty(n + 1, bool)
    over[n] = True
    np.logical_not(inside, out=over[:n])
    over[offsets] = True
    starts = np.flatnonzero(inside & fresh[:n])
    ends = np.flatnonzero(inside & over[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return spans(~WHITE[data], offsets)


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)


def span_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of every span, eight bytes at a time for all spans together."""
    padded = np.zeros(len(data) + 8, np.uint8)
    padded[: len(data)] = data
    eight = np.ndarray((len(data) + 1,), "<u8", padded, strides=(1,))
    left = ends - starts
    out = mix64(left.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    rows, at = None, starts
    while len(at):
        part = eight[at] & _HEAD[np.minimum(left, 8)]
        if rows is None:
            out = mix64(out ^ part)
        else:
            out[rows] = mix64(out[rows] ^ part)
        more = np.flatnonzero(left > 8)
        rows = more if rows is None else rows[more]
        at, left = at[more] + 8, left[more] - 8
    return out


def runs_of(counts: np.ndarray) -> np.ndarray:
    """0, 1, .. within each run of the given lengths."""
    ends = np.cumsum(counts)
    total = int(ends[-1]) if len(ends) else 0
    return np.arange(total) - np.repeat(ends - counts, counts)
