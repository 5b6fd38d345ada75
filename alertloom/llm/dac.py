"""Token ids in files of directly addressable codes.

An id is split into chunks of bits. Level 0 holds the lowest chunk of every id, level 1 the next
chunk of those ids that have more, and so on; a bitmap per level tells which ids go on, and a
directory of ranks per block of the bitmap gives the place in the next level. Any token is read
from as many chunks as it has, without decoding a block.

File, little endian: magic ``DACF``, uint32 levels, uint64 documents, uint64 tokens, uint8 width
of each level (padded to 8), uint8 has_id per document (padded to 8), int64 document ids, uint64 end
of each document in tokens, then per level: uint64 entries, chunks (a byte or two each), and,
but for the last level, bitmap bytes and uint64 ranks before each block of 512 bits; all
sections padded to 8 bytes.

Documents are range partitioned and sorted by doc_id, null first, so files in order of their
names hold ascending ids. Nulls: a null text has the end id alone. Repeated rows are written
each, next to each other. An empty table gives no files and no rows.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.bpe import encoded_texts, vocabulary_path
from alertloom.llm.common import stored
from alertloom.llm.files import read_file, write_file
from alertloom.session import scratch_path

MAGIC = b"DACF"
WIDTHS = (8, 8, 16)
BLOCK = 512
TOKENS_PER_FILE = 1 << 22
END_ID = 2


def _padded(data: bytes) -> bytes:
    return data + bytes(-len(data) % 8)


def pack(doc_ids: Sequence[int | None], ends: np.ndarray, ids: np.ndarray, widths: Sequence[int] = WIDTHS) -> bytes:
    """A file's bytes. ``ends``: token count up to the end of each document."""
    highest, used, total = int(ids.max(initial=0)), [], 0
    for w in widths:
        used.append(w)
        total += w
        if highest < 1 << total:
            break
    else:
        raise ValueError(f"id {highest} needs more than {total} bits")
    known = np.array([d is not None for d in doc_ids], np.uint8)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    out = [struct.pack("<4sIQQ", MAGIC, len(used), len(numbers), len(ids)), _padded(bytes(used)), _padded(known.tobytes())]
    out += [numbers.tobytes(), np.asarray(ends, "<u8").tobytes()]
    rest = ids.astype(np.uint32)
    for level, w in enumerate(used):
        chunk = (rest & np.uint32((1 << w) - 1)).astype("<u1" if w <= 8 else "<u2")
        out += [struct.pack("<Q", len(rest)), _padded(chunk.tobytes())]
        if level + 1 < len(used):
            rest = rest >> np.uint32(w)
            more = rest > 0
            per_block = np.add.reduceat(more, np.arange(0, len(more), BLOCK), dtype=np.uint64) if len(more) else np.zeros(0, np.uint64)
            ranks = np.append(np.uint64(0), np.cumsum(per_block)).astype("<u8")
            out += [_padded(np.packbits(more, bitorder="little").tobytes()), ranks.tobytes()]
            rest = rest[more]
    return b"".join(out)


class DacFile:
    """Reads a file's bytes; sections are views, nothing is decoded ahead."""

    def __init__(self, raw: bytes) -> None:
        magic, levels, docs, self.tokens = struct.unpack_from("<4sIQQ", raw)
        if magic != MAGIC:
            raise ValueError("not a file of directly addressable codes")
        at = 24

        def take(kind: str, n: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, n, at)
            at += -(-found.nbytes // 8) * 8
            return found

        self.widths = take("u1", levels).tolist()
        known, numbers = take("u1", docs), take("<i8", docs)
        self.doc_ids = [int(n) if k else None for k, n in zip(known, numbers, strict=True)]
        self.ends = take("<u8", docs).astype(np.int64)
        self.levels: list[tuple[np.ndarray, np.ndarray | None, np.ndarray | None]] = []
        for level, w in enumerate(self.widths):
            n = int(take("<u8", 1)[0])
            chunk = take("u1" if w <= 8 else "<u2", n)
            last = level + 1 == levels
            bitmap = None if last else take("u1", -(-n // 8))
            self.levels.append((chunk, bitmap, None if last else take("<u8", -(-n // BLOCK) + 1)))

    def token(self, i: int) -> int:
        """One id by its place: a chunk, a bit and a rank per level."""
        if not 0 <= i < self.tokens:
            raise IndexError(i)
        value = shift = 0
        for w, (chunk, bitmap, ranks) in zip(self.widths, self.levels, strict=True):
            value |= int(chunk[i]) << shift
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            block = i // BLOCK
            ones = np.unpackbits(bitmap[block * BLOCK // 8 : (i >> 3) + 1], bitorder="little")[: i - block * BLOCK]
            i = int(ranks[block]) + int(ones.sum())
            shift += w
        return value

    def all(self) -> np.ndarray:
        """All ids, level by level."""
        where: np.ndarray | None = None
        out, shift = np.zeros(self.tokens, np.uint32), 0
        for w, (chunk, bitmap, _) in zip(self.widths, self.levels, strict=True):
            part = chunk.astype(np.uint32) << np.uint32(shift)
            if where is None:
                out |= part
            else:
                out[where] |= part
            if bitmap is not None:
                more = np.flatnonzero(np.unpackbits(bitmap, count=len(chunk), bitorder="little"))
                where = more if where is None else where[more]
            shift += w
        return out


def _writer(folder: str, path: str, end_id: int, per_file: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, count = TaskContext.get().partitionId(), 0, 0
        doc_ids: list[int | None] = []
        parts: list[np.ndarray] = []
        ends: list[np.ndarray] = []

        def flush() -> pa.RecordBatch:
            nonlocal part, count
            name = f"{folder}/ids-{shard:08d}-{part:06d}.dac"
            write_file(name, pack(doc_ids, np.concatenate(ends), np.concatenate(parts)))
            row = pa.RecordBatch.from_pylist([{"shard": shard, "part": part, "path": name, "tokens": count}])
            part, count = part + 1, 0
            for kept in (doc_ids, parts, ends):
                kept.clear()
            return row

        for batch, ids, bounds in encoded_texts(batches, path, end_id):
            doc_ids += batch.column("doc_id").to_pylist()
            parts.append(ids)
            ends.append(bounds[1:] + count)
            count += len(ids)
            if count >= per_file:
                yield flush()
        if doc_ids:
            yield flush()

    return write


def write_ids(
    docs: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID, per_file: int = TOKENS_PER_FILE
) -> DataFrame:
    """Encodes ``doc_id, text`` into files below ``folder``; stored ``shard, part, path, tokens`` of the files."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    ordered = rows.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    write = _writer(folder, path or vocabulary_path(), end_id, per_file)
    return stored(ordered.mapInArrow(write, "shard long, part long, path string, tokens long"), "dac-files")


def read_ids(files: DataFrame) -> DataFrame:
    """Per document of the files: ``doc_id, start, n_tokens, ids_crc32``; ``start`` counts ids of all documents before.

    One row per file meets in one task to number the tokens.
    """
    before = Window.orderBy("shard", "part").rowsBetween(Window.unboundedPreceding, -1)
    placed = files.withColumn("base", F.coalesce(F.sum("tokens").over(before), F.lit(0)))

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, base in zip(frame["path"], frame["base"], strict=True):
                found = DacFile(read_file(name))
                raw = found.all().astype("<u4").tobytes()
                begins = np.append(0, found.ends[:-1])
                spans = zip(begins.tolist(), found.ends.tolist(), strict=True)
                crc = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in spans]
                yield pd.DataFrame(
                    {
                        "doc_id": pd.array(found.doc_ids, dtype="Int64"),
                        "start": begins + base,
                        "n_tokens": found.ends - begins,
                        "ids_crc32": np.array(crc, np.int64),
                    }
                )

    tasks = int(files.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = placed.select("path", "base").repartition(tasks)
    return spread.mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op4_token_codes(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_ids(write_ids(docs, scratch_path(spark, "dac")))
