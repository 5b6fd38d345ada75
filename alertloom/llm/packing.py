"""Packing documents into sequences as a cutting-stock problem, by column generation.

Documents are cut at multiples of the sequence length; their last pieces are the items. Lengths
are counted in classes, exact ones up to 64 tokens and multiples of eight above, so a histogram with a
bounded number of classes describes any number of items. Room is dealt in units of eight tokens, of
which two, four and eight short pieces taken together leave less unused than single ones. The linear program over filling patterns is solved on that histogram: a knapsack by
dynamic programming prices new patterns by the duals until none saves a sequence. Pattern counts
are rounded down, and the few items left over are placed first-fit by decreasing length. Items
are ranked within their class and a rank's slot in a pattern gives the sequence.

Ranks need no global sort: a task numbers the items of its partition by class, and running
totals of (partition, class) counts are added. The histogram is all that reaches the driver.

Nulls: a null text is empty, so its document is the end id alone; a null doc_id is an id like
others. Repeated rows are packed each. An empty table gives no rows.
"""

from __future__ import annotations

import warnings
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.bpe import encoded_texts, vocabulary_path
from alertloom.llm.common import stored

LENGTH = 2048
UNIT = 8
#: Pieces up to this length are counted by their exact length, longer ones by length rounded up to ``UNIT``.
EXACT = 64
END_ID = 1
MOST_COLUMNS = 20_000
#: The program stops when its value is proven to be within this share of the best.
GAP = 5e-4


def classes(length: int = LENGTH) -> np.ndarray:
    """The class of every piece length 0 .. ``length``, in tokens."""
    sizes = np.arange(length + 1)
    return np.where(sizes <= EXACT, sizes, np.minimum(-(-sizes // UNIT) * UNIT, length))


def parcels(sizes: np.ndarray, capacity: int, unit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """What a knapsack in units takes: class, pieces in it, units. Single pieces round up; ``unit`` of them do not."""
    kinds, pieces, room = [], [], []
    for k, size in enumerate(sizes.tolist()):
        n = 1
        while n == 1 or (n <= unit and (n * size) // 2 % unit and n * size <= capacity):
            kinds.append(k)
            pieces.append(n)
            room.append(-(-n * size // unit))
            n *= 2
    order = np.argsort(room, kind="stable")
    return tuple(np.array(v, np.int64)[order] for v in (kinds, pieces, room))


def priced_pattern(values: np.ndarray, items: tuple[np.ndarray, np.ndarray, np.ndarray], rooms: int) -> tuple[float, np.ndarray]:
    """The most valuable filling of a sequence: knapsack with any number of each parcel."""
    kinds, pieces, sizes = items
    worth = values[kinds] * pieces
    best, choice = np.zeros(rooms + 1), np.full(rooms + 1, -1)
    fits = np.searchsorted(sizes, np.arange(rooms + 1), "right").tolist()
    for room in range(1, rooms + 1):
        best[room], n = best[room - 1], fits[room]
        if n:
            totals = worth[:n] + best[room - sizes[:n]]
            k = int(totals.argmax())
            if totals[k] > best[room] + 1e-12:
                best[room], choice[room] = totals[k], k
    pattern, room = np.zeros(len(values)), rooms
    while room > 0:
        if choice[room] < 0:
            room -= 1
        else:
            pattern[kinds[choice[room]]] += pieces[choice[room]]
            room -= int(sizes[choice[room]])
    return float(best[rooms]), pattern


def cutting_stock(demand: Mapping[int, int], capacity: int, unit: int = 1) -> list[tuple[dict[int, int], int]]:
    """Patterns ``{size: count}`` with how often each is used; together exactly the demand.

    Room is dealt in units. Warns if the program stopped without a proof of ``GAP``; the plan is whole all the same.
    """
    sizes = np.array(sorted(s for s, n in demand.items() if n > 0), np.int64)
    if not len(sizes):
        return []
    need = np.array([demand[s] for s in sizes.tolist()], float)
    items = parcels(sizes, capacity, unit)
    patterns = np.diag((capacity // sizes).astype(float))  # a column per basic pattern
    inverse = np.diag(1 / np.diag(patterns))
    use = inverse @ need
    for _ in range(MOST_COLUMNS):
        duals = inverse.sum(axis=0)
        worth, column = priced_pattern(duals, items, capacity // unit)
        if worth <= 1 + GAP:
            break
        step = inverse @ column
        ratio = np.where(step > 1e-9, use / np.where(step > 1e-9, step, 1), np.inf)
        leave = int(ratio.argmin())
        patterns[:, leave] = column
        row = inverse[leave] / step[leave]
        inverse -= np.outer(step, row)
        inverse[leave] = row
        use = np.maximum(inverse @ need, 0)
    else:
        warnings.warn(f"cutting stock stopped after {MOST_COLUMNS} columns, up to {worth - 1:.2%} from the best", stacklevel=2)
    counts = patterns.astype(np.int64)
    times = np.floor(use + 1e-6).astype(np.int64)
    left = need.astype(np.int64)
    plan = []
    for j in np.argsort(-times, kind="stable").tolist():
        held = counts[:, j] > 0
        t = min(int(times[j]), int((left[held] // counts[held, j]).min()))
        if t > 0:
            left -= counts[:, j] * t
            plan.append(({int(s): int(c) for s, c in zip(sizes[held], counts[held, j], strict=True)}, t))
    # fewer items are left than the basis has patterns times their items: independent of the demand
    rooms: list[int] = []
    bins: list[dict[int, int]] = []
    for size, n in zip(sizes[::-1].tolist(), left[::-1].tolist(), strict=True):
        for at in sorted(range(len(rooms)), key=rooms.__getitem__):
            if n and (taken := min(n, rooms[at] // size)):
                rooms[at] -= taken * size
                bins[at][size] = taken
                n -= taken
        while n:
            taken = min(n, capacity // size)
            rooms.append(capacity - taken * size)
            bins.append({size: taken})
            n -= taken
    return plan + [(b, 1) for b in bins]


def slots(plan: list[tuple[dict[int, int], int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per class the first rank of each of its runs of slots, items per sequence, and first sequence."""
    found: dict[int, list[tuple[int, int, int]]] = {}
    filled: dict[int, int] = {}
    sequence = 0
    for pattern, times in plan:
        for size, count in pattern.items():
            found.setdefault(size, []).append((filled.get(size, 0), count, sequence))
            filled[size] = filled.get(size, 0) + count * times
        sequence += times
    return {s: tuple(np.array(v, np.int64).T) for s, v in found.items()}


def _pieces(path: str, end_id: int, length: int):
    class_of = classes(length)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, met = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for batch, ids, bounds in encoded_texts(batches, path, end_id):
            tokens = np.diff(bounds)
            count = -(-tokens // length)
            of = np.repeat(np.arange(len(tokens)), count)
            start = (np.arange(len(of)) - np.repeat(np.cumsum(count) - count, count)) * length
            size = np.minimum(length, tokens[of] - start)
            units = class_of[size]
            # the number of the piece among those of its class in this partition
            order = np.argsort(units, kind="stable")
            ordered = units[order]
            first = np.searchsorted(ordered, ordered)
            nth = np.empty(len(of), np.int64)
            nth[order] = np.arange(len(of)) - first + met[ordered]
            met += np.bincount(units, minlength=len(met))
            # pieces lie end to end, as documents are cut in order
            ends = np.append(0, np.cumsum(size)) * 4
            raw = pa.py_buffer(ids.astype("<u4").tobytes())
            binary = pa.Array.from_buffers(pa.binary(), len(of), [None, pa.py_buffer(ends.astype(np.int32).tobytes()), raw])
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id").take(pa.array(of)),
                    *[pa.array(v.astype(np.int64)) for v in (start, size, tokens[of], np.full(len(of), block), units, nth)],
                    binary,
                ],
                names=["doc_id", "start", "length", "doc_tokens", "block", "units", "nth", "ids"],
            )

    return cut


def pieces(docs: DataFrame, path: str | None = None, end_id: int = END_ID, length: int = LENGTH) -> DataFrame:
    """Stored pieces with their ids (little-endian uint32), class and number within (block, class)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema = "doc_id long, start long, length long, doc_tokens long, block long, units long, nth long, ids binary"
    return stored(rows.mapInArrow(_pieces(path or vocabulary_path(), end_id, length), schema), "pieces")


def placed(found: DataFrame, length: int = LENGTH) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to pieces (with any other columns); needs no ids."""
    counts = stored(found.groupBy("block", "units").agg(F.count("*").alias("n")), "piece-counts")
    demand = {r.units: r.n for r in counts.groupBy("units").agg(F.sum("n").alias("n")).collect()}
    table = slots(cutting_stock(demand, length, UNIT))
    before = Window.partitionBy("units").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("block", "units", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    ranked = found.join(bases, ["block", "units"]).withColumn("rank", F.col("base") + F.col("nth")).drop("base", "nth", "block")

    @F.pandas_udf("long")
    def sequence(units: pd.Series, rank: pd.Series) -> pd.Series:
        out = np.empty(len(units), np.int64)
        kinds, ranks = units.to_numpy(), rank.to_numpy()
        for kind in np.unique(kinds):
            first, count, base = table[int(kind)]
            rows = np.flatnonzero(kinds == kind)
            run = np.searchsorted(first, ranks[rows], "right") - 1
            out[rows] = base[run] + (ranks[rows] - first[run]) // count[run]
        return pd.Series(out)

    numbered = ranked.withColumn("sequence_id", sequence("units", "rank"))
    ahead = Window.partitionBy("sequence_id").orderBy(F.desc("units"), "rank").rowsBetween(Window.unboundedPreceding, -1)
    return numbered.withColumn("offset", F.coalesce(F.sum("length").over(ahead), F.lit(0))).drop("units", "rank")


def sequences(placed_pieces: DataFrame) -> DataFrame:
    """``sequence_id, length, ids``: the packed ids of every sequence, from placed pieces with their ids."""
    parts = F.sort_array(F.collect_list(F.struct("offset", "length", "ids")))
    rows = placed_pieces.groupBy("sequence_id").agg(parts.alias("parts"))
    whole = F.aggregate("parts", F.lit(b""), lambda a, p: F.concat(a, p["ids"]))
    total = F.aggregate("parts", F.lit(0).cast("long"), lambda a, p: a + p["length"])
    return rows.select("sequence_id", total.alias("length"), whole.alias("ids"))


def pack(docs: DataFrame) -> DataFrame:
    """Per piece ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    found = pieces(docs).withColumn("ids_crc32", F.crc32("ids")).drop("ids")
    return placed(found).select("doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")


def op6_packing(spark, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
