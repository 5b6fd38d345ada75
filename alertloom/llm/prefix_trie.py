"""Prefix trie of conversations by splitters and a skeleton.

The path of a conversation is the sequence of its turns' digests; in the order of paths (and ids)
the members of a node are neighbours. Splitters cut that order into shards of about equal size.
Only nodes on a splitter's path can have members in two shards: these nodes, the skeleton, form a
small trie that is broadcast. Every other node lies in one shard, whose sorted conversations are
streamed once with a stack of open nodes. Skeleton nodes are summed over the shards and then from
the bottom up. A node with very many members or children, such as the root or a first turn that a
third of all conversations share, is thus spread over shards.

Splitters are quantiles of a bounded sample (``SAMPLE_PER_SHARD`` paths of least hash per shard,
``MOST_SHARDS`` shards), which decides about balance only. The number of shards is lowered until all
splitters fit in ``SKELETON_BYTES`` by the length of the longest path, so the broadcast is bounded.
The ids of conversations that end in a skeleton node go through one hash in order, as SHA-256
demands; they stream by and are never held.

Nulls: a null turn comes first, null roles and texts are empty, rows without conv_id are left out.
Rows of equal turn are ordered by role and text. Repeated rows are turns of their own. A
conversation is one row of 22 bytes a turn. No conversations: no nodes. Turns are told apart by
128-bit digests and their length.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from alertloom.llm.common import stored

#: Digest and length (6 bytes) of a turn.
ELEMENT = 22
BASE, MOST_SHARED = 100, 6
SHARD_ROWS, SAMPLE_PER_SHARD, MOST_SHARDS, SKELETON_BYTES = 4096, 32, 2048, 32 << 20
#: Characters of ids in one row on their way to a skeleton node's hash.
IDS_CHARS = 1 << 16


def paths(turns: DataFrame) -> DataFrame:
    """``conv_id, path`` of ``turns(conv_id, turn, role, text)``."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    size = F.char_length(text)
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text))
    element = F.concat(digest, F.lpad(F.lower(F.hex(size)), 12, "0"))
    rows = turns.filter("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), text.alias("text"), element.alias("e"))
    tied = Window.partitionBy("conv_id", "turn").orderBy("role", "text")
    # places among rows of one turn by role and text, so that texts stay out of the gathered rows
    placed = rows.withColumn("at", F.row_number().over(tied)).select("conv_id", "turn", "at", "e")
    known = F.col("turn").isNotNull()
    gathered = placed.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct(known.alias("known"), "turn", "at", "e"))).alias("t"))
    return gathered.select("conv_id", F.unhex(F.array_join(F.transform("t", lambda t: t["e"]), "")).alias("path"))


def rebuilt(own: DataFrame, base: int = BASE, most: int = MOST_SHARED) -> DataFrame:
    """Paths whose first h turns are those of the conversation c - c % base; h = crc32(c) % most."""
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).cast("int")
    first = own.filter(F.col("conv_id") % base == 0).select(F.col("conv_id").alias("_base"), F.substring("path", 1, ELEMENT * (most - 1)).alias("_head"))
    rows = own.withColumns({"_base": F.col("conv_id") - F.col("conv_id") % base, "_h": h})
    head = F.coalesce(F.expr(f"substring(_head, 1, {ELEMENT} * _h)"), F.lit(b""))
    tail = F.expr(f"substring(path, {ELEMENT} * _h + 1, length(path))")
    return rows.join(first, "_base", "left").select("conv_id", F.concat(head, tail).alias("path"))


def splitters(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> list[tuple[bytes, int]]:
    """Ascending (path, conv_id) at which the shards but the first begin."""
    size = rows.agg(F.count("*").alias("n"), F.max(F.length("path")).alias("longest")).first()
    shards = min(-(-size.n // shard_rows), MOST_SHARDS, max(1, SKELETON_BYTES // max(size.longest or 0, 1)))
    if shards < 2:
        return []
    sample = rows.orderBy(F.xxhash64("conv_id"), "conv_id").limit(SAMPLE_PER_SHARD * shards)
    # a bounded sample, so one task may rank it
    place = F.ntile(shards).over(Window.orderBy("path", "conv_id"))
    cut = Window.partitionBy("_tile").orderBy("path", "conv_id")
    heads = sample.withColumn("_tile", place).withColumn("_at", F.row_number().over(cut)).filter("_at = 1 AND _tile > 1")
    return [(bytes(r.path), r.conv_id) for r in heads.select("path", "conv_id").orderBy("path", "conv_id").collect()]


class Skeleton:
    """Trie of the splitters' paths; node 0 is the root."""

    def __init__(self, cuts: list[tuple[bytes, int]]) -> None:
        self.child: dict[tuple[int, bytes], int] = {}
        self.parent, self.chars, self.depth = [-1], [0], [0]
        for path, _ in cuts:
            at = 0
            for k in range(0, len(path), ELEMENT):
                e = path[k : k + ELEMENT]
                found = self.child.get((at, e))
                if found is None:
                    found = self.child[at, e] = len(self.parent)
                    self.parent.append(at)
                    self.chars.append(int.from_bytes(e[16:], "big"))
                    self.depth.append(self.depth[at] + 1)
                at = found


FOUND_SCHEMA = (
    "skeleton int, shard int, part long, ids string, conv_id long, depth long, parent_skeleton int, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)
_TYPES = [pa.int32(), pa.int32(), pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.int32(), *[pa.int64()] * 5, pa.string()]
_NAMES = [part.split()[0] for part in FOUND_SCHEMA.split(", ")]
_EMPTY = hashlib.sha256(b"").hexdigest()


class _Node:
    __slots__ = ("element", "skeleton", "n", "least", "children", "leaves", "saved", "ends", "ids", "waiting")

    def __init__(self, element: bytes, skeleton: int) -> None:
        self.element, self.skeleton = element, skeleton
        self.n = self.children = self.leaves = self.saved = 0
        self.least: int | None = None
        self.ends = None  # running hash, or ids not yet sent of a skeleton node
        self.ids = 0
        self.waiting: list[list] = []  # finished children, until this node's least member is known


class _Scan:
    """One shard's sorted conversations, streamed past a stack of open nodes."""

    def __init__(self, skeleton: Skeleton, shard: int) -> None:
        self.skeleton, self.shard = skeleton, shard
        self.stack = [_Node(b"", 0)]
        self.path = b""
        self.part = 0
        self.rows: list[tuple] = []

    def _send_ids(self, node: _Node) -> None:
        if node.ends:
            self.rows.append((node.skeleton, self.shard, self.part, ",".join(node.ends), *[None] * 9))
            self.part += 1
            node.ends, node.ids = [], 0

    def _close(self) -> None:
        node = self.stack.pop()
        depth = len(self.stack)
        if node.skeleton >= 0:
            self._send_ids(node)
            self.rows.append((node.skeleton, self.shard, -1, None, node.least, depth, None, None, node.n, node.children, node.leaves, node.saved, None))
            return
        parent = self.stack[-1]
        node.leaves += node.children == 0
        node.saved += (node.n - 1) * int.from_bytes(node.element[16:], "big")
        for w in node.waiting:
            w[7] = node.least
            self.rows.append(tuple(w))
        done = [-1, None, None, None, node.least, depth, None, None, node.n, node.children, node.leaves, node.saved, node.ends.hexdigest() if node.ends else _EMPTY]
        parent.children += 1
        parent.leaves += node.leaves
        parent.saved += node.saved
        if parent.least is None or node.least < parent.least:
            parent.least = node.least
        if parent.skeleton >= 0:
            done[6] = parent.skeleton
            self.rows.append(tuple(done))
        else:
            parent.waiting.append(done)

    def add(self, conv: int, path: bytes) -> None:
        if path != self.path or len(self.stack) * ELEMENT != len(path) + ELEMENT:
            same, limit = 0, min(len(path), len(self.path))
            while same < limit and path[same : same + ELEMENT] == self.path[same : same + ELEMENT]:
                same += ELEMENT
            while (len(self.stack) - 1) * ELEMENT > same:
                self._close()
            for k in range(same, len(path), ELEMENT):
                e, above = path[k : k + ELEMENT], self.stack[-1].skeleton
                self.stack.append(_Node(e, self.skeleton.child.get((above, e), -1) if above >= 0 else -1))
            self.path = path
        for node in self.stack:
            node.n += 1
            if node.skeleton >= 0 and (node.least is None or conv < node.least):
                node.least = conv
        last = self.stack[-1]
        if last.least is None or conv < last.least:
            last.least = conv
        if last.skeleton >= 0:
            last.ends = last.ends or []
            last.ends.append(str(conv))
            last.ids += 1 + len(last.ends[-1])
            if last.ids >= IDS_CHARS:
                self._send_ids(last)
        elif last.ends is None:
            last.ends = hashlib.sha256(str(conv).encode())
        else:
            last.ends.update(f",{conv}".encode())

    def finish(self) -> None:
        while self.stack:
            self._close()


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else [()] * len(_NAMES)
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES, strict=True)], names=_NAMES)


def _hash_ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    node, running = None, None

    def closed() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([node], pa.int32()), pa.array([running.hexdigest()])], names=["skeleton", "ends_sha256"])

    for batch in batches:
        for at, ids in zip(batch.column("skeleton").to_pylist(), batch.column("ids").to_pylist(), strict=True):
            if running is None or at != node:
                if running is not None:
                    yield closed()
                node, running = at, hashlib.sha256(ids.encode())
            else:
                running.update(f",{ids}".encode())
    if running is not None:
        yield closed()


def _reduced(spark, skeleton: Skeleton, partial: DataFrame) -> DataFrame:
    """Skeleton nodes with totals: sums over the shards, then from the bottom up."""
    sums = {r.skeleton: r for r in partial.groupBy("skeleton").agg(
        F.min("conv_id").alias("least"), *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")]
    ).collect()}
    size = len(skeleton.parent)
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for k in range(size - 1, -1, -1):  # a child comes after its parent
        r, up = sums.get(k), skeleton.parent[k]
        if r is None:
            continue
        children[k] += r.n_children
        leaves[k] += r.n_leaves + (children[k] == 0)
        saved[k] += r.saved_tokens + ((r.n_convs - 1) * skeleton.chars[k] if up >= 0 else 0)
        if up >= 0:
            children[up] += 1
            leaves[up] += leaves[k]
            saved[up] += saved[k]
    rows = [
        (k, r.least, skeleton.depth[k], sums[skeleton.parent[k]].least if k else None, r.n_convs, children[k], leaves[k], saved[k])
        for k, r in sorted(sums.items())
    ]
    schema = "skeleton int, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long"
    return spark.createDataFrame(rows, schema)


COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rows: DataFrame, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """One row per node of the trie of ``rows(conv_id, path)``, with the columns of ``COLUMNS``; conv_id is unique."""
    spark = rows.sparkSession
    rows = stored(rows, "paths")
    cuts = splitters(rows, shard_rows)
    shared = spark.sparkContext.broadcast(cuts)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = zip(batch.column("path").to_pylist(), batch.column("conv_id").to_pylist(), strict=True)
            at = pa.array([bisect.bisect_right(shared.value, key) for key in keys], pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, at], names=["conv_id", "path", "shard"])

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        skeleton, now = Skeleton(shared.value), None
        for batch in batches:
            for conv, path, shard in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "path", "shard")), strict=True):
                if now is None or shard != now.shard:
                    if now is not None:
                        now.finish()
                        yield _batch(now.rows)
                    now = _Scan(skeleton, shard)
                now.add(conv, path)
            if now is not None:
                yield _batch(now.rows)
                now.rows = []
        if now is not None:
            now.finish()
            yield _batch(now.rows)

    sharded = rows.select("conv_id", "path").mapInArrow(place, "conv_id long, path binary, shard int")
    ordered = sharded.repartitionById(len(cuts) + 1, F.col("shard")).sortWithinPartitions("shard", "path", "conv_id")
    found = stored(ordered.mapInArrow(scan, FOUND_SCHEMA), "nodes")

    top = _reduced(spark, Skeleton(cuts), found.filter("skeleton >= 0 AND part = -1"))
    ids = found.filter("skeleton >= 0 AND part >= 0").select("skeleton", "shard", "part", "ids")
    ends = ids.repartition("skeleton").sortWithinPartitions("skeleton", "shard", "part").mapInArrow(_hash_ids, "skeleton int, ends_sha256 string")
    upper = top.join(ends, "skeleton", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_EMPTY))).select(*COLUMNS)
    # the skeleton is bounded by SKELETON_BYTES
    above = F.broadcast(top.select(F.col("skeleton").alias("parent_skeleton"), F.col("conv_id").alias("_above")))
    lower = found.filter("skeleton = -1").join(above, "parent_skeleton", "left")
    lower = lower.withColumn("parent_conv_id", F.coalesce("_above", "parent_conv_id")).select(*COLUMNS)
    return upper.unionByName(lower)


def op13_prefix_trie(spark, sf_dir: str) -> DataFrame:
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    return trie(rebuilt(paths(turns)))


OP13_SQL = r"""
WITH turns AS (
  SELECT CAST(conv_id AS BIGINT) AS c, list({'role': coalesce(role, ''), 'text': coalesce(text, '')}
         ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS t
  FROM conversations WHERE conv_id IS NOT NULL GROUP BY conv_id
), heads AS (
  SELECT c, t, (4294967295 - list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), [1, 1, 1, 1, 1, 1, 1, 1]::BIGINT[]),
      lambda v, one: xor(v >> 1, CASE WHEN v & one = one THEN 3988292384 ELSE 0 END::BIGINT)))) % 6 AS h
  FROM turns
), rebuilt AS (
  SELECT x.c, list_concat(coalesce(b.t[1:x.h], []), x.t[x.h + 1:]) AS t
  FROM heads x LEFT JOIN turns b ON b.c = x.c - x.c % 100
), members AS (
  SELECT c, d, t[1:d] AS path, len(t) = d AS ends FROM (SELECT c, t, unnest(range(0, len(t) + 1)) AS d FROM rebuilt)
), nodes AS (
  SELECT path, any_value(d) AS depth, min(c) AS conv_id, count(*) AS n_convs,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256
  FROM members GROUP BY path
), kids AS (
  SELECT path[1:depth - 1] AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
), full_nodes AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN kids USING (path)
), up AS (
  SELECT path[1:a] AS path, n_children = 0 AS leaf, CASE WHEN depth > 0 THEN (n_convs - 1) * length(path[depth].text) ELSE 0 END AS saved
  FROM (SELECT *, unnest(range(0, depth + 1)) AS a FROM full_nodes)
), sums AS (
  SELECT path, count(*) FILTER (leaf) AS n_leaves, CAST(sum(saved) AS BIGINT) AS saved_tokens FROM up GROUP BY path
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n.n_children, s.n_leaves, s.saved_tokens, n.ends_sha256
FROM full_nodes n JOIN sums s USING (path) LEFT JOIN nodes p ON n.depth > 0 AND p.path = n.path[1:n.depth - 1]
"""
