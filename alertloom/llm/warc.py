"""WARC archives: monolithic gzip files, and their normaliser.

A monolithic archive is one gzip stream over all its records, so no record can be read alone.
The normaliser inflates such a stream once, from start to end, rewrites every record as a gzip
member of its own, turns repeated payloads into revisit records on the way, and writes a sidecar
index with the place of each member. Files are bounded (``RAW_PER_FILE``), and the records of
one file are the unit of work; only digests, never payloads, are shuffled.

Of records with equal payloads of at least ``least_bytes`` the one with the largest page_id is
the response; of several rows with that id the first in file order. Nulls: a null html is an
empty payload, a null url an empty target, a null page_id is below all others and is given back
as null. An empty table gives no files and no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections.abc import Iterator, Mapping

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from alertloom.llm.common import stored
from alertloom.llm.files import Writing, located
from alertloom.session import scratch_path

RAW_PER_FILE = 1 << 25
LEVEL = 1
READ = 1 << 20
VERSION = b"WARC/1.1"
DATE = "1970-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(kind: str, page_id: int | None, url: str | None, digest: str, size: int, payload: bytes | None, refers_to: int | None = None) -> bytes:
    """One record; a revisit has the HTTP header of its response and no payload."""
    head = HTTP.format(size).encode()
    block = head if payload is None else head + payload
    target = re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")
    fields = [
        ("WARC-Type", kind),
        ("WARC-Record-ID", f"<urn:page:{'' if page_id is None else page_id}>"),
        ("WARC-Date", DATE),
        ("WARC-Target-URI", target),
        ("WARC-Payload-Digest", f"sha1:{digest}"),
        ("Content-Type", "application/http; msgtype=response"),
        ("Content-Length", str(len(block))),
    ]
    if kind == "revisit":
        fields.insert(5, ("WARC-Profile", PROFILE))
        fields.insert(5, ("WARC-Refers-To", f"<urn:page:{'' if refers_to is None else refers_to}>"))
    lines = b"".join(f"{k}: {v}\r\n".encode() for k, v in fields)
    return b"%s\r\n%s\r\n%s\r\n\r\n" % (VERSION, lines, block)


def parse(header: bytes) -> dict[str, str]:
    lines = header.decode("utf-8", "replace").split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    return {k.strip().lower(): v.strip() for k, _, v in (x.partition(":") for x in lines[1:] if x)}


def _page(urn: str | None) -> int | None:
    number = (urn or "").removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def inflated(chunks: Iterator[bytes]) -> Iterator[bytes]:
    """The content of a gzip file of one or several members, in bounded parts."""
    inflate = zlib.decompressobj(31)
    for chunk in chunks:
        while chunk:
            if inflate.eof:
                inflate = zlib.decompressobj(31)
            part = inflate.decompress(chunk, READ)
            if part:
                yield part
            chunk = inflate.unused_data if inflate.eof else inflate.unconsumed_tail
    if not inflate.eof:
        raise EOFError("the gzip stream is cut off")


def records(parts: Iterator[bytes]) -> Iterator[tuple[dict[str, str], bytes]]:
    """Fields and block of each record of an inflated stream; holds one record at a time."""
    held = bytearray()

    def more() -> bool:
        part = next(parts, None)
        if part is not None:
            held.extend(part)
        return part is not None

    while True:
        seen = 0
        while (end := held.find(b"\r\n\r\n", max(0, seen - 3))) < 0:
            seen = len(held)
            if not more():
                if held.strip():
                    raise EOFError("a record is cut off")
                return
        fields = parse(bytes(held[:end]))
        stop = end + 4 + int(fields["content-length"])
        while len(held) < stop + 4:
            if not more():
                raise EOFError("a record is cut off")
        yield fields, bytes(held[end + 4 : stop])
        del held[: stop + 4]


def payload_of(block: bytes) -> bytes:
    return block[block.index(b"\r\n\r\n") + 4 :]


def _file_chunks(uri: str) -> Iterator[bytes]:
    store, path = located(uri)
    with store.open_input_stream(path, compression=None) as stream:
        while part := stream.read(READ):
            yield part


def normalise_file(source: str, target: str, refers_to: Mapping[int, int | None]) -> int:
    """Rewrites ``source`` as one member per record at ``target`` with ``target + ".idx"`` beside it.

    ``refers_to`` names records by their number in the file that become revisits. Index lines:
    place, length, type, page id, of each member.
    """
    out, place, index = Writing(target), 0, []
    for n, (fields, block) in enumerate(records(inflated(_file_chunks(source)))):
        page, digest = _page(fields["warc-record-id"]), fields["warc-payload-digest"].removeprefix("sha1:")
        body = payload_of(block)
        repeat = n in refers_to
        kind = "revisit" if repeat else fields["warc-type"]
        whole = record(kind, page, fields["warc-target-uri"], digest, len(body), None if repeat else body, refers_to.get(n))
        deflate = zlib.compressobj(LEVEL, wbits=31)
        member = deflate.compress(whole) + deflate.flush()
        out.write(member)
        index.append(f"{place} {len(member)} {kind} {'-' if page is None else page}\n")
        place += len(member)
    out.close()
    side = Writing(f"{target}.idx")
    side.write("".join(index).encode())
    side.close()
    return len(index)


def _capturer(folder: str, per_file: int):
    names = ["path", "nth", "page_id", "payload_bytes", "payload_digest"]

    def capture(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard, part, raw, nth, out, deflate = TaskContext.get().partitionId(), 0, 0, 0, None, None
        rows: list[tuple] = []

        def flush() -> pa.RecordBatch:
            nonlocal out, part, raw, nth
            out.write(deflate.flush())
            out.close()
            columns = list(zip(*rows, strict=True))
            rows.clear()
            types = [pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string()]
            batch = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names)
            out, part, raw, nth = None, part + 1, 0, 0
            return batch

        for batch in batches:
            for page, url, html in zip(*(batch.column(c) for c in ("page_id", "url", "html")), strict=True):
                if out is None:
                    path = f"{folder}/pages-{shard:06d}-{part:06d}.warc.gz"
                    out, deflate = Writing(path), zlib.compressobj(LEVEL, wbits=31)
                page, payload = page.as_py(), (html.as_py() or "").encode()
                digest = payload_digest(payload)
                whole = record("response", page, url.as_py(), digest, len(payload), payload)
                out.write(deflate.compress(whole))
                rows.append((path, nth, page, len(payload), digest))
                nth, raw = nth + 1, raw + len(whole)
                if raw >= per_file:
                    yield flush()
        if rows:
            yield flush()

    return capture


def capture(pages: DataFrame, folder: str, per_file: int = RAW_PER_FILE) -> DataFrame:
    """Writes monolithic archives; stored ``path, nth, page_id, payload_bytes, payload_digest`` of all records."""
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    schema = "path string, nth long, page_id long, payload_bytes long, payload_digest string"
    return stored(rows.mapInArrow(_capturer(folder, per_file), schema), "captured")


def repeats(captured: DataFrame, least_bytes: int = 0) -> DataFrame:
    """``path, nth, refers_to`` of the records whose payload another record holds."""
    long_enough = captured.filter(F.col("payload_bytes") >= least_bytes)
    # least by (file, number) among those of the largest id
    rank = F.struct(F.col("page_id").isNull().alias("unknown"), (-F.col("page_id")).alias("down"), "path", "nth")
    first = long_enough.groupBy("payload_digest").agg(F.min(rank).alias("first"), F.count("*").alias("n"))
    first = first.filter("n > 1").select(
        "payload_digest", (-F.col("first.down")).alias("refers_to"), F.col("first.path").alias("_path"), F.col("first.nth").alias("_nth")
    )
    both = long_enough.join(first, "payload_digest")
    return both.filter((F.col("path") != F.col("_path")) | (F.col("nth") != F.col("_nth"))).select("path", "nth", "refers_to")


def normalise(captured: DataFrame, folder: str, least_bytes: int = 0) -> DataFrame:
    """Stored ``path, records`` of normalised archives. A group holds the repeats of one bounded file."""
    files = captured.groupBy("path").agg(F.count("*").alias("records"))
    numbers = F.collect_list(F.struct("nth", "refers_to"))
    found = files.join(repeats(captured, least_bytes).groupBy("path").agg(numbers.alias("repeats")), "path", "left")

    def rewrite(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            done = []
            for source, held in zip(frame["path"], frame["repeats"], strict=True):
                target = f"{folder}/{source.rpartition('/')[2]}"
                revisits = {int(r["nth"]): None if pd.isna(r["refers_to"]) else int(r["refers_to"]) for r in (held if held is not None else [])}
                done.append((target, normalise_file(source, target, revisits)))
            yield pd.DataFrame(done, columns=["path", "records"])

    # a task per file: by the bytes of their names, any number of files would be merged into one
    dealt = found.repartition(max(1, files.count()), "path")
    return stored(dealt.mapInPandas(rewrite, "path string, records long"), "normalised")


def read_member(stream, place: int, length: int) -> tuple[dict[str, str], bytes]:
    """One record by its place, without anything before it."""
    stream.seek(place)
    return next(records(inflated(iter([stream.read(length)]))))


def read_archives(normalised: DataFrame) -> DataFrame:
    """Per record of normalised archives, by their indexes: its page, payload size and digest, type and response."""

    def read(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for path in frame["path"]:
                store, name = located(path)
                with store.open_input_stream(f"{name}.idx", compression=None) as side:
                    index = [x.split() for x in side.read().decode().splitlines()]
                rows = []
                with store.open_input_file(name) as stream:
                    for place, length, *_ in index:
                        fields, block = read_member(stream, int(place), int(length))
                        kind, digest = fields["warc-type"], fields["warc-payload-digest"].removeprefix("sha1:")
                        size = int(re.search(rb"\nContent-Length: (\d+)\r", block)[1])
                        if kind == "response":
                            body = payload_of(block)
                            if len(body) != size or payload_digest(body) != digest:
                                raise ValueError(f"{path} at {place}: payload and digest differ")
                        page, refers = _page(fields["warc-record-id"]), _page(fields.get("warc-refers-to"))
                        rows.append((page, size, digest, kind, refers))
                names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
                yield pd.DataFrame(rows, columns=names).astype({"page_id": "Int64", "refers_to": "Int64"})

    tasks = int(normalised.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    schema = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
    return normalised.select("path").repartition(tasks).mapInPandas(read, schema)


def op9_warc(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    captured = capture(pages, scratch_path(spark, "warc-monolithic"))
    return read_archives(normalise(captured, scratch_path(spark, "warc")))


OP9_SQL = r"""
WITH digits AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages
), kept AS (
  SELECT html, max(page_id) AS last FROM digits GROUP BY html
)
SELECT d.page_id, CAST(strlen(d.html) AS BIGINT) AS payload_bytes,
       array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + CAST((('0x' || substr(d.hex, 1 + 5 * (k // 4), 5))::BIGINT >> (5 * (3 - k % 4))) & 31 AS INTEGER), 1)
         FOR k IN range(32)], '') AS payload_digest,
       CASE WHEN d.page_id = k.last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN d.page_id <> k.last THEN k.last END AS refers_to
FROM digits d JOIN kept k ON d.html = k.html
"""
