"""Files in the shared folder, written and read by tasks.

A file appears under its name only when complete, and a repeated task writes the same bytes to
the same name, so lost executors and speculative tasks leave whole files. Paths are URIs of a
file system that pyarrow opens (local or mounted, HDFS, object stores).
"""

from __future__ import annotations

import uuid

from pyarrow import fs


def located(uri: str) -> tuple[fs.FileSystem, str]:
    if uri.startswith("file:/") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return fs.FileSystem.from_uri(uri)


class Writing:
    """A binary file under construction; ``close`` gives it its name."""

    def __init__(self, uri: str) -> None:
        self.uri = uri
        self.store, self.path = located(uri)
        self.store.create_dir(self.path.rpartition("/")[0], recursive=True)
        self.part = f"{self.path}.{uuid.uuid4().hex}.part"
        self.stream = self.store.open_output_stream(self.part, compression=None)

    def write(self, data: bytes) -> None:
        self.stream.write(data)

    def close(self) -> None:
        self.stream.close()
        self.store.move(self.part, self.path)


def write_file(uri: str, data: bytes) -> None:
    out = Writing(uri)
    out.write(data)
    out.close()


def read_file(uri: str) -> bytes:
    store, path = located(uri)
    with store.open_input_stream(path, compression=None) as stream:
        return stream.read()
