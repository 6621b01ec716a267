"""One writer at a time on a table.

The lease is a file beside the table's partitions that only one process can create. A second writer waits
for it, and fails with the name of the holder when its patience ends. A driver that dies keeps its
lease; the error says which file to remove once that run is known to be dead.
"""

import json
import os
import time
from collections.abc import Iterator
from contextlib import contextmanager
from datetime import datetime, timezone
from pathlib import Path
from urllib.parse import urlsplit

from pyspark.sql import SparkSession

NAME = "_lease"
POLL_SECONDS = 0.2


class TableBusyError(RuntimeError):
    """Another run holds the table's lease."""


class _LocalFile:
    def __init__(self, path: str) -> None:
        self.path = Path(path)

    def create(self, text: str) -> bool:
        self.path.parent.mkdir(parents=True, exist_ok=True)
        try:
            handle = os.open(self.path, os.O_CREAT | os.O_EXCL | os.O_WRONLY)
        except FileExistsError:
            return False
        with os.fdopen(handle, "w") as out:
            out.write(text)
        return True

    def read(self) -> str:
        return self.path.read_text()

    def remove(self) -> None:
        self.path.unlink(missing_ok=True)


class _HadoopFile:
    """On HDFS a create without overwrite is atomic; a bare object store gives no such promise."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.place = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.system = self.place.getFileSystem(spark._jsc.hadoopConfiguration())

    def create(self, text: str) -> bool:
        if self.system.exists(self.place):
            return False
        try:
            stream = self.system.create(self.place, False)
        except Exception as error:
            if "AlreadyExists" in str(error) or "AlreadyBeingCreated" in str(error):
                return False
            raise
        stream.write(bytearray(text.encode()))
        stream.close()
        return True

    def read(self) -> str:
        return bytes(self.system.open(self.place).readAllBytes()).decode()

    def remove(self) -> None:
        self.system.delete(self.place, False)


def _file(spark: SparkSession, path: str) -> _LocalFile | _HadoopFile:
    url = urlsplit(path)
    if url.scheme in ("", "file"):
        return _LocalFile(url.path)
    return _HadoopFile(spark, path)


def _holder(file: _LocalFile | _HadoopFile) -> str:
    try:
        return file.read()
    except Exception:  # released in this moment, or not written yet
        return "an unknown run"


@contextmanager
def lease(spark: SparkSession, table: str, owner: str, wait: float) -> Iterator[None]:
    """Hold the lease of the table at ``table`` for the block; wait up to ``wait`` seconds for it."""
    path = f"{table.rstrip('/')}/{NAME}"
    file, end = _file(spark, path), time.monotonic() + wait
    text = json.dumps({"run": owner, "since": datetime.now(timezone.utc).isoformat(timespec="seconds")})
    while not file.create(text):
        if time.monotonic() >= end:
            raise TableBusyError(
                f"{table} is being written by {_holder(file)}; "
                f"if that run is dead, look for its files below {table}/.spark-staging-* and remove {path}"
            )
        time.sleep(POLL_SECONDS)
    try:
        yield
    finally:
        file.remove()
