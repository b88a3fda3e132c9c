"""One run at a time in a folder, and prompts pinned by their hash."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession


class Held(RuntimeError):
    """Another driver holds the run."""


@contextmanager
def run_lock(spark: SparkSession, folder: str) -> Iterator[None]:
    """Holds a run's folder for as long as the block runs. The lock is a file that is created or not in one step, in
    whatever store the folder is; it goes with the driver."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder.rstrip('/')}/run.lock")
    files = at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.createNewFile(at):
        raise Held(f"{at} is there: another run works in this folder, or one died without taking it away")
    files.deleteOnExit(at)
    try:
        yield
    finally:
        files.delete(at, False)


def load_prompt(spark: SparkSession, folder: str, version: str, pinned: dict[str, str]) -> str:
    """The text of ``version``.md, byte for byte. pinned: version -> SHA-256; an unknown version or other bytes raise."""
    if version not in pinned:
        raise ValueError(f"prompt {version!r} is not pinned; known: {sorted(pinned)}")
    rows = spark.read.format("binaryFile").load(f"{folder.rstrip('/')}/{version}.md").select("content").collect()  # one small file
    if len(rows) != 1 or hashlib.sha256(rows[0][0]).hexdigest() != pinned[version]:
        raise ValueError(f"prompt {version!r} differs from what is pinned")
    return bytes(rows[0][0]).decode()
