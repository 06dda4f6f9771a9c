"""Shared pieces of the operators in this subpackage."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from itemtrack.operators.common import materialize as _materialize

# One slice of rows that a task holds as Python objects at a time.
SLICE_BYTES = 4 << 20

REMEMBERED_BYTES = 64 << 20    # of parts of texts that an operator remembers in a worker
LONGEST_PART = 64              # letters of a remembered part
ENTRY_BYTES = 200              # what an entry takes besides its part and its value, about


class Remembered:
    """Results for short parts of texts, bounded in bytes.  A full memory takes no more: the parts
    seen first are the frequent ones.  A worker serves many tasks: an operator that starts there
    makes all others forget (see :func:`slices`)."""

    everyone: "list[Remembered]" = []

    def __init__(self, max_bytes: int = REMEMBERED_BYTES):
        self.held: dict = {}
        self.max_bytes = self.left = max_bytes
        self.everyone.append(self)

    def put(self, part: str, value, size: int = 0) -> bool:
        size += ENTRY_BYTES + len(part)
        if len(part) > LONGEST_PART or size > self.left:
            return False
        self.left -= size
        self.held[part] = value
        return True

    def forget(self) -> None:
        self.held.clear()
        self.left = self.max_bytes


# Shuffle files of a finished job are of no use once its result is a table.
_CLEAN = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def shuffles_removed(spark: SparkSession):
    """Jobs inside remove their shuffle files when they end."""
    before = spark.conf.get(_CLEAN, "false")
    spark.conf.set(_CLEAN, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEAN, before)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """``df`` as a table in the shared folder; the job's shuffle files go when it ends."""
    with shuffles_removed(df.sparkSession):
        return _materialize(df, name)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fold(id_col: str, modulus: int) -> Column:
    """crc32 of the id as text, modulo ``modulus`` (null id: the empty text)."""
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % modulus


def slices(batches: Iterator[pa.RecordBatch], column: str = "text", max_bytes: int = SLICE_BYTES,
           own: Remembered | None = None) -> Iterator[pa.RecordBatch]:
    """Cut Arrow batches so that ``column`` holds at most ``max_bytes`` per slice (a
    single longer text makes a slice of its own): memory stays bounded whatever the
    rows-per-batch setting is.  What other operators remember in this worker is released."""
    for memory in Remembered.everyone:
        if memory is not own:
            memory.forget()
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(batch.schema.get_field_index(column))
        offsets = np.frombuffer(values.buffers()[1], np.int64 if pa.types.is_large_string(values.type)
                                else np.int32)[values.offset:values.offset + len(values) + 1]
        start = 0
        while start < batch.num_rows:
            end = int(np.searchsorted(offsets, offsets[start] + max_bytes, "right")) - 1
            end = min(max(end, start + 1), batch.num_rows)
            yield batch.slice(start, end - start)
            start = end


def text_bytes(batch: pa.RecordBatch, column: str = "text") -> list[bytes]:
    """The texts of a slice as UTF-8 bytes; null is the empty text."""
    values = batch.column(batch.schema.get_field_index(column)).cast(pa.binary())
    return [b"" if v is None else v for v in values.to_pylist()]


def texts(batch: pa.RecordBatch, column: str = "text") -> list[str]:
    """The texts of a slice; null is the empty text."""
    return ["" if v is None else v
            for v in batch.column(batch.schema.get_field_index(column)).to_pylist()]


def mix64(x: np.ndarray) -> np.ndarray:
    """Avalanche of 64-bit integers (the finaliser of splitmix64), vectorised."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(words: list[bytes]) -> np.ndarray:
    """64-bit hashes of words, equal on every worker (Python's own hash is not)."""
    from xxhash import xxh3_64_intdigest
    return np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))
