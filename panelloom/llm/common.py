"""Helpers shared by the corpus operators."""

from __future__ import annotations

import ctypes
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, SparkSession

from panelloom.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the shared input tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def keep(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Write to the shared scratch folder and read back: lineage ends there."""
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def save_bytes(spark: SparkSession, data: bytes, name: str) -> str:
    """Write one file to the shared scratch folder, whatever file system that is on."""
    folder = scratch_path(spark, "file")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{folder}/{name}")
    out = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(path)
    out.write(bytearray(data))
    out.close()
    return path.toString()


def runs_of(sizes: Sequence[int], budget: int) -> Iterator[tuple[int, int]]:
    """Cut a batch in runs of rows of about ``budget`` bytes; one row may exceed it."""
    begin = held = 0
    for i, size in enumerate(sizes):
        if i > begin and held + size > budget:
            yield begin, i
            begin, held = i, 0
        held += size
    if begin < len(sizes):
        yield begin, len(sizes)


def texts_of(column) -> list[str]:
    """An Arrow string column as Python strings, nulls as empty texts."""
    return [value or "" for value in column.to_pylist()]


def text_runs(column: pa.Array, budget: int) -> Iterator[tuple[int, int, list[str]]]:
    """Rows of an Arrow string column from ``low`` to ``high`` as Python strings, about
    ``budget`` bytes at a time, so that a batch is never held twice."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for low, high in runs_of(sizes, budget):
        yield low, high, texts_of(column.slice(low, high - low))


def release() -> None:
    """Give freed memory back to the system: workers are reused and would keep their peak."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


class Hashes(dict):
    """Word to 64-bit hash; forgets all when full, so its memory is bounded."""

    LIMIT = 150_000

    def __missing__(self, word: str) -> int:
        if len(self) >= self.LIMIT:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word.encode("utf-8", "surrogatepass"))
        return value

    def of(self, words: Iterable[str], count: int) -> np.ndarray:
        """Hashes of the words in order."""
        return np.fromiter(map(self.__getitem__, words), np.uint64, count)


def mixed(values: np.ndarray) -> np.ndarray:
    """Finaliser with full avalanche on 64-bit integers."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x
