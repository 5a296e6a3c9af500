"""Shared helpers of the text operators: table access, the shared scratch folder, word hashing."""

from __future__ import annotations

import ctypes
import gc
import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager, suppress
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession

#: Words are runs of bytes other than these (space and 0x09-0x0D); this is what ``bytes.split()`` does.
WORD_CACHE = 300_000

#: Odd 64-bit multipliers of a word's place in a window (powers of the golden-ratio constant).
MULTIPLIERS = np.array([pow(0x9E3779B97F4A7C15, i + 1, 1 << 64) for i in range(64)], dtype=np.uint64)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Where it is unset, one is made and set if all runs on this machine (tests)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        base = tempfile.mkdtemp(prefix="lodestone-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/lodestone/{spark.sparkContext.applicationId}{_scope.get()}"


#: The folder within the application's in which scratch tables are written at present.
_scope: ContextVar[str] = ContextVar("scope", default="")


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Scratch tables that are made within go to a folder of their own, which is deleted at the end; what is to stay is written by `materialise` with ``stays``."""
    token = _scope.set(f"/scope-{uuid.uuid4().hex[:12]}")
    folder = shared_dir(spark)
    try:
        yield
    finally:
        _scope.reset(token)
        remove(spark, folder)


def materialise(df: DataFrame, name: str, *, stays: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage, survives the loss of executors. ``stays``: it outlives the `scratch` it is written in."""
    spark = df.sparkSession
    path = f"{shared_dir(spark).removesuffix(_scope.get()) if stays else shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a materialised ``df`` that nothing reads any more."""
    spark = df.sparkSession
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        remove(spark, folder)


def remove(spark: SparkSession, folder: str) -> None:
    """Delete a folder of this application's scratch folder."""
    if "/lodestone/" in folder and spark.sparkContext.applicationId in folder:
        path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def chunks(values: pa.Array, most: int = 2 << 20) -> Iterator[tuple[int, list]]:
    """Runs of a column's values of about ``most`` bytes or characters, each with the place of its first."""
    start, held, size = 0, [], 0
    for i in range(len(values)):
        x = values[i].as_py()
        held.append(x)
        size += len(x)
        if size >= most:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def _give_back() -> None:
    """Return freed memory to the system: a Python worker that waits for its next task should hold little."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    with suppress(OSError, AttributeError):  # only where the C library can
        ctypes.CDLL(None).malloc_trim(0)


def tidy(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``run`` over a task's batches; when it has ended, what it held is given back."""

    def wrapped(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            _give_back()

    return wrapped


class WordHashes(dict):
    """64-bit xxhash of each distinct word (bytes); emptied when it has grown to WORD_CACHE words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= WORD_CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads every input bit over the output (in place)."""
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def windows(hashes: np.ndarray, k: int) -> np.ndarray:
    """A 64-bit hash of each run of ``k`` consecutive words."""
    n = len(hashes) - k + 1
    out = np.zeros(max(n, 0), np.uint64)
    for j in range(k if n > 0 else 0):
        out += hashes[j : j + n] * MULTIPLIERS[j]
    return mix(out)
