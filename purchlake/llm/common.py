"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import sys
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_dir
from ..sources.tables import table_path


def ship(module: str) -> None:
    """Send ``module`` to Python workers with the functions that use it, so
    executors need no installed copy of this package."""
    cloudpickle.register_pickle_by_value(sys.modules[module])


ship(__name__)

BATCH_BYTES, BATCH_LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20

#: Lets a query drop its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Of stored steps; whole texts take about a third less than with the default.
CODEC = "zstd"

#: Odd multipliers, so that they have inverses modulo 2^64.
BASE, OTHER_BASE = 0x9E3779B97F4A7C15, 0xD1B54A32D192ED03


def small_batches(spark: SparkSession) -> None:
    """Bound the bytes of a batch sent to Python: rows here are whole texts or large blobs, and
    a worker holds a batch several times over.  A session's own setting is left as it is."""
    if BATCH_BYTES not in spark.conf.getAll:
        spark.conf.set(BATCH_BYTES, str(BATCH_LIMIT))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, name))


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet to the shared checkpoint folder and read it back.

    Cuts the lineage: later stages, and a rerun of tasks whose executor was
    lost, read committed files.  Unlike ``checkpoint()`` the rows are computed
    once and kept compressed.  The write's own shuffle files go when it has ended: nothing
    reads them any more, and else they would stay while later steps fill the disks."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{label}-{uuid.uuid4().hex[:12]}"
    small_batches(spark)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode("errorifexists").option("compression", CODEC).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def frugal(run: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """A task body that gives freed memory back to the system when it ends: idle
    workers stay for later tasks and would keep it."""

    def body(batches: Iterator) -> Iterator:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc has it
            if trim is not None:
                trim(0)

    return body


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string column and the offsets of its rows; null counts as empty."""
    column = column.fill_null("").cast(pa.large_string())
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)), ends


def by_bytes(ends: np.ndarray, limit: int = 1 << 19) -> Iterator[tuple[int, int]]:
    """Row ranges [a, b) of about ``limit`` bytes each; a longer row stands alone."""
    a, n = 0, len(ends) - 1
    while a < n:
        b = max(a + 1, int(np.searchsorted(ends, ends[a] + limit, "right")) - 1)
        yield a, b
        a = b


def mix64(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (the finaliser of splitmix64)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class Polynomial:
    """Prefix hashes of a byte string: any substring's hash in constant time, free of its place."""

    _powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def __init__(self, data: np.ndarray, base: int = BASE):
        n = len(data)
        up, down = self._powers.get(base, (np.empty(0, np.uint64), np.empty(0, np.uint64)))
        if len(up) <= n:
            up, down = (np.multiply.accumulate(np.concatenate((np.ones(1, np.uint64), np.full(n, b, np.uint64))))
                        for b in (base, pow(base, -1, 1 << 64)))
            self._powers[base] = up, down
        self.down = down
        self.sums = np.zeros(n + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=self.sums[1:])

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]
