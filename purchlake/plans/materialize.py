"""Materialised intermediate tables in the shared checkpoint folder.

The marts read silver *tables*, not silver plans: a silver table is written
once (parquet, in the folder named by ``spark.checkpoint.dir``) and every
mart that needs it scans the written files.  That cuts the lineage (a lost
executor re-reads files instead of re-running the feed dedup), lets
column pruning and filter pushdown reach the silver scan, and stops a mart
that uses one silver table twice from computing it twice.

The path is keyed by the input directory, the names, sizes and modification
times of its files (listed through the session's file system, whatever the
scheme), the table name and a digest of the library's code.  Changed inputs or
a changed definition thus get a table of their own; a table is read only if
its write was committed.

A write drops its shuffle files when it has ended: nothing reads them any more, and
they would else lie beside those of the mart until the driver happens to collect its garbage.
"""

from __future__ import annotations

import functools
import hashlib
import pathlib
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..session import checkpoint_dir
from ..sources import store

#: Lets a query drop its shuffle files when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Of tables and steps in the shared folder; about a quarter less than with the default.
CODEC = "zstd"

_PACKAGE = pathlib.Path(__file__).resolve().parents[1]


@functools.cache
def _code_digest() -> str:
    h = hashlib.sha1()
    for folder in ("functions", "operators", "plans", "sources", "."):
        for p in sorted((_PACKAGE / folder).glob("*.py")):
            h.update(p.read_bytes())
    return h.hexdigest()


def table_dir(spark: SparkSession, sf_dir: str, name: str, inputs: list | None = None) -> str:
    """Folder of the table ``name`` for the inputs as they are now (or as listed in ``inputs``)."""
    inputs = store.files(spark, sf_dir) if inputs is None else inputs
    key = hashlib.sha1(repr((sf_dir, name, inputs, _code_digest())).encode()).hexdigest()[:16]
    return f"{checkpoint_dir(spark).rstrip('/')}/purchlake-tables/{name}-{key}"


def write(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Write ``df`` packed, and drop the write's shuffle files."""
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.mode(mode).option("compression", CODEC).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)


def stored(df: DataFrame, label: str) -> DataFrame:
    """A step of a query, written to the shared folder and read back: its shuffle files are gone before the
    next step shuffles.  The folder is not removed, as the result may be read later."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/purchlake-steps/{label}-{uuid.uuid4().hex[:12]}"
    write(df, path, "errorifexists")
    return spark.read.schema(df.schema).parquet(path)


def materialized(spark: SparkSession, build: Callable[[], DataFrame], sf_dir: str, name: str,
                 inputs: list | None = None) -> DataFrame:
    """Read the table if it was written, else build, write, read."""
    path = table_dir(spark, sf_dir, name, inputs)
    if not store.exists(spark, f"{path}/_SUCCESS"):  # written only after the job commit
        write(build(), path)
    return spark.read.parquet(path)
