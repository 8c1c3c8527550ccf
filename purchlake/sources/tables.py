"""Readers for the driver tables (one parquet file/dir per table)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
                 "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

# Fact tables whose rows feed per-row projections and windows.
FACT_TABLES = {"lineitem", "orders", "events"}
SCAN_PARTITIONS = "spark.purchlake.scanPartitions"
SPLIT_BYTES, SPLIT_LIMIT = "spark.sql.files.maxPartitionBytes", 16 << 20


def small_splits(spark: SparkSession) -> None:
    """Bound what a scan task reads: feeds widen and multiply the compressed rows, and the map side of a top-1
    sorts them in the task's memory.  Row groups are never split.  A session's own setting is left as it is."""
    if SPLIT_BYTES not in spark.conf.getAll:
        spark.conf.set(SPLIT_BYTES, str(SPLIT_LIMIT))


def table_path(sf_dir: str, name: str) -> str:
    return f"{sf_dir.rstrip('/')}/{name}.parquet"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Parquet scan; later projections and filters are pushed into it.

    Input layout belongs to whoever writes the files; splits are kept small (``small_splits``).  Only where the session
    sets ``spark.purchlake.scanPartitions`` (say, a test machine with each
    table in one row group) are fact tables dealt to that many partitions."""
    small_splits(spark)
    df = spark.read.parquet(table_path(sf_dir, name))
    deal = spark.conf.get(SCAN_PARTITIONS, None)
    return df.repartition(int(deal)) if deal and name in FACT_TABLES else df


class Tables:
    """Lazy accessor: ``Tables(spark, sf_dir).lineitem``."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self._cache: dict[str, DataFrame] = {}

    def __getattr__(self, name: str) -> DataFrame:
        if name in DRIVER_TABLES:
            if name not in self._cache:
                self._cache[name] = read(self.spark, self.sf_dir, name)
            return self._cache[name]
        raise AttributeError(name)
