"""Incremental silver loads as a Structured Streaming query.

The batch pipeline re-reads the feed behind a high-water mark.  As a stream,
the file source hands each new feed file to exactly one micro-batch (its
offsets live in the checkpoint), and ``foreachBatch`` applies the same
silver spec to that batch and upserts the result into the silver table:

    readStream(feed) -> foreachBatch:
        target  = current snapshot of the silver table
        batch   = silver.run(spec, micro-batch)           # guards, top-1, lookups, conform
        merged  = upsert_by_key(target, batch, keys, version)
        write merged as a new snapshot, then commit it

The offsets decide what is new, so a stream slices by no high-water mark: a
late file is merged like any other, and a row replaces the stored one only if
its version (``ingestiontime``) is not older.  The order in which files arrive
and the size of the micro-batches thus do not change the table.

Re-running an epoch after a failure repeats the same upsert, which gives the
same table (the merge is idempotent), so the sink is effectively exactly
once.  The checkpoint location must be on shared storage; by default it is
placed under the session's ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import uuid
from collections.abc import Collection

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..operators import keyed
from ..operators.checks import CheckedLookups, KeyChecks
from ..operators.upsert import (Commit, CommitConflict, current_commit, has_partitions, merge_snapshot, read_commit,
                                upsert_by_key, upsert_partitions, write_snapshot)
from ..plans import silver
from ..session import checkpoint_dir
from ..sources import store


def staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """A batch as a written table: merges read it more than once, and it can be a whole feed."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/batches/{name}-{uuid.uuid4().hex[:12]}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def merge_batch(spark: SparkSession, spec: silver.SilverSpec, batch: DataFrame, table_path: str,
                lookups=None, use_high_water_mark: bool = True, version: str | None = None,
                partition: tuple[str, Column] | None = None, layout: keyed.Layout | None = None,
                first_load: bool = False, unique: Collection[str] = ()) -> str:
    """Apply one micro-batch (or any batch of feed rows) to the silver table.

    layout: keep the table by key ranges and rewrite only those the batch touches.
    partition=(name, expr): keep the table partitioned by ``expr`` (a stable
    function of the business key, e.g. a document-number prefix) and rewrite
    only the partitions the batch touches; without either, every merge writes a
    new snapshot of the whole table.
    Duplicate lookup keys are counted inside the job and logged; in a table by
    layout, rows that share a business key fail the write.
    unique: lookups proven unique in their keys, see ``silver.run``.
    first_load: a table without any commit takes the whole history, rows without
    an ingestion time included (the initial-load variants); else it is read
    behind the mark of an empty table."""
    if partition is not None:
        name, expr = partition
        target = spark.read.parquet(table_path) if has_partitions(spark, table_path, name) else None
        fresh = silver.run(spec, batch, lookups, target=target, initial=not use_high_water_mark, unique=unique)
        upsert_partitions(spark, table_path, fresh.withColumn(name, expr), spec.keys, name, version=version)
        return table_path
    checks = KeyChecks()
    if lookups is not None:
        lookups = CheckedLookups(lookups, silver.LOOKUP_KEYS, checks)
    base = current_commit(spark, table_path)
    if not use_high_water_mark or (first_load and base is None):
        if first_load and base is None:
            spec = silver.initial_form(spec)
        fresh = silver.run(spec, batch, lookups, initial=True, unique=unique)
    else:
        # the committed mark spares a scan of the whole table for max(ingestiontime)
        mark = base and base.mark
        fresh = silver.run(spec, batch, lookups, target=None if mark else read_commit(spark, table_path, base), mark=mark,
                           unique=unique)
    if layout is None and base is None:
        try:
            path = write_snapshot(fresh, table_path, mark_col="ingestiontime", base=None)
            checks.warn(spec.name)
            return path
        except CommitConflict:
            pass  # another writer made the table meanwhile: merge into it
    rows, folder = staged(fresh, spec.name)
    checks.warn(spec.name)
    if layout is not None:
        keyed.merge(spark, table_path, layout, rows, version=version, mark_col="ingestiontime", overtaken="ingestiontime",
                    unique=spec.keeps_key())
    else:
        def merged(now: DataFrame, commit: Commit) -> DataFrame:
            overtaken = base is None or commit.number != base.number
            return upsert_by_key(now, rows, spec.keys, version=version or ("ingestiontime" if overtaken else None))

        merge_snapshot(spark, table_path, merged, mark_col="ingestiontime")
    store.remove(spark, folder)
    return table_path


def start(spark: SparkSession, spec: silver.SilverSpec, feed_path: str, table_path: str,
          lookups=None, checkpoint_location: str | None = None, available_now: bool = True,
          processing_time: str | None = None, max_files_per_trigger: int | None = None,
          use_high_water_mark: bool = False, version: str | None = "ingestiontime",
          partition: tuple[str, Column] | None = None, layout: keyed.Layout | None = None) -> StreamingQuery:
    """Start the streaming load of one silver table from a parquet feed directory."""
    schema = spark.read.parquet(feed_path).schema
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    stream = reader.parquet(feed_path)
    ckpt = checkpoint_location or f"{checkpoint_dir(spark).rstrip('/')}/streams/{spec.name}"

    def process(batch: DataFrame, epoch_id: int) -> None:
        merge_batch(spark, spec, batch, table_path, lookups, use_high_water_mark, version, partition, layout)

    writer = stream.writeStream.foreachBatch(process).option("checkpointLocation", ckpt)
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()
