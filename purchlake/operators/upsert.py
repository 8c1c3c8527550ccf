"""Keyed upsert of a batch into a target table without a row-level format.

The result is ``target`` minus the rows whose key appears in ``batch``,
plus ``batch``: a left-anti join and a union.  Both sides are shuffled once
on the key (or the batch is broadcast when AQE measures it as small), and
no row of the target is ever collected anywhere.

A table is a folder of snapshots and numbered commits.  A write first puts
down a whole snapshot, then one commit file that names the snapshot *and*
its high-water mark; the commit appears at once, by a rename.  The commit
with the highest number is the table.  A job that dies before its commit
leaves the previous commit in force, and a re-run is idempotent.  A commit takes
the number after the one its content was derived from, in one step that fails if
that number is taken: of two writers, one merges again or fails.  A table
counts as new only if its commit folder is proven absent: any other failure
to read it is raised.
"""

from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..sources import store

COMMITS = "_commits"
#: Commits whose snapshots stay readable; older ones are removed after a write.
KEPT = 3


def upsert_by_key(target: DataFrame | None, batch: DataFrame, keys: Sequence[str],
                  version: str | None = None, delete_when: Column | None = None,
                  null_safe: bool = True) -> DataFrame:
    """Merge ``batch`` into ``target`` by ``keys``.

    version:     when set, a batch row replaces a target row only if its
                 ``version`` is not older (guards out-of-order replays).
    delete_when: batch rows matching it remove the key instead of writing it.
    null_safe:   NULL key parts match each other (nullable key columns).
    """
    drop = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    if target is None:
        return batch.where(~drop)
    b = batch
    if version is not None:
        # the target holds one row per key, so this join cannot multiply rows
        tv = target.select(*[F.col(k).alias(f"__t_{k}") for k in keys], F.col(version).alias("__tv"))
        cond = _and([(F.col(k).eqNullSafe(F.col(f"__t_{k}")) if null_safe else F.col(k) == F.col(f"__t_{k}"))
                     for k in keys])
        b = (b.join(tv, cond, "left")
              .where(F.col("__tv").isNull() | (F.col(version) >= F.col("__tv")))
              .select(*batch.columns))
    bk = b.select(*keys)
    kept = target.join(bk, _eq(target, bk, keys, null_safe), "left_anti")
    return kept.unionByName(b.where(~drop).select(*target.columns))


def _and(conds: list[Column]) -> Column:
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def _eq(left: DataFrame, right: DataFrame, keys: Sequence[str], null_safe: bool) -> Column:
    return _and([left[k].eqNullSafe(right[k]) if null_safe else left[k] == right[k] for k in keys])


class Commit(NamedTuple):
    number: int
    snapshot: str | None
    mark: dt.datetime | None
    keyed: dict | None = None  # ranges of a table laid out by key, see ``keyed``

    def folders(self) -> set[str]:
        return {r["path"] for r in self.keyed["ranges"] if r["path"]} if self.keyed else {self.snapshot}


def _commits(spark: SparkSession, table_path: str) -> list[str]:
    folder = f"{table_path}/{COMMITS}"
    if not store.exists(spark, folder):
        return []
    return [n for n in store.names(spark, folder) if n.endswith(".json") and not n.startswith(".")]


def _read_commit(spark: SparkSession, table_path: str, name: str) -> Commit:
    got = json.loads(store.read_text(spark, f"{table_path}/{COMMITS}/{name}"))
    mark = got["mark"] and dt.datetime.fromisoformat(got["mark"])
    return Commit(int(name.removesuffix(".json")), got["snapshot"], mark, got.get("keyed"))


def current_commit(spark: SparkSession, table_path: str) -> Commit | None:
    """The commit in force, or None for a table never written."""
    found = _commits(spark, table_path)
    return _read_commit(spark, table_path, found[-1]) if found else None


def read_commit(spark: SparkSession, table_path: str, commit: Commit | None) -> DataFrame | None:
    """The table as of ``commit``; None for a table never written."""
    if commit is not None and commit.keyed:
        from .keyed import read
        return read(spark, table_path, commit)
    return None if commit is None else spark.read.parquet(f"{table_path}/{commit.snapshot}")


def read_table(spark: SparkSession, table_path: str) -> DataFrame | None:
    return read_commit(spark, table_path, current_commit(spark, table_path))


def read_mark(spark: SparkSession, table_path: str) -> dt.datetime | None:
    """High-water mark committed with the table, or None."""
    commit = current_commit(spark, table_path)
    return commit and commit.mark


class CommitConflict(FileExistsError):
    """The table has moved on since the commit that a write was derived from."""


def write_snapshot(df: DataFrame, table_path: str, partition_by: Sequence[str] = (),
                   mark_col: str | None = None, base: Commit | None | str = "unread") -> str:
    """Write ``df`` as a new snapshot, then commit it.

    mark_col: its maximum, observed while the snapshot is written, is
    committed as the high-water mark, so the next incremental run needs no
    scan of the table to find it.
    base: the commit ``df`` was derived from (None: a table never written).  The
    write takes the number after it, so a commit made since then by another
    writer makes this one fail with ``CommitConflict``, and nothing changes.
    Left out, ``df`` replaces whatever the table holds."""
    spark = df.sparkSession
    before = current_commit(spark, table_path) if base == "unread" else base
    number = before.number + 1 if before else 1
    name = f"snap-{number:012d}-{uuid.uuid4().hex[:8]}"
    seen = Observation()
    out = df.observe(seen, F.max(mark_col).alias("mark")) if mark_col else df
    w = out.write.mode("errorifexists")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(f"{table_path}/{name}")
    mark = seen.get["mark"] if mark_col else None
    try:
        _put(spark, table_path, number, {"snapshot": name, "mark": mark and mark.isoformat()})
    except CommitConflict:
        store.remove(spark, f"{table_path}/{name}")
        raise
    _forget(spark, table_path)
    return f"{table_path}/{name}"


def _put(spark: SparkSession, table_path: str, number: int, content: dict) -> None:
    try:
        store.create_text(spark, f"{table_path}/{COMMITS}/{number:012d}.json", json.dumps(content))
    except FileExistsError as e:
        raise CommitConflict(f"{table_path}: commit {number} was made by another writer") from e


def commit_keyed(spark: SparkSession, table_path: str, base: Commit | None, keyed: dict, mark: dt.datetime | None) -> None:
    """Commit ranges derived from ``base``; ``CommitConflict`` if the table has moved on."""
    _put(spark, table_path, base.number + 1 if base else 1, {"snapshot": None, "mark": mark and mark.isoformat(), "keyed": keyed})
    _forget(spark, table_path)


def merge_snapshot(spark: SparkSession, table_path: str, merge: Callable[[DataFrame | None, Commit | None], DataFrame],
                   mark_col: str | None = None, attempts: int = 5) -> str:
    """Write ``merge(table, its commit)``, compare-and-swap: where another writer has committed since the table
    was read, the merge is done again on what it left; after ``attempts`` the conflict is raised."""
    for left in reversed(range(attempts)):
        base = current_commit(spark, table_path)
        try:
            return write_snapshot(merge(read_commit(spark, table_path, base), base), table_path, mark_col=mark_col, base=base)
        except CommitConflict:
            if not left:
                raise
    raise ValueError("attempts must be at least 1")


def _forget(spark: SparkSession, table_path: str) -> None:
    """Remove what only commits beyond the last KEPT refer to, commit file first."""
    found = _commits(spark, table_path)
    if len(found) <= KEPT:
        return
    used = set().union(*(_read_commit(spark, table_path, name).folders() for name in found[-KEPT:]))
    for name in found[:-KEPT]:
        old = _read_commit(spark, table_path, name)
        store.remove(spark, f"{table_path}/{COMMITS}/{name}")
        for folder in old.folders() - used:
            store.remove(spark, f"{table_path}/{folder}")


def upsert_partitions(spark: SparkSession, table_path: str, batch: DataFrame, keys: Sequence[str],
                      partition_col: str, version: str | None = None) -> None:
    """Upsert ``batch`` into a parquet table partitioned by ``partition_col``,
    rewriting only the partitions the batch touches.

    ``partition_col`` must be a stable function of the key (every version of a
    key lands in the same partition), e.g. a document-number prefix, so
    recent changes concentrate in few partitions, or a hash bucket.

    touched partitions (one value each, so no more than the table has or
    gets) -> read only those, by a partition filter -> merge -> checkpoint into
    the shared checkpoint folder (cuts the lineage to the files about to be
    replaced) -> dynamic partition overwrite.  Each key lives in one partition,
    so a failure part-way leaves every key either old or new, and re-running
    the batch is idempotent.
    """
    if not has_partitions(spark, table_path, partition_col):
        merged = batch
    else:
        from ..session import checkpoint_dir
        checkpoint_dir(spark)  # the shared folder named by spark.checkpoint.dir
        merged = upsert_by_key(affected_partitions(spark, table_path, batch, partition_col),
                               batch, keys, version=version).checkpoint(eager=True)
    (merged.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(table_path))


def has_partitions(spark: SparkSession, table_path: str, partition_col: str) -> bool:
    """Whether the table was ever written: it is proven absent, or its top folder is listed."""
    return store.exists(spark, table_path) and any(
        n.startswith(f"{partition_col}=") for n in store.names(spark, table_path))


def affected_partitions(spark: SparkSession, table_path: str, batch: DataFrame, partition_col: str) -> DataFrame:
    """The rows of the table in partitions that ``batch`` touches; the scan is pruned to those."""
    # the batch's schema also types the partition column: left to inference,
    # a value such as '00000000' would come back as an integer
    current = spark.read.schema(batch.schema).parquet(table_path)
    touched = [r[0] for r in batch.select(partition_col).distinct().collect()]
    part = F.col(partition_col)
    keep = part.isin([v for v in touched if v is not None])
    return current.where(keep | part.isNull() if None in touched else keep).select(*batch.columns)
