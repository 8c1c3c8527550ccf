"""Tables laid out by key: a merge rewrites only the key ranges its batch touches.

Rows are split into ranges of the first key column (document numbers grow, so
recent changes fall in few ranges) and, within a range, bucketed by the key.  A
commit lists the ranges: where each starts, its folder, its rows and its mark.

A merge reads the touched ranges only.  They are opened as a bucketed table of
the session's catalog, one partition for each range at its own folder, so Spark
plans the scan pruned to them and joins it without shuffling the target; only
the batch moves.  What comes out is written as new folders, ranges that have
grown past twice their size are split by the quantiles of their keys, and one
commit names the new folders beside the untouched old ones.  The commit is
compare-and-swap (see ``upsert``): a merge that another writer has overtaken is
done again on what that writer left.

Ranges are split by key values, so one value of the first key column, however
many rows it has, stays in one range; its rows still spread over the buckets by
the whole key.
"""

from __future__ import annotations

import datetime as dt
import hashlib
import json
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..sources import store
from .checks import raise_on_duplicates
from .upsert import Commit, CommitConflict, commit_keyed, current_commit

RANGE = "__range"


@dataclass(frozen=True)
class Layout:
    """keys: never NULL, the first one orders the ranges; nullable: further key columns.
    range_rows: rows of a range, about.  buckets: files of a range (0: the session's shuffle partitions)."""

    keys: Sequence[str]
    nullable: Sequence[str] = ()
    range_rows: int = 20_000_000
    buckets: int = 0


def _which(c: Column, ranges: Sequence[dict]) -> Column:
    """Id of the range that holds a key: a balanced tree of comparisons."""
    if len(ranges) == 1:
        return F.lit(ranges[0]["id"])
    half = len(ranges) // 2
    return F.when(c < F.lit(ranges[half]["from"]), _which(c, ranges[:half])).otherwise(_which(c, ranges[half:]))


def open_ranges(spark: SparkSession, table_path: str, commit: Commit) -> DataFrame:
    """The table as of ``commit``, with the id of each row's range as ``RANGE``."""
    keyed = commit.keyed
    schema = StructType.fromJson(keyed["schema"])
    name = "purchlake_" + hashlib.sha1(json.dumps([table_path, keyed]).encode()).hexdigest()[:20]
    if not spark.catalog.tableExists(name):
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        keys = ", ".join(f"`{k}`" for k in keyed["keys"])
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}, `{RANGE}` int) USING parquet PARTITIONED BY (`{RANGE}`) "
                  f"CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {keyed['buckets']} BUCKETS "
                  f"LOCATION '{table_path}/_ranges'")
        places = [f"PARTITION (`{RANGE}` = {r['id']}) LOCATION '{table_path}/{r['path']}'" for r in keyed["ranges"] if r["path"]]
        if places:
            spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {' '.join(places)}")
        spark.sql(f"ANALYZE TABLE {name} COMPUTE STATISTICS NOSCAN")
    return spark.table(name)


def read(spark: SparkSession, table_path: str, commit: Commit) -> DataFrame:
    return open_ranges(spark, table_path, commit).drop(RANGE)


def _same_key(a: DataFrame, b: DataFrame, prefix: str, keyed: dict) -> Column:
    """Equality on the bucketed keys, which the join is planned on; the nullable ones are compared beside it."""
    cond = F.lit(True)
    for k in keyed["keys"]:
        cond = cond & (a[k] == b[prefix + k])
    for k in keyed["nullable"]:
        cond = cond & F.coalesce(a[k] == b[prefix + k], a[k].isNull() & b[prefix + k].isNull())
    return cond


def merged_ranges(spark: SparkSession, table_path: str, commit: Commit, batch: DataFrame, touched: Sequence[int],
                  version: str | None = None, delete_when: Column | None = None) -> DataFrame:
    """The touched ranges with ``batch`` merged in, rows of the batch replacing those of their key."""
    keyed = commit.keyed
    target = open_ranges(spark, table_path, commit).where(F.col(RANGE).isin(list(touched)))
    names = [*keyed["keys"], *keyed["nullable"]]
    if version is not None:
        old = target.select(*[F.col(k).alias(f"__t_{k}") for k in names], F.col(version).alias("__t_version"))
        batch = (batch.join(old, _same_key(batch, old, "__t_", keyed), "left")
                 .where(F.col("__t_version").isNull() | (F.col(version) >= F.col("__t_version"))).select(*batch.columns))
    gone = batch.select(*[F.col(k).alias(f"__b_{k}") for k in names])
    kept = target.join(gone, _same_key(target, gone, "__b_", keyed), "left_anti").drop(RANGE)
    drop = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
    fresh = batch.where(~drop).repartition(keyed["buckets"], *keyed["keys"])
    return kept.unionByName(fresh.select(*kept.columns))


def _starts(keys: DataFrame, pieces: int) -> list[str]:
    """Where ``pieces`` ranges of about equal size start, the first left out."""
    found = (keys.toDF("k").repartitionByRange(pieces, "k").groupBy(F.spark_partition_id()).agg(F.min("k").alias("k"))
             .select("k").collect())
    return sorted({r.k for r in found})[1:]


def _merge_onto(spark: SparkSession, table_path: str, base: Commit | None, layout: Layout, batch: DataFrame,
                version: str | None, delete_when: Column | None, mark_col: str | None, unique: bool) -> None:
    first = layout.keys[0]
    if base is None:
        keyed = {"keys": list(layout.keys), "nullable": list(layout.nullable), "range_rows": layout.range_rows,
                 "buckets": layout.buckets or int(spark.conf.get("spark.sql.shuffle.partitions")),
                 "schema": batch.schema.jsonValue(), "ranges": [{"id": 0, "from": None, "rows": 0, "path": None, "mark": None}]}
    else:
        keyed = base.keyed
    ranges = keyed["ranges"]
    counts = {r[0]: r[1] for r in batch.select(_which(F.col(first), ranges).alias(RANGE)).groupBy(RANGE).count().collect()}
    if base is not None and not counts:
        return
    if base is None:
        drop = F.lit(False) if delete_when is None else F.coalesce(delete_when, F.lit(False))
        out = batch.where(~drop).repartition(keyed["buckets"], *keyed["keys"])
    else:
        out = merged_ranges(spark, table_path, base, batch, sorted(counts), version, delete_when)
    if unique:
        out = raise_on_duplicates(out, [*keyed["keys"], *keyed["nullable"]], table_path)

    taken = max(r["id"] for r in ranges) + 1
    after: list[dict] = []
    for r in ranges:
        if r["id"] not in counts and base is not None:
            after.append(r)
            continue
        rows = r["rows"] + counts.get(r["id"], 0)
        starts = [r["from"]]
        if rows > 2 * keyed["range_rows"]:
            here = batch.where(_which(F.col(first), ranges) == r["id"]).select(first)
            if r["path"]:
                here = here.unionAll(open_ranges(spark, table_path, base).where(F.col(RANGE) == r["id"]).select(first))
            starts += [s for s in _starts(here, -(-rows // keyed["range_rows"])) if r["from"] is None or s > r["from"]]
        for s in starts:
            after.append({"id": taken, "from": s})
            taken += 1

    folder = f"data-{uuid.uuid4().hex[:12]}"
    name = f"purchlake_write_{uuid.uuid4().hex[:12]}"
    (out.withColumn(RANGE, _which(F.col(first), after)).write.partitionBy(RANGE).bucketBy(keyed["buckets"], *keyed["keys"])
     .sortBy(*keyed["keys"]).format("parquet").option("path", f"{table_path}/{folder}").saveAsTable(name))
    try:
        mark = F.max(mark_col) if mark_col else F.lit(None).cast("timestamp_ntz")
        written = {r[RANGE]: r for r in spark.table(name).groupBy(RANGE).agg(F.count("*").alias("rows"), mark.alias("mark")).collect()}
    finally:
        spark.sql(f"DROP TABLE {name}")  # the catalog's entry; the files stay
    for r in after:
        if "path" not in r:
            got = written.get(r["id"])
            r.update(rows=got["rows"] if got else 0, path=f"{folder}/{RANGE}={r['id']}" if got else None,
                     mark=got["mark"].isoformat() if got and got["mark"] else None)
    marks = [dt.datetime.fromisoformat(r["mark"]) for r in after if r["mark"]]
    try:
        commit_keyed(spark, table_path, base, {**keyed, "ranges": after}, max(marks, default=None))
    except CommitConflict:
        store.remove(spark, f"{table_path}/{folder}")
        raise


def merge(spark: SparkSession, table_path: str, layout: Layout, batch: DataFrame, version: str | None = None,
          delete_when: Column | None = None, mark_col: str | None = None, attempts: int = 5,
          overtaken: str | None = None, unique: bool = False) -> None:
    """Upsert ``batch``, a written table (it is read more than once), by ``layout``'s keys.

    A key may have several rows: those of the batch replace all of the table.
    version: a batch row replaces a stored one only if it is not older in this column.
    overtaken: that column for merges done again after another writer's commit.
    unique: the write fails, and nothing is committed, if two of the rows to be written share a key.
    mark_col: its maximum is committed as the table's high-water mark."""
    for left in reversed(range(attempts)):
        base = current_commit(spark, table_path)
        try:
            _merge_onto(spark, table_path, base, layout, batch, version, delete_when, mark_col, unique)
            return
        except CommitConflict:
            if not left:
                raise
            version = version or overtaken
