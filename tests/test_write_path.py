"""Commits that survive a crash at any step, streams that lose no rows, clocks without zones."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from purchlake import streaming
from purchlake.functions import ntz
from purchlake.functions.scalar import parse_compact_ts
from purchlake.operators import upsert
from purchlake.operators.upsert import read_mark, read_table, upsert_by_key, write_snapshot
from purchlake.plans import silver
from purchlake.plans.materialize import materialized, table_dir
from purchlake.sources import FEEDS, Lookups, Tables, store

SF = "/root/testdata/sf0.001"
CUT = dt.datetime(1998, 1, 1)


def same(a, b):
    b = b.select(*a.columns)
    return a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty()


@pytest.mark.parametrize("step", ["before the snapshot", "after the snapshot", "after the commit"])
def test_load_stopped_at_any_step_and_rerun(spark, scratch, monkeypatch, step):
    spec = silver.spec_for("silver_mm_zipritem")
    feed = FEEDS[spec.feed](Tables(spark, SF))
    table = f"{scratch}/t"
    streaming.merge_batch(spark, spec, feed.where(F.col("ingestiontime") < ntz(CUT)), table)
    before, mark = read_table(spark, table).count(), read_mark(spark, table)

    def stop(*_, **__):
        raise RuntimeError("stopped")

    with monkeypatch.context() as m:
        if step == "before the snapshot":
            m.setattr(silver, "run", stop)
        elif step == "after the snapshot":
            m.setattr(store, "create_text", stop)
        else:
            m.setattr(upsert, "_forget", stop)
        with pytest.raises(RuntimeError):
            streaming.merge_batch(spark, spec, feed, table)
    if step != "after the commit":
        assert read_table(spark, table).count() == before and read_mark(spark, table) == mark
    streaming.merge_batch(spark, spec, feed, table)
    assert same(read_table(spark, table).drop(silver.AUDIT), silver.run(spec, feed).drop(silver.AUDIT))


def test_unreadable_commit_is_no_empty_table(spark, scratch):
    table = f"{scratch}/t"
    df = spark.range(5)
    write_snapshot(df, table)
    assert read_table(spark, f"{scratch}/never") is None
    store.create_text(spark, f"{table}/_commits/000000000002.json", "{ not json")
    with pytest.raises(ValueError):
        read_table(spark, table)
    with pytest.raises(ValueError):
        write_snapshot(df, table)


def test_two_writers_of_one_number(spark, scratch, monkeypatch):
    table = f"{scratch}/t"
    write_snapshot(spark.range(1), table)
    stale = upsert.current_commit(spark, table)
    write_snapshot(spark.range(2), table)
    monkeypatch.setattr(upsert, "current_commit", lambda *_: stale)
    with pytest.raises(FileExistsError):
        write_snapshot(spark.range(3), table)
    monkeypatch.undo()
    assert read_table(spark, table).count() == 2


def test_old_snapshots_are_removed(spark, scratch):
    table = f"{scratch}/t"
    for n in range(6):
        write_snapshot(spark.range(n + 1), table)
    left = [x for x in store.names(spark, table) if x.startswith("snap-")]
    assert len(left) == upsert.KEPT and read_table(spark, table).count() == 6


def test_delete_removes_keys_of_the_batch_only(spark):
    target = spark.createDataFrame([(1, "x"), (2, "gone"), (3, "gone")], "k int, v string")
    batch = spark.createDataFrame([(2, "gone"), (4, "y")], "k int, v string")
    got = upsert_by_key(target, batch, ["k"], delete_when=F.col("v") == "gone")
    assert sorted(map(tuple, got.collect())) == [(1, "x"), (3, "gone"), (4, "y")]


def test_stream_with_late_files_keeps_every_row(spark, scratch):
    """Newer file first, one file per micro-batch."""
    t = Tables(spark, SF)
    lk = Lookups(spark, t)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")
    feed = FEEDS[spec.feed](t)
    feed_dir, table = f"{scratch}/feed", f"{scratch}/t"
    feed.where(F.col("ingestiontime") >= ntz(CUT)).coalesce(1).write.parquet(feed_dir)
    feed.where(F.col("ingestiontime") < ntz(CUT)).coalesce(1).write.mode("append").parquet(feed_dir)
    streaming.start(spark, spec, feed_dir, table, lk, checkpoint_location=f"{scratch}/ckpt",
                    max_files_per_trigger=1).awaitTermination(300)
    assert upsert.current_commit(spark, table).number >= 2
    assert same(read_table(spark, table).drop(silver.AUDIT), silver.run(spec, feed, lk).drop(silver.AUDIT))


def test_touched_partitions_prune_the_scan(spark, scratch):
    path = f"{scratch}/t"
    df = spark.range(1000).select("id", (F.col("id") % 50).cast("string").alias("p"), F.lit(1).alias("v"))
    upsert.upsert_partitions(spark, path, df, ["id"], "p")
    for batch in (df.where("p = '7'"), spark.createDataFrame([(7, "7", 2)], df.schema)):
        plan = upsert.affected_partitions(spark, path, batch, "p")._jdf.queryExecution().executedPlan().toString()
        assert "PartitionFilters: [" in plan and "PartitionFilters: []" not in plan
    assert not upsert.has_partitions(spark, f"{scratch}/never", "p")


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_compact_timestamps_pass_no_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        text = ["20240310023000", "20241103013000", "20240230000000", "2024031002300", "20240310023060", "", None,
                "00000101000000", "2024 310023000"]
        df = spark.createDataFrame([(x,) for x in text], "s string")
        got = [str(r[0]) for r in df.select(parse_compact_ts("s").cast("string")).collect()]
        assert got == ["2024-03-10 02:30:00", "2024-11-03 01:30:00"] + ["None"] * 7
        good = df.where(F.col("s").isin(text[:2]))
        assert same(good.select(parse_compact_ts("s").alias("t")), good.select(parse_compact_ts("s", True).alias("t")))
        assert dict(good.select(parse_compact_ts("s").alias("t")).dtypes)["t"] == "timestamp_ntz"
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_error_policy_reaches_dates(spark):
    spec = silver.spec_for("silver_mm_zimmprgdocsl")
    feed = FEEDS[spec.feed](Tables(spark, SF))
    assert silver.run(spec, feed).where("schedulelinedeliverydate is null").count() > 0
    with pytest.raises(PySparkException):
        silver.run(spec, feed, on_error="fail").write.format("noop").mode("overwrite").save()


def test_materialised_table_follows_its_input(spark, scratch):
    src = f"file://{scratch}/in"
    spark.range(3).write.parquet(f"{src}/a.parquet")
    build = lambda: spark.read.parquet(f"{src}/a.parquet")
    first = table_dir(spark, src, "a")
    assert materialized(spark, build, src, "a").count() == 3 and table_dir(spark, src, "a") == first
    spark.range(5).write.mode("overwrite").parquet(f"{src}/a.parquet")
    assert table_dir(spark, src, "a") != first
    assert materialized(spark, build, src, "a").count() == 5


def test_scans_deal_no_rows_out(spark):
    plan = Tables(spark, SF).lineitem._jdf.queryExecution().executedPlan().toString()
    assert "RoundRobin" not in plan and "Exchange" not in plan
