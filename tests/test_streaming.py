"""Two feed drops streamed into a silver table equal one batch load."""

import datetime as dt

from pyspark.sql import functions as F

from purchlake import streaming
from purchlake.functions import ntz
from purchlake.operators.upsert import read_table
from purchlake.plans import silver
from purchlake.sources import FEEDS, Lookups, Tables

SF = "/root/testdata/sf0.001"
CUT = dt.datetime(1998, 1, 1)


def test_stream_two_drops_equals_batch(spark, scratch):
    t = Tables(spark, SF)
    lk = Lookups(spark, t)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")
    feed = FEEDS[spec.feed](t)
    feed_dir, table = f"{scratch}/feed", f"{scratch}/silver_items"
    feed.where(F.col("ingestiontime") < ntz(CUT)).write.parquet(feed_dir)
    q = streaming.start(spark, spec, feed_dir, table, lk, checkpoint_location=f"{scratch}/ckpt")
    q.awaitTermination(300)
    first = read_table(spark, table).count()
    feed.where(F.col("ingestiontime") >= ntz(CUT)).write.mode("append").parquet(feed_dir)
    q = streaming.start(spark, spec, feed_dir, table, lk, checkpoint_location=f"{scratch}/ckpt")
    q.awaitTermination(300)
    got = read_table(spark, table).drop(silver.AUDIT)
    want = silver.run(spec, feed, lk).drop(silver.AUDIT)
    assert first > 0
    assert got.count() == want.count()
    assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0


def test_rerun_of_a_batch_is_idempotent(spark, scratch):
    t = Tables(spark, SF)
    spec = silver.spec_for("silver_mm_zipritem")
    feed = FEEDS[spec.feed](t)
    table = f"{scratch}/silver_pr"
    streaming.merge_batch(spark, spec, feed, table)
    once = read_table(spark, table).drop(silver.AUDIT)
    streaming.merge_batch(spark, spec, feed, table)
    twice = read_table(spark, table).drop(silver.AUDIT)
    assert once.count() == twice.count()
    assert once.exceptAll(twice).count() == 0


def test_partitioned_merges_equal_batch(spark, scratch):
    from purchlake.session import checkpoint_dir
    checkpoint_dir(spark)
    t = Tables(spark, SF)
    lk = Lookups(spark, t)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")
    feed = FEEDS[spec.feed](t)
    table = f"{scratch}/items_by_prefix"
    part = ("docprefix", F.substring("purchasingdocument", 1, 8))
    streaming.merge_batch(spark, spec, feed.where(F.col("ingestiontime") < ntz(CUT)), table, lk, partition=part)
    streaming.merge_batch(spark, spec, feed.where(F.col("ingestiontime") >= ntz(CUT)), table, lk, partition=part)
    got = spark.read.parquet(table).drop(silver.AUDIT, "docprefix")
    want = silver.run(spec, feed, lk).drop(silver.AUDIT)
    assert got.count() == want.count()
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_stored_mark_tracks_the_table_max(spark, scratch):
    from purchlake.operators.upsert import read_mark
    t = Tables(spark, SF)
    spec = silver.spec_for("silver_mm_zipritem")
    feed = FEEDS[spec.feed](t)
    table = f"{scratch}/silver_pr_mark"
    streaming.merge_batch(spark, spec, feed.where(F.col("ingestiontime") < ntz(CUT)), table)
    streaming.merge_batch(spark, spec, feed.where(F.col("ingestiontime") >= ntz(CUT)), table)
    got = read_table(spark, table)
    assert read_mark(spark, table) == got.agg(F.max("ingestiontime")).first()[0]
    want = silver.run(spec, feed).drop(silver.AUDIT)
    assert got.drop(silver.AUDIT).exceptAll(want).count() == 0 and got.count() == want.count()
