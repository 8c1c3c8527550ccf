"""What incremental loads have missed is found by digests and merged once more."""

import datetime as dt
import random

from pyspark.sql import functions as F

from purchlake.functions import ntz
from purchlake.operators.reconcile import differing_buckets, digests, reconcile
from purchlake.operators.upsert import read_table
from purchlake.plans import silver
from purchlake.plans.pipeline import layout_of, repair
from purchlake.sources import FEEDS, Lookups, Tables
from purchlake.streaming import merge_batch

SF = "/root/testdata/sf0.001"
DAY = dt.datetime(2024, 1, 1)
SCHEMA = "k string, p string, t timestamp_ntz"


def test_against_dictionaries(spark):
    rng = random.Random(3)
    keys = [(f"k{i}", rng.choice(["a", "b", None])) for i in range(400)] + [(None, None), (None, "a"), ("a", None)]
    feed = {k: rng.choice([None, *(DAY + dt.timedelta(hours=h) for h in range(9))]) for k in keys}
    table = dict(feed)
    for k in rng.sample(keys, 12):
        del table[k]
    for k in rng.sample(sorted(table, key=str), 9):
        table[k] = rng.choice([None, DAY - dt.timedelta(days=1)])
    table[("more", None)] = DAY
    want = {(*k, feed.get(k), table.get(k), "extra" if k not in feed else "missing" if k not in table else "stale")
            for k in feed.keys() | table.keys() if k not in feed or k not in table or feed[k] != table[k]}
    a, b = (spark.createDataFrame([(*k, t) for k, t in d.items()], SCHEMA) for d in (feed, table))
    for buckets in (1, 64, 4096):
        assert set(map(tuple, reconcile(a, b.repartition(3), ["k", "p"], "t", buckets).collect())) == want
    assert differing_buckets(a, b, ["k", "p"], "t").count() <= len(want)
    assert reconcile(a, a.repartition(5), ["k", "p"], "t").isEmpty()
    assert reconcile(a.limit(0), a.limit(0), ["k", "p"], "t").isEmpty()


def test_digests_tell_null_places_apart(spark):
    rows = [[("a", None, DAY)], [(None, "a", DAY)], [("a", None, None)], [("a", None, DAY)] * 2]
    seen = {tuple(r)[1:] for one in rows for r in digests(spark.createDataFrame(one, SCHEMA), ["k", "p"], "t", 1).collect()}
    assert len(seen) == 4


def test_only_differing_buckets_are_joined(spark):
    a = spark.range(2000).select(F.col("id").cast("string").alias("k"), F.lit("x").alias("p"), F.lit(DAY).cast("timestamp_ntz").alias("t"))
    b = a.where("k <> '77'")
    df = reconcile(a, b, ["k", "p"], "t", 512)
    assert [tuple(r)[:2] for r in df.collect()] == [("77", "x")]
    assert differing_buckets(a, b, ["k", "p"], "t", 512).count() == 1
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "LeftSemi" in plan


def test_repair_of_a_table(spark, scratch):
    """Two runs with late arrivals, then the repair: the table is what one run over all gives."""
    t = Tables(spark, SF)
    lk = Lookups(spark, t)
    name = "silver_mm_zimmpurgdocitem"
    spec, cut, table = silver.spec_for(name), ntz(dt.datetime(1998, 6, 1)), f"{scratch}/t"
    feed = FEEDS[spec.feed](t)
    sizes = {"range_rows": 800, "buckets": 3}
    early = feed.where((F.col("ingestiontime") < cut) & (F.col("changesequence") % 9 != 0))
    merge_batch(spark, spec, early, table, lk, layout=layout_of(spec, **sizes), first_load=True)
    merge_batch(spark, spec, feed, table, lk, layout=layout_of(spec, **sizes), first_load=True)
    want = silver.run(silver.initial_form(spec), feed, lk, initial=True).drop(silver.AUDIT)
    held = read_table(spark, table).drop(silver.AUDIT)
    missing = want.exceptAll(held).count()
    assert missing > 0
    assert repair(spark, name, feed, table, lk, **sizes) == missing
    held = read_table(spark, table).drop(silver.AUDIT)
    assert held.count() == want.count() and want.exceptAll(held).isEmpty()
    assert repair(spark, name, feed, table, lk, **sizes) == 0
