"""Edge cases of the operators on tiny in-memory frames."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from pyspark.sql import Window
from pyspark.sql import Window
from pyspark.sql import functions as F

from purchlake.functions import (late_days, parse_compact_date, parse_compact_ts, remaining_qty, safe_ratio,
                                 substr_from, uom_to_target, concat_strict, null_or_empty_flag)
from purchlake.operators import (Field, conform, hot_keys, latest_per_key, lookup, preferred_match, signed_sum, since,
                                 upsert_by_key)
from purchlake.operators.checks import duplicate_keys, fan_out_report

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows(df, *cols):
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=lambda t: tuple((x is None, x) for x in t))


def test_latest_per_key_one_row_per_key_with_tie_breaker(spark):
    df = spark.createDataFrame(
        [("a", T0, 1, "old"), ("a", T0 + dt.timedelta(hours=1), 1, "new"), ("a", T0 + dt.timedelta(hours=1), 2, "newer"),
         ("b", T0, 1, "only"), (None, T0, 1, "n1"), (None, T0 + dt.timedelta(days=1), 1, "n2")],
        "k string, ts timestamp, seq int, v string")
    out = latest_per_key(df, ["k"], [F.desc("ts")], [F.desc("seq")])
    assert {r.k: r.v for r in out.collect()} == {"a": "newer", "b": "only", None: "n2"}
    assert out.count() == 3


def test_latest_per_key_plans_a_partial_group_limit(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("k"), F.col("id").alias("ts"))
    with pytest.raises(ValueError):
        latest_per_key(df, ["k"], [F.desc("ts")], [])
    plan = latest_per_key(df, ["k"], [], [F.desc("ts")])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_since_empty_target_uses_floor_and_is_inclusive(spark):
    feed = spark.createDataFrame([(1, T0), (2, None), (3, dt.datetime(1899, 12, 31, 18, 0))], "id int, ingestiontime timestamp")
    empty = feed.limit(0)
    assert rows(since(feed, empty), "id") == [(1,), (3,)]          # NULL timestamp dropped, boundary kept
    assert rows(since(feed, None), "id") == [(1,), (2,), (3,)]     # initial load keeps everything
    target = spark.createDataFrame([(T0 + dt.timedelta(hours=6),)], "ingestiontime timestamp")
    assert rows(since(feed, target), "id") == [(1,)]               # ts == max - 6h is kept
    assert rows(since(feed, target, mode="literal"), "id") == [(1,)]


def test_lookup_keeps_left_rows_under_right_and_left_predicates(spark):
    left = spark.createDataFrame([(1, "R"), (2, None), (3, "X")], "k int, code string")
    dim = spark.createDataFrame([(1, "EA", "one"), (1, "KG", "uno"), (3, "EA", "three")], "k int, unit string, name string")
    out = lookup(left, dim, [("k", "k")], {"name": "name"}, where=F.col("unit") == "EA",
                 gate=F.col("code") == "R")
    assert rows(out, "k", "name") == [(1, "one"), (2, None), (3, None)]


def test_chained_lookup_misses_propagate(spark):
    left = spark.createDataFrame([(1,), (2,)], "k int")
    d1 = spark.createDataFrame([(1, 10)], "k int, k2 int")
    d2 = spark.createDataFrame([(10, "x")], "k2 int, v string")
    out = lookup(lookup(left, d1, [("k", "k")], {"k2": "k2"}), d2, [("k2", "k2")], {"v": "v"})
    assert rows(out, "k", "v") == [(1, "x"), (2, None)]


def test_signed_sum_null_rules(spark):
    df = spark.createDataFrame(
        [("g1", "101", "S", Decimal("5")), ("g1", "101", "H", Decimal("2")), ("g1", "122", "S", Decimal("9")),
         ("g2", "122", "S", Decimal("4")),                       # only non-matching -> 0
         ("g3", "101", "S", None)],                               # matching NULL -> NULL
        "g string, t string, dc string, q decimal(18,3)")
    out = df.groupBy("g").agg(signed_sum("q", F.col("t").isin("101", "102"), F.col("dc") == "H").alias("s"))
    got = {r.g: r.s for r in out.collect()}
    assert got == {"g1": Decimal("3.000"), "g2": Decimal("0.000"), "g3": None}


def test_measures_edge_cases(spark):
    df = spark.createDataFrame(
        [(Decimal("10.00"), Decimal("0"), None, None, None),
         (Decimal("10.00"), None, Decimal("3"), "X", dt.date(2024, 1, 5)),
         (Decimal("10.00"), Decimal("4"), Decimal("12"), None, None)],
        "amt decimal(18,2), per decimal(18,3), ordered decimal(18,3), flag string, receipt date")
    out = df.select(safe_ratio("amt", "per").alias("p"),
                    remaining_qty("ordered", F.lit(Decimal("5")), "flag").alias("rq"),
                    late_days(F.lit(None).cast("date"), "receipt").alias("late")).collect()
    assert [r.p for r in out] == [None, None, Decimal("2.5000")]
    assert [r.rq for r in out] == [None, 0, Decimal("7.000")]     # NULL ordered stays NULL, delivered -> 0
    assert [r.late for r in out] == [0, None, 0]                  # receipt without due date -> NULL


def test_uom_fallback_to_grams(spark):
    df = spark.createDataFrame([(Decimal("2500"), "G"), (Decimal("7"), "EA")], "q decimal(18,3), unit string")
    n = F.lit(None).cast("decimal(18,3)")
    out = df.select(uom_to_target("q", n, n, n, n, fallback=("unit", "G", 1000)).alias("kg")).collect()
    assert [r.kg for r in out] == [Decimal("2.500"), None]


def test_parsers_are_tolerant_and_strict_mode_fails(spark):
    df = spark.createDataFrame([("20240229", "123456"), ("00000000", "000000"), ("", "1")], "d string, t string")
    out = df.select(parse_compact_date("d").alias("d"), parse_compact_ts(concat_strict("d", "t")).alias("ts")).collect()
    assert out[0].d == dt.date(2024, 2, 29) and out[0].ts == dt.datetime(2024, 2, 29, 12, 34, 56)
    assert out[1].d is None and out[1].ts is None and out[2].d is None
    with pytest.raises(Exception):
        df.select(parse_compact_date("d", strict=True)).collect()


def test_scalar_helpers(spark):
    df = spark.createDataFrame([("0000012345", None), ("0012", "")], "s string, flag string")
    out = df.select(substr_from("s", 3).alias("s3"), null_or_empty_flag("flag").alias("f"),
                    concat_strict("s", "flag").alias("c")).collect()
    assert [r.s3 for r in out] == ["00012345", "12"]
    assert [r.f for r in out] == ["X", "X"]
    assert [r.c for r in out] == [None, "0012"]


def test_conform_try_cast_nulls_bad_values(spark):
    df = spark.createDataFrame([("1.2345",), ("oops",)], "x string")
    out = conform(df, [Field("x", None, "decimal(18,3)")]).collect()
    assert [r.x for r in out] == [Decimal("1.235"), None]        # HALF_UP, malformed -> NULL
    with pytest.raises(Exception):
        conform(df, [Field("x", None, "decimal(18,3)")], on_error="fail").collect()


def test_upsert_two_batches_idempotent_and_guarded(spark):
    target = spark.createDataFrame([("a", None, T0, 1), ("b", "p", T0, 1)], "k string, p string, ts timestamp, v int")
    batch = spark.createDataFrame([("a", None, T0 + dt.timedelta(hours=1), 2), ("c", "p", T0, 3)],
                                  "k string, p string, ts timestamp, v int")
    once = upsert_by_key(target, batch, ["k", "p"])
    assert rows(once, "k", "v") == [("a", 2), ("b", 1), ("c", 3)]  # NULL key part matched null-safely
    twice = upsert_by_key(once, batch, ["k", "p"])
    assert rows(twice, "k", "v") == rows(once, "k", "v")
    stale = spark.createDataFrame([("a", None, T0 - dt.timedelta(days=1), 0)], "k string, p string, ts timestamp, v int")
    assert rows(upsert_by_key(once, stale, ["k", "p"], version="ts"), "k", "v") == [("a", 2), ("b", 1), ("c", 3)]
    assert rows(upsert_by_key(once, stale, ["k", "p"]), "k", "v") == [("a", 0), ("b", 1), ("c", 3)]
    deleted = upsert_by_key(once, batch.where("k = 'c'").withColumn("v", F.lit(-1)), ["k", "p"],
                            delete_when=F.col("v") < 0)
    assert rows(deleted, "k") == [("a",), ("b",)]


def _brute_preferred(left, right):
    out = {}
    for lid, key, plant in left:
        cands = [r for r in right if r[0] == key]
        if not cands:
            out[lid] = None
            continue
        def prio(r):
            return 1 if (r[1] is not None and r[1] == plant) else (2 if r[1] is None else 3)
        best = min(cands, key=lambda r: (prio(r), -r[2], r[3]))
        out[lid] = best[3]
    return out


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_preferred_match_equals_rank_over_all_pairs(spark, seed):
    rnd = random.Random(seed)
    plants = ["P0", "P1", "P2", None]
    left = [(i, f"R{rnd.randrange(6)}", rnd.choice(plants)) for i in range(60)]
    right = [(f"R{rnd.randrange(5)}", rnd.choice(plants), rnd.randrange(4), f"id{j:03d}") for j in range(40)]
    ldf = spark.createDataFrame(left, "lid int, rec string, plant string")
    rdf = spark.createDataFrame(right, "rec string, plant string, ts int, rid string")
    got = preferred_match(ldf, rdf, ("rec", "rec"), ("plant", "plant"), ["-ts", "rid"], ["rid"],
                          hot=hot_keys(ldf, ["rec"]) if seed == 3 else None)
    assert {r.lid: r.rid for r in got.collect()} == _brute_preferred(left, right)


def test_preferred_match_orders_like_a_ranking(spark):
    """Descending times, ties, missing times last; against the window formulation."""
    rnd = random.Random(9)
    ts = [None, *(T0 + dt.timedelta(hours=h) for h in range(3))]
    right = [(f"R{rnd.randrange(5)}", rnd.choice(["P0", "P1", None]), rnd.choice(ts), rnd.choice(["a", None, "b"]), j) for j in range(90)]
    left = [(i, rnd.choice([f"R{rnd.randrange(6)}", None]), rnd.choice(["P0", "P1", "P2", None])) for i in range(120)]
    ldf = spark.createDataFrame(left, "lid int, rec string, plant string")
    for kind in ("timestamp", "timestamp_ntz"):
        rdf = spark.createDataFrame(right, f"rec string, plant string, ts timestamp, org string, id int").withColumn("ts", F.col("ts").cast(kind))
        got = preferred_match(ldf, rdf, ("rec", "rec"), ("plant", "plant"), ["-ts", "org", "-id"], ["id"], rename={"id": "best"})
        assert got.columns == ["lid", "rec", "plant", "best"]
        r = rdf.select(F.col("rec").alias("r"), F.col("plant").alias("p"), "ts", "org", "id")
        prio = F.when(F.col("plant") == F.col("p"), 1).when(F.col("p").isNull(), 2).otherwise(3)
        w = Window.partitionBy("lid").orderBy(prio, F.desc("ts"), F.asc("org"), F.desc("id"))
        want = (ldf.join(r, F.col("rec") == F.col("r"), "left").withColumn("rn", F.row_number().over(w)).where("rn = 1"))
        assert {x.lid: x.best for x in got.collect()} == {x.lid: x.id for x in want.collect()}


def test_preferred_match_moves_candidates_once(spark):
    left = spark.range(50).select("id", F.lit("r").alias("rec"), F.lit("p").alias("plant"))
    right = spark.range(50).select(F.lit("r").alias("rec"), F.lit("p").alias("plant"), "id")
    plan = preferred_match(left, right, ("rec", "rec"), ("plant", "plant"), ["-id"], ["id"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Range (0, 50") == 2 and "Window" not in plan and "Generate" not in plan
    assert sum("Join" in x for x in plan.split("\n")) == 1


def test_checks(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "k int, v string")
    assert rows(duplicate_keys(df, ["k"]), "k", "n_rows") == [(1, 2)]
    rep = fan_out_report(df, df, [("k", "k")])
    assert rows(rep, "k", "pairs") == [(1, 4)]


def test_null_keys_are_spread_but_never_match(spark):
    left = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "k string, v int")
    dim = spark.createDataFrame([(None, "null-row"), ("a", "A")], "k string, name string")
    out = lookup(left, dim, [("k", "k")], {"name": "name"})
    assert rows(out, "v", "name") == [(1, None), (2, None), (3, "A")]
    plain = lookup(left, dim, [("k", "k")], {"name": "name"}, spread_null_keys=False)
    assert rows(plain, "v", "name") == rows(out, "v", "name")
    assert "xxhash64" in out._jdf.queryExecution().optimizedPlan().toString()


def test_partition_scoped_upsert_rewrites_only_touched_partitions(spark, scratch):
    import glob
    import os

    from purchlake.operators.upsert import upsert_partitions
    from purchlake.session import checkpoint_dir
    checkpoint_dir(spark)
    path = f"{scratch}/tbl"
    first = spark.createDataFrame([(f"{p}{i}", p, i) for p in "ab" for i in range(3)], "k string, part string, v int")
    upsert_partitions(spark, path, first, ["k"], "part")
    before_b = sorted(glob.glob(f"{path}/part=b/*.parquet"))
    mtimes = [os.path.getmtime(f) for f in before_b]
    batch = spark.createDataFrame([("a1", "a", 10), ("a9", "a", 9)], "k string, part string, v int")
    upsert_partitions(spark, path, batch, ["k"], "part")
    got = {r.k: r.v for r in spark.read.parquet(path).collect()}
    assert got == {"a0": 0, "a1": 10, "a2": 2, "a9": 9, "b0": 0, "b1": 1, "b2": 2}
    assert sorted(glob.glob(f"{path}/part=b/*.parquet")) == before_b
    assert [os.path.getmtime(f) for f in before_b] == mtimes
    upsert_partitions(spark, path, batch, ["k"], "part")              # idempotent re-run
    assert {r.k: r.v for r in spark.read.parquet(path).collect()} == got


def test_null_key_rows_spread_over_shuffle_partitions(spark):
    """A third of the rows have a NULL key; with a sort-merge join they must not
    all land in the one partition NULL hashes to."""
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    prev_aqe = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, F.lit(None).cast("string"))
                                         .otherwise((F.col("id") % 50).cast("string")).alias("k"), "id")
        dim = spark.range(50).select(F.col("id").cast("string").alias("k"), (F.col("id") * 10).alias("v"))
        out = lookup(left, dim, [("k", "k")], {"v": "v"})
        assert "SortMergeJoin" in out._jdf.queryExecution().executedPlan().toString()
        parts = (out.where(F.col("k").isNull()).select(F.spark_partition_id().alias("p")).distinct().count())
        assert parts > 1
        assert out.where(F.col("k").isNull() & F.col("v").isNotNull()).count() == 0
        assert out.count() == 3000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        spark.conf.set("spark.sql.adaptive.enabled", prev_aqe)
