"""A key with nine tenths of the rows is dealt to several partitions, also where the other side is a top-1."""

import pytest
from pyspark.sql import functions as F

from purchlake.operators.dedup import latest_per_key, preferred_match
from purchlake.operators.enrich import deal_hot, hot_keys, lookup

ROWS = 40_000


@pytest.fixture
def sort_merge(spark):
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
             "spark.sql.shuffle.partitions": "32"}
    before = {k: spark.conf.get(k, None) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        if v is None:
            spark.conf.unset(k)
        else:
            spark.conf.set(k, v)


@pytest.fixture
def left(spark):
    return spark.range(ROWS).select("id", F.when(F.col("id") % 10 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                    F.concat(F.lit("P"), F.col("id") % 3).alias("plant"))


@pytest.fixture
def right(spark):
    return spark.range(3000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
                                    F.when(F.col("id") % 4 > 0, F.concat(F.lit("P"), F.col("id") % 4)).alias("plant"),
                                    F.col("id").alias("v"))


def largest(df):
    # reads what was joined, else a join with one row per key is dropped
    return df.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n"), F.count("v").alias("m")).agg(F.max("n"), F.max("m")).first()[0]


def test_lookup_onto_a_top1(spark, sort_merge, left, right):
    top = latest_per_key(right.select("k", "v"), ["k"], [], [F.desc("v")])
    whole = lookup(left, top, [("k", "k")], {"v": "v"})
    parts = lookup(left, top, [("k", "k")], {"v": "v"}, hot=hot_keys(left, ["k"]))
    assert largest(whole) >= 0.9 * ROWS
    assert largest(parts) <= 0.35 * ROWS
    assert parts.exceptAll(whole).isEmpty() and parts.count() == ROWS


def test_preferred_match(spark, sort_merge, left, right):
    def match(hot):
        return preferred_match(left, right, ("k", "k"), ("plant", "plant"), ["-v"], ["v"], hot=hot)

    whole, parts = match(None), match(hot_keys(left, ["k"]))
    assert largest(whole) >= 0.9 * ROWS
    assert largest(parts) <= 0.35 * ROWS
    assert parts.exceptAll(whole).isEmpty() and parts.count() == ROWS


def test_only_hot_keys_are_repeated(spark, sort_merge, left, right):
    hot = hot_keys(left, ["k"])
    found = spark.range(1).select(hot.alias("h")).first().h
    assert list(found.values()) == [-(-(9 * 32) // 10)]  # nine tenths of the rows: as many of 32 partitions
    dim = right.groupBy("k").agg(F.max("v").alias("v"))
    dealt, _ = deal_hot(left, dim, F.lit(True), hot, [F.col("k")], [F.col("k")], "part")
    assert dealt.count() == dim.count() + found.popitem()[1] - 1
    even = spark.range(1000).select(F.col("id").cast("string").alias("k"))
    assert spark.range(1).select(hot_keys(even, ["k"]).alias("h")).first().h == {}
    assert spark.range(1).select(hot_keys(even.where("false"), ["k"]).alias("h")).first().h in ({}, None)


def test_composite_and_null_keys(spark, sort_merge):
    left = spark.range(9000).select("id", F.when(F.col("id") % 3 > 0, "m").alias("m"), F.when(F.col("id") % 2 > 0, "p").alias("p"))
    dim = spark.createDataFrame([("m", "p", 1), ("m", None, 2), (None, "p", 3)], "m string, p string, v int")
    out = lookup(left, dim, [("m", "m"), ("p", "p")], {"v": "v"}, hot=hot_keys(left, ["m", "p"]))
    assert out.count() == 9000 and out.where("v = 1").count() == 3000 and out.where("v is not null").count() == 3000
    with pytest.raises(TypeError):
        lookup(left.withColumn("m", F.col("id")), dim, [("m", "m")], {"v": "v"}, hot=hot_keys(left, ["m"]))
