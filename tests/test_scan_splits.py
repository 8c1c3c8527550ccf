"""A scan task reads a bounded part of a table, so that the map side of a top-1 need not spill."""

from purchlake.sources import store, tables


def test_splits_are_small_unless_the_session_says_otherwise(spark, scratch):
    least = "spark.sql.files.minPartitionNum"
    before = spark.conf.getAll.get(tables.SPLIT_BYTES)
    data = f"{scratch}/lineitem.parquet"
    (spark.range(1_000_000, numPartitions=1).selectExpr("id", "uuid() AS u").write.option("parquet.block.size", 4 << 20)
     .parquet(data))  # some 36 MB in one file of many row groups
    try:
        spark.conf.unset(tables.SPLIT_BYTES)
        spark.conf.set(least, "1")  # else as many as cores
        df = tables.read(spark, scratch, "lineitem")
        n = df.rdd.getNumPartitions()
        size = sum(x[1] for x in store.files(spark, data))
        assert size > 2 * tables.SPLIT_LIMIT and size / n <= tables.SPLIT_LIMIT
        assert df.count() == 1_000_000
        spark.conf.set(tables.SPLIT_BYTES, "64m")
        tables.read(spark, scratch, "lineitem")
        assert spark.conf.get(tables.SPLIT_BYTES) == "64m"
    finally:
        spark.conf.unset(least)
        spark.conf.unset(tables.SPLIT_BYTES) if before is None else spark.conf.set(tables.SPLIT_BYTES, before)
