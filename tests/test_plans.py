"""Physical-plan properties the design relies on."""

import datetime as dt

from pyspark.sql import functions as F

from purchlake.operators import since
from purchlake.plans import silver
from purchlake.plans.catalog import Ctx, mart_po_item

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_silver_dedup_uses_partial_top1_and_skips_noop_distinct(spark):
    c = Ctx(spark, SF)
    p = plan(c.silver("silver_mm_zimmpurdochist"))
    assert "WindowGroupLimit" in p and "Partial" in p
    assert not silver.spec_for("silver_mm_zimmpurdochist").distinct_needed()   # key carried unchanged
    assert silver.spec_for("silver_mm_zipricingelement").distinct_needed()     # item key is cut by SUBSTR
    assert silver.spec_for("silver_mm_zimmpurgdocitem").distinct_needed()      # lookups may fan out


def test_distinct_goes_only_by_proof(spark):
    """Item silver: without DISTINCT where every lookup holds each key once, with it where one does not."""
    from purchlake.sources import FEEDS, Lookups, Tables
    t = Tables(spark, SF)
    lk = Lookups(spark, t)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")

    class Doubled:
        def __getattr__(self, name):
            dim = getattr(lk, name)
            return dim.unionAll(dim.limit(1)) if name == "ziproductgrp" else dim

    counts = {}
    for label, lookups in (("proven", lk), ("not", Doubled())):
        unique = silver.unique_lookups(lookups, spec.lookups)
        assert ("ziproductgrp" in unique) == (label == "proven") and {"ziproduct", "ziprduom", "ziprdplant"} <= unique
        df = silver.run(spec, FEEDS[spec.feed](t), lookups, unique=unique)
        wide = [x for x in plan(df).split("\n") if "Aggregate" in x and "material_description" in x]
        assert bool(wide) == (label == "not")
        counts[label] = df.count()
    assert counts["proven"] == counts["not"] == silver.run(spec, FEEDS[spec.feed](t), lk).count()


def test_null_keys_are_no_duplicates(spark):
    from purchlake.operators.checks import proven_unique
    a = spark.createDataFrame([("x", 1), (None, 2), (None, 3)], "k string, v int")
    b = a.unionAll(a)
    assert proven_unique({"a": (a, ["k"]), "b": (b, ["k"]), "none": (a.limit(0), ["k"])}) == {"a", "none"}
    assert proven_unique({}) == frozenset()


def test_item_mart_has_no_pairwise_join_and_broadcasts_fixed_units(spark):
    p = plan(mart_po_item(spark, SF))
    assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p
    assert "hashpartitioning(orderquantityunit" not in p                     # unit table is broadcast


def test_incremental_literal_mark_reaches_the_scan(spark, scratch):
    feed = spark.range(10).select(F.col("id"), F.lit(dt.datetime(2024, 1, 1)).alias("ingestiontime"))
    feed.write.parquet(f"{scratch}/feed")
    f = spark.read.parquet(f"{scratch}/feed")
    out = since(f, f, mode="literal")
    assert "PushedFilters: [IsNotNull(ingestiontime), GreaterThanOrEqual(ingestiontime" in plan(out)


def test_item_rows_move_once_per_lookup_key(spark):
    """Broadcast off: the latest-version window, then product, unit, plant and group, then DISTINCT."""
    from purchlake.plans import silver
    from purchlake.sources import FEEDS, Lookups, Tables
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        t = Tables(spark, "/root/testdata/sf0.001")
        spec = silver.spec_for("silver_mm_zimmpurgdocitem")
        plan = silver.run(spec, FEEDS[spec.feed](t), Lookups(spark, t))._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    wide = [x for x in plan.split("\n") if "SortMergeJoin" in x and "LeftOuter" in x]
    assert len(wide) == 5  # four on item rows, one between the product and its factors


def test_wide_item_rows_move_twice(spark):
    """Item mart, broadcast off: for the item key and for the header; and once per unit code, a table that
    is broadcast by its statistics otherwise."""
    import re
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        df = mart_po_item(spark, SF)
        jvm = spark._jvm.org.apache.spark.sql.execution.ExplainMode
        text = df._jdf.queryExecution().explainString(jvm.fromString("formatted"))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    moves = [(m[1], m[2]) for m in re.finditer(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: ([^\n]*)", text)]
    wide = [how for what, how in moves if "material_description" in what]
    assert sum("unit#" not in how for how in wide) == 2, wide
    assert len(wide) <= 4
