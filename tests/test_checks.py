"""Checks made by the job itself: duplicate lookup keys are counted, duplicate business keys stop the write."""

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from purchlake.operators import keyed
from purchlake.operators.checks import CheckedLookups, KeyChecks, raise_on_duplicates
from purchlake.operators.upsert import current_commit, read_table
from purchlake.plans import silver
from purchlake.plans.pipeline import layout_of
from purchlake.plans.silver import LOOKUP_KEYS, units_per_product
from purchlake.sources import FEEDS, Lookups, Tables
from purchlake.streaming import merge_batch

SF = "/root/testdata/sf0.001"
SPECS = {"ziproduct": "silver_mm_zimmpurgdocitem", "ziprduom": "silver_mm_zimmpurgdocitem",
         "ziprdplant": "silver_mm_zimmpurgdocitem", "ziproductgrp": "silver_mm_zimmpurgdocitem",
         "zisupplier": "silver_mm_zmmpurchasingdoc", "zimmpurchgroup": "silver_mm_zmmpurchasingdoc", "ziuser": "silver_mm_zipoapprov"}


class Doubled:
    """Lookups, one of which holds three rows again, with a key that has a NULL part besides."""

    def __init__(self, lookups, name):
        self.lookups, self.name = lookups, name

    def __getattr__(self, name):
        dim = getattr(self.lookups, name)
        if name != self.name:
            return dim
        keys = LOOKUP_KEYS[name]
        some = dim.orderBy(*keys).limit(3)
        nothing = dim.limit(2).withColumn(keys[-1], F.lit(None).cast("string"))
        return dim.unionAll(some).unionAll(nothing)


@pytest.mark.parametrize("name", SPECS)
def test_a_duplicate_in_each_lookup(spark, name):
    t = Tables(spark, SF)
    spec = silver.spec_for(SPECS[name])
    for lookups, want in ((Lookups(spark, t), {}), (Doubled(Lookups(spark, t), name), {name: 6})):
        checks = KeyChecks()
        out = silver.run(spec, FEEDS[spec.feed](t), CheckedLookups(lookups, LOOKUP_KEYS, checks))
        out.write.format("noop").mode("overwrite").save()
        assert checks.found() == want


def test_load_warns_and_stops_at_two_rows_of_a_key(spark, scratch, caplog):
    t = Tables(spark, SF)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")
    feed, lk, table = FEEDS[spec.feed](t), Lookups(spark, t), f"{scratch}/t"
    layout = layout_of(spec, buckets=3)
    merge_batch(spark, spec, feed, table, lk, layout=layout)
    rows = read_table(spark, table).count()
    # the same rows again: DISTINCT takes them out, so the load goes on, with a warning
    caplog.clear()
    merge_batch(spark, spec, feed, table, Doubled(lk, "ziproductgrp"), layout=layout)
    assert "6 rows of ziproductgrp" in caplog.text and read_table(spark, table).count() == rows

    class Torn(Doubled):
        def __getattr__(self, name):
            dim = getattr(self.lookups, name)
            return dim.unionAll(dim.withColumn("materialgroupname", F.lit("other"))) if name == self.name else dim

    before = current_commit(spark, table)
    with pytest.raises(PySparkException, match="several rows of key"):
        merge_batch(spark, spec, feed, table, Torn(lk, "ziproductgrp"), layout=layout)
    assert current_commit(spark, table) == before


def test_raise_on_duplicates_in_a_keyed_write(spark, scratch):
    good = spark.createDataFrame([("a", None, 1), ("a", "x", 2), ("b", None, 3)], "k string, p string, v int")
    layout = keyed.Layout(["k"], ["p"], buckets=2)
    keyed.merge(spark, f"{scratch}/t", layout, good, unique=True)
    with pytest.raises(PySparkException, match="a, NULL"):
        keyed.merge(spark, f"{scratch}/t", layout, spark.createDataFrame([("a", None, 5), ("a", None, 6)], good.schema), unique=True)
    assert sorted(r.v for r in read_table(spark, f"{scratch}/t").collect()) == [1, 2, 3]
    df = good.repartition(4, "k")
    plan = raise_on_duplicates(df, ["k", "p"], "t")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1  # the repartition's own


def test_units_are_taken_from_one_row(spark):
    uom = spark.createDataFrame([("m", "KG", 1, 9), ("m", "KG", 5, 2), ("m", "EA", None, 3), ("n", "BOX", 1, 1)],
                                "product string, alternativeunit string, quantitynumerator int, quantitydenominator int")
    got = {r.product: tuple(r)[1:] for r in units_per_product(uom).collect()}
    assert got == {"m": (5, 2, None, 3), "n": (None, None, None, None)}
