"""A key cut by the same prefix in every row keeps its rows apart, so its DISTINCT goes; else it stays."""

from pyspark.sql import functions as F

from purchlake.plans import silver
from purchlake.plans.catalog import Ctx

SF = "/root/testdata/sf0.001"
NAME = "silver_mm_zipricingelement"


def shuffles(df):
    return df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")


def test_pricing_moves_once(spark):
    c = Ctx(spark, SF)
    spec = silver.spec_for(NAME)
    plain = silver.run(spec, c.feed(spec.feed), c.lk)
    proven = c.silver(NAME)
    assert shuffles(plain) == 2 and shuffles(proven) == 1
    out = [x.drop(silver.AUDIT) for x in (proven, plain)]
    assert out[0].exceptAll(out[1]).isEmpty() and out[1].exceptAll(out[0]).isEmpty()


def test_distinct_stays_where_the_prefix_varies(spark):
    """The same condition under items 000001 and 100001: alike after the cut."""
    c = Ctx(spark, SF)
    spec = silver.spec_for(NAME)
    one = c.feed(spec.feed).where("pricingdocumentitem = '000001'")
    both = one.unionAll(one.withColumn("pricingdocumentitem", F.lit("100001")))
    assert silver.lossless_cuts(spec, one) == {"pricingdocumentitem"}
    assert silver.lossless_cuts(spec, both) == frozenset()
    assert silver.lossless_cuts(spec, one.unionAll(one.withColumn("pricingdocumentitem", F.lit("")))) == frozenset()
    assert not silver.lossless_cuts(silver.spec_for("silver_mm_zimmpurdochist"), c.feed("zimmpurdochist"))
    assert spec.distinct_needed(whole=silver.lossless_cuts(spec, both))
    rows = silver.run(spec, both, c.lk, whole=silver.lossless_cuts(spec, both)).count()
    assert rows == silver.run(spec, one, c.lk, whole=silver.lossless_cuts(spec, one)).count() > 0
