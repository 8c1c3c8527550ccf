"""Lookups whose rows multiply behind a small file are not taken for small: no broadcast through the driver."""

import time

import pytest
from pyspark.sql import functions as F

from purchlake.operators.enrich import lookup
from purchlake.operators.incremental import since
from purchlake.plans import silver
from purchlake.plans.catalog import PIPELINES, Ctx
from purchlake.plans.operator_queries import OPERATORS

SF = "/root/testdata/sf0.001"


def joins(df, kind):
    return [x for x in df._jdf.queryExecution().executedPlan().toString().split("\n") if kind in x]


@pytest.mark.parametrize("initial", [False, True])
def test_item_silver_broadcasts_no_product_data(spark, initial):
    df = Ctx(spark, SF).silver("silver_mm_zimmpurgdocitem", initial)
    assert len(joins(df, "SortMergeJoin")) >= 4
    assert not [x for x in joins(df, "BroadcastHashJoin") if "product" in x]


@pytest.mark.parametrize("name", ["uom_to_base", "uom_to_kg", "uom_to_ea"])
def test_unit_queries_broadcast_nothing(spark, name):
    df = OPERATORS[name][0](spark, SF)
    assert joins(df, "SortMergeJoin") and not joins(df, "BroadcastHashJoin")


def test_item_master_data_equals_plain_joins(spark):
    """Products missing, doubled, only in the plant table; units and plants doubled, missing or NULL."""
    items = spark.createDataFrame(
        [(str(i), m, u, p, "G1") for i, (m, u, p) in enumerate(
            (m, u, p) for m in ("a", "b", "c", "d", None) for u in ("EA", "KG", "X", None) for p in ("P1", "P2", None))],
        "purchasingdocument string, material string, orderquantityunit string, plant string, materialgroup string"
    ).withColumn("purchasingdocumentitem", F.lit("1"))

    class Lk:
        ziproduct = spark.createDataFrame([("a", "g", "EA"), ("b", "g", "KG"), ("b", "h", "KG"), (None, "n", "EA")],
                                          "product string, productgroup string, baseunit string")
        ziprduom = spark.createDataFrame(
            [("a", "EA", 1, 2), ("a", "KG", 3, None), ("a", None, 8, 8), ("b", "EA", 4, 4), ("b", "EA", 5, 4),
             ("c", "EA", 6, 6), (None, "EA", 7, 7)],
            "product string, alternativeunit string, quantitynumerator int, quantitydenominator int")
        ziprdplant = spark.createDataFrame([("a", "P1", 1), ("a", None, 2), ("c", "P2", 3), ("c", "P2", 3), ("c", "P2", 4), (None, "P1", 5)],
                                           "product string, plant string, safetystockquantity int")
        ziproductgrp = spark.createDataFrame([("G1", "one")], "materialgroup string, materialgroupname string")

    got = silver._enrich_po_item(items, Lk)
    for name in ("items", "ziproduct", "ziprduom", "ziprdplant", "ziproductgrp"):
        (items if name == "items" else getattr(Lk, name)).createOrReplaceTempView(f"gl_{name}")
    silver.units_per_product(Lk.ziprduom).createOrReplaceTempView("gl_factors")
    want = spark.sql("""SELECT i.*, p.product AS pr_product, p.productgroup AS pr_productgroup, p.baseunit AS pr_baseunit,
        f.kg_num, f.kg_den, f.ea_num, f.ea_den, u.quantitynumerator AS u_num, u.quantitydenominator AS u_den,
        s.safetystockquantity AS p_safetystock, g.materialgroupname AS pgr_name
      FROM gl_items i LEFT JOIN gl_ziproduct p ON i.material = p.product LEFT JOIN gl_factors f ON p.product = f.product
      LEFT JOIN gl_ziprduom u ON p.product = u.product AND i.orderquantityunit = u.alternativeunit
      LEFT JOIN gl_ziprdplant s ON i.material = s.product AND i.plant = s.plant
      LEFT JOIN gl_ziproductgrp g ON i.materialgroup = g.materialgroup""")
    assert sorted(map(str, got.select(*want.columns).collect())) == sorted(map(str, want.collect()))
    assert got.columns == want.columns and got.count() > items.count()


def test_growing_dimension_is_joined_by_sort(spark):
    left, dim = spark.range(100).withColumn("k", F.col("id") % 7), spark.range(5).withColumn("v", F.col("id") * 2)
    plain, grown = (lookup(left, dim, [("k", "id")], {"v": "v"}, grows=g) for g in (False, True))
    assert joins(plain, "BroadcastHashJoin") and not joins(grown, "BroadcastHashJoin")
    assert grown.exceptAll(plain).isEmpty() and grown.count() == 100


@pytest.mark.parametrize("name, key", [("silver_mm_zmmpurchasingdoc", "supplier"), ("silver_mm_zipoapprov", "userid")])
def test_suppliers_and_users_are_not_broadcast(spark, name, key):
    df = Ctx(spark, SF).silver(name)
    assert len(joins(df, "SortMergeJoin")) == 1
    assert not [x for x in joins(df, "BroadcastHashJoin") if f"_{key}#" in x]


@pytest.mark.parametrize("name", ["mart_last_price", "mart_po_history", "mart_po_history_incremental",
                                  "mart_info_record", "mart_info_record_incremental"])
def test_marts_broadcast_no_silver_table(spark, name):
    """Packed and cut to a few columns, a silver table of millions of rows is below the threshold to the planner."""
    df = PIPELINES[name][0](spark, SF)
    assert joins(df, "SortMergeJoin") and not joins(df, "Broadcast")


@pytest.mark.parametrize("name", ["mart_po_item", "mart_po_item_incremental"])
def test_item_mart_broadcasts_only_the_units(spark, name):
    df = PIPELINES[name][0](spark, SF)
    assert len(joins(df, "BroadcastHashJoin")) == 2 and all("unit" in x for x in joins(df, "BroadcastHashJoin"))


@pytest.mark.parametrize("name", ["mart_info_record", "mart_po_history", "mart_po_item"])
def test_second_run_does_not_plan_its_target_again(spark, name):
    """The mark is found before: what the driver plans for a second run is no larger than for a first."""
    first, second = (PIPELINES[n][0](spark, SF)._jdf.queryExecution().optimizedPlan().toString().count("Relation [")
                     for n in (name, f"{name}_incremental"))
    assert 0 < second <= first


@pytest.mark.parametrize("last", [0, 1])
def test_zoned_mark_in_an_hour_that_comes_twice(spark, monkeypatch, last):
    """25 October 2020, 02:30 in Berlin, first and second time."""
    feed = spark.sql("SELECT id, timestamp_seconds(1603585800 + 3600 * id) AS ingestiontime FROM range(2)")
    target = feed.where(F.col("id") <= last)
    with monkeypatch.context() as m:
        m.setenv("TZ", "Europe/Berlin")
        time.tzset()
        got = [{r.id for r in since(feed, target, lookback="0 HOURS", mode=mode).collect()} for mode in ("subquery", "literal")]
    time.tzset()
    assert got[0] == got[1] == set(range(last, 2))
