"""What a mart leaves on the disks while it runs: no shuffle files of written tables, no wide rows moved for nothing."""

import re
import time

import pytest
from pyspark.sql import functions as F

from purchlake.plans.catalog import PIPELINES, Ctx
from purchlake.plans.materialize import CLEANUP, materialized, stored

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    files = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles().mkString("\n")
    return {x for x in files.split("\n") if "/shuffle_" in x}


def moves(df):
    """(columns, partitioning) of each exchange of the plan."""
    jvm = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode
    text = df._jdf.queryExecution().explainString(jvm.fromString("formatted"))
    return [(m[1], m[2]) for m in re.finditer(r"\(\d+\) Exchange\nInput \[\d+\]: \[([^\n]*)\]\nArguments: ([^\n]*)", text)]


@pytest.fixture
def sort_merge(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("how", ["table", "step"])
def test_written_tables_leave_no_shuffle_files(spark, how):
    def build():
        return spark.range(2000).groupBy((F.col("id") % 7).alias("k")).agg(F.count("*").alias("n"))

    before, conf = shuffle_files(spark), spark.conf.get(CLEANUP, "false")
    df = materialized(spark, build, SF, f"test-{time.time_ns()}", []) if how == "table" else stored(build(), "test")
    end = time.time() + 20
    while (left := shuffle_files(spark) - before) and time.time() < end:
        time.sleep(0.2)
    assert not left and spark.conf.get(CLEANUP, "false") == conf
    assert df.count() == 7 and df.agg(F.sum("n")).first()[0] == 2000
    assert all(".zstd." in f for f in df.inputFiles())


@pytest.mark.parametrize("name", ["mart_po_item", "mart_po_item_incremental"])
def test_item_mart_has_prices_from_a_step(spark, sort_merge, name):
    """Pricing totals and latest prices are not shuffled beside the wide rows, nor do unit factors move."""
    df = PIPELINES[name][0](spark, SF)
    moved = moves(df)
    assert moved and not [x for x, _ in moved if "conditionamount" in x or "pricingdocument#" in x]
    assert not [how for _, how in moved if re.match(r"hashpartitioning\((coalesce\()?(material|condition)#", how)]
    assert not [x for x, _ in moved if "quantity_numerator" in x]


def test_item_mart_is_the_same_without_steps(spark):
    from purchlake.plans import gold
    c = Ctx(spark, SF)
    frames = [c.items(), c.pr_items(), c.schedule(), c.po_approvals(), c.pr_approvals(), c.headers(), c.history(), c.pricing(),
              c.lk.ziunitofmeasure]
    whole, steps = gold.mart_po_item(*frames).drop(gold.MART_AUDIT), gold.mart_po_item(*frames, store=stored).drop(gold.MART_AUDIT)
    assert whole.schema == steps.schema and whole.count() == steps.count() > 0
    assert whole.exceptAll(steps).isEmpty()


@pytest.mark.parametrize("name", ["mart_po_history", "mart_po_history_incremental"])
def test_history_rows_move_once(spark, sort_merge, name):
    """For the item key; the items have their header by then."""
    rows = [how for what, how in moves(PIPELINES[name][0](spark, SF)) if "purchasinghistorydocument#" in what]
    assert len(rows) == 1 and "purchasingdocumentitem#" in rows[0]
