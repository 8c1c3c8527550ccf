"""Query catalogue: every pipeline of the reference as a (spark, sf_dir) ->
DataFrame callable, with its SQL oracle.

Silver inputs of the marts are built inline from the feeds (the first run
of the pipeline: empty targets).  In production each silver table would be
read from its own snapshot instead; the plans are the same.

The audit timestamps (``current_timestamp()``) are left out of compared
outputs: they differ between any two runs by design.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import ntz
from ..operators import reconcile, since, upsert_by_key
from ..sources import FEEDS, Lookups, Tables, store
from . import gold, oracle, silver
from .materialize import materialized, stored

Query = Callable[[SparkSession, str], DataFrame]


class Ctx:
    """Tables, feeds, lookups and silver frames of one scale-factor dir."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = Tables(spark, sf_dir)
        self.lk = Lookups(spark, self.t)
        self.inputs: list | None = None
        self.asked: dict[str, bool] = {}  # lookups checked so far: unique or not

    def feed(self, name: str) -> DataFrame:
        return FEEDS[name](self.t)

    def silver(self, name: str, initial: bool = False) -> DataFrame:
        spec = silver.spec_for(name, initial)
        feed = self.feed(spec.feed)
        return silver.run(spec, feed, self.lk, initial=initial, unique=self.unique(spec), whole=self.whole(spec, feed))

    def whole(self, spec: silver.SilverSpec, feed: DataFrame) -> frozenset[str]:
        """The spec's cut key columns that lose nothing; asked only where a DISTINCT depends on it."""
        return silver.lossless_cuts(spec, feed) if spec.distinct and spec.keeps_key(spec.cut) else frozenset()

    def unique(self, spec: silver.SilverSpec) -> frozenset[str]:
        """The spec's lookups proven unique; asked only where a DISTINCT depends on it."""
        if not spec.distinct_needed() or not spec.keeps_key():
            return frozenset()
        missing = [n for n in spec.lookups if n not in self.asked]
        if missing:
            self.asked.update(dict.fromkeys(missing, False))
            self.asked.update(dict.fromkeys(silver.unique_lookups(self.lk, missing), True))
        return frozenset(n for n in spec.lookups if self.asked[n])

    def table(self, name: str) -> DataFrame:
        """Silver table as the marts read it: written once, then scanned."""
        if self.inputs is None:  # one listing for all tables of a query
            self.inputs = store.files(self.spark, self.sf_dir)
        return materialized(self.spark, lambda: self.silver(name), self.sf_dir, name, self.inputs)

    def items(self): return self.table("silver_mm_zimmpurgdocitem")
    def headers(self): return self.table("silver_mm_zmmpurchasingdoc")
    def history(self): return self.table("silver_mm_zimmpurdochist")
    def pricing(self): return self.table("silver_mm_zipricingelement")
    def schedule(self): return self.table("silver_mm_zimmprgdocsl")
    def pr_items(self): return self.table("silver_mm_zipritem")
    def pr_approvals(self): return self.table("silver_mm_ziprapprov")
    def po_approvals(self): return self.table("silver_mm_zipoapprov")
    def info(self): return self.table("silver_mm_ziinforecorgdata")


def _no_audit(df: DataFrame) -> DataFrame:
    return df.drop(silver.AUDIT, gold.MART_AUDIT)


def _silver_query(name: str, initial: bool = False) -> Query:
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _no_audit(Ctx(spark, sf_dir).silver(name, initial))
    return q


def mart_last_price(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _no_audit(gold.mart_last_price(c.items(), c.headers()))


def mart_po_history(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _no_audit(gold.mart_po_history(c.history(), c.items(), c.headers()))


def mart_info_record(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _no_audit(gold.mart_info_record(c.items(), c.info(), c.headers()))


def mart_po_item(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    return _no_audit(gold.mart_po_item(c.items(), c.pr_items(), c.schedule(), c.po_approvals(),
                                       c.pr_approvals(), c.headers(), c.history(), c.pricing(),
                                       c.lk.ziunitofmeasure, store=stored))


# Second run of a pipeline: the target holds everything ingested before this
# instant, the new batch is sliced behind its high-water mark.
INCREMENT_CUT = dt.datetime(1998, 6, 1)
APPROVAL_CUT = dt.datetime(2024, 1, 20)
#: One version in so many arrives late, see ``late_versions``.
LATE = 9


def _second_run(name: str, cut: dt.datetime = INCREMENT_CUT) -> Query:
    """The load again, onto the table made from what was ingested before the cut."""
    def q(spark: SparkSession, sf_dir: str) -> DataFrame:
        c = Ctx(spark, sf_dir)
        spec = silver.spec_for(name)
        feed = c.feed(spec.feed)
        proven = {"unique": c.unique(spec), "whole": c.whole(spec, feed)}
        target = silver.run(spec, feed.where(F.col("ingestiontime") < ntz(cut)), c.lk, **proven)
        return _no_audit(silver.run(spec, feed, c.lk, target=target, **proven))
    return q


def late_versions(spark, sf_dir):
    """Item versions that two incremental runs have missed: some versions from before the cut arrive
    only after the first run, older than the second run's mark reaches back."""
    c = Ctx(spark, sf_dir)
    spec = silver.spec_for("silver_mm_zimmpurgdocitem")
    feed = c.feed(spec.feed)
    in_time = (F.col("ingestiontime") < ntz(INCREMENT_CUT)) & (F.col("changesequence") % LATE != 0)

    def run(rows: DataFrame) -> DataFrame:
        return silver.newest_versions(spec, rows)

    first = run(feed.where(in_time))
    table = upsert_by_key(first, run(since(feed, first)), spec.keys)
    return reconcile(run(feed), table, spec.keys)


def mart_po_history_incremental(spark, sf_dir):
    c = Ctx(spark, sf_dir)
    history, items, headers = c.history(), c.items(), c.headers()
    target = gold.mart_po_history(history.where(F.col("ingestiontime") < ntz(INCREMENT_CUT)), items, headers)
    return _no_audit(gold.mart_po_history(history, items, headers, target=target))


def mart_info_record_incremental(spark, sf_dir):
    """Second run of the info-record mart: its mark is the max ingestion time
    of the *info records* it stores, applied to the items (two clocks, Q4)."""
    c = Ctx(spark, sf_dir)
    items, info, headers = c.items(), c.info(), c.headers()
    target = gold.mart_info_record(items.where(F.col("ingestiontime") < ntz(INCREMENT_CUT)), info, headers)
    return _no_audit(gold.mart_info_record(items, info, headers, target=target))


def mart_po_item_incremental(spark, sf_dir):
    """Second run of the item mart; the latest price is taken over the slice only (Q5)."""
    c = Ctx(spark, sf_dir)
    items = c.items()
    rest = [c.pr_items(), c.schedule(), c.po_approvals(), c.pr_approvals(), c.headers(), c.history(), c.pricing(),
            c.lk.ziunitofmeasure]
    target = gold.mart_po_item(items.where(F.col("ingestiontime") < ntz(INCREMENT_CUT)), *rest)
    return _no_audit(gold.mart_po_item(items, *rest, target=target, store=stored))


PIPELINES: dict[str, tuple[Query, str]] = {
    "silver_goods_movement": (_silver_query("silver_mm_zigoodsmvmtdoc"), oracle.table("s_goods")),
    "silver_info_record": (_silver_query("silver_mm_ziinforecorgdata"), oracle.table("s_info")),
    "silver_schedule_line": (_silver_query("silver_mm_zimmprgdocsl"), oracle.table("s_schedule")),
    "silver_po_history": (_silver_query("silver_mm_zimmpurdochist"), oracle.table("s_history")),
    "silver_po_item": (_silver_query("silver_mm_zimmpurgdocitem"), oracle.table("s_item")),
    "silver_po_item_full": (_silver_query("silver_mm_zimmpurgdocitem", True), oracle.table("s_item_full")),
    "silver_po_approval": (_silver_query("silver_mm_zipoapprov"), oracle.table("s_po_approval")),
    "silver_po_approval_full": (_silver_query("silver_mm_zipoapprov", True), oracle.table("s_po_approval_full")),
    "silver_pr_approval": (_silver_query("silver_mm_ziprapprov"), oracle.table("s_pr_approval")),
    "silver_pricing": (_silver_query("silver_mm_zipricingelement"), oracle.table("s_pricing")),
    "silver_pr_item": (_silver_query("silver_mm_zipritem"), oracle.table("s_pr_item")),
    "silver_po_header": (_silver_query("silver_mm_zmmpurchasingdoc"), oracle.table("s_header")),
    "silver_po_header_full": (_silver_query("silver_mm_zmmpurchasingdoc", True), oracle.table("s_header_full")),
    "mart_po_item": (mart_po_item, oracle.table("g_po_item")),
    "mart_info_record": (mart_info_record, oracle.table("g_info_record")),
    "mart_po_history": (mart_po_history, oracle.table("g_po_history")),
    "mart_last_price": (mart_last_price, oracle.table("g_last_price")),
    "silver_po_item_incremental": (_second_run("silver_mm_zimmpurgdocitem"), oracle.table("s_item_inc")),
    "silver_po_approval_incremental": (_second_run("silver_mm_zipoapprov", APPROVAL_CUT), oracle.table("s_po_approval_inc")),
    "silver_goods_movement_incremental": (_second_run("silver_mm_zigoodsmvmtdoc"), oracle.table("s_goods_inc")),
    "silver_info_record_incremental": (_second_run("silver_mm_ziinforecorgdata"), oracle.table("s_info_inc")),
    "silver_schedule_line_incremental": (_second_run("silver_mm_zimmprgdocsl"), oracle.table("s_schedule_inc")),
    "silver_po_history_incremental": (_second_run("silver_mm_zimmpurdochist"), oracle.table("s_history_inc")),
    "silver_pr_approval_incremental": (_second_run("silver_mm_ziprapprov", APPROVAL_CUT), oracle.table("s_pr_approval_inc")),
    "silver_pricing_incremental": (_second_run("silver_mm_zipricingelement"), oracle.table("s_pricing_inc")),
    "silver_pr_item_incremental": (_second_run("silver_mm_zipritem"), oracle.table("s_pr_item_inc")),
    "silver_po_header_incremental": (_second_run("silver_mm_zmmpurchasingdoc"), oracle.table("s_header_inc")),
    "reconcile_late_versions": (late_versions, oracle.table("x_late")),
    "mart_po_item_incremental": (mart_po_item_incremental, oracle.table("g_po_item_inc")),
    "mart_po_history_incremental": (mart_po_history_incremental, oracle.table("g_po_history_inc")),
    "mart_info_record_incremental": (mart_info_record_incremental, oracle.table("g_info_record_inc")),
}
