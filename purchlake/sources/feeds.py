"""Procurement change feeds and lookups derived from the driver tables.

The reference reads ERP change feeds (bronze) and master-data lookups.
For tests and benchmarks they are derived here from the TPC-H-like driver
tables by deterministic column expressions, so they grow with the scale
factor and an independent SQL oracle can repeat the derivation.

Every feed carries the CDC envelope (ingestiontime, isupsert, isdelete,
isinsert, changetype) plus ``changesequence``, a per-source sequence number
used as the explicit tie-breaker when two versions share an ingestion time.
Business columns are strings; dates are compact ``yyyyMMdd`` strings, times
``HHmmss`` strings, exactly as the silver layer expects to parse them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .tables import Tables

# ---------------------------------------------------------------- helpers


def pad(c: Column, n: int) -> Column:
    return F.lpad(c.cast("string"), n, "0")


def doc(c: Column) -> Column:
    """10-character document number with leading zeros."""
    return pad(c, 10)


def tag(prefix: str, c: Column) -> Column:
    return F.concat(F.lit(prefix), c.cast("string"))


def compact_date(c: Column) -> Column:
    return F.date_format(c, "yyyyMMdd")


def pick(c: Column, values: list) -> Column:
    """CASE c WHEN 0 THEN values[0] WHEN 1 THEN values[1] ... END."""
    out = None
    for i, v in enumerate(values):
        lit = v if isinstance(v, Column) else F.lit(v)
        out = F.when(c == i, lit) if out is None else out.when(c == i, lit)
    return out


def envelope(ts: Column, is_delete: Column, seq: Column) -> list[Column]:
    return [ts.alias("ingestiontime"),
            (~is_delete).alias("isupsert"),
            is_delete.alias("isdelete"),
            F.lit(False).alias("isinsert"),
            F.when(is_delete, F.lit("D")).otherwise(F.lit("U")).alias("changetype"),
            seq.alias("changesequence")]


def _known(ts: Column, when: Column) -> Column:
    """An ingestion time that some versions lack: only a load of the whole history sees those."""
    return F.when(when, ts)


def _li_seq() -> Column:
    return (F.col("l_orderkey").cast("bigint") * 8_000_000_000
            + F.col("l_linenumber").cast("bigint") * 1_000_000_000 + F.col("l_partkey"))


# Fixed code values of the procurement domain used by the queries.
UNITS = ["EA", "KG", "BOX", "G"]
MOVEMENT_RECEIPT, MOVEMENT_RETURN, MOVEMENT_OTHER = "101", "102", "122"
CONDITION_TYPES = ["ZFB3", "ZCB1", "ZDB3", "PB00"]
UNIT_CODES = [("EA", "PCE"), ("KG", "KGM"), ("G", "GRM")]


def _unit(c: Column) -> Column:
    return pick(c % 4, UNITS)


def _movement_type() -> Column:
    t = F.col("l_tax")
    return (F.when(t < 0.03, F.lit(MOVEMENT_RECEIPT)).when(t < 0.06, F.lit(MOVEMENT_RETURN))
            .otherwise(F.lit(MOVEMENT_OTHER)))


def _credit_code() -> Column:
    return F.when(F.col("l_returnflag") == "R", F.lit("H")).otherwise(F.lit("S"))


# ---------------------------------------------------------------- feeds


def po_item_feed(t: Tables) -> DataFrame:
    """zimmpurgdocitem: one version per lineitem row, keyed by (order, line)."""
    li = t.lineitem
    return li.select(
        doc(F.col("l_orderkey")).alias("purchasingdocument"),
        pad(F.col("l_linenumber"), 5).alias("purchasingdocumentitem"),
        F.lit("F").alias("purchasingdocumentcategory"),
        F.when(F.col("l_partkey") % 50 != 0, tag("M", F.col("l_partkey"))).alias("material"),
        tag("Part ", F.col("l_partkey")).alias("purchasingdocumentitemtext"),
        tag("P", F.col("l_suppkey") % 5).alias("plant"),
        tag("G", F.col("l_partkey") % 12).alias("materialgroup"),
        _unit(F.col("l_partkey")).alias("orderquantityunit"),
        F.col("l_extendedprice").cast("decimal(18,2)").alias("netpriceamount"),
        pick(F.col("l_linenumber") % 6, [0, None, 3, 2, 7, 10]).cast("decimal(18,3)").alias("netpricequantity"),
        F.col("l_quantity").cast("decimal(18,3)").alias("orderquantity"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("netamount"),
        pick(F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "R", 1).otherwise(2),
             ["", None, "X"]).alias("invoiceisexpected"),
        F.when(F.col("l_linestatus") == "F", F.lit("X")).alias("IsCompletelyDelivered"),
        F.when(F.col("l_suppkey") % 20 == 0, F.lit("L")).alias("purchasingdocumentdeletioncode"),
        doc(F.col("l_orderkey") + 1_000_000).alias("purchaserequisition"),
        pad(F.col("l_linenumber"), 5).alias("purchaserequisitionitem"),
        tag("I", F.col("l_partkey") - F.col("l_partkey") % 4).alias("purchasinginforecord"),
        F.when(F.col("l_tax") >= 0.04, F.lit("V7")).otherwise(F.lit("V0")).alias("taxcode"),
        *envelope(_known(F.col("l_shipdate"), F.col("l_partkey") % 211 != 5), F.col("l_suppkey") % 25 == 3, _li_seq()),
    )


def po_header_feed(t: Tables) -> DataFrame:
    """zmmpurchasingdoc: one version per order, a second one a day later for odd keys."""
    o = t.orders.withColumn("v", F.explode(F.sequence(F.lit(0), (F.col("o_orderkey") % 2).cast("int"))))
    usd = F.col("o_custkey") % 3 == 0
    return o.select(
        doc(F.col("o_orderkey")).alias("purchasingdocument"),
        F.lit("F").alias("purchasingdocumentcategory"),
        tag("Z", F.substring("o_orderpriority", 1, 1)).alias("purchasingdocumenttype"),
        F.when(F.col("o_orderstatus") == "F", F.lit("R")).alias("releasecode"),
        doc(F.col("o_custkey") % 100).alias("supplier"),
        tag("PG", F.col("o_custkey") % 30).alias("purchasinggroup"),
        F.when(usd, F.lit("USD")).otherwise(F.lit("THB")).alias("documentcurrency"),
        F.when(usd, F.lit(35.5)).otherwise(F.lit(1.0)).cast("decimal(18,4)").alias("exchangerate"),
        compact_date(F.col("o_orderdate")).alias("purchasingdocumentorderdate"),
        F.when(F.col("v") == 0, F.lit("NT30")).otherwise(F.lit("NT60")).alias("paymentterms"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("FOB")).otherwise(F.lit("CIF")).alias("incotermsclassification"),
        doc(F.col("o_orderkey")).alias("purchasingdocumentcondition"),
        F.col("o_totalprice").cast("decimal(18,2)").alias("purgreleasetimetotalamount"),
        compact_date(F.date_add(F.col("o_orderdate").cast("date"), -2)).alias("creationdate"),
        *envelope(_known(F.timestamp_add("DAY", F.col("v"), F.col("o_orderdate")), F.col("o_orderkey") % 52 != 8),
                  F.col("o_custkey") % 40 == 0,
                  F.col("o_orderkey") * 2 + F.col("v")),
    )


def po_history_feed(t: Tables) -> DataFrame:
    """zimmpurdochist: purchase-order history (goods receipts and others)."""
    li = t.lineitem
    return li.select(
        doc(F.col("l_orderkey")).alias("purchasingdocument"),
        pad(F.col("l_linenumber"), 5).alias("purchasingdocumentitem"),
        pad(F.col("l_suppkey") % 3, 2).alias("accountassignmentnumber"),
        F.when(F.col("l_linestatus") == "F", F.lit("E")).otherwise(F.lit("Q")).alias("purchasinghistorydocumenttype"),
        F.year("l_shipdate").cast("string").alias("purchasinghistorydocumentyear"),
        F.concat(F.lit("50"), pad(F.col("l_partkey") % 3, 8)).alias("purchasinghistorydocument"),
        pad(F.col("l_linenumber"), 4).alias("purchasinghistorydocumentitem"),
        _movement_type().alias("goodsmovementtype"),
        _credit_code().alias("debitcreditcode"),
        compact_date(F.col("l_shipdate")).alias("postingdate"),
        F.when(F.col("l_partkey") % 97 != 0, F.col("l_quantity").cast("decimal(18,3)")).alias("quantity"),
        F.when(F.col("l_partkey") % 89 != 0, F.col("l_extendedprice").cast("decimal(18,2)"))
         .alias("purordamountincompanycodecrcy"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("decimal(18,4)").alias("purchaseorderamount"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 30 == 1, _li_seq()),
    )


def pricing_feed(t: Tables) -> DataFrame:
    """zipricingelement: 1-3 pricing conditions per order line."""
    li = t.lineitem.withColumn("n", F.explode(F.sequence(F.lit(1), (1 + F.col("l_partkey") % 3).cast("int"))))
    ccy = (F.col("l_suppkey") + F.col("n")) % 3
    return li.select(
        doc(F.col("l_orderkey")).alias("pricingdocument"),
        F.concat(F.lit("0"), pad(F.col("l_linenumber"), 5)).alias("pricingdocumentitem"),
        pad(F.col("l_suppkey") % 3, 3).alias("pricingprocedurestep"),
        pad(F.col("n"), 2).alias("pricingprocedurecounter"),
        pick((F.col("l_linenumber") + F.col("n")) % 4, CONDITION_TYPES).alias("conditiontype"),
        F.date_format("l_shipdate", "yyyyMMddHHmmss").alias("pricingdatetime"),
        F.when(F.col("n") == 1, F.lit("A")).otherwise(F.lit("C")).alias("conditioncalculationtype"),
        (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)").alias("conditionamount"),
        F.lit("THB").alias("transactioncurrency"),
        F.when((F.col("l_returnflag") == "A") & (F.col("n") == 2), F.lit("Y")).alias("conditioninactivereason"),
        pick(ccy, ["THB", "USD"]).alias("conditioncurrency"),
        (F.col("l_quantity") * 10).cast("decimal(18,3)").alias("conditionratevalue"),
        F.when(ccy == 1, F.lit(35.5)).otherwise(F.lit(1.0)).cast("decimal(18,4)").alias("PriceDetnExchangeRate"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 40 == 9, _li_seq() * 4 + F.col("n")),
    )


def schedule_feed(t: Tables) -> DataFrame:
    """zimmprgdocsl: schedule lines; '00000000' marks an unset delivery date."""
    li = t.lineitem
    due = F.date_add(F.col("l_shipdate").cast("date"), (F.col("l_partkey") % 11).cast("int") - 5)
    return li.select(
        doc(F.col("l_orderkey")).alias("purchasingdocument"),
        pad(F.col("l_linenumber"), 5).alias("purchasingdocumentitem"),
        pad(1 + F.col("l_suppkey") % 2, 4).alias("scheduleline"),
        F.when(F.col("l_partkey") % 83 == 0, F.lit("00000000")).otherwise(compact_date(due))
         .alias("schedulelinedeliverydate"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 45 == 2, _li_seq()),
    )


def pr_item_feed(t: Tables) -> DataFrame:
    """zipritem: requisition items; lines with l_suppkey % 50 = 7 get a second
    requisition for the same PO item (fan-out in the item mart)."""
    li = t.lineitem.withColumn(
        "k", F.explode(F.sequence(F.lit(0), F.when(F.col("l_suppkey") % 50 == 7, 1).otherwise(0))))
    base = F.col("l_orderkey") + F.col("k") * 50_000_000
    return li.select(
        doc(base + 1_000_000).alias("purchaserequisition"),
        pad(F.col("l_linenumber"), 5).alias("purchaserequisitionitem"),
        doc(F.col("l_orderkey")).alias("purchasingdocument"),
        pad(F.col("l_linenumber"), 5).alias("purchasingdocumentitem"),
        F.concat(doc(base), pad(F.col("l_linenumber"), 5)).alias("purchasereqnitemuniqueid"),
        F.when(F.col("l_suppkey") % 13 == 0, F.lit("X")).alias("isdeleted"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 35 == 4, _li_seq()),
    )


def pr_approval_feed(t: Tables) -> DataFrame:
    """ziprapprov: requisition approvals; two events share each tabkey (versions)."""
    e = t.events
    return e.select(
        doc(F.expr("event_id div 2")).alias("tabkey"),
        F.concat(doc(F.col("user_id") + 150 * (F.col("event_id") % 97)),
                 pad(F.col("event_id") % 7 + 1, 5)).alias("purchasereqnitemuniqueid"),
        F.date_format("ts", "yyyyMMdd").alias("updatedate"),
        F.date_format("ts", "HHmmss").alias("updatetime"),
        *envelope(F.col("ts"), F.col("event_type") == "error", F.col("event_id")),
    )


def po_approval_feed(t: Tables) -> DataFrame:
    """zipoapprov: purchase-order approval steps (code '00' = final approval)."""
    e = t.events
    return e.select(
        doc(F.col("user_id") + 150 * (F.col("event_id") % 20)).alias("purchasingdocument"),
        F.when(F.col("event_type") == "purchase", F.lit("00")).otherwise(F.lit("01")).alias("approvercode"),
        F.date_format("ts", "yyyyMMdd").alias("approvedate"),
        F.date_format("ts", "HHmmss").alias("approvetime"),
        tag("U", F.col("event_id") % 50).alias("approveusername"),
        tag("Level ", F.col("event_id") % 3).alias("approverdescription"),
        F.when(F.col("value") >= 50.0, F.lit("X")).otherwise(F.lit("")).alias("isapprove"),
        *envelope(_known(F.col("ts"), F.col("user_id") % 23 != 4), F.col("event_id") % 31 == 0, F.col("event_id")),
    )


def info_record_feed(t: Tables) -> DataFrame:
    """ziinforecorgdata: info records per (record, org, category, plant);
    plant is NULL for a share of the rows (org-level records)."""
    li = t.lineitem
    return li.select(
        tag("I", F.col("l_partkey") - F.col("l_partkey") % 4).alias("purchasinginforecord"),
        tag("O", F.col("l_suppkey") % 2).alias("purchasingorganization"),
        F.when(F.col("l_linestatus") == "F", F.lit("0")).otherwise(F.lit("2")).alias("purchasinginforecordcategory"),
        F.when(F.col("l_suppkey") % 6 != 5, tag("P", F.col("l_suppkey") % 5)).alias("plant"),
        F.col("l_quantity").alias("materialplanneddeliverydurn"),
        F.when(F.col("l_discount") <= 0.08, compact_date(F.date_add(F.col("l_shipdate").cast("date"), 365)))
         .alias("pricevalidityenddate"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 60 == 11, _li_seq()),
    )


def goods_movement_feed(t: Tables) -> DataFrame:
    """zigoodsmvmtdoc: material documents with a six-part key."""
    li = t.lineitem
    amount = F.col("l_extendedprice").cast("decimal(18,2)")
    qty = F.col("l_quantity").cast("decimal(18,2)")
    null_str = F.lit(None).cast("string")
    return li.select(
        doc(F.col("l_orderkey")).alias("materialdocumentkey1"),
        pad(F.col("l_linenumber"), 4).alias("materialdocumentkey2"),
        doc(F.col("l_suppkey")).alias("materialdocumentkey3"),
        doc(F.col("l_partkey")).alias("materialdocumentkey4"),
        F.when(F.col("l_partkey") % 71 != 0, F.col("l_linestatus")).alias("materialdocumentkey5"),
        F.year("l_shipdate").cast("string").alias("materialdocumentkey6"),
        F.year("l_shipdate").cast("string").alias("materialdocumentyear"),
        F.concat(F.lit("49"), pad(F.col("l_orderkey"), 8)).alias("materialdocument"),
        pad(F.col("l_linenumber"), 4).alias("materialdocumentitem"),
        tag("P", F.col("l_suppkey") % 5).alias("plant"),
        tag("S", F.col("l_partkey") % 4).alias("storagelocation"),
        tag("M", F.col("l_partkey")).alias("material"),
        F.when(F.col("l_returnflag") != "N", tag("B", F.col("l_returnflag"))).alias("batch"),
        F.lit("EA").alias("materialbaseunit"),
        _unit(F.col("l_partkey")).alias("entryunit"),
        compact_date(F.col("l_shipdate")).alias("postingdate"),
        doc(F.col("l_orderkey")).alias("purchaseorder"),
        pad(F.col("l_linenumber"), 5).alias("purchaseorderitem"),
        null_str.alias("manufacturingorder"),
        null_str.alias("manufacturingorderitem"),
        tag("U", F.col("l_suppkey") % 50).alias("createdbyuser"),
        doc(F.col("l_suppkey")).alias("supplier"),
        null_str.alias("customer"),
        doc(F.col("l_orderkey")).alias("referencedocument"),
        _movement_type().alias("goodsmovementtype"),
        tag("GR ", F.col("l_orderkey")).alias("materialdocumentheadertext"),
        tag("Line ", F.col("l_linenumber")).alias("materialdocumentitemtext"),
        _credit_code().alias("debitcreditcode"),
        amount.alias("totalgoodsmvtamtincccrcy"),
        qty.alias("quantityinbaseunit"),
        qty.alias("quantityinentryunit"),
        qty.alias("goodsreceiptqtyinorderunit"),
        *envelope(F.col("l_shipdate"), F.col("l_partkey") % 55 == 5, _li_seq()),
    )


# ---------------------------------------------------------------- lookups


def product(t: Tables) -> DataFrame:
    p = t.part
    return p.select(tag("M", F.col("p_partkey")).alias("product"),
                    tag("G", F.col("p_partkey") % 10).alias("productgroup"),
                    pick(F.col("p_size") % 3, ["EA", "KG", "G"]).alias("baseunit"))


def product_uom(t: Tables) -> DataFrame:
    """Alternative units per product: EA, BOX, G always, KG only for odd parts.
    Numerators/denominators come from {1, 2, 5, 10, 0, NULL}."""
    p = t.part.withColumn("u", F.explode(F.sequence(F.lit(0), (2 + F.col("p_partkey") % 2).cast("int"))))
    return p.select(
        tag("M", F.col("p_partkey")).alias("product"),
        pick(F.col("u"), ["EA", "BOX", "G", "KG"]).alias("alternativeunit"),
        pick((F.col("p_partkey") + F.col("u")) % 6, [1, 3, 5, 7, 0, None]).cast("decimal(18,3)")
         .alias("quantitynumerator"),
        pick((F.col("p_partkey") * 7 + F.col("u")) % 5, [3, 2, 7, 10, 0]).cast("decimal(18,3)")
         .alias("quantitydenominator"),
    )


def product_plant(t: Tables) -> DataFrame:
    p = t.part.withColumn("k", F.explode(F.sequence(F.lit(0), F.lit(4))))
    return p.select(tag("M", F.col("p_partkey")).alias("product"),
                    tag("P", F.col("k")).alias("plant"),
                    (F.col("p_size") * (F.col("k") + 1)).cast("decimal(18,3)").alias("safetystockquantity"))


def product_group(t: Tables) -> DataFrame:
    g = t.part.select((F.col("p_partkey") % 10).alias("g")).distinct()
    return g.select(tag("G", F.col("g")).alias("materialgroup"),
                    tag("Group ", F.col("g")).alias("materialgroupname"))


def supplier(t: Tables) -> DataFrame:
    return t.supplier.select(doc(F.col("s_suppkey")).alias("supplier"), F.col("s_name").alias("suppliername"))


def purchasing_group(t: Tables) -> DataFrame:
    return t.nation.select(tag("PG", F.col("n_nationkey")).alias("purchasinggroup"),
                           F.col("n_name").alias("purchasinggroupname"))


def user(t: Tables) -> DataFrame:
    return t.customer.select(tag("U", F.col("c_custkey")).alias("userid"), F.col("c_name").alias("fullname"))


def unit_of_measure(spark: SparkSession) -> DataFrame:
    """Internal -> external unit codes (fixed master data; BOX has no entry).

    Built as an inline VALUES relation: unlike an RDD-backed frame it carries
    size statistics, so the planner sees it is tiny and broadcasts it instead
    of shuffling the item rows by a unit code with a handful of values."""
    rows = ", ".join(f"('{a}', '{b}')" for a, b in UNIT_CODES)
    return spark.sql(f"SELECT * FROM VALUES {rows} AS t(unitofmeasure, unitofmeasure_e)")


FEEDS = {
    "zigoodsmvmtdoc": goods_movement_feed,
    "ziinforecorgdata": info_record_feed,
    "zimmprgdocsl": schedule_feed,
    "zimmpurdochist": po_history_feed,
    "zimmpurgdocitem": po_item_feed,
    "zipoapprov": po_approval_feed,
    "ziprapprov": pr_approval_feed,
    "zipricingelement": pricing_feed,
    "zipritem": pr_item_feed,
    "zmmpurchasingdoc": po_header_feed,
}


class Lookups:
    def __init__(self, spark: SparkSession, t: Tables):
        self.spark, self.t = spark, t

    @property
    def ziproduct(self): return product(self.t)

    @property
    def ziprduom(self): return product_uom(self.t)

    @property
    def ziprdplant(self): return product_plant(self.t)

    @property
    def ziproductgrp(self): return product_group(self.t)

    @property
    def zisupplier(self): return supplier(self.t)

    @property
    def zimmpurchgroup(self): return purchasing_group(self.t)

    @property
    def ziuser(self): return user(self.t)

    @property
    def ziunitofmeasure(self): return unit_of_measure(self.spark)
