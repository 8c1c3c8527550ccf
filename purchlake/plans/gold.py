"""Gold marts built from the silver tables.

Each mart takes silver DataFrames (read from tables in production, or
built inline for tests) and an optional ``target`` -- the mart's current
contents -- for its high-water mark.  ``target=None`` means an empty mart:
every live row is in scope.

Plan shape, chosen for large inputs:

* aggregate before joining (receipts and pricing are reduced to one row per
  item with partial/final hash aggregation);
* every right side of the item mart's joins has at most one row per join key
  except the two requisition joins, which fan out exactly like the
  reference's left joins do (several requisitions per PO item, several
  approvals per requisition);
* the measures the reference computes in a separate CTE and self-joins back
  (remaining quantity/value, unit price) are computed as columns on the same
  frame -- identical while the item key is unique, and one shuffle cheaper;
* rows with a NULL material or plant are kept out of the latest-price window
  (they could never match the equi-join), so no NULL group can skew it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import (late_days, ntz, lead_days, open_end_date, remaining_qty, remaining_value,
                         safe_ratio, substr_from, to_local, uom_to_base, uom_to_target)
from ..fixed import (CONDITION_TOTALS, CREDIT_CODE, DELIVERED, FIRST_SCHEDULE_LINE, GRAM_UNIT, GRAMS_PER_KG,
                     LOCAL_CURRENCY, RECEIPT_MOVEMENTS, RELEASED, SUPPLIER_FROM)
from ..operators.aggregate import conditional_sum, converted_sum, signed_sum
from ..operators.dedup import latest_per_key, preferred_match
from ..operators.enrich import hot_keys, lookup
from ..operators.incremental import DEFAULT_FLOOR, DEFAULT_LOOKBACK, since

MART_AUDIT = "last_main_silver_modified_dt"
ENVELOPE_OUT = ["ingestiontime", "isinsert", "isupsert", "isdelete", "changetype"]



def _live(df: DataFrame) -> DataFrame:
    """Soft-delete filter: ``isdelete = false`` (drops TRUE and NULL)."""
    return df.where(F.col("isdelete") == F.lit(False))


def _live_items(items: DataFrame) -> DataFrame:
    return _live(items).where(F.col("purchasingdocumentdeletioncode").isNull())


def _slice(df: DataFrame, target: DataFrame | None, lookback: str, floor: dt.datetime,
           watermark_col: str = "ingestiontime") -> DataFrame:
    """Rows of the main table at or after the mart's mark.  ``watermark_col``
    names the mart column the mark is taken from (the info-record mart stores
    the info record's ingestion time there, yet slices items by theirs: Q4).
    The mark is fetched first: a mart reads its slice in several places (hot keys, latest price), and in
    each the driver would plan the target anew for a subquery."""
    if target is None:
        return df.where(F.col("ingestiontime") >= ntz(floor) - F.expr(f"INTERVAL {lookback}"))
    return since(df, target, target_ts_col=watermark_col, lookback=lookback, floor=floor, mode="literal")


# ---------------------------------------------------------------- last price


def mart_last_price(items: DataFrame, headers: DataFrame) -> DataFrame:
    """Latest non-NULL unit price per material (full recompute).

    Latest = highest PO number (string order), then newest ingestion; the
    item number breaks the remaining ties.  Header soft-deletes are not
    applied here, as in the reference.  Headers grow with the data; two of their columns
    pass for small by the planner's size, so they are sort-merge joined."""
    base = (_live_items(items).where(F.col("material").isNotNull())
            .select("material", "purchasingdocument", "purchasingdocumentitem", "ingestiontime",
                    safe_ratio("netpriceamount", "netpricequantity").alias("price_per_unit"))
            .where(F.col("price_per_unit").isNotNull()))
    ranked = base.join(headers.select("purchasingdocument", "purchasingdocumentorderdate").hint("merge"),
                       "purchasingdocument", "inner")
    top = latest_per_key(ranked, ["material"],
                         [F.desc("purchasingdocument"), F.desc("ingestiontime")],
                         [F.desc("purchasingdocumentitem")])
    return top.select(
        "material",
        F.col("purchasingdocument").alias("latest_price_po_document"),
        F.col("purchasingdocumentitem").alias("latest_price_po_item"),
        F.col("purchasingdocumentorderdate").alias("latest_price_po_date"),
        F.col("price_per_unit").alias("latest_material_price_per_unit"),
        F.current_timestamp().alias("last_modified_dt"),
    )


# ---------------------------------------------------------------- header / item projections

ITEM_ATTRS = ["material", "material_description", "materialgroup", "materialgroupname", "baseunit",
              "orderquantityunit", "free_item", "purchaserequisition", "purchaserequisitionitem",
              "orderquantity", "netpriceamount", "netpricequantity", "netamount", "taxcode",
              "safetystockquantity"]
HEADER_ATTRS = ["supplier", "suppliername", "releasecode", "purchasinggroup", "documentcurrency",
                "exchangerate", "purchasingdocumentorderdate", "paymentterms", "incotermsclassification",
                "purchasingdocumentcondition", "purgreleasetimetotalamount"]


def _headers(headers: DataFrame) -> DataFrame:
    return _live(headers).select("purchasingdocument", *HEADER_ATTRS, "purchasinggroupname")


# ---------------------------------------------------------------- history mart

HISTORY_COLS = ["purchasingdocument", "purchasingdocumentitem", "accountassignmentnumber",
                "purchasinghistorydocumenttype", "purchasinghistorydocumentyear", "purchasinghistorydocument",
                "purchasinghistorydocumentitem", "goodsmovementtype", "postingdate", "debitcreditcode", "quantity",
                "purordamountincompanycodecrcy", "purchaseorderamount"]


def mart_po_history(history: DataFrame, items: DataFrame, headers: DataFrame,
                    target: DataFrame | None = None, lookback: str = DEFAULT_LOOKBACK,
                    floor: dt.datetime = DEFAULT_FLOOR, watermark_col: str = "ingestiontime") -> DataFrame:
    """History rows with item and header attributes (header via the item).  Items and headers grow
    with the data and are never broadcast, however small their packed files are.  The items get their header
    first, so the history rows move for the item key only (never NULL: silver guards)."""
    h = _slice(_live(history), target, lookback, floor, watermark_col).select(*HISTORY_COLS, *ENVELOPE_OUT)
    po = lookup(_live_items(items).select("purchasingdocument", "purchasingdocumentitem", *ITEM_ATTRS), _headers(headers),
                [("purchasingdocument", "purchasingdocument")], {c: c for c in HEADER_ATTRS}, spread_null_keys=False, grows=True)
    out = lookup(h, po, [("purchasingdocument", "purchasingdocument"),
                         ("purchasingdocumentitem", "purchasingdocumentitem")],
                 {c: c for c in [*ITEM_ATTRS, *HEADER_ATTRS]}, spread_null_keys=False, grows=True)
    return out.select(*HISTORY_COLS, *ITEM_ATTRS, *HEADER_ATTRS, *ENVELOPE_OUT,
                      F.current_timestamp().alias(MART_AUDIT))


# ---------------------------------------------------------------- info-record mart

INFO_COLS = ["purchasinginforecord", "purchasingorganization", "purchasinginforecordcategory", "plant",
             "materialplanneddeliverydurn", "pricevalidityenddate"]


def mart_info_record(items: DataFrame, info: DataFrame, headers: DataFrame,
                     target: DataFrame | None = None, lookback: str = DEFAULT_LOOKBACK,
                     floor: dt.datetime = DEFAULT_FLOOR, watermark_col: str = "ingestiontime") -> DataFrame:
    """Each live PO item with its preferred info record: same plant first,
    then a plant-less record, then any other; within a class the newest
    record wins (then organisation, category, plant).  Records and headers grow with the data and
    are never broadcast."""
    po = _slice(_live_items(items), target, lookback, floor, watermark_col).select(
        "purchasingdocument", "purchasingdocumentitem", "plant", "purchasinginforecord", *ITEM_ATTRS)
    i = _live(info)
    right = ["purchasinginforecord", "purchasingorganization", "purchasinginforecordcategory", "plant",
             "materialplanneddeliverydurn", "pricevalidityenddate", *ENVELOPE_OUT]
    rename = {c: f"i_{c}" for c in right}
    m = preferred_match(po, i, key=("purchasinginforecord", "purchasinginforecord"), attr=("plant", "plant"),
                        order=["-ingestiontime", "purchasingorganization", "purchasinginforecordcategory", "plant"],
                        right_cols=right, rename=rename, hot=hot_keys(po, ["purchasinginforecord"]))
    m = m.withColumn("i_pricevalidityenddate", open_end_date("i_pricevalidityenddate"))
    h = _headers(headers)
    out = lookup(m, h, [("purchasingdocument", "purchasingdocument")],
                 {f"h_{c}": c for c in HEADER_ATTRS if c != "purchasinggroupname"}, grows=True)
    return out.select(
        *[F.col(f"i_{c}").alias(c) for c in INFO_COLS],
        "purchasingdocument", "purchasingdocumentitem",
        "material", "material_description", "materialgroup", "materialgroupname", "baseunit",
        "orderquantityunit", "free_item", "purchaserequisition", "purchaserequisitionitem", "orderquantity",
        "netpriceamount", "netpricequantity", "netamount", "taxcode", "safetystockquantity",
        *[F.col(f"h_{c}").alias(c) for c in HEADER_ATTRS],
        *[F.col(f"i_{c}").alias(c) for c in ENVELOPE_OUT],
        F.current_timestamp().alias(MART_AUDIT),
    )


# ---------------------------------------------------------------- item mart


def receipts_by_item(history: DataFrame) -> DataFrame:
    """First/last posting date over all history types; signed receipt sums
    over movement types 101/102 (credit code 'H' negates)."""
    is_gr = F.col("goodsmovementtype").isin(*RECEIPT_MOVEMENTS)
    credit = F.col("debitcreditcode") == CREDIT_CODE
    return (_live(history).groupBy("purchasingdocument", "purchasingdocumentitem").agg(
        F.min("postingdate").alias("first_grdate"),
        F.max("postingdate").alias("latest_grdate"),
        signed_sum("quantity", is_gr, credit).alias("gr_qty"),
        signed_sum("purordamountincompanycodecrcy", is_gr, credit).alias("gr_value_thb"),
        signed_sum("purchaseorderamount", is_gr, credit).alias("gr_value_pocurrency"),
    ))




def pricing_by_item(pricing: DataFrame) -> DataFrame:
    """Manual pivot of active pricing conditions per (pricing doc, item)."""
    active = F.col("conditioninactivereason").isNull()
    local = F.col("conditioncurrency") == LOCAL_CURRENCY
    aggs = []
    for name, ctype in CONDITION_TOTALS.items():
        cond = (F.col("conditiontype") == ctype) & active
        aggs.append(conditional_sum("conditionamount", cond).alias(f"{name}_amount"))
        aggs.append(converted_sum("conditionamount", "pricedetnexchangerate", "conditionratevalue", cond, local)
                    .alias(f"{name}_amount_thb"))
    aggs.append(conditional_sum("conditionamount", active).alias("po_actual_value"))
    return _live(pricing).groupBy("pricingdocument", "pricingdocumentitem").agg(*aggs)


#: Master data of a unit conversion; used up before the rows move.
UOM_FACTORS = [f"quantity_{part}{unit}" for unit in ("", "_kg", "_ea") for part in ("numerator", "denominator")]


def converted_units(items: DataFrame) -> DataFrame:
    """The ordered quantity in base unit, KG and EA instead of the six factors it is made with."""
    qty = "orderquantity"
    return items.select(
        "*", uom_to_base(qty, "quantity_numerator", "quantity_denominator").alias("material_qty_conversion"),
        uom_to_target(qty, "quantity_numerator", "quantity_denominator", "quantity_numerator_kg",
                      "quantity_denominator_kg", fallback=("orderquantityunit", GRAM_UNIT, GRAMS_PER_KG))
         .alias("quantity_in_kg"),
        uom_to_target(qty, "quantity_numerator", "quantity_denominator", "quantity_numerator_ea",
                      "quantity_denominator_ea").alias("quantity_in_ea"),
    ).drop(*UOM_FACTORS)


def item_prices(po: DataFrame, d: DataFrame, pricing: DataFrame) -> DataFrame:
    """Item key, latest price and pricing totals of each item of ``po``: what is looked up by other keys than
    the item's, on a narrow frame.  Prices come first, so the totals move no further."""
    item_id = ["purchasingdocument", "purchasingdocumentitem"]

    # latest unit price per (material, plant) within the slice, from a narrow
    # projection of the items (NULL material / plant can never match)
    priced = (po.select("material", "plant", "ingestiontime", *item_id,
                        safe_ratio("netpriceamount", "netpricequantity").alias("price_per_unit"))
                .where(F.col("price_per_unit").isNotNull() & F.col("material").isNotNull()
                       & F.col("plant").isNotNull()))
    priced = lookup(priced, d, [("purchasingdocument", "purchasingdocument")],
                    {"lm_date": "purchasingdocumentorderdate", "lm_doc": "purchasingdocument"},
                    spread_null_keys=False, grows=True)
    lm = latest_per_key(priced, ["material", "plant"], [F.desc_nulls_last("lm_date"), F.desc("ingestiontime")],
                        [F.desc("purchasingdocument"), F.desc("purchasingdocumentitem")])

    r = lookup(po.select(*item_id, "material", "plant"), d, [("purchasingdocument", "purchasingdocument")],
               {"condition": "purchasingdocumentcondition"}, spread_null_keys=False, grows=True)
    r = lookup(r, lm, [("material", "material"), ("plant", "plant")],
               {"lm_price": "price_per_unit", "lm_date": "lm_date", "lm_doc": "lm_doc"}, salt_cols=item_id,
               hot=hot_keys(po, ["material", "plant"]), grows=True).drop("material", "plant")
    totals = [f"{name}_amount{unit}" for name in CONDITION_TOTALS for unit in ("", "_thb")]
    r = lookup(r, pricing_by_item(pricing), [("condition", "pricingdocument"), ("purchasingdocumentitem", "pricingdocumentitem")],
               {f"p_{c}": c for c in [*totals, "po_actual_value"]}, salt_cols=item_id, grows=True)
    return r.select(*item_id, "lm_price", "lm_date", "lm_doc", "p_po_actual_value",
                    *[F.col(f"p_{c}").cast("decimal(18,4)").alias(f"total_{c}") for c in totals])


def mart_po_item(items: DataFrame, pr_items: DataFrame, schedule: DataFrame, po_approvals: DataFrame,
                 pr_approvals: DataFrame, headers: DataFrame, history: DataFrame, pricing: DataFrame,
                 units: DataFrame, target: DataFrame | None = None, lookback: str = DEFAULT_LOOKBACK,
                 floor: dt.datetime = DEFAULT_FLOOR, watermark_col: str = "ingestiontime",
                 store: Callable[[DataFrame, str], DataFrame] | None = None) -> DataFrame:
    """Wide PO-item fact (76 columns).  The item key is unique (a keyed silver load sees to it).
    All that is looked up grows with the data, but for the fixed units, and is never broadcast.
    ``store`` writes a step to disk and reads it back, so its shuffle files are gone before the next one's come."""
    po = _slice(_live_items(items), target, lookback, floor, watermark_col)
    d = _headers(headers)
    h = receipts_by_item(history)
    sl = _live(schedule).where(F.col("scheduleline") == FIRST_SCHEDULE_LINE)
    pr = _live(pr_items)
    ar = _live(pr_approvals)
    key2 = [("purchasingdocument", "purchasingdocument"), ("purchasingdocumentitem", "purchasingdocumentitem")]
    item_id = ["purchasingdocument", "purchasingdocumentitem"]

    # pricing and latest price are resolved on a narrow frame of item key and join keys,
    # requisition approvals on the requisitions, so none of their keys moves the wide rows
    r = item_prices(po, d, pricing)
    r = r if store is None else store(r, "item-prices")
    approved = lookup(pr.select(*item_id, F.col("purchasereqnitemuniqueid").alias("pr_uid")), ar,
                      [("pr_uid", "purchasereqnitemuniqueid")], {"ar_updatedate": "updatedate"}, grows=True)

    # header with its final approval: both keyed by PO, so they are joined on
    # the small side first (the approval only attaches to released headers)
    da = lookup(d, po_approvals, [("purchasingdocument", "purchasingdocument")],
                {"a_approvedate": "approvedate", "a_isapprove": "isapprove", "a_approvercode": "approvercode",
                 "a_approverdescription": "approverdescription", "a_approverfullname": "approverfullname"},
                gate=F.col("releasecode") == RELEASED, spread_null_keys=False, grows=True)

    # the wide rows move once for the item key (never NULL: silver guards) and once for the header
    f = lookup(converted_units(po), h, key2, {"first_grdate": "first_grdate", "latest_grdate": "latest_grdate",
                                              "gr_qty": "gr_qty", "gr_value_thb": "gr_value_thb",
                                              "gr_value_pocurrency": "gr_value_pocurrency"}, spread_null_keys=False, grows=True)
    f = lookup(f, sl, key2, {"po_delivery_date": "schedulelinedeliverydate"}, spread_null_keys=False, grows=True)
    f = lookup(f, r, key2, {c: c for c in r.columns if c not in item_id}, spread_null_keys=False, grows=True)
    f = lookup(f, approved, key2, {"ar_updatedate": "ar_updatedate"}, spread_null_keys=False, grows=True)
    f = lookup(f, da, [("purchasingdocument", "purchasingdocument")],
               {"d_doc": "purchasingdocument", **{f"d_{c}": c for c in HEADER_ATTRS},
                "d_purchasinggroupname": "purchasinggroupname",
                **{c: c for c in ["a_approvedate", "a_isapprove", "a_approvercode", "a_approverdescription",
                                  "a_approverfullname"]}}, spread_null_keys=False, grows=True)
    f = lookup(f, units, [("orderquantityunit", "unitofmeasure")], {"uom_p": "unitofmeasure_e"})
    f = lookup(f, units, [("baseunit", "unitofmeasure")], {"uom_b": "unitofmeasure_e"})

    return f.select(
        "purchasingdocument", "purchasingdocumentitem",
        F.col("d_purchasingdocumentorderdate").alias("purchasing_date"),
        F.col("purchaserequisition").alias("reference_pr_number"),
        F.col("d_purchasingdocumentcondition").alias("purchasingdocumentcondition"),
        "free_item", "material", "material_description", "materialgroup", "materialgroupname",
        F.col("d_purchasinggroup").alias("purchasinggroup"),
        F.col("d_purchasinggroupname").alias("purchasinggroupname"),
        "po_delivery_date", "netpriceamount", "netamount",
        to_local("netamount", "d_exchangerate").alias("netamount_thb"),
        "netpricequantity", safe_ratio("netpriceamount", "netpricequantity").alias("price_per_unit"),
        "first_grdate", "latest_grdate",
        F.col("orderquantity").alias("po_quantity"),
        F.col("uom_p").alias("purchasing_unit"),
        "material_qty_conversion", F.col("uom_b").alias("baseunit"), "quantity_in_kg", "quantity_in_ea",
        F.col("d_documentcurrency").alias("documentcurrency"),
        F.col("d_exchangerate").alias("exchangerate"),
        F.col("gr_value_thb").alias("total_gr_value_thb"),
        F.col("gr_value_pocurrency").alias("total_gr_value_po_currency"),
        safe_ratio("gr_value_thb", "gr_qty").alias("gr_value_per_unit"),
        *[f"total_{name}_amount{unit}" for name in ("freight", "clearance", "discount") for unit in ("", "_thb")],
        F.col("gr_qty").alias("total_gr_qty"),
        F.col("p_po_actual_value").alias("total_po_actual_value"),
        to_local("p_po_actual_value", "d_exchangerate").alias("total_po_actual_value_thb"),
        substr_from("d_supplier", SUPPLIER_FROM).alias("supplier"),
        F.col("d_suppliername").alias("suppliername"),
        F.col("d_paymentterms").alias("paymentterms"),
        "iscompletelydelivered",
        remaining_qty("orderquantity", "gr_qty", "iscompletelydelivered", DELIVERED).alias("gr_quantity_remain"),
        remaining_value("orderquantity", "gr_qty", "iscompletelydelivered", "netpriceamount", "netpricequantity",
                        delivered_code=DELIVERED).alias("gr_value_remain"),
        remaining_value("orderquantity", "gr_qty", "iscompletelydelivered", "netpriceamount", "netpricequantity",
                        rate="d_exchangerate", dtype="decimal(18,4)", delivered_code=DELIVERED)
        .alias("gr_value_remain_thb"),
        F.col("d_releasecode").alias("releasecode"),
        F.col("a_approvercode").alias("approvercode"),
        F.col("a_approverdescription").alias("approverdescription"),
        F.col("a_approverfullname").alias("approverfullname"),
        F.col("a_isapprove").alias("isapprove"),
        F.col("a_approvedate").alias("po_approvedate"),
        F.col("ar_updatedate").alias("pr_approvedate"),
        F.col("d_incotermsclassification").alias("incotermsclassification"),
        F.col("d_purgreleasetimetotalamount").alias("purgreleasetimetotalamount"),
        "taxcode",
        lead_days("ar_updatedate", "a_approvedate").alias("pr_to_po_approval_days"),
        lead_days("a_approvedate", "latest_grdate").alias("po_approval_to_latest_gr_days"),
        lead_days("ar_updatedate", "latest_grdate").alias("pr_approval_to_latest_gr_days"),
        lead_days("po_delivery_date", "latest_grdate").alias("po_delivery_date_to_latest_gr_days"),
        lead_days("d_purchasingdocumentorderdate", "po_delivery_date").alias("po_document_date_to_po_delivery_date"),
        lead_days("po_delivery_date", "first_grdate").alias("po_delivery_date_to_first_gr_date"),
        lead_days("a_approvedate", "first_grdate").alias("po_approval_to_first_gr_date"),
        late_days("po_delivery_date", "latest_grdate").alias("late_days"),
        "safetystockquantity",
        F.col("lm_price").alias("latest_material_price_per_unit"),
        F.col("lm_date").alias("latest_price_po_date"),
        F.col("lm_doc").alias("latest_price_po_document"),
        "purchasinginforecord", *ENVELOPE_OUT,
        F.current_timestamp().alias(MART_AUDIT),
    )


PO_ITEM_COLUMNS = 76
