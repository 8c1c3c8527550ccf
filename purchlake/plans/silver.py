"""Silver layer: one declarative spec per change feed and a generic runner.

run(spec) =  incremental slice (high-water mark on the target, 6 h overlap)
          -> not-null guards on the business key (+ optional pre-filter)
          -> latest version per business key (row_number = 1)
          -> lookups (left joins to master data)
          -> conforming projection to the silver contract
          -> DISTINCT where the reference asks for it.

DISTINCT is a full shuffle over every column.  When the contract carries every
business-key column unchanged (or cut by a prefix proven to be the same in all rows)
and all lookups are proven unique in their keys (or there are none), the rows are already
unique (one per key after the top-1), so the runner skips it; the result is identical.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Collection, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import concat_strict, ntz, label, null_or_empty_flag, parse_compact_date, parse_compact_ts, substr_from
from ..fixed import CONDITION_LABELS, EA_UNIT, FINAL_APPROVAL_CODE, KG_UNIT, PRICING_ITEM_FROM
from ..operators.checks import proven_unique
from ..operators.conform import Field, conform
from ..operators.dedup import latest_per_key
from ..operators.enrich import lookup
from ..operators.incremental import DEFAULT_FLOOR, DEFAULT_LOOKBACK, require_keys, since

ENVELOPE = ["ingestiontime", "isupsert", "isdelete", "isinsert", "changetype"]
AUDIT = "last_modified_dt"
STR, D2, D3, D4 = "string", "decimal(18,2)", "decimal(18,3)", "decimal(18,4)"



@dataclass
class SilverSpec:
    name: str
    feed: str
    keys: list[str]
    guards: list[str]
    contract: list[Field]
    order: list[Column] = field(default_factory=lambda: [F.desc("ingestiontime")])
    tie_breakers: list[Column] = field(default_factory=lambda: [F.desc("changesequence")])
    prefilter: Column | None = None
    enrich: Callable[[DataFrame, object], DataFrame] | None = None
    lookups: tuple[str, ...] = ()  # those that enrich reads by key
    distinct: bool = False
    cut: Mapping[str, int] = field(default_factory=dict)  # key columns carried from this position on

    @property
    def columns(self) -> list[str]:
        return [f.name for f in self.contract] + [AUDIT]

    def keeps_key(self, whole: Collection[str] = ()) -> bool:
        """Whether the contract carries every business-key column unchanged.  ``whole``: columns whose
        cut is proven to lose nothing."""
        kept = {f.name for f in self.contract
                if (f.source is None or (isinstance(f.source, str) and f.source == f.name))
                and f.dtype in (None, STR)}
        return set(self.keys) <= kept | (set(self.cut) & set(whole))

    def distinct_needed(self, unique: Collection[str] = (), whole: Collection[str] = ()) -> bool:
        """``unique``: lookups whose keys are proven unique.  One row per key after the top-1 stays
        one row per key through joins with those, so there is nothing to take out.
        ``whole``: key columns whose cut is proven to lose nothing."""
        return self.distinct and not (self.keeps_key(whole) and set(self.lookups) <= set(unique))


def _fields(spec: Sequence[tuple]) -> list[Field]:
    out = []
    for item in spec:
        name, dtype, *src = item
        out.append(Field(name, src[0] if src else name, dtype))
    return out


def _envelope() -> list[Field]:
    return [Field(c) for c in ENVELOPE]


def run(spec: SilverSpec, feed: DataFrame, lookups=None, target: DataFrame | None = None,
        initial: bool = False, lookback: str = DEFAULT_LOOKBACK, floor: dt.datetime = DEFAULT_FLOOR,
        hwm_mode: str = "subquery", on_error: str = "null", mark: dt.datetime | None = None,
        unique: Collection[str] = (), whole: Collection[str] = ()) -> DataFrame:
    """Build one silver batch.

    initial=True  : full history, no high-water mark (initial-load variant).
    target=None   : incremental against an empty target (everything with a
                    non-NULL ingestion time).
    target=frame  : incremental against the current silver table.
    mark=datetime : the target's max(ingestiontime), already known (stored
                    with the table), so the target is not scanned for it.
    unique        : names of lookups proven unique in their keys (``unique_lookups``);
                    a DISTINCT that they make void is left out.
    whole         : key columns whose cut is proven to lose nothing (``lossless_cuts``); likewise."""
    if initial:
        df = feed
    elif mark is not None or target is None:
        zoned = feed.schema["ingestiontime"].dataType.simpleString() == "timestamp"
        at = F.lit(mark or floor) if zoned else ntz(mark or floor)  # in the column's own type
        df = feed.filter(F.col("ingestiontime") >= at - F.expr(f"INTERVAL {lookback}"))
    else:
        df = since(feed, target, lookback=lookback, floor=floor, mode=hwm_mode)
    df = require_keys(df, spec.guards)
    if spec.prefilter is not None:
        df = df.filter(spec.prefilter)
    df = latest_per_key(df, spec.keys, spec.order, spec.tie_breakers)
    if spec.enrich is not None:
        df = spec.enrich(df, lookups)
    out = conform(df, spec.contract, on_error=on_error).withColumn(AUDIT, F.current_timestamp())
    if spec.distinct_needed(unique, whole):
        out = out.distinct()
    return out


def newest_versions(spec: SilverSpec, feed: DataFrame, initial: bool = False) -> DataFrame:
    """(keys, ingestiontime): the version of each key that a load of the whole feed would keep."""
    df = feed if initial else feed.where(F.col("ingestiontime").isNotNull())
    df = require_keys(df, spec.guards)
    if spec.prefilter is not None:
        df = df.filter(spec.prefilter)
    return latest_per_key(df, spec.keys, spec.order, spec.tie_breakers).select(*spec.keys, "ingestiontime")


# ------------------------------------------------------------------ enrichments


#: Keys that the lookups are looked up by; expected to be unique, see ``checks.KeyChecks``.
LOOKUP_KEYS = {"ziproduct": ["product"], "ziprduom": ["product", "alternativeunit"], "ziprdplant": ["product", "plant"],
               "ziproductgrp": ["materialgroup"], "zisupplier": ["supplier"], "zimmpurchgroup": ["purchasinggroup"],
               "ziuser": ["userid"]}


def unique_lookups(lookups, names: Collection[str] = tuple(LOOKUP_KEYS)) -> frozenset[str]:
    """Which of the lookups hold each key once, found by one job over them."""
    return proven_unique({n: (getattr(lookups, n), LOOKUP_KEYS[n]) for n in names})


def lossless_cuts(spec: SilverSpec, feed: DataFrame) -> frozenset[str]:
    """Key columns of which the contract drops the same prefix in every row of the feed: what is left tells
    all their values apart.  One job over those columns, two strings a column come back."""
    if not spec.cut:
        return frozenset()
    head = {c: F.substring(F.col(c).cast(STR), 1, at - 1) for c, at in spec.cut.items()}
    ends = feed.agg(*[f(h).alias(f"{n}_{c}") for c, h in head.items() for n, f in (("min", F.min), ("max", F.max))]).first()
    return frozenset(c for c in head if ends[f"min_{c}"] == ends[f"max_{c}"])


def units_per_product(uom: DataFrame) -> DataFrame:
    """One row per product with its KG and EA factors as columns; of several rows of one unit, one is taken whole."""
    def of(unit: str):
        return F.max(F.when(F.col("alternativeunit") == unit, F.struct("quantitynumerator", "quantitydenominator")))
    return uom.groupBy("product").agg(of(KG_UNIT).alias("kg"), of(EA_UNIT).alias("ea")).select(
        "product", F.col("kg.quantitynumerator").alias("kg_num"), F.col("kg.quantitydenominator").alias("kg_den"),
        F.col("ea.quantitynumerator").alias("ea_num"), F.col("ea.quantitydenominator").alias("ea_den"))


def rows_per_product(dim: DataFrame, name: str, cols: Sequence[str]) -> DataFrame:
    """One row per (non-NULL) product with all its rows as a list, as long as a product has units or plants."""
    return dim.where(F.col("product").isNotNull()).groupBy("product").agg(F.collect_list(F.struct(*cols)).alias(name))


def _match(df: DataFrame, rows: str, on: tuple[str, str], cols: Mapping[str, str]) -> DataFrame:
    """``lookup`` among the rows listed in column ``rows``: every match gives a row, none gives NULLs."""
    left, right = on
    hits = F.transform(F.filter(rows, lambda x: x[right] == F.col(left)),
                       lambda x: F.struct(*[x[src].alias(name) for name, src in cols.items()]))
    return df.select("*", F.inline_outer(hits)).drop(rows)


def _enrich_po_item(df: DataFrame, lk) -> DataFrame:
    """Master data of an item.  A product's factors to KG and EA, its units and its plants are
    gathered on the small side, so the wide item rows move once for the product and once for the group, and
    their own unit and plant are found in the lists.  All of it grows with the products and is never broadcast.
    (product, alternativeunit) is expected to be unique in the unit table; the load counts rows
    that are not (``checks.KeyChecks``)."""
    item = ["purchasingdocument", "purchasingdocumentitem"]
    factors = ["kg_num", "kg_den", "ea_num", "ea_den"]
    unit, stock = ["alternativeunit", "quantitynumerator", "quantitydenominator"], ["plant", "safetystockquantity"]
    product = lookup(lk.ziproduct, units_per_product(lk.ziprduom), [("product", "product")],
                     {c: c for c in factors}, spread_null_keys=False, grows=True)
    product = lookup(product, rows_per_product(lk.ziprduom, "units", unit), [("product", "product")],
                     {"units": "units"}, spread_null_keys=False, grows=True)
    df = lookup(df, product, [("material", "product")],
                {"pr_product": "product", "pr_productgroup": "productgroup", "pr_baseunit": "baseunit",
                 **{c: c for c in [*factors, "units"]}}, salt_cols=item, grows=True)
    df = _match(df, "units", ("orderquantityunit", "alternativeunit"),
                {"u_num": "quantitynumerator", "u_den": "quantitydenominator"})
    df = lookup(df, rows_per_product(lk.ziprdplant, "plants", stock), [("material", "product")],
                {"plants": "plants"}, salt_cols=item, grows=True)
    df = _match(df, "plants", ("plant", "plant"), {"p_safetystock": "safetystockquantity"})
    df = lookup(df, lk.ziproductgrp, [("materialgroup", "materialgroup")],
                {"pgr_name": "materialgroupname"}, salt_cols=item)
    return df


def _enrich_po_header(df: DataFrame, lk) -> DataFrame:
    """Suppliers grow with the data and pack well, so they are never broadcast."""
    df = lookup(df, lk.zisupplier, [("supplier", "supplier")], {"s_name": "suppliername"}, grows=True)
    return lookup(df, lk.zimmpurchgroup, [("purchasinggroup", "purchasinggroup")],
                  {"g_name": "purchasinggroupname"})


def _enrich_po_approval(df: DataFrame, lk) -> DataFrame:
    """Users grow with the data and pack well, so they are never broadcast."""
    return lookup(df, lk.ziuser, [("approveusername", "userid")], {"u_fullname": "fullname"}, grows=True)


# ------------------------------------------------------------------ contracts

def build_specs() -> dict[str, SilverSpec]:
    """All silver specs.  Built on call: Column objects need a live session."""

    GOODS_MOVEMENT = _fields([
        *[(f"materialdocumentkey{i}", STR) for i in range(1, 7)],
        ("materialdocumentyear", STR), ("materialdocument", STR), ("materialdocumentitem", STR),
        ("plant", STR), ("storagelocation", STR), ("material", STR), ("batch", STR),
        ("materialbaseunit", STR), ("entryunit", STR),
        ("postingdate", None, lambda strict: parse_compact_date("postingdate", strict)),
        ("purchaseorder", STR), ("purchaseorderitem", STR), ("manufacturingorder", STR),
        ("manufacturingorderitem", STR), ("createdbyuser", STR), ("supplier", STR), ("customer", STR),
        ("referencedocument", STR), ("goodsmovementtype", STR), ("materialdocumentheadertext", STR),
        ("materialdocumentitemtext", STR), ("debitcreditcode", STR),
        ("totalgoodsmvtamtincccrcy", D2), ("quantityinbaseunit", D2), ("quantityinentryunit", D2),
        ("goodsreceiptqtyinorderunit", D2),
    ]) + _envelope()

    INFO_RECORD = _fields([
        ("purchasinginforecord", STR), ("purchasingorganization", STR), ("purchasinginforecordcategory", STR),
        ("plant", STR), ("materialplanneddeliverydurn", "double"),
        ("pricevalidityenddate", None, lambda strict: parse_compact_date("pricevalidityenddate", strict)),
    ]) + _envelope()

    SCHEDULE_LINE = _fields([
        ("purchasingdocument", STR), ("purchasingdocumentitem", STR), ("scheduleline", STR),
        ("schedulelinedeliverydate", None, lambda strict: parse_compact_date("schedulelinedeliverydate", strict)),
    ]) + _envelope()

    PO_HISTORY = _fields([
        ("purchasingdocument", STR), ("purchasingdocumentitem", STR), ("accountassignmentnumber", STR),
        ("purchasinghistorydocumenttype", STR), ("purchasinghistorydocumentyear", STR),
        ("purchasinghistorydocument", STR), ("purchasinghistorydocumentitem", STR), ("goodsmovementtype", STR),
        ("postingdate", None, lambda strict: parse_compact_date("postingdate", strict)),
        ("quantity", D3), ("debitcreditcode", STR), ("purordamountincompanycodecrcy", D2),
        ("purchaseorderamount", D2),
    ]) + _envelope()

    PO_ITEM = _fields([
        ("purchasingdocument", STR), ("purchasingdocumentitem", STR), ("purchasingdocumentcategory", STR),
        ("material", STR), ("material_description", STR, "purchasingdocumentitemtext"),
        ("quantity_numerator", D3, "u_num"), ("quantity_denominator", D3, "u_den"),
        ("quantity_numerator_kg", D3, "kg_num"), ("quantity_denominator_kg", D3, "kg_den"),
        ("quantity_numerator_ea", D3, "ea_num"), ("quantity_denominator_ea", D3, "ea_den"),
        ("plant", STR), ("materialgroup", STR, "pr_productgroup"), ("materialgroupname", STR, "pgr_name"),
        ("netpriceamount", D3), ("orderquantityunit", STR), ("baseunit", STR, "pr_baseunit"),
        ("free_item", None, null_or_empty_flag("invoiceisexpected")),
        ("purchaserequisition", STR), ("purchaserequisitionitem", STR), ("purchasinginforecord", STR),
        ("orderquantity", D3), ("taxcode", STR), ("safetystockquantity", D3, "p_safetystock"),
        ("netamount", D3), ("netpricequantity", D3), ("purchasingdocumentdeletioncode", STR),
        ("iscompletelydelivered", STR),
    ]) + _envelope()

    PO_APPROVAL = _fields([
        ("purchasingdocument", STR),
        ("approvedate", None, lambda strict: parse_compact_date("approvedate", strict)),
        ("approvetime", STR),
        ("approve_dt", None, lambda strict: parse_compact_ts(concat_strict("approvedate", "approvetime"), strict)),
        ("approvercode", STR), ("approveusername", STR), ("approverdescription", STR),
        ("approverfullname", STR, "u_fullname"), ("isapprove", STR),
    ]) + _envelope()

    PR_APPROVAL = _fields([
        ("tabkey", STR), ("purchasereqnitemuniqueid", STR),
        ("updatedate", None, lambda strict: parse_compact_date("updatedate", strict)),
        ("updatetime", STR),
        ("update_dt", None, lambda strict: parse_compact_ts(concat_strict("updatedate", "updatetime"), strict)),
    ]) + _envelope()

    PRICING = _fields([
        ("pricingdocument", STR),
        ("pricingdocumentitem", None, substr_from(F.col("pricingdocumentitem").cast(STR), PRICING_ITEM_FROM)),
        ("pricingprocedurestep", STR), ("pricingprocedurecounter", STR), ("conditiontype", STR),
        ("condition_description", None, label("conditiontype", CONDITION_LABELS)),
        ("pricingdatetime", None, lambda strict: parse_compact_ts("pricingdatetime", strict)),
        ("conditioncalculationtype", STR), ("conditionamount", D3), ("transactioncurrency", STR),
        ("conditioninactivereason", STR), ("conditioncurrency", STR), ("conditionratevalue", D3),
        ("pricedetnexchangerate", D4, "PriceDetnExchangeRate"),
    ]) + _envelope()

    PR_ITEM = _fields([
        ("purchaserequisition", STR), ("purchaserequisitionitem", STR), ("purchasingdocument", STR),
        ("purchasingdocumentitem", STR), ("purchasereqnitemuniqueid", STR), ("isdeleted", STR),
    ]) + _envelope()

    PO_HEADER = _fields([
        ("purchasingdocument", STR), ("purchasingdocumentcategory", STR), ("purchasingdocumenttype", STR),
        ("releasecode", STR), ("supplier", STR), ("suppliername", STR, "s_name"), ("purchasinggroup", STR),
        ("purchasinggroupname", STR, "g_name"), ("documentcurrency", STR), ("exchangerate", D4),
        ("purchasingdocumentorderdate", None, lambda strict: parse_compact_date("purchasingdocumentorderdate", strict)),
        ("paymentterms", STR), ("incotermsclassification", STR), ("purchasingdocumentcondition", STR),
        ("purgreleasetimetotalamount", D2),
        ("creationdate", None, lambda strict: parse_compact_date("creationdate", strict)),
    ]) + _envelope()


    def _spec(name, feed, keys, contract, guards=None, **kw) -> SilverSpec:
        return SilverSpec(name=name, feed=feed, keys=keys, guards=guards if guards is not None else keys,
                          contract=contract, **kw)


    return {s.name: s for s in [
        _spec("silver_mm_zigoodsmvmtdoc", "zigoodsmvmtdoc", [f"materialdocumentkey{i}" for i in range(1, 7)],
              GOODS_MOVEMENT),
        _spec("silver_mm_ziinforecorgdata", "ziinforecorgdata",
              ["purchasinginforecord", "purchasingorganization", "purchasinginforecordcategory", "plant"],
              INFO_RECORD, guards=["purchasinginforecord", "purchasingorganization", "purchasinginforecordcategory"],
              distinct=True),
        _spec("silver_mm_zimmprgdocsl", "zimmprgdocsl", ["purchasingdocument", "purchasingdocumentitem", "scheduleline"],
              SCHEDULE_LINE, distinct=True),
        _spec("silver_mm_zimmpurdochist", "zimmpurdochist",
              ["purchasingdocument", "purchasingdocumentitem", "accountassignmentnumber",
               "purchasinghistorydocumenttype", "purchasinghistorydocumentyear", "purchasinghistorydocument",
               "purchasinghistorydocumentitem"], PO_HISTORY, distinct=True),
        _spec("silver_mm_zimmpurgdocitem", "zimmpurgdocitem", ["purchasingdocument", "purchasingdocumentitem"],
              PO_ITEM, enrich=_enrich_po_item, lookups=("ziproduct", "ziprduom", "ziprdplant", "ziproductgrp"), distinct=True),
        _spec("silver_mm_zipoapprov", "zipoapprov", ["purchasingdocument"], PO_APPROVAL,
              order=[F.desc("approvedate"), F.desc("approvetime"), F.desc("ingestiontime")],
              prefilter=F.col("approvercode") == FINAL_APPROVAL_CODE, enrich=_enrich_po_approval, lookups=("ziuser",)),
        _spec("silver_mm_ziprapprov", "ziprapprov", ["tabkey"], PR_APPROVAL),
        _spec("silver_mm_zipricingelement", "zipricingelement",
              ["pricingdocument", "pricingdocumentitem", "pricingprocedurestep", "pricingprocedurecounter"],
              PRICING, distinct=True, cut={"pricingdocumentitem": PRICING_ITEM_FROM}),
        _spec("silver_mm_zipritem", "zipritem", ["purchaserequisition", "purchaserequisitionitem"], PR_ITEM,
              distinct=True),
        _spec("silver_mm_zmmpurchasingdoc", "zmmpurchasingdoc", ["purchasingdocument"], PO_HEADER,
              enrich=_enrich_po_header, lookups=("zisupplier", "zimmpurchgroup")),
    ]}



# Initial-load variants that differ from "incremental on an empty target"
# beyond the missing high-water mark: the header one adds DISTINCT.
INITIAL_DISTINCT = {"silver_mm_zmmpurchasingdoc"}


def initial_form(spec: SilverSpec) -> SilverSpec:
    """The spec as its initial load runs it."""
    return replace(spec, distinct=True) if spec.name in INITIAL_DISTINCT else spec


def spec_for(name: str, initial: bool = False) -> SilverSpec:
    s = build_specs()[name]
    return initial_form(s) if initial else s
