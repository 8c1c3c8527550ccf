"""One query per operator of the survey inventory, on the driver tables.

Each entry is ``key -> (spark_query, oracle_sql)``.  The Spark side uses
the library's operators and column functions; the oracle is plain DuckDB
SQL over the same tables.  Modulo expressions below only *derive* column
values (to induce NULLs, codes and unit sizes the driver tables lack);
no query filters rows away to make itself cheaper.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (coalesce_default, ntz, concat_strict, date_diff_days, label, late_days, lead_days,
                         null_or_empty_flag, open_end_date, parse_compact_date, parse_compact_ts,
                         remaining_qty, remaining_value, safe_ratio, substr_from, to_local, uom_to_base,
                         uom_to_target)
from ..operators import (Field, conditional_sum, conform, converted_sum, hot_keys, latest_per_key, lookup,
                         preferred_match, require_keys, signed_sum, since, upsert_by_key)
from ..operators.incremental import high_water_mark
from ..sources import FEEDS, Lookups, Tables
from ..sources.feeds import doc, pad, tag
from . import oracle as O

OPERATORS: dict[str, tuple] = {}


def op(key: str, sql_text: str | None):
    def deco(fn):
        OPERATORS[key] = (fn, sql_text)
        return fn
    return deco


def T(spark: SparkSession, sf_dir: str) -> Tables:
    return Tables(spark, sf_dir)


L_KEYS = ["l_orderkey", "l_linenumber"]
CUT = dt.datetime(1999, 1, 1)
CUT_SQL = "TIMESTAMP '1999-01-01 00:00:00'"


def desc_ts_tb():
    """Newest ship date first; the part key makes (order, line, date, part) unique."""
    return [F.desc("l_shipdate")], [F.desc("l_partkey")]


def qty3(c="l_quantity"):
    return F.col(c).cast("decimal(18,3)")


# ---------------------------------------------------------------- sources / incremental


@op("scan_feed", "SELECT * FROM lineitem")
def scan_feed(spark, sf):
    return T(spark, sf).lineitem


@op("scan_prune", "SELECT o_orderkey, o_custkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'")
def scan_prune(spark, sf):
    return T(spark, sf).orders.where(F.col("o_orderstatus") == "F").select("o_orderkey", "o_custkey", "o_totalprice")


@op("incremental_since", """
SELECT * FROM lineitem
WHERE l_shipdate >= (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') - INTERVAL 6 HOUR FROM orders)""")
def incremental_since(spark, sf):
    t = T(spark, sf)
    return since(t.lineitem, t.orders, ts_col="l_shipdate", target_ts_col="o_orderdate")


@op("incremental_empty_target", """
SELECT * FROM lineitem
WHERE l_shipdate >= (SELECT coalesce(max(o_orderdate), TIMESTAMP '1900-01-01') - INTERVAL 6 HOUR
                     FROM orders WHERE false)""")
def incremental_empty_target(spark, sf):
    t = T(spark, sf)
    return since(t.lineitem, t.orders.where(F.lit(False)), ts_col="l_shipdate", target_ts_col="o_orderdate")


@op("agg_global_max", "SELECT max(l_shipdate) AS max_shipdate FROM lineitem")
def agg_global_max(spark, sf):
    return T(spark, sf).lineitem.agg(F.max("l_shipdate").alias("max_shipdate"))


@op("high_water_mark", "SELECT coalesce(max(l_shipdate), TIMESTAMP '1900-01-01') - INTERVAL 6 HOUR AS hwm FROM lineitem")
def hwm_query(spark, sf):
    return high_water_mark(T(spark, sf).lineitem, "l_shipdate")


UPSERT_FEED_SQL = f"""f AS (SELECT {O.doc('l_orderkey')} AS purchasingdocument,
  {O.pad('l_linenumber', 5)} AS purchasingdocumentitem, CAST(l_extendedprice AS DECIMAL(18,2)) AS netpriceamount,
  CASE WHEN l_partkey % 211 <> 5 THEN l_shipdate END AS ingestiontime, {O.LI_SEQ} AS changesequence FROM lineitem),
tgt AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY purchasingdocument,
  purchasingdocumentitem ORDER BY ingestiontime DESC, changesequence DESC) AS rn
  FROM f WHERE ingestiontime < {CUT_SQL}) WHERE rn = 1),
bat AS (SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY purchasingdocument,
  purchasingdocumentitem ORDER BY ingestiontime DESC, changesequence DESC) AS rn
  FROM f WHERE ingestiontime >= (SELECT coalesce(max(ingestiontime), TIMESTAMP '1900-01-01') - INTERVAL 6 HOUR
                                  FROM tgt)) WHERE rn = 1)"""


@op("upsert_by_key", f"""WITH {UPSERT_FEED_SQL}
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM bat WHERE bat.purchasingdocument = tgt.purchasingdocument
  AND bat.purchasingdocumentitem = tgt.purchasingdocumentitem)
UNION ALL SELECT * FROM bat""")
def upsert_query(spark, sf):
    keys = ["purchasingdocument", "purchasingdocumentitem"]
    feed = FEEDS["zimmpurgdocitem"](T(spark, sf)).select(*keys, F.col("netpriceamount").cast("decimal(18,2)"),
                                                          "ingestiontime", "changesequence")
    order, tb = [F.desc("ingestiontime")], [F.desc("changesequence")]
    target = latest_per_key(feed.where(F.col("ingestiontime") < ntz(CUT)), keys, order, tb)
    batch = latest_per_key(since(feed, target), keys, order, tb)
    return upsert_by_key(target, batch, keys)


# ---------------------------------------------------------------- filters and projections


@op("filter_not_null_keys", O.sql(f"""SELECT {', '.join(O.GM_KEYS)}, changesequence FROM f_goods
WHERE {' AND '.join(k + ' IS NOT NULL' for k in O.GM_KEYS)}""", "f_goods"))
def filter_not_null_keys(spark, sf):
    keys = [f"materialdocumentkey{i}" for i in range(1, 7)]
    return require_keys(FEEDS["zigoodsmvmtdoc"](T(spark, sf)), keys).select(*keys, "changesequence")


@op("prefilter_latest", """
SELECT user_id, event_id, ts FROM (
  SELECT user_id, event_id, ts, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn
  FROM events WHERE event_type = 'purchase') WHERE rn = 1""")
def prefilter_latest(spark, sf):
    e = T(spark, sf).events.where(F.col("event_type") == "purchase")
    return latest_per_key(e, ["user_id"], [F.desc("ts")], [F.desc("event_id")]).select("user_id", "event_id", "ts")


_FLAG3 = "CASE l_suppkey % 3 WHEN 0 THEN true WHEN 1 THEN false END"


@op("filter_soft_delete", f"""SELECT l_orderkey, l_linenumber, l_partkey, isdelete FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, {_FLAG3} AS isdelete FROM lineitem) WHERE isdelete = false""")
def filter_soft_delete(spark, sf):
    li = T(spark, sf).lineitem.select(*L_KEYS, "l_partkey", F.when(F.col("l_suppkey") % 3 == 0, True)
                                      .when(F.col("l_suppkey") % 3 == 1, False).alias("isdelete"))
    return li.where(F.col("isdelete") == F.lit(False))


@op("filter_is_null", """SELECT l_orderkey, l_linenumber, l_partkey, deletioncode FROM (
  SELECT l_orderkey, l_linenumber, l_partkey, CASE l_suppkey % 3 WHEN 0 THEN '' WHEN 1 THEN 'L' END AS deletioncode
  FROM lineitem) WHERE deletioncode IS NULL""")
def filter_is_null(spark, sf):
    li = T(spark, sf).lineitem.select(*L_KEYS, "l_partkey", F.when(F.col("l_suppkey") % 3 == 0, "")
                                      .when(F.col("l_suppkey") % 3 == 1, "L").alias("deletioncode"))
    return li.where(F.col("deletioncode").isNull())


@op("filter_first_line", O.sql("""SELECT purchasingdocument, purchasingdocumentitem, scheduleline,
  schedulelinedeliverydate FROM f_schedule WHERE scheduleline = '0001'""", "f_schedule"))
def filter_first_line(spark, sf):
    return (FEEDS["zimmprgdocsl"](T(spark, sf)).where(F.col("scheduleline") == "0001")
            .select("purchasingdocument", "purchasingdocumentitem", "scheduleline", "schedulelinedeliverydate"))


@op("outer_to_inner", """SELECT o.o_orderkey, l.l_linenumber, l.l_tax FROM orders o
LEFT JOIN lineitem l ON o.o_orderkey = l.l_orderkey WHERE l.l_tax IS NOT NULL""")
def outer_to_inner(spark, sf):
    t = T(spark, sf)
    j = t.orders.join(t.lineitem, t.orders.o_orderkey == t.lineitem.l_orderkey, "left")
    return j.where(F.col("l_tax").isNotNull()).select("o_orderkey", "l_linenumber", "l_tax")


@op("predicates", """SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem
WHERE (l_returnflag <> 'N' AND l_quantity < 25) OR l_discount >= CAST(0.08 AS DOUBLE)""")
def predicates(spark, sf):
    li = T(spark, sf).lineitem
    cond = ((F.col("l_returnflag") != "N") & (F.col("l_quantity") < 25)) | (F.col("l_discount") >= 0.08)
    return li.where(cond).select(*L_KEYS, "l_partkey")


@op("filter_in", "SELECT l_orderkey, l_linenumber, l_returnflag FROM lineitem WHERE l_returnflag IN ('A', 'R')")
def filter_in(spark, sf):
    return T(spark, sf).lineitem.where(F.col("l_returnflag").isin("A", "R")).select(*L_KEYS, "l_returnflag")


@op("flag_null_or_empty", O.sql("""SELECT purchasingdocument, purchasingdocumentitem, changesequence,
  CASE WHEN invoiceisexpected IS NULL OR invoiceisexpected = '' THEN 'X' END AS free_item FROM f_item""", "f_item"))
def flag_null_or_empty(spark, sf):
    f = FEEDS["zimmpurgdocitem"](T(spark, sf))
    return f.select("purchasingdocument", "purchasingdocumentitem", "changesequence",
                    null_or_empty_flag("invoiceisexpected").alias("free_item"))


@op("conform_cast", """SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_partkey AS VARCHAR) AS l_partkey,
  CAST(l_linenumber AS VARCHAR) AS l_linenumber, CAST(l_extendedprice AS DECIMAL(18,2)) AS l_extendedprice,
  CAST(l_quantity AS DECIMAL(18,3)) AS l_quantity, CAST(l_quantity AS INTEGER) AS quantity_int,
  CAST(l_discount AS DOUBLE) AS l_discount FROM lineitem""")
def conform_cast(spark, sf):
    return conform(T(spark, sf).lineitem, [
        Field("l_orderkey", None, "string"), Field("l_partkey", None, "string"),
        Field("l_linenumber", None, "string"), Field("l_extendedprice", None, "decimal(18,2)"),
        Field("l_quantity", None, "decimal(18,3)"), Field("quantity_int", "l_quantity", "int"),
        Field("l_discount", None, "double")])


@op("cast_decimal", """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CAST(l_extendedprice * l_discount AS DECIMAL(18,4)) AS DECIMAL(18,3)) AS discount_amount FROM lineitem""")
def cast_decimal(spark, sf):
    li = T(spark, sf).lineitem
    return li.select(*L_KEYS, "l_partkey", (F.col("l_extendedprice") * F.col("l_discount")).cast("decimal(18,4)")
                     .cast("decimal(18,3)").alias("discount_amount"))


@op("project_rename", """SELECT p_partkey AS material_id, p_name AS material_description, p_brand AS brand,
  p_retailprice AS list_price FROM part""")
def project_rename(spark, sf):
    p = T(spark, sf).part
    return p.select(F.col("p_partkey").alias("material_id"), F.col("p_name").alias("material_description"),
                    F.col("p_brand").alias("brand"), F.col("p_retailprice").alias("list_price"))


# ---------------------------------------------------------------- joins


@op("lookup_left", O.sql("""SELECT f.purchasingdocument, f.purchasingdocumentitem, f.changesequence, f.material,
  p.productgroup, p.baseunit FROM f_item f LEFT JOIN lk_product p ON f.material = p.product""",
                         "f_item", "lk_product"))
def lookup_left(spark, sf):
    t = T(spark, sf)
    f = FEEDS["zimmpurgdocitem"](t).select("purchasingdocument", "purchasingdocumentitem", "changesequence", "material")
    return lookup(f, Lookups(spark, t).ziproduct, [("material", "product")],
                  {"productgroup": "productgroup", "baseunit": "baseunit"})


@op("join_left_composite", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, a.pair_qty
FROM lineitem l LEFT JOIN (SELECT l_partkey, l_suppkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS DECIMAL(28,3))
  AS pair_qty FROM lineitem GROUP BY l_partkey, l_suppkey) a
ON l.l_partkey = a.l_partkey AND l.l_suppkey = a.l_suppkey""")
def join_left_composite(spark, sf):
    li = T(spark, sf).lineitem
    agg = li.groupBy("l_partkey", "l_suppkey").agg(F.sum(qty3()).alias("pair_qty"))
    return lookup(li.select(*L_KEYS, "l_partkey", "l_suppkey"), agg,
                  [("l_partkey", "l_partkey"), ("l_suppkey", "l_suppkey")], {"pair_qty": "pair_qty"})


@op("join_left_right_pred", """SELECT o.o_orderkey, l.l_partkey, l.l_shipdate FROM orders o
LEFT JOIN (SELECT * FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, row_number() OVER (
    PARTITION BY l_orderkey, l_linenumber ORDER BY l_shipdate DESC, l_partkey DESC) AS rn FROM lineitem)
  WHERE rn = 1) l ON o.o_orderkey = l.l_orderkey AND l.l_linenumber = 1""")
def join_left_right_pred(spark, sf):
    t = T(spark, sf)
    first = latest_per_key(t.lineitem.select(*L_KEYS, "l_partkey", "l_shipdate"), L_KEYS, *desc_ts_tb())
    return lookup(t.orders.select("o_orderkey"), first, [("o_orderkey", "l_orderkey")],
                  {"l_partkey": "l_partkey", "l_shipdate": "l_shipdate"}, where=F.col("l_linenumber") == 1)


@op("join_left_left_pred", """SELECT o.o_orderkey, o.o_orderstatus, e.event_id, e.event_type FROM orders o
LEFT JOIN (SELECT * FROM (SELECT user_id, event_id, event_type, row_number() OVER (PARTITION BY user_id
    ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1) e
ON o.o_custkey = e.user_id AND o.o_orderstatus = 'F'""")
def join_left_left_pred(spark, sf):
    t = T(spark, sf)
    last = latest_per_key(t.events.select("user_id", "event_id", "event_type", "ts"), ["user_id"],
                          [F.desc("ts")], [F.desc("event_id")])
    return lookup(t.orders.select("o_orderkey", "o_orderstatus", "o_custkey"), last, [("o_custkey", "user_id")],
                  {"event_id": "event_id", "event_type": "event_type"},
                  gate=F.col("o_orderstatus") == "F").drop("o_custkey")


@op("join_inner", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_orderdate, o.o_custkey
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey""")
def join_inner(spark, sf):
    t = T(spark, sf)
    return (t.lineitem.select(*L_KEYS, "l_partkey")
            .join(t.orders.select("o_orderkey", "o_orderdate", "o_custkey"),
                  F.col("l_orderkey") == F.col("o_orderkey"), "inner").drop("o_orderkey"))


@op("lookup_roles", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, sn.n_name AS supplier_nation,
  cn.n_name AS customer_nation
FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey LEFT JOIN customer c ON o.o_custkey = c.c_custkey
LEFT JOIN nation sn ON s.s_nationkey = sn.n_nationkey LEFT JOIN nation cn ON c.c_nationkey = cn.n_nationkey""")
def lookup_roles(spark, sf):
    t = T(spark, sf)
    j = t.lineitem.select(*L_KEYS, "l_partkey", "l_suppkey").join(
        t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey"), "l_orderkey", "inner")
    j = lookup(j, t.supplier, [("l_suppkey", "s_suppkey")], {"s_nationkey": "s_nationkey"})
    j = lookup(j, t.customer, [("o_custkey", "c_custkey")], {"c_nationkey": "c_nationkey"})
    j = lookup(j, t.nation, [("s_nationkey", "n_nationkey")], {"supplier_nation": "n_name"})
    j = lookup(j, t.nation, [("c_nationkey", "n_nationkey")], {"customer_nation": "n_name"})
    return j.select(*L_KEYS, "l_partkey", "supplier_nation", "customer_nation")


@op("join_chained", """SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, o.o_custkey, c.c_name
FROM lineitem l LEFT JOIN (SELECT * FROM orders WHERE o_orderstatus = 'F') o ON l.l_orderkey = o.o_orderkey
LEFT JOIN customer c ON o.o_custkey = c.c_custkey""")
def join_chained(spark, sf):
    t = T(spark, sf)
    j = lookup(t.lineitem.select(*L_KEYS, "l_partkey"), t.orders.where(F.col("o_orderstatus") == "F"),
               [("l_orderkey", "o_orderkey")], {"o_custkey": "o_custkey"})
    return lookup(j, t.customer, [("o_custkey", "c_custkey")], {"c_name": "c_name"})


_PLANT_SQL = "CASE WHEN l_suppkey % 5 = 0 THEN NULL ELSE 'P' || CAST(l_suppkey % 5 AS VARCHAR) END"


def _plant():
    return F.when(F.col("l_suppkey") % 5 != 0, tag("P", F.col("l_suppkey") % 5))


@op("latest_price_lookup", f"""SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.plant, p.l_extendedprice AS latest_price
FROM (SELECT l_orderkey, l_linenumber, l_partkey, {_PLANT_SQL} AS plant FROM lineitem) l
LEFT JOIN (SELECT * FROM (SELECT l_partkey, {_PLANT_SQL} AS plant, l_extendedprice, row_number() OVER (
    PARTITION BY l_partkey, {_PLANT_SQL} ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC) AS rn
  FROM lineitem) WHERE rn = 1) p ON l.l_partkey = p.l_partkey AND l.plant = p.plant""")
def latest_price_lookup(spark, sf):
    li = T(spark, sf).lineitem.withColumn("plant", _plant())
    top = latest_per_key(li.where(F.col("plant").isNotNull()).select("l_partkey", "plant", "l_extendedprice",
                                                                     "l_shipdate", *L_KEYS),
                         ["l_partkey", "plant"], [F.desc("l_shipdate")], [F.desc("l_orderkey"), F.desc("l_linenumber")])
    return lookup(li.select(*L_KEYS, "l_partkey", "plant"), top, [("l_partkey", "l_partkey"), ("plant", "plant")],
                  {"latest_price": "l_extendedprice"}, hot=hot_keys(li, ["l_partkey", "plant"]))


@op("preferred_match", O.sql(f"""SELECT l_orderkey, l_linenumber, inforecord, info_plant, info_org FROM (
  SELECT l.l_orderkey, l.l_linenumber, i.purchasinginforecord AS inforecord, i.plant AS info_plant,
    i.purchasingorganization AS info_org,
    row_number() OVER (PARTITION BY l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_shipdate
      ORDER BY CASE WHEN i.plant = l.plant THEN 1 WHEN i.plant IS NULL THEN 2 ELSE 3 END,
               i.ingestiontime DESC, i.purchasingorganization ASC NULLS FIRST,
               i.purchasinginforecordcategory ASC NULLS FIRST, i.plant ASC NULLS FIRST,
               i.changesequence DESC) AS rn
  FROM (SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, {O.tag('I', 'l_partkey - l_partkey % 4')} AS inforecord,
          {O.tag('P', 'l_suppkey % 5')} AS plant FROM lineitem) l
  LEFT JOIN (SELECT * FROM f_info WHERE isdelete = false) i ON i.purchasinginforecord = l.inforecord)
WHERE rn = 1""", "f_info"))
def preferred_match_query(spark, sf):
    t = T(spark, sf)
    left = t.lineitem.select(*L_KEYS, tag("I", F.col("l_partkey") - F.col("l_partkey") % 4).alias("inforecord"),
                             tag("P", F.col("l_suppkey") % 5).alias("plant"))
    info = FEEDS["ziinforecorgdata"](t).where(F.col("isdelete") == F.lit(False))
    m = preferred_match(left, info, key=("inforecord", "purchasinginforecord"), attr=("plant", "plant"),
                        order=["-ingestiontime", "purchasingorganization", "purchasinginforecordcategory", "plant",
                               "-changesequence"],
                        right_cols=["purchasinginforecord", "plant", "purchasingorganization"],
                        rename={"purchasinginforecord": "i_rec", "plant": "info_plant",
                                "purchasingorganization": "info_org"}, hot=hot_keys(left, ["inforecord"]))
    return m.select(*L_KEYS, F.col("i_rec").alias("inforecord"), "info_plant", "info_org")


# ---------------------------------------------------------------- aggregations


@op("agg_min_max_date", """SELECT l_orderkey, l_linenumber, min(l_shipdate) AS first_date, max(l_shipdate) AS last_date
FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def agg_min_max_date(spark, sf):
    return T(spark, sf).lineitem.groupBy(*L_KEYS).agg(F.min("l_shipdate").alias("first_date"),
                                                      F.max("l_shipdate").alias("last_date"))


@op("agg_signed_sum", """SELECT l_orderkey, l_linenumber, CAST(sum(CASE WHEN l_linestatus = 'F' THEN
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS DECIMAL(18,3)) ELSE CAST(l_quantity AS DECIMAL(18,3)) END
  ELSE 0 END) AS DECIMAL(28,3)) AS net_qty FROM lineitem GROUP BY l_orderkey, l_linenumber""")
def agg_signed_sum(spark, sf):
    li = T(spark, sf).lineitem.withColumn("q", qty3())
    return li.groupBy(*L_KEYS).agg(signed_sum("q", F.col("l_linestatus") == "F", F.col("l_returnflag") == "R")
                                   .alias("net_qty"))


_CODES = {"C0": "amount_c0", "C1": "amount_c1", "C2": "amount_c2"}


def _pivot_sql(thb: bool) -> str:
    cols = []
    for code, name in _CODES.items():
        k = code[1]
        if thb:
            val = ("CASE WHEN l_linenumber % 2 = 0 THEN CAST(l_extendedprice AS DECIMAL(18,2)) "
                   "ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS DECIMAL(38,2)) * CAST(35.5 AS DECIMAL(18,4)) END")
            cols.append(f"CAST(sum(CASE WHEN l_linenumber % 3 = {k} THEN {val} ELSE 0 END) AS DECIMAL(38,6)) AS {name}_thb")
        else:
            cols.append(f"CAST(sum(CASE WHEN l_linenumber % 3 = {k} THEN CAST(l_extendedprice AS DECIMAL(18,2)) "
                        f"ELSE 0 END) AS DECIMAL(28,2)) AS {name}")
    return f"SELECT l_orderkey, {', '.join(cols)} FROM lineitem GROUP BY l_orderkey"


@op("agg_pivot_sum", _pivot_sql(False))
def agg_pivot_sum(spark, sf):
    li = T(spark, sf).lineitem.withColumn("amt", F.col("l_extendedprice").cast("decimal(18,2)"))
    code = F.concat(F.lit("C"), (F.col("l_linenumber") % 3).cast("string"))
    return li.groupBy("l_orderkey").agg(*[conditional_sum("amt", code == k).alias(n) for k, n in _CODES.items()])


@op("agg_currency_sum", _pivot_sql(True))
def agg_currency_sum(spark, sf):
    li = (T(spark, sf).lineitem.withColumn("amt", F.col("l_extendedprice").cast("decimal(18,2)"))
          .withColumn("rate", F.lit(35.5).cast("decimal(18,4)")))
    code = F.concat(F.lit("C"), (F.col("l_linenumber") % 3).cast("string"))
    local = F.col("l_linenumber") % 2 == 0
    return li.groupBy("l_orderkey").agg(*[converted_sum("amt", "rate", "amt", code == k, local)
                                          .cast("decimal(38,6)").alias(f"{n}_thb") for k, n in _CODES.items()])


@op("distinct_rows", "SELECT DISTINCT l_orderkey, l_returnflag, l_linestatus FROM lineitem")
def distinct_rows(spark, sf):
    return T(spark, sf).lineitem.select("l_orderkey", "l_returnflag", "l_linestatus").distinct()


# ---------------------------------------------------------------- windows (top-1 per group)


def _top_sql(cols: str, part: str, order: str, src: str = "lineitem") -> str:
    return (f"SELECT {cols} FROM (SELECT *, row_number() OVER (PARTITION BY {part} ORDER BY {order}) AS rn "
            f"FROM {src}) WHERE rn = 1")


@op("latest_per_key", _top_sql("l_orderkey, l_linenumber, l_partkey, l_shipdate, l_quantity",
                               "l_orderkey, l_linenumber", "l_shipdate DESC, l_partkey DESC"))
def latest_per_key_q(spark, sf):
    li = T(spark, sf).lineitem
    return latest_per_key(li, L_KEYS, *desc_ts_tb()).select(*L_KEYS, "l_partkey", "l_shipdate", "l_quantity")


@op("latest_multi_order", _top_sql("user_id, event_id, event_type", "user_id",
                                   "strftime(ts, '%Y%m%d') DESC, strftime(ts, '%H%M%S') DESC, event_id DESC",
                                   "events"))
def latest_multi_order(spark, sf):
    e = T(spark, sf).events.select("user_id", "event_id", "event_type",
                                   F.date_format("ts", "yyyyMMdd").alias("d"), F.date_format("ts", "HHmmss").alias("t"))
    return latest_per_key(e, ["user_id"], [F.desc("d"), F.desc("t")], [F.desc("event_id")]).select(
        "user_id", "event_id", "event_type")


@op("latest_price_by_plant", f"""SELECT l_partkey, plant, l_orderkey, l_linenumber, o_orderdate FROM (
  SELECT l_partkey, {_PLANT_SQL} AS plant, l_orderkey, l_linenumber, o_orderdate, row_number() OVER (
    PARTITION BY l_partkey, {_PLANT_SQL} ORDER BY o_orderdate DESC, l_orderkey DESC, l_linenumber DESC,
    l_shipdate DESC) AS rn
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey) WHERE rn = 1""")
def latest_price_by_plant(spark, sf):
    t = T(spark, sf)
    j = t.lineitem.withColumn("plant", _plant()).join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"),
                                                                      "o_orderdate"), "l_orderkey")
    top = latest_per_key(j, ["l_partkey", "plant"], [F.desc("o_orderdate")],
                         [F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("l_shipdate")])
    return top.select("l_partkey", "plant", *L_KEYS, "o_orderdate")


@op("latest_price_by_material", _top_sql("l_partkey, l_orderkey, l_linenumber, l_extendedprice", "l_partkey",
                                         f"{O.doc('l_orderkey')} DESC, l_shipdate DESC, l_linenumber DESC"))
def latest_price_by_material(spark, sf):
    li = T(spark, sf).lineitem.withColumn("docno", doc(F.col("l_orderkey")))
    top = latest_per_key(li, ["l_partkey"], [F.desc("docno"), F.desc("l_shipdate")], [F.desc("l_linenumber")])
    return top.select("l_partkey", *L_KEYS, "l_extendedprice")


@op("rank_by_case", _top_sql("l_orderkey, l_linenumber, l_returnflag, l_partkey", "l_orderkey",
                             "CASE WHEN l_returnflag = 'R' THEN 1 WHEN l_returnflag = 'A' THEN 2 ELSE 3 END, "
                             "l_linenumber, l_shipdate, l_partkey"))
def rank_by_case(spark, sf):
    li = T(spark, sf).lineitem
    prio = F.when(F.col("l_returnflag") == "R", 1).when(F.col("l_returnflag") == "A", 2).otherwise(3)
    top = latest_per_key(li, ["l_orderkey"], [prio], ["l_linenumber", "l_shipdate", "l_partkey"])
    return top.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")


@op("latest_nullable_key", """SELECT part_group, supp_group, l_orderkey, l_linenumber FROM (
  SELECT l_partkey % 500 AS part_group, nullif(l_suppkey % 6, 5) AS supp_group, l_orderkey, l_linenumber,
    row_number() OVER (PARTITION BY l_partkey % 500, nullif(l_suppkey % 6, 5)
      ORDER BY l_shipdate DESC, l_orderkey DESC, l_linenumber DESC, l_partkey DESC) AS rn FROM lineitem)
WHERE rn = 1""")
def latest_nullable_key(spark, sf):
    li = T(spark, sf).lineitem.select(
        (F.col("l_partkey") % 500).alias("part_group"),
        F.when(F.col("l_suppkey") % 6 != 5, F.col("l_suppkey") % 6).alias("supp_group"), *L_KEYS,
        "l_shipdate", "l_partkey")
    top = latest_per_key(li, ["part_group", "supp_group"], [F.desc("l_shipdate")],
                         [F.desc("l_orderkey"), F.desc("l_linenumber"), F.desc("l_partkey")])
    return top.select("part_group", "supp_group", *L_KEYS)


# ---------------------------------------------------------------- scalar functions


@op("parse_compact_date", O.sql(f"""SELECT purchasingdocument, purchasingdocumentitem, scheduleline, changesequence,
  {O.d8('schedulelinedeliverydate')} AS delivery_date FROM f_schedule""", "f_schedule"))
def parse_compact_date_q(spark, sf):
    f = FEEDS["zimmprgdocsl"](T(spark, sf))
    return f.select("purchasingdocument", "purchasingdocumentitem", "scheduleline", "changesequence",
                    parse_compact_date("schedulelinedeliverydate").alias("delivery_date"))


@op("parse_compact_ts", f"""SELECT event_id, {O.ts14("strftime(ts, '%Y%m%d') || strftime(ts, '%H%M%S')")} AS event_dt
FROM events""")
def parse_compact_ts_q(spark, sf):
    e = T(spark, sf).events
    return e.select("event_id", parse_compact_ts(concat_strict(F.date_format("ts", "yyyyMMdd"),
                                                               F.date_format("ts", "HHmmss"))).alias("event_dt"))


@op("concat_null", O.sql("""SELECT purchasingdocument, purchasingdocumentitem, changesequence,
  material || purchasingdocumentitem AS material_item FROM f_item""", "f_item"))
def concat_null(spark, sf):
    f = FEEDS["zimmpurgdocitem"](T(spark, sf))
    return f.select("purchasingdocument", "purchasingdocumentitem", "changesequence",
                    concat_strict("material", "purchasingdocumentitem").alias("material_item"))


@op("substr_from", f"""SELECT l_orderkey, l_linenumber, l_partkey, substr({O.pad('l_linenumber', 6)}, 2) AS item5,
  substr({O.doc('l_suppkey')}, 3) AS supplier8 FROM lineitem""")
def substr_from_q(spark, sf):
    li = T(spark, sf).lineitem
    return li.select(*L_KEYS, "l_partkey", substr_from(pad(F.col("l_linenumber"), 6), 2).alias("item5"),
                     substr_from(doc(F.col("l_suppkey")), 3).alias("supplier8"))


@op("coalesce_default", O.sql("""SELECT o.o_orderkey,
  coalesce(i.valid_to, DATE '9999-12-31') AS valid_to,
  coalesce(q.qty, CAST(0 AS DECIMAL(28,3))) AS shipped_qty
FROM orders o
LEFT JOIN (SELECT l_orderkey, max(CASE WHEN l_discount <= CAST(0.08 AS DOUBLE) THEN CAST(l_shipdate AS DATE) + 365 END)
           AS valid_to FROM lineitem GROUP BY l_orderkey) i ON o.o_orderkey = i.l_orderkey
LEFT JOIN (SELECT l_orderkey, CAST(sum(CAST(l_quantity AS DECIMAL(18,3))) AS DECIMAL(28,3)) AS qty FROM lineitem
           GROUP BY l_orderkey) q ON o.o_orderkey = q.l_orderkey"""))
def coalesce_default_q(spark, sf):
    t = T(spark, sf)
    li = t.lineitem
    valid = li.groupBy("l_orderkey").agg(F.max(F.when(F.col("l_discount") <= 0.08, F.date_add(
        F.col("l_shipdate").cast("date"), 365))).alias("valid_to"))
    qty = li.groupBy("l_orderkey").agg(F.sum(qty3()).alias("qty"))
    o = lookup(t.orders.select("o_orderkey"), valid, [("o_orderkey", "l_orderkey")], {"valid_to": "valid_to"})
    o = lookup(o, qty, [("o_orderkey", "l_orderkey")], {"qty": "qty"})
    return o.select("o_orderkey", open_end_date("valid_to").alias("valid_to"),
                    coalesce_default("qty", F.lit(0).cast("decimal(28,3)")).alias("shipped_qty"))


@op("case_label", O.sql("""SELECT pricingdocument, pricingdocumentitem, pricingprocedurestep, pricingprocedurecounter,
  changesequence, CASE conditiontype WHEN 'ZFB3' THEN 'Freight' WHEN 'ZCB1' THEN 'Clearance'
  WHEN 'ZDB3' THEN 'Discount' END AS condition_description FROM f_pricing""", "f_pricing"))
def case_label(spark, sf):
    from ..fixed import CONDITION_LABELS
    f = FEEDS["zipricingelement"](T(spark, sf))
    return f.select("pricingdocument", "pricingdocumentitem", "pricingprocedurestep", "pricingprocedurecounter",
                    "changesequence", label("conditiontype", CONDITION_LABELS).alias("condition_description"))


@op("date_diff_days", """SELECT l_orderkey, l_linenumber, l_partkey,
  datediff('day', CAST(o_orderdate AS DATE), CAST(l_shipdate AS DATE)) AS order_to_ship_days,
  datediff('day', CAST(l_shipdate AS DATE), CAST(o_orderdate AS DATE)) AS ship_to_order_days
FROM lineitem JOIN orders ON l_orderkey = o_orderkey""")
def date_diff_days_q(spark, sf):
    t = T(spark, sf)
    j = t.lineitem.join(t.orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate"), "l_orderkey")
    return j.select(*L_KEYS, "l_partkey", date_diff_days("o_orderdate", "l_shipdate").alias("order_to_ship_days"),
                    date_diff_days("l_shipdate", "o_orderdate").alias("ship_to_order_days"))


@op("decimal_arith", """SELECT l_orderkey, l_linenumber, l_partkey,
  CAST(CAST(l_extendedprice AS DECIMAL(18,3)) - CAST(l_quantity AS DECIMAL(18,3)) AS DECIMAL(19,3)) AS diff,
  CAST(CAST(l_extendedprice AS DECIMAL(38,3)) * CAST(l_quantity AS DECIMAL(18,3)) AS DECIMAL(37,6)) AS product,
  -CAST(l_extendedprice AS DECIMAL(18,3)) AS negated,
  CAST(CAST(l_extendedprice AS DECIMAL(18,3)) * CAST(0.001 AS DECIMAL(4,3)) AS DECIMAL(23,8)) AS per_mille
FROM lineitem""")
def decimal_arith(spark, sf):
    li = T(spark, sf).lineitem
    a, b = F.col("l_extendedprice").cast("decimal(18,3)"), qty3()
    return li.select(*L_KEYS, "l_partkey", (a - b).alias("diff"), (a * b).alias("product"), (-a).alias("negated"),
                     (a / F.lit(1000)).alias("per_mille"))


# ---------------------------------------------------------------- measures

_NPQ = [0, None, 3, 2, 7, 10]


def _npq_sql() -> str:
    return f"CAST({O.pick('l_linenumber % 6', _NPQ)} AS DECIMAL(18,3))"


@op("safe_ratio", f"""SELECT l_orderkey, l_linenumber, l_partkey,
  {O.exact_ratio('amount', 'per_qty', 4, 18, 2, 18, 3)} AS price_per_unit
FROM (SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, {_npq_sql()} AS per_qty FROM lineitem)""")
def safe_ratio_q(spark, sf):
    from ..sources.feeds import pick
    li = T(spark, sf).lineitem
    npq = pick(F.col("l_linenumber") % 6, _NPQ).cast("decimal(18,3)")
    return li.select(*L_KEYS, "l_partkey", safe_ratio(F.col("l_extendedprice").cast("decimal(18,2)"), npq)
                     .alias("price_per_unit"))


def _remaining_base(spark, sf) -> DataFrame:
    """Per (order, line): the newest line version's ordered quantity and
    price terms, the signed received quantity over all versions."""
    from ..sources.feeds import pick
    li = T(spark, sf).lineitem
    latest = latest_per_key(li, L_KEYS, *desc_ts_tb()).select(
        *L_KEYS, qty3().alias("ordered"), F.col("l_extendedprice").cast("decimal(18,2)").alias("amount"),
        pick(F.col("l_linenumber") % 6, _NPQ).cast("decimal(18,3)").alias("per_qty"),
        F.when(F.col("l_linestatus") == "F", F.lit("X")).alias("delivered"),
        F.when(F.col("l_partkey") % 3 == 0, F.lit(35.5)).otherwise(F.lit(1.0)).cast("decimal(18,4)").alias("rate"))
    recv = li.groupBy(*L_KEYS).agg(signed_sum(qty3(), F.col("l_tax") < 0.06, F.col("l_returnflag") == "R")
                                   .alias("received"))
    return lookup(latest, recv, [("l_orderkey", "l_orderkey"), ("l_linenumber", "l_linenumber")],
                  {"received": "received"})


_REMAIN_BASE_SQL = f"""WITH latest AS ({_top_sql(
    "l_orderkey, l_linenumber, CAST(l_quantity AS DECIMAL(18,3)) AS ordered, "
    "CAST(l_extendedprice AS DECIMAL(18,2)) AS amount, " + _npq_sql() + " AS per_qty, "
    "CASE WHEN l_linestatus = 'F' THEN 'X' END AS delivered, "
    "CAST(CASE WHEN l_partkey % 3 = 0 THEN 35.5 ELSE 1.0 END AS DECIMAL(18,4)) AS rate",
    "l_orderkey, l_linenumber", "l_shipdate DESC, l_partkey DESC")}),
recv AS (SELECT l_orderkey, l_linenumber, CAST(sum(CASE WHEN l_tax < CAST(0.06 AS DOUBLE) THEN
    CASE WHEN l_returnflag = 'R' THEN -CAST(l_quantity AS DECIMAL(18,3)) ELSE CAST(l_quantity AS DECIMAL(18,3)) END
  ELSE 0 END) AS DECIMAL(28,3)) AS received FROM lineitem GROUP BY l_orderkey, l_linenumber),
b AS (SELECT latest.*, recv.received FROM latest LEFT JOIN recv
  ON latest.l_orderkey = recv.l_orderkey AND latest.l_linenumber = recv.l_linenumber)"""
_REST = ("CASE WHEN ordered - coalesce(received, 0) < 0 THEN 0 ELSE ordered - coalesce(received, 0) END")
_PRICE = O.quotient_scale(18, 2, 18, 3)
# open quantity x unit price keeps 6 decimals, and so does that x rate
_OPEN_SQL = f"""{_REMAIN_BASE_SQL},
v AS (SELECT *, {O.whole(_REST, 3)} AS rest,
  CASE WHEN per_qty <> 0 THEN {O.quotient('amount', 18, 2, 'per_qty', 18, 3)} END AS price,
  {O.half_up('(rest * price)', f"{10 ** (_PRICE + 3 - 6)}::HUGEINT")} AS value6,
  {O.half_up(f"(value6 * {O.whole('rate', 4)})", '10000::HUGEINT')} AS local6, delivered IS NOT DISTINCT FROM 'X' AS closed
  FROM b)"""


@op("remaining_qty", f"""{_REMAIN_BASE_SQL}
SELECT l_orderkey, l_linenumber, CAST(CASE WHEN delivered = 'X' THEN 0 ELSE {_REST} END AS DECIMAL(29,3))
  AS open_qty FROM b""")
def remaining_qty_q(spark, sf):
    b = _remaining_base(spark, sf)
    return b.select(*L_KEYS, remaining_qty("ordered", "received", "delivered").alias("open_qty"))


@op("remaining_value", f"""{_OPEN_SQL}
SELECT l_orderkey, l_linenumber, {O.shown('if(closed, 0::HUGEINT, value6)', 6, 3)} AS open_value FROM v""")
def remaining_value_q(spark, sf):
    b = _remaining_base(spark, sf)
    return b.select(*L_KEYS, remaining_value("ordered", "received", "delivered", "amount", "per_qty")
                    .alias("open_value"))


@op("remaining_value_local", f"""{_OPEN_SQL}
SELECT l_orderkey, l_linenumber, {O.shown('if(closed, 0::HUGEINT, local6)', 6, 4)} AS open_value_local FROM v""")
def remaining_value_local_q(spark, sf):
    b = _remaining_base(spark, sf)
    return b.select(*L_KEYS, remaining_value("ordered", "received", "delivered", "amount", "per_qty", rate="rate",
                                             dtype="decimal(18,4)").alias("open_value_local"))


@op("amount_local", """SELECT o_orderkey, CAST(CAST(CAST(o_totalprice AS DECIMAL(18,3)) AS DECIMAL(38,3))
  * CAST(CASE WHEN o_custkey % 3 = 0 THEN 35.5 ELSE 1.0 END AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS amount_thb
FROM orders""")
def amount_local(spark, sf):
    o = T(spark, sf).orders
    rate = F.when(F.col("o_custkey") % 3 == 0, F.lit(35.5)).otherwise(F.lit(1.0)).cast("decimal(18,4)")
    return o.select("o_orderkey", to_local(F.col("o_totalprice").cast("decimal(18,3)"), rate).alias("amount_thb"))


_UOM_SQL = O.sql("""SELECT f.purchasingdocument, f.purchasingdocumentitem, f.changesequence, f.orderquantityunit,
  f.orderquantity, u.quantitynumerator AS num, u.quantitydenominator AS den, kg.quantitynumerator AS kg_num,
  kg.quantitydenominator AS kg_den, ea.quantitynumerator AS ea_num, ea.quantitydenominator AS ea_den
FROM f_item f
LEFT JOIN lk_uom u ON f.material = u.product AND f.orderquantityunit = u.alternativeunit
LEFT JOIN lk_uom kg ON f.material = kg.product AND kg.alternativeunit = 'KG'
LEFT JOIN lk_uom ea ON f.material = ea.product AND ea.alternativeunit = 'EA'""", "f_item", "lk_uom")


def _uom_base(spark, sf) -> DataFrame:
    """The unit table has several rows per product and grows with them, so none of its lookups is broadcast;
    the two by product share one shuffle."""
    t = T(spark, sf)
    uom = Lookups(spark, t).ziprduom
    f = FEEDS["zimmpurgdocitem"](t).select("purchasingdocument", "purchasingdocumentitem", "changesequence",
                                           "material", "orderquantityunit", "orderquantity")
    version = ["purchasingdocument", "purchasingdocumentitem", "changesequence"]
    f = lookup(f, uom, [("material", "product"), ("orderquantityunit", "alternativeunit")],
               {"num": "quantitynumerator", "den": "quantitydenominator"}, salt_cols=version, grows=True)
    f = lookup(f, uom, [("material", "product")], {"kg_num": "quantitynumerator", "kg_den": "quantitydenominator"},
               where=F.col("alternativeunit") == "KG", salt_cols=version, grows=True)
    return lookup(f, uom, [("material", "product")], {"ea_num": "quantitynumerator", "ea_den": "quantitydenominator"},
                  where=F.col("alternativeunit") == "EA", salt_cols=version, grows=True)


_ID = "purchasingdocument, purchasingdocumentitem, changesequence"


@op("uom_to_base", f"""WITH u AS ({_UOM_SQL}), c AS (SELECT *, {O.base6('orderquantity', 'num', 'den')} AS base6 FROM u)
SELECT {_ID}, {O.shown('base6', 6, 3)} AS qty_base FROM c""")
def uom_to_base_q(spark, sf):
    return _uom_base(spark, sf).select(*_ID.split(", "), uom_to_base("orderquantity", "num", "den").alias("qty_base"))


@op("uom_to_kg", f"""WITH u AS ({_UOM_SQL}), c AS (SELECT *, {O.base6('orderquantity', 'num', 'den')} AS base6,
  {O.target6('base6', 'kg_num', 'kg_den')} AS kg6 FROM u)
SELECT {_ID}, if({O.no_target('num', 'den', 'kg_num', 'kg_den')},
  CASE WHEN orderquantityunit = 'G' THEN {O.shown(O.whole('orderquantity', 3), 6, 3)} END, {O.shown('kg6', 6, 3)}) AS qty_kg
FROM c""")
def uom_to_kg_q(spark, sf):
    return _uom_base(spark, sf).select(*_ID.split(", "), uom_to_target(
        "orderquantity", "num", "den", "kg_num", "kg_den", fallback=("orderquantityunit", "G", 1000)).alias("qty_kg"))


@op("uom_to_ea", f"""WITH u AS ({_UOM_SQL}), c AS (SELECT *, {O.base6('orderquantity', 'num', 'den')} AS base6,
  {O.target6('base6', 'ea_num', 'ea_den')} AS ea6 FROM u)
SELECT {_ID}, {O.shown('ea6', 6, 3)} AS qty_ea FROM c""")
def uom_to_ea_q(spark, sf):
    return _uom_base(spark, sf).select(*_ID.split(", "), uom_to_target(
        "orderquantity", "num", "den", "ea_num", "ea_den").alias("qty_ea"))


_SHIP_SQL = """(SELECT l_orderkey, CAST(min(l_shipdate) AS DATE) AS first_ship, CAST(max(l_shipdate) AS DATE) AS last_ship
  FROM lineitem GROUP BY l_orderkey)"""


def _ships(t: Tables) -> DataFrame:
    return t.lineitem.groupBy("l_orderkey").agg(F.min("l_shipdate").cast("date").alias("first_ship"),
                                                F.max("l_shipdate").cast("date").alias("last_ship"))


@op("lead_time_days", f"""SELECT o.o_orderkey,
  datediff('day', CAST(o.o_orderdate AS DATE), s.first_ship) AS order_to_first_ship_days,
  datediff('day', CAST(o.o_orderdate AS DATE), s.last_ship) AS order_to_last_ship_days,
  datediff('day', s.first_ship, s.last_ship) AS first_to_last_ship_days
FROM orders o LEFT JOIN {_SHIP_SQL} s ON o.o_orderkey = s.l_orderkey""")
def lead_time_days(spark, sf):
    t = T(spark, sf)
    o = lookup(t.orders.select("o_orderkey", "o_orderdate"), _ships(t), [("o_orderkey", "l_orderkey")],
               {"first_ship": "first_ship", "last_ship": "last_ship"})
    return o.select("o_orderkey", lead_days("o_orderdate", "first_ship").alias("order_to_first_ship_days"),
                    lead_days("o_orderdate", "last_ship").alias("order_to_last_ship_days"),
                    lead_days("first_ship", "last_ship").alias("first_to_last_ship_days"))


@op("late_days", f"""SELECT o.o_orderkey, CAST(CASE WHEN s.last_ship IS NULL THEN 0
  WHEN datediff('day', d.due, s.last_ship) < 0 THEN 0 ELSE datediff('day', d.due, s.last_ship) END AS INTEGER)
  AS late_days
FROM orders o
JOIN (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE CAST(o_orderdate AS DATE) + 30 END AS due
      FROM orders) d ON o.o_orderkey = d.o_orderkey
LEFT JOIN {_SHIP_SQL} s ON o.o_orderkey = s.l_orderkey""")
def late_days_q(spark, sf):
    t = T(spark, sf)
    o = t.orders.select("o_orderkey", F.when(F.col("o_orderkey") % 7 != 0, F.date_add(
        F.col("o_orderdate").cast("date"), 30)).alias("due"))
    o = lookup(o, _ships(t), [("o_orderkey", "l_orderkey")], {"last_ship": "last_ship"})
    return o.select("o_orderkey", late_days("due", "last_ship").alias("late_days"))


# ---------------------------------------------------------------- checks


@op("uniqueness_check", O.sql("""SELECT CAST(sum(n) AS BIGINT) AS n_rows, count(*) AS n_keys,
  count(CASE WHEN n > 1 THEN 1 END) AS n_duplicate_keys, max(n) AS max_rows_per_key
FROM (SELECT purchasingdocument, purchasingdocumentitem, count(*) AS n FROM s_pr_item
      GROUP BY purchasingdocument, purchasingdocumentitem)""", "s_pr_item"))
def uniqueness_check_q(spark, sf):
    """Grain check behind the item mart's fan-out: requisition items per PO item."""
    from .catalog import Ctx
    from ..operators import uniqueness_check
    return uniqueness_check(Ctx(spark, sf).silver("silver_mm_zipritem"),
                            ["purchasingdocument", "purchasingdocumentitem"])
