"""End-to-end load of the silver tables and marts into a table folder.

The reference is a set of SELECT statements whose results are written by key
(the write itself is implied).  ``load_all`` runs them in dependency order:

    feeds -> 10 silver tables (first load where a table was never committed,
             else incremental behind the committed mark)
          -> 4 marts (increment behind the mart's own mark, upserted on the
             mart grain; the last-price mart is recomputed and replaced)

Tables are laid out by key ranges (see ``operators.keyed``), so a batch rewrites
only the ranges it touches and the target is not shuffled.  Commits are
compare-and-swap.  A re-run after a failure resumes from the last commits and is
idempotent.

The load mode follows from the table: the three feeds with an initial-load
variant take their whole history, rows without an ingestion time included, if
the table's commit folder is proven absent; later runs read behind the mark.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..operators import keyed
from ..operators.reconcile import reconcile, rows_of_keys
from ..operators.upsert import read_table, write_snapshot
from ..sources import FEEDS, Lookups, Tables, store
from ..streaming.silver_stream import merge_batch, staged
from . import gold, silver
from .materialize import stored

# Silver tables in load order (all independent of each other).
SILVER_TABLES = [
    "silver_mm_zigoodsmvmtdoc", "silver_mm_ziinforecorgdata", "silver_mm_zimmprgdocsl",
    "silver_mm_zimmpurdochist", "silver_mm_zimmpurgdocitem", "silver_mm_zipoapprov", "silver_mm_ziprapprov",
    "silver_mm_zipricingelement", "silver_mm_zipritem", "silver_mm_zmmpurchasingdoc",
]
#: Feeds with an initial-load variant.
FIRST_LOADS = {"silver_mm_zimmpurgdocitem", "silver_mm_zipoapprov", "silver_mm_zmmpurchasingdoc"}
ITEM_KEY = ["purchasingdocument", "purchasingdocumentitem"]
HISTORY_KEY = ["purchasingdocument", "purchasingdocumentitem", "accountassignmentnumber",
               "purchasinghistorydocumenttype", "purchasinghistorydocumentyear", "purchasinghistorydocument",
               "purchasinghistorydocumentitem"]
# Mart grains used for the keyed write.
MART_KEYS = {"mart_mm_poitem": ITEM_KEY, "mart_mm_inforecord": ITEM_KEY, "mart_mm_pohistory": HISTORY_KEY}


def layout_of(spec: silver.SilverSpec, **sizes: int) -> keyed.Layout:
    """The guarded key columns are never NULL; the others may be."""
    return keyed.Layout(spec.guards, [k for k in spec.keys if k not in spec.guards], **sizes)


def _upsert_mart(spark: SparkSession, path: str, build, **sizes: int) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1]
    rows, folder = staged(build(read_table(spark, path)), name)
    keyed.merge(spark, path, keyed.Layout(MART_KEYS[name], **sizes), rows)
    store.remove(spark, folder)
    return path


def repair(spark: SparkSession, name: str, feed: DataFrame, path: str, lookups: Lookups, **sizes: int) -> int:
    """Merge the versions that the table of ``name`` has missed (they arrived later than the marks reach
    back); returns the number of keys that differed.  Only for tables that keep the feed's keys unchanged."""
    spec = silver.spec_for(name)
    if not spec.keeps_key():
        raise ValueError(f"{name} does not carry its feed's keys")
    wanted = silver.newest_versions(spec, feed, initial=name in FIRST_LOADS)
    found, folder = staged(reconcile(wanted, read_table(spark, path), spec.keys).where("status <> 'extra'"), f"{name}-missed")
    n = found.count()
    if n:
        merge_batch(spark, spec, rows_of_keys(feed, found, spec.keys), path, lookups, use_high_water_mark=False,
                    layout=layout_of(spec, **sizes))
    store.remove(spark, folder)
    return n


def load_all(spark: SparkSession, sf_dir: str, table_root: str, **sizes: int) -> dict[str, str]:
    """Load every silver table and mart from the feeds of ``sf_dir``; ``sizes``: those of ``keyed.Layout``."""
    t = Tables(spark, sf_dir)
    lk = Lookups(spark, t)
    root = table_root.rstrip("/")
    out: dict[str, str] = {}
    unique = silver.unique_lookups(lk)
    for name in SILVER_TABLES:
        spec = silver.spec_for(name)
        out[name] = merge_batch(spark, spec, FEEDS[spec.feed](t), f"{root}/{name}", lk, layout=layout_of(spec, **sizes),
                                first_load=name in FIRST_LOADS, unique=unique)

    def s(name: str) -> DataFrame:
        return read_table(spark, f"{root}/{name}")

    items, headers = s("silver_mm_zimmpurgdocitem"), s("silver_mm_zmmpurchasingdoc")
    units = lk.ziunitofmeasure
    out["mart_mm_poitem"] = _upsert_mart(spark, f"{root}/mart_mm_poitem", lambda tgt: gold.mart_po_item(
        items, s("silver_mm_zipritem"), s("silver_mm_zimmprgdocsl"), s("silver_mm_zipoapprov"),
        s("silver_mm_ziprapprov"), headers, s("silver_mm_zimmpurdochist"), s("silver_mm_zipricingelement"),
        units, target=tgt, store=stored), **sizes)
    out["mart_mm_inforecord"] = _upsert_mart(spark, f"{root}/mart_mm_inforecord", lambda tgt: gold.mart_info_record(
        items, s("silver_mm_ziinforecorgdata"), headers, target=tgt), **sizes)
    out["mart_mm_pohistory"] = _upsert_mart(spark, f"{root}/mart_mm_pohistory", lambda tgt: gold.mart_po_history(
        s("silver_mm_zimmpurdochist"), items, headers, target=tgt), **sizes)
    out["mart_mm_matlastprice"] = write_snapshot(gold.mart_last_price(items, headers),
                                                 f"{root}/mart_mm_matlastprice")
    return out
