"""Fixed values.

These must equal the values the reference's queries use, or the results
differ.  They are stated here once, in the order a load meets them.
"""

import datetime as dt

# ---- fixed values (must equal the reference's) ----
LOOKBACK = "6 hours"                       # overlap re-read behind the high-water mark
EMPTY_TARGET_FLOOR = dt.datetime(1900, 1, 1)  # mark of an empty target, before the lookback
COMPACT_DATE = "yyyyMMdd"                  # date strings in the feeds
COMPACT_TIMESTAMP = "yyyyMMddHHmmss"       # timestamp strings (date || time)
FINAL_APPROVAL_CODE = "00"                 # PO approval step kept in silver
FREE_ITEM_FLAG = "X"                       # set when invoice-expected is NULL or ''
KG_UNIT = "KG"                             # unit-conversion target: kilograms
EA_UNIT = "EA"                             # unit-conversion target: each
PRICING_ITEM_FROM = 2                      # pricing item key: SUBSTR(item, 2)
CONDITION_LABELS = {"ZFB3": "Freight", "ZCB1": "Clearance", "ZDB3": "Discount"}
RECEIPT_MOVEMENTS = ("101", "102")         # goods-movement types counted as receipts
CREDIT_CODE = "H"                          # debit/credit code that negates a receipt
CONDITION_TOTALS = {"clearance": "ZCB1", "discount": "ZDB3", "freight": "ZFB3"}
LOCAL_CURRENCY = "THB"                     # condition currency taken at its rate value
DELIVERED = "X"                            # completely-delivered flag: nothing remains
FIRST_SCHEDULE_LINE = "0001"               # schedule line giving the delivery date
RELEASED = "R"                             # release code that attaches the PO approval
SUPPLIER_FROM = 3                          # mart supplier: SUBSTR(supplier, 3)
GRAM_UNIT, GRAMS_PER_KG = "G", 1000        # grams fall back to qty / 1000 in KG
OPEN_END_DATE = "9999-12-31"               # NULL price-validity end
