from .measures import (late_days, lead_days, ratio, remaining_qty, remaining_value, safe_ratio,
                       to_local, uom_to_base, uom_to_target)
from .scalar import (coalesce_default, concat_strict, date_diff_days, label, null_or_empty_flag, ntz,
                     open_end_date, parse_compact_date, parse_compact_ts, substr_from)

__all__ = [
    "late_days", "lead_days", "ratio", "remaining_qty", "remaining_value", "safe_ratio", "to_local",
    "uom_to_base", "uom_to_target", "coalesce_default", "concat_strict", "date_diff_days", "label",
    "null_or_empty_flag", "ntz", "open_end_date", "parse_compact_date", "parse_compact_ts", "substr_from",
]
