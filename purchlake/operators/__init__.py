from .aggregate import conditional_sum, converted_sum, signed_sum
from .checks import duplicate_keys, fan_out_report, uniqueness_check
from .conform import Field, conform
from .dedup import best_of_each_class, latest_per_key, preferred_match
from .enrich import hot_keys, lookup
from .incremental import high_water_mark, require_keys, since
from .reconcile import reconcile
from .upsert import read_table, upsert_by_key, write_snapshot

__all__ = [
    "conditional_sum", "converted_sum", "signed_sum", "duplicate_keys",
    "fan_out_report", "uniqueness_check", "Field", "conform", "best_of_each_class", "latest_per_key",
    "preferred_match", "hot_keys", "lookup",
    "reconcile", "high_water_mark", "require_keys", "since", "read_table", "upsert_by_key", "write_snapshot",
]
