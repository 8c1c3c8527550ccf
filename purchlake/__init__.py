"""purchlake: purchasing marts from change-data feeds, built on Spark DataFrames.

Layers
------
sources    read driver tables / feed tables, derive the test feeds
functions  column-level building blocks (parsers, guarded ratios, unit conversion)
operators  DataFrame-level operators (incremental slice, latest-per-key,
           lookups, conditional aggregation, conform, upsert, checks)
plans      silver specs, gold marts and the query catalogue
streaming  micro-batch (Structured Streaming) driver for the silver upserts
"""

__all__ = ["session"]
