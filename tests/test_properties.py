"""Property tests (hypothesis): top-1 per key and upsert invariants."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from purchlake.operators import latest_per_key, upsert_by_key

T0 = dt.datetime(2024, 1, 1)
versions = st.lists(st.tuples(st.sampled_from(["a", "b", "c", None]), st.integers(0, 20), st.integers(0, 3)),
                    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1], r[2]))
SETTINGS = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))


def frame(spark, rows):
    return spark.createDataFrame([(k, T0 + dt.timedelta(hours=h), s) for k, h, s in rows],
                                 "k string, ts timestamp, seq int")


@SETTINGS
@given(versions)
def test_latest_per_key_is_the_max_version_of_each_key(spark, rows):
    out = latest_per_key(frame(spark, rows), ["k"], [F.desc("ts")], [F.desc("seq")]).collect()
    want = {}
    for k, h, s in rows:
        if k not in want or (h, s) > want[k]:
            want[k] = (h, s)
    assert {r.k: (int((r.ts - T0).total_seconds() // 3600), r.seq) for r in out} == want
    assert len(out) == len(want)


@SETTINGS
@given(versions, st.integers(0, 20))
def test_upsert_in_two_batches_equals_one_load(spark, rows, cut):
    df = frame(spark, rows)
    top = lambda d: latest_per_key(d, ["k"], [F.desc("ts")], [F.desc("seq")])
    first = top(df.where(F.col("ts") < F.lit(T0 + dt.timedelta(hours=cut))))
    second = top(df.where(F.col("ts") >= F.lit(T0 + dt.timedelta(hours=cut))))
    merged = upsert_by_key(first, second, ["k"])
    once = top(df)
    assert sorted(map(tuple, merged.collect()), key=str) == sorted(map(tuple, once.collect()), key=str)
    again = upsert_by_key(merged, second, ["k"])
    assert sorted(map(tuple, again.collect()), key=str) == sorted(map(tuple, merged.collect()), key=str)
