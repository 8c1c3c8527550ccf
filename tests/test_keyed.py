"""Tables laid out by key: only touched ranges are read and written, the target is not shuffled, no writer's rows are lost."""

import datetime as dt
import random
import re

import pytest
from pyspark.sql import functions as F

from purchlake.operators import keyed, upsert
from purchlake.operators.upsert import CommitConflict, current_commit, read_mark, read_table, write_snapshot
from purchlake.plans import silver
from purchlake.plans.pipeline import FIRST_LOADS, layout_of
from purchlake.sources import FEEDS, Lookups, Tables, store
from purchlake.streaming import merge_batch

SF = "/root/testdata/sf0.001"
LAYOUT = keyed.Layout(["k", "j"], ["p"], range_rows=100, buckets=4)
SCHEMA = "k string, j int, p string, v int, t timestamp_ntz"
DAY = dt.datetime(2024, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(k, j, p, v, DAY + dt.timedelta(hours=v)) for k, j, p, v in rows], SCHEMA)


def held(df):
    return sorted(((r.k, r.j, r.p, r.v) for r in df.collect()), key=str)


def test_many_merges_against_a_dictionary(spark, scratch):
    """Growing keys, NULL key parts, several rows of one key, deletes; ranges split as they grow."""
    rng = random.Random(1)
    table, want = f"{scratch}/t", {}
    for n in range(5):
        rows = {}
        for _ in range(260):
            key = (f"{rng.randrange(60 * n, 60 * n + 200):05d}", rng.randrange(2), rng.choice(["a", None]))
            rows[key] = [(*key, rng.randrange(100)) for _ in range(rng.choice([1, 1, 2]))]
        keyed.merge(spark, table, LAYOUT, frame(spark, [r for rs in rows.values() for r in rs]), delete_when=F.col("v") == 7,
                    mark_col="t")
        for key, rs in rows.items():
            want[key] = [r for r in rs if r[3] != 7]
        assert held(read_table(spark, table)) == sorted((r for rs in want.values() for r in rs), key=str)
        ranges = current_commit(spark, table).keyed["ranges"]
        assert sum(r["rows"] for r in ranges) == sum(map(len, want.values()))
        starts = [r["from"] for r in ranges]
        assert starts[0] is None and starts[1:] == sorted(set(starts[1:]))
        assert read_mark(spark, table) == DAY + dt.timedelta(hours=max(r[3] for rs in want.values() for r in rs))
    assert len(ranges) > 4 and max(r["rows"] for r in ranges) <= 2 * LAYOUT.range_rows


def test_untouched_ranges_keep_their_files(spark, scratch):
    table = f"{scratch}/t"
    keyed.merge(spark, table, LAYOUT, frame(spark, [(f"{i:05d}", 0, None, 1) for i in range(1000)]))
    before = {r["from"]: r["path"] for r in current_commit(spark, table).keyed["ranges"]}
    assert len(before) >= 8
    keyed.merge(spark, table, LAYOUT, frame(spark, [("00999", 0, None, 2), ("01000", 0, "x", 3)]))
    after = {r["from"]: r["path"] for r in current_commit(spark, table).keyed["ranges"]}
    changed = [k for k in after if after[k] != before[k]]
    assert changed == [max(k for k in after if k)]
    assert read_table(spark, table).count() == 1001
    keyed.merge(spark, table, LAYOUT, frame(spark, []))
    assert current_commit(spark, table).number == 2


def test_old_ranges_are_removed(spark, scratch):
    table = f"{scratch}/t"
    keyed.merge(spark, table, LAYOUT, frame(spark, [(f"{i:05d}", 0, None, 1) for i in range(1000)]))
    for v in range(2, 8):
        keyed.merge(spark, table, LAYOUT, frame(spark, [("00000", 0, None, v)]))
    used = set()
    for name in store.names(spark, f"{table}/_commits"):
        if name.endswith(".json") and not name.startswith("."):
            used |= upsert._read_commit(spark, table, name).folders()
    there = {f"{d}/{p}" for d in store.names(spark, table) if d.startswith("data-")
             for p in store.names(spark, f"{table}/{d}") if p.startswith(keyed.RANGE)}
    assert there == used and read_table(spark, table).where("k = '00000'").first().v == 7


@pytest.mark.parametrize("version", [None, "t"])
def test_plan_prunes_and_does_not_shuffle_the_target(spark, scratch, version):
    table = f"{scratch}/t"
    keyed.merge(spark, table, LAYOUT, frame(spark, [(f"{i:05d}", 0, None, 1) for i in range(1000)]))
    commit = current_commit(spark, table)
    batch = frame(spark, [(f"{i:05d}", 0, None, 2) for i in range(950, 1040)])
    batch.write.parquet(f"{scratch}/batch")
    last = commit.keyed["ranges"][-1]["id"]
    confs = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    old = {k: spark.conf.get(k) for k in confs}
    for k, v in confs.items():
        spark.conf.set(k, v)
    try:
        df = keyed.merged_ranges(spark, table, commit, spark.read.parquet(f"{scratch}/batch"), [last], version)
        plan = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    lines = plan.split("\n")
    depth = lambda x: re.match(r"[ :]*(?:[+:]-)?", x).end()
    targets = [i for i, x in enumerate(lines) if "FileScan" in x and "purchlake_" in x]
    assert targets
    for i in targets:
        assert "Bucketed: true" in lines[i] and f"{keyed.RANGE}#" in lines[i] and "InMemoryFileIndex(1 paths)" in lines[i]
        at = i
        while "SortMergeJoin" not in lines[at]:  # from parent to parent, up to the join
            at = max(j for j in range(at) if depth(lines[j]) < depth(lines[at]))
            assert "Exchange" not in lines[at], plan


def test_interleaved_writers_lose_no_rows(spark, scratch, monkeypatch):
    """A reads, B merges and commits, A commits: A merges again on what B left."""
    for layout in (True, False):
        table = f"{scratch}/t{layout}"
        put = lambda rows: (keyed.merge(spark, table, LAYOUT, frame(spark, rows)) if layout else
                            upsert.merge_snapshot(spark, table, lambda now, _: upsert.upsert_by_key(now, frame(spark, rows), ["k"])))
        put([("00001", 0, None, 1)])
        real, between = upsert._put, [lambda: put([("00003", 0, None, 3)])]

        def interleaved(*args):
            if between:
                between.pop()()
            real(*args)

        with monkeypatch.context() as m:
            m.setattr(upsert, "_put", interleaved)
            put([("00002", 0, None, 2)])
        assert [r[0] for r in held(read_table(spark, table))] == ["00001", "00002", "00003"]
        assert current_commit(spark, table).number == 3


def test_a_write_derived_from_an_old_commit_fails(spark, scratch):
    table = f"{scratch}/t"
    write_snapshot(spark.range(1), table, base=None)
    base = current_commit(spark, table)
    write_snapshot(spark.range(2), table, base=base)
    with pytest.raises(CommitConflict):
        write_snapshot(spark.range(3), table, base=base)
    with pytest.raises(CommitConflict):
        write_snapshot(spark.range(3), table, base=None)
    assert read_table(spark, table).count() == 2
    assert len([x for x in store.names(spark, table) if x.startswith("snap-")]) == 2


@pytest.mark.parametrize("place", ["_by_link", "_by_rename"])
def test_create_refuses_a_taken_name(spark, scratch, place):
    path = f"file://{scratch}/c/1.json"
    store.create_text(spark, path, "first")
    with pytest.raises(FileExistsError):
        store.create_text(spark, path, "second")
    with pytest.raises(Exception, match="xists"):
        getattr(store, place)(spark, path, "second")
    getattr(store, place)(spark, f"file://{scratch}/c/2.json", "other")
    assert store.read_text(spark, path) == "first" and store.read_text(spark, f"file://{scratch}/c/2.json") == "other"
    assert [n for n in store.names(spark, f"file://{scratch}/c") if not n.endswith(".crc")] == ["1.json", "2.json"]


def test_a_store_that_cannot_refuse_is_an_error(spark, scratch):
    with pytest.raises(RuntimeError, match="two writers"):
        store._by_create(spark, f"file://{scratch}/x.json", "text")


@pytest.mark.parametrize("name", sorted(FIRST_LOADS))
def test_first_load_then_increments(spark, scratch, name):
    """No commit: the whole history.  A commit: behind the mark, so rows without a time are not seen again."""
    t = Tables(spark, SF)
    spec, lk = silver.spec_for(name), Lookups(spark, t)
    feed, table = FEEDS[spec.feed](t), f"{scratch}/t"
    layout = layout_of(spec, range_rows=400, buckets=3)
    merge_batch(spark, spec, feed, table, lk, layout=layout, first_load=True)
    whole = silver.run(silver.spec_for(name, True), feed, lk, initial=True).drop(silver.AUDIT)
    now = read_table(spark, table).drop(silver.AUDIT)
    assert now.exceptAll(whole).isEmpty() and now.count() == whole.count() > silver.run(spec, feed, lk).count()
    merge_batch(spark, spec, feed, table, lk, layout=layout, first_load=True)
    again = read_table(spark, table).drop(silver.AUDIT)
    assert again.count() == whole.count() and again.exceptAll(whole).isEmpty()
