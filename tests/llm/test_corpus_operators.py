"""Every operator on a hostile corpus, against brute force; empty tables; clashing column names."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus
from purchlake.llm import (content_sort_dedup, genetic_packing, language_bits, license_rules, ngram_join, pii_anchors,
                           reshard, small_world, suffix_dedup, temperature_mixing)

ROWS = corpus.corpus()


@pytest.fixture(scope="module")
def docs(spark):
    return corpus.frame(spark, ROWS, clashing=True).repartition(5).persist()


@pytest.fixture(scope="module")
def empty(spark):
    return corpus.frame(spark, [])


def test_exact_dedup(docs):
    groups = defaultdict(list)
    for r in ROWS:
        groups[corpus.blanks(r[1])].append(r[0])
    want = []
    for text, ids in groups.items():
        known = sorted(i for i in ids if i is not None)
        keep = known[0] if known else None
        order = known + [None] * (len(ids) - len(known))
        sha = hashlib.sha256(text.encode()).hexdigest()
        want += [(i, keep, len(ids), k == 0, sha) for k, i in enumerate(order)]
    got = content_sort_dedup.annotate_copies(docs)
    assert Counter(map(tuple, got.collect())) == Counter(want)
    kept = content_sort_dedup.drop_copies(docs)
    assert kept.columns == docs.columns
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(
        next((i, t) for i, t, *_ in sorted(ROWS, key=lambda r: (r[0] is None, r[0] or 0)) if corpus.blanks(t) == text
             ) for text in groups)


def test_exact_dedup_group_over_partitions(spark):
    """A group that spans partitions: half of all rows are one text."""
    df = spark.range(4000, numPartitions=6).select(
        F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 0, "same  text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    got = content_sort_dedup.annotate_copies(df)
    hot = got.where("group_size > 1").agg(F.count("*"), F.min("keep_id"), F.max("keep_id"), F.max("group_size"),
                                          F.sum(F.col("kept").cast("int"))).first()
    assert tuple(hot) == (2000, 0, 0, 2000, 1)
    assert content_sort_dedup.drop_copies(df).count() == 2001


def test_packing(docs):
    n, least = corpus.check_packing(genetic_packing.pack(genetic_packing.pieces(docs)).collect(), [(r[0], r[1]) for r in ROWS])
    assert n <= least + 2


def test_packing_over_blocks(spark, monkeypatch):
    monkeypatch.setattr(genetic_packing, "BLOCK", 64)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit(0).alias("piece"), F.lit(0).cast("long").alias("start"),
                                 (F.col("id") * 37 % 1500 + 1).alias("length"), F.col("id").alias("ids_crc32"))
    got = genetic_packing.pack(df).collect()
    assert len(got) == 500
    used = Counter()
    for r in got:
        used[r.sequence_id] += r.length
    assert max(used.values()) <= 2048
    assert len(used) <= 1.06 * sum(used.values()) / 2048


def test_licences(docs):
    got = {(r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in license_rules.scan_licenses(docs).collect()}
    want = set()
    for doc, text, *_ in ROWS:
        w = re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(corpus.LOWER))
        at, labels = [], set()
        for phrase, label in license_rules.BASE.items():
            p = phrase.split()
            hits = [k for k in range(len(w)) if w[k:k + len(p)] == p]
            at += hits
            labels |= {label} if hits else set()
        want.add((doc, len(w), len(at), min(at, default=None), max(at, default=None), ",".join(sorted(labels))))
    assert got == want


def test_mixing(docs):
    def words(t):
        return len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))

    got = [tuple(r) for r in temperature_mixing.mix(docs).select(
        "row.doc_id", "row.text", "source", "epoch", "tokens", "weight", "mix_key").collect()]
    rows = Counter((r[0], r[1], r[3]) for r in ROWS)
    assert Counter((g[0], g[1], g[2]) for g in got if g[3] == 0) == rows  # nothing is left out
    assert all(n <= rows[k[:3]] for k, n in Counter((*g[:3], g[3]) for g in got).items())
    tokens = Counter()
    for r in ROWS:
        tokens[r[3]] += words(r[1])
    x = temperature_mixing.find_exponent({str(k): v for k, v in tokens.items()})
    w = {k: (v / sum(tokens.values())) ** x for k, v in tokens.items()}
    budget = max(v / w[k] for k, v in tokens.items())
    used = Counter()
    for g in got:
        assert g[4] == words(g[1]) and g[5] == pytest.approx(w[g[2]] / sum(w.values()))
        assert 0 <= g[6] <= 1
        used[g[2]] += g[4]
    longest = max(words(r[1]) for r in ROWS)
    for s in tokens:
        assert abs(used[s] - w[s] * budget) <= longest
        assert used[s] <= temperature_mixing.MAX_REPEATS * tokens[s] + longest
    assert temperature_mixing.mixed_rows(docs).columns == docs.columns


def test_mixing_cuts_to_a_budget(spark):
    df = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 5000, "big").otherwise("small").alias("source"),
                                  F.lit("a b c").alias("text"))
    got = temperature_mixing.mix(df, max_repeats=None, target_entropy=math.log(2), budget=6000.0)
    n = {r[0]: r[1] for r in got.groupBy("source").agg(F.sum("tokens")).collect()}
    assert abs(n["big"] - 3000) <= 3 and abs(n["small"] - 3000) <= 3
    # any stretch of the order holds the sources at their weights
    half = {r[0]: r[1] for r in got.where("mix_key < 0.25").groupBy("source").agg(F.sum("tokens")).collect()}
    assert half["big"] == pytest.approx(750, rel=0.15) and half["small"] == pytest.approx(750, rel=0.15)


def test_mixing_loses_no_row_to_rounding(spark):
    """The least read source is read once; rows without tokens come along wherever its last token is."""
    def spent(n):
        tokens = {"+a": n, "+b": n // 2}
        w = temperature_mixing.weights(tokens, temperature_mixing.find_exponent(tokens, 1.7))
        return temperature_mixing.repeats(tokens, w)["+a"] * n

    n = next(n for n in range(4, 120) if spent(n) < n)
    df = spark.createDataFrame([(i, "a", "x") for i in range(n)] + [(n + i, "a", None) for i in range(900)]
                               + [(2000 + i, "b", "x") for i in range(n // 2)], "doc_id long, source string, text string")
    got = temperature_mixing.mix(df, max_repeats=1.7).where("epoch = 0 and source = 'a'")
    assert sorted(r[0] for r in got.select("row.doc_id").collect()) == list(range(n + 900))


def test_mixing_of_many_sources(docs, monkeypatch):
    def rows():
        got = temperature_mixing.mix(docs).select("row.doc_id", "row.text", "source", "epoch", "block", "tokens", "weight", "mix_key")
        return sorted((tuple((x is not None, x) for x in r[:6]), r[6], r[7]) for r in got.collect())

    want = rows()
    monkeypatch.setattr(temperature_mixing, "MOST_SOURCES", 3)
    got = rows()
    assert [g[0] for g in got] == [g[0] for g in want]
    assert np.allclose([g[1:] for g in got], [g[1:] for g in want])


def test_suffix_dedup(docs):
    got = Counter(map(tuple, suffix_dedup.remove_repeats(docs).collect()))
    want = Counter()
    for (body, gone), (doc, *_) in zip(corpus.repeated_bytes([r[1] for r in ROWS]), ROWS):
        kept = bytes(b for b, g in zip(body, gone) if not g)
        spans = len(re.findall(rb"\x01+", bytes(gone)))
        want[doc, len(body), sum(gone), spans, hashlib.sha256(kept).hexdigest()] += 1
    assert got == want


def test_suffix_dedup_in_small_segments(spark):
    """Texts longer than a segment give the same result."""
    import random
    rng = random.Random(3)
    passage = corpus.sentence(rng, 80)
    texts = [corpus.sentence(rng, 300) + passage + corpus.sentence(rng, 200), passage[40:] + corpus.sentence(rng, 90),
             corpus.sentence(rng, 500)]
    data = [t.encode() for t in texts]
    flat = np.frombuffer(b"".join(data), np.uint8)
    ends = np.concatenate(([0], np.cumsum([len(d) for d in data])))

    def cells():
        out = set()
        for part, cut, row, start in suffix_dedup.segments(flat, ends):
            c = suffix_dedup.cells(part, cut)
            for f, l, o, s, h in zip(c["first"], c["last"], c["offset"], c["seg"], c["core"]):
                out |= {(int(row[s]), int(start[s] + w - cut[s]), int(h), int(o) - int(w - f)) for w in range(f, l + 1)}
        return out

    whole = cells()
    before, suffix_dedup.SEGMENT = suffix_dedup.SEGMENT, 1000
    try:
        assert cells() == whole
    finally:
        suffix_dedup.SEGMENT = before


def test_ngram_join(docs):
    root, sets = corpus.jaccard_components(ROWS)
    least = {}
    for i, r in zip(root, ROWS):
        if r[0] is not None:
            least[i] = min(least.get(i, r[0]), r[0])
    want = Counter((r[0], len(s), least.get(i) if s else r[0]) for r, i, s in zip(ROWS, root, sets))
    got = Counter(map(tuple, ngram_join.join_documents(docs).collect()))
    assert got == want
    kept = ngram_join.keep_one_each(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, _, c in want if i is None or i == c}


def test_ngram_join_chains_and_many_near_copies(spark):
    """Links that no pivot sees: a chain whose ends differ, and a hot list with outsiders."""
    import random
    rng = random.Random(11)
    base = corpus.sentence(rng, 100).split(" ")
    rows, words = [], list(base)
    for i in range(40):  # each step replaces the next two words
        words = list(words)
        words[(2 * i) % 100:(2 * i) % 100 + 2] = [f"new{i}a", f"new{i}b"]
        rows.append((i, " ".join(words), "en", "s", 1))
    rows += [(100 + i, corpus.edited(rng, " ".join(base), 1 + i % 6), "en", "s", 1) for i in range(120)]
    root, sets = corpus.jaccard_components(rows)
    least = defaultdict(lambda: 10**9)
    for i, r in zip(root, rows):
        least[i] = min(least[i], r[0])
    got = {r.doc_id: r.component_id for r in ngram_join.join_documents(corpus.frame(spark, rows)).collect()}
    assert got == {r[0]: least[i] for r, i in zip(rows, root)}


def test_language(docs, spark):
    got = {r.doc_id: r for r in language_bits.identify(docs).collect()}
    for doc, text, *_ in ROWS:
        held = doc is not None and zlib.crc32(str(doc).encode()) % 4 == 2
        r = got[doc]
        assert r.held_out == held and 0 <= r.score <= 1
        if not any(c.isalpha() for c in text or ""):
            assert doc is None or r.lang_pred == "und"
        elif doc is not None:
            assert r.lang_pred in ("en", "fr")
    kept = language_bits.keep_identified(docs)
    assert kept.columns == docs.columns
    assert Counter(r.doc_id for r in kept.collect()) == Counter(r[0] for r in ROWS if any(c.isalpha() for c in r[1] or ""))


def test_language_accuracy_on_held_out(spark):
    df = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language_bits.identify(df).join(df.select("doc_id", "lang"), "doc_id").where("held_out")
    right, n = got.agg(F.sum((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right >= 0.97 * n


def test_language_ignores_label_source_and_id(spark):
    """Changing them in held-out rows changes no prediction."""
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    held = language_bits.held_out()
    other = df.withColumn("lang", F.when(held, "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("z"))
    assert corpus.rows_of(language_bits.identify(df)) == corpus.rows_of(language_bits.identify(other))


def test_personal_data(docs):
    got = {r.doc_id: r for r in pii_anchors.find_personal_data(docs).collect()}
    mail = next(r for r in ROWS if r[1] and r[1].startswith("mail "))
    assert got[mail[0]].spans == "email:5:20,ip:24:32"
    assert got[mail[0]].base_sha256 == hashlib.sha256(b"email:5:20,ip:24:32").hexdigest()
    blank = next(r for r in ROWS if r[1] == "")
    assert got[blank[0]].base_sha256 == hashlib.sha256(b"").hexdigest() and len(got) == len({r[0] for r in ROWS})


def test_resharding(docs):
    got = reshard.assign_rows(docs, F.pmod(F.crc32(F.coalesce(F.col("source"), F.lit("")).cast("binary")), F.lit(5)), 4).collect()
    sizes = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in ROWS)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == sizes
    count = Counter(r.shard for r in got)
    assert set(count) == set(range(4)) and max(count.values()) - min(count.values()) <= 1
    assert sorted((r.shard, r.slot) for r in got) == [(j, k) for j in range(4) for k in range(count[j])]
    # leaving rows are the smallest of their old shard
    for old in {r.old_shard for r in got}:
        out = [r.size for r in got if r.old_shard == old and r.shard != old]
        stay = [r.size for r in got if r.old_shard == old and r.shard == old]
        assert not out or not stay or max(out) <= min(stay)


def test_rewrite_round_trip(spark, scratch):
    df = spark.range(300).select(F.col("id").alias("doc_id"), F.repeat(F.lit("x"), (F.col("id") % 50).cast("int")).alias("text"))
    old = F.when(F.col("doc_id") < 100, 0).when(F.col("doc_id") < 130, 1).otherwise(2)  # shard 0 holds what it shall hold
    assigned = reshard.assign_rows(df, old, 3)
    df.withColumn("shard", old).write.partitionBy("shard").parquet(f"{scratch}/old")
    changed = reshard.rewrite_shards(df, assigned, f"{scratch}/new", 3)
    assert changed == [1, 2]
    both = spark.read.parquet(f"{scratch}/new").select("doc_id", "text", "shard").unionAll(
        spark.read.parquet(f"{scratch}/old").where("shard = 0").select("doc_id", "text", "shard"))
    want = df.join(assigned.select("doc_id", "shard"), "doc_id")
    assert corpus.rows_of(both) == corpus.rows_of(want)


def test_near_vectors(spark):
    rng = np.random.default_rng(2)
    base = rng.normal(size=(60, 8))
    vectors = [*base.tolist(), *(base[:10] + 0.01 * rng.normal(size=(10, 8))).tolist(), *([base[0].tolist()] * 5),
               (3 * base[1]).tolist(), [0.0] * 8, None, [], [1.0, None] + [0.0] * 6, [float("nan")] * 8,
               [float("inf")] + [0.0] * 7, [1.0, 2.0], [2.0, 4.0]]
    rows = [(i * 2 + 1, v, 1) for i, v in enumerate(vectors)]
    rows += [rows[0], (None, base[0].tolist(), 1)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int").withColumn("v", F.lit(1)).withColumn("cls", F.lit(2))
    good = [(i, np.array(v)) for i, v, _ in rows if i is not None and v and None not in v
            and np.isfinite(np.array(v, float)).all() and np.any(v)]
    n, root = [], list(range(len(good)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, (_, a) in enumerate(good):
        links = [j for j, (_, b) in enumerate(good) if j != i and len(a) == len(b)
                 and a @ b / np.linalg.norm(a) / np.linalg.norm(b) >= 0.95]
        n.append(len(links))
        for j in links:
            root[max(find(i), find(j))] = min(find(i), find(j))
    least = defaultdict(lambda: 10**9)
    for i, (v, _) in enumerate(good):
        least[find(i)] = min(least[find(i)], v)
    want = Counter((v, n[i], least[find(i)], v == least[find(i)]) for i, (v, _) in enumerate(good))
    used = Counter(v for v, _ in good)
    for i, _, _ in rows:
        if used[i]:
            used[i] -= 1
        else:
            want[i, 0, i, True] += 1
    assert Counter(map(tuple, small_world.near_duplicates(df).collect())) == want


def test_empty_tables(empty, spark):
    for df in (content_sort_dedup.annotate_copies(empty), content_sort_dedup.drop_copies(empty), license_rules.scan_licenses(empty),
               language_bits.identify(empty), language_bits.keep_identified(empty), pii_anchors.find_personal_data(empty),
               genetic_packing.pack(genetic_packing.pieces(empty)), temperature_mixing.mix(empty),
               reshard.assign_rows(empty, F.lit(0), 3), suffix_dedup.remove_repeats(empty), ngram_join.join_documents(empty),
               ngram_join.keep_one_each(empty),
               small_world.near_duplicates(spark.createDataFrame([], "vec_id long, embedding array<float>"))):
        assert df.count() == 0
