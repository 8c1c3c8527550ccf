"""Divergence between the sources of a language, over run-length columns.

The vocabulary of a language holds the terms of at least ``LEAST_DOCS`` of its
documents.  Every source is a column of counts over that vocabulary.  The
vocabulary is reordered so that equal counts lie together: lexicographically by
counts, the source with the fewest occurrences first (few distinct counts make
long runs).  The ordered vocabulary is cut into blocks by range; within a
block each column is a list of runs (start, length, count), zeros included.  For
a pair of sources the run boundaries are intersected; within a segment both
counts are constant, so its share is f times its length.  Sums over the blocks
give the pair's value.

Smoothed shares: p = 1 + floor(10^9 (count + 2) / (N + 2V)), with N the column's
total and V the size of the vocabulary; f = floor((p - q)^2 / (p + q)).  All
arithmetic is on integers: p is taken once for each distinct count of a column,
in integers of any size, and stays below 2^31, so f fits 64 bits.

Nulls: null text, lang and source count as ''.  A source without terms, or a
language without a kept term, still has its pairs (value 0 if V = 0).  Ties rank
by the item's bytes.  Repeated rows count as often as they occur, very long
texts are read match by match, an empty table gives no rows, extra columns are
ignored.

Sizes: counts are added up within tasks before the shuffle, so a hot source or
term arrives as few rows.  A term's columns and a language's sources are held
by one task; the result itself has a row for each ordered pair of sources.
"""

from __future__ import annotations

import re
import string
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import frugal, ship, small_batches, stored, table

ship(__name__)

#: Fixed values of the definition: documents that hold a kept term, added to each count, scale of p, ranks of terms.
LEAST_DOCS, ADDED, SCALE, TOP = 10, 2, 1_000_000_000, 10
TERMS = re.compile(rb"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
#: Entries of a task's tally before they are handed on.
TALLY = 500_000
#: Texts longer than this are read match by match.
LONG_TEXT = 1 << 22
#: Counts (term, source) of a block of the vocabulary, about.
BLOCK = 1 << 20


def _tally(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms are counted as bytes: each byte of a character beyond ASCII belongs to a term, so the
    pattern finds the same terms, and lower-casing bytes changes A-Z only."""
    occurrences: defaultdict = defaultdict(Counter)
    documents: defaultdict = defaultdict(Counter)

    def out() -> Iterator[pa.RecordBatch]:
        for (lang, source), counts in occurrences.items():
            terms = list(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(terms), pa.string()), pa.array([source] * len(terms), pa.string()),
                 pa.array(terms, pa.binary()).cast(pa.string()), pa.array(list(counts.values()), pa.int64()),
                 pa.array(list(map(documents[lang, source].__getitem__, terms)), pa.int64())],
                names=["lang", "source", "term", "n", "docs"])

    for batch in batches:
        for lang, source, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
            text = body.as_py().lower()
            if len(text) < LONG_TEXT:
                found = TERMS.findall(text)
                occurrences[lang, source].update(found)
                documents[lang, source].update(set(found))
            else:
                found = Counter(m[0] for m in TERMS.finditer(text))
                occurrences[lang, source].update(found)
                documents[lang, source].update(found.keys())
        if sum(map(len, occurrences.values())) > TALLY:
            yield from out()
            occurrences.clear()
            documents.clear()
    yield from out()


def count_terms(df: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs): occurrences and documents of each term in each source."""
    small_batches(df.sparkSession)
    return (df.select("lang", "source", F.col("text").cast("binary")).mapInArrow(frugal(_tally), "lang string, source string, term string, n long, docs long")
            .groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs")))


RUNS = "lang string, block int, src int, start long, len long, n long"


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ordered rows (block, lang, counts) -> the runs of non-zero counts; src -1 tells a block's length."""
    opened: dict[int, list[int]] = {}  # src -> [start, count, place after its last term]
    rows: list[tuple] = []
    lang = block = None
    at = 0

    def closed(src: int) -> tuple:
        start, n, end = opened.pop(src)
        return lang, block, src, start, end - start, n

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        types = (pa.string(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows) if rows else [()] * 6, types)],
                                          names=[f.split()[0] for f in RUNS.split(", ")])

    for batch in batches:
        for b, name, counts in zip(*(c.to_pylist() for c in batch.columns)):
            if (name, b) != (lang, block):
                rows += [closed(src) for src in list(opened)]
                if at:
                    rows.append((lang, block, -1, 0, at, 0))
                lang, block, at = name, b, 0
            for entry in counts:
                src, n = entry["src"], entry["n"]
                run = opened.get(src)
                if run is not None and run[1] == n and run[2] == at:
                    run[2] = at + 1
                else:
                    if run is not None:
                        rows.append(closed(src))
                    opened[src] = [at, n, at + 1]
            at += 1
        if len(rows) > 50_000:
            yield batch_of(rows)
            rows = []
    rows += [closed(src) for src in list(opened)]
    if at:
        rows.append((lang, block, -1, 0, at, 0))
    yield batch_of(rows)


def share(count: int, total: int, kept: int) -> int:
    return 1 + SCALE * (count + ADDED) // (total + ADDED * kept)


def column(starts: list[int], lengths: list[int], counts: list[int], size: int, total: int, kept: int
           ) -> tuple[np.ndarray, np.ndarray]:
    """(ends, p): a source's runs over a block of ``size`` terms, with the zero runs between them."""
    ends: list[int] = []
    values: list[int] = []
    at = 0
    for start, length, n in sorted(zip(starts, lengths, counts)):
        if start > at:
            ends.append(start)
            values.append(0)
        at = start + length
        ends.append(at)
        values.append(n)
    if at < size:
        ends.append(size)
        values.append(0)
    of = {n: share(n, total, kept) for n in set(values)}
    return np.array(ends, np.int64), np.array([of[n] for n in values], np.int64)


def divergence(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> int:
    """Sum of f over a block: the boundaries of both columns cut it into segments of constant counts."""
    ends = np.union1d(a[0], b[0])
    p, q = a[1][np.searchsorted(a[0], ends)], b[1][np.searchsorted(b[0], ends)]
    lengths = np.diff(ends, prepend=0)
    return int((((p - q) * (p - q)) // (p + q) * lengths).sum())


PARTIAL = "lang string, a int, b int, value long"


def _pairs(rows: pa.Table) -> pa.Table:
    """Runs and sources of one block of one language -> the block's share of each pair a < b."""
    lang = rows["lang"][0].as_py()
    src, start, length, n = (rows[c].to_numpy() for c in ("src", "start", "len", "n"))
    size = int(length[src < 0].sum())
    order = np.lexsort((start, src))
    listed = order[start[order] < 0]                  # one row for each source: total in n, V in len
    runs = order[(start[order] >= 0) & (src[order] >= 0)]
    cuts = np.searchsorted(src[runs], src[listed], "left"), np.searchsorted(src[runs], src[listed], "right")
    columns = []
    for i, x, y in zip(listed, *cuts):
        r = runs[x:y]
        columns.append(column(start[r].tolist(), length[r].tolist(), n[r].tolist(), size, int(n[i]), int(length[i]))
                       if size else None)
    names = src[listed].tolist()
    a, b = np.triu_indices(len(names), 1)
    values = [divergence(columns[i], columns[j]) if size else 0 for i, j in zip(a.tolist(), b.tolist())]
    names = np.array(names, np.int32)
    return pa.table({"lang": pa.array([lang] * len(values), pa.string()), "a": pa.array(names[a], pa.int32()),
                     "b": pa.array(names[b], pa.int32()), "value": pa.array(values, pa.int64())})


def _share(count: str, total: str, kept: str) -> Column:
    """``share`` on columns; the quotient of decimals by ``div`` is an exact integer."""
    return F.expr(f"1 + cast({SCALE} as decimal(10,0)) * cast({count} + {ADDED} as decimal(20,0)) "
                  f"div cast({total} + {ADDED} * {kept} as decimal(20,0))")


def audit(df: DataFrame, text: str = "text", lang: str = "lang", source: str = "source") -> DataFrame:
    """(lang, source, part, item, value, rank); see the module's text."""
    spark = df.sparkSession
    blank = [F.coalesce(df[f"`{c}`"].cast("string"), F.lit("")).alias(name)
             for c, name in ((lang, "lang"), (source, "source"), (text, "text"))]
    docs = df.select(*blank)
    counts = stored(count_terms(docs), "term-counts")
    mass = counts.groupBy("lang", "source").agg(F.sum("n").alias("mass"))
    groups = docs.select("lang", "source").distinct().join(mass, ["lang", "source"], "left")
    scarce_first = Window.partitionBy("lang").orderBy(F.coalesce("mass", F.lit(0)), "source")
    groups = stored(groups.select("lang", "source", (F.row_number().over(scarce_first) - 1).alias("src")), "groups")

    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs")).where(F.col("docs") >= LEAST_DOCS).drop("docs")
    counted = counts.select("lang", "source", "term", "n").join(kept, ["lang", "term"]).join(groups, ["lang", "source"])
    terms = stored(counted.groupBy("lang", "term").agg(
        F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("src", "n"))).alias("counts")), "kept-terms")
    entries = terms.select("lang", "term", "total", F.explode("counts").alias("c")).select(
        "lang", "term", "total", "c.src", "c.n")
    langs = terms.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("total").alias("lang_total"))
    totals = entries.groupBy("lang", "src").agg(F.sum("n").alias("total"))
    zero = F.lit(0).cast("long")
    info = stored(groups.join(totals, ["lang", "src"], "left").join(langs, "lang", "left").select(
        "lang", "source", "src", F.coalesce("total", zero).alias("src_total"), F.coalesce("kept", zero).alias("kept"),
        F.coalesce("lang_total", zero).alias("lang_total")), "group-totals")

    parts = 1 + (terms.agg(F.sum(F.size("counts"))).first()[0] or 0) // BLOCK
    ordered = (terms.repartitionByRange(parts, "lang", "counts", "term").sortWithinPartitions("lang", "counts", "term")
               .select(F.spark_partition_id().alias("block"), "lang", "counts"))
    runs = stored(ordered.mapInArrow(frugal(_runs), RUNS), "runs")
    blocks = runs.where("src = -1").select("lang", "block")
    # a language without kept terms has one block of no terms
    blocks = blocks.unionAll(info.where("kept = 0").select("lang", F.lit(0).alias("block")).distinct())
    listed = blocks.join(info, "lang").select("lang", "block", "src", F.lit(-1).cast("long").alias("start"),
                                              F.col("kept").alias("len"), F.col("src_total").alias("n"))
    sums = runs.unionAll(listed).groupBy("lang", "block").applyInArrow(_pairs, PARTIAL)
    sums = stored(sums.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pair-sums")
    both = sums.unionAll(sums.select("lang", "b", "a", "value"))
    pairs = (both.join(info.select("lang", F.col("src").alias("a"), "source"), ["lang", "a"])
             .join(info.select("lang", F.col("src").alias("b"), F.col("source").alias("item")), ["lang", "b"])
             .select("lang", "source", F.lit("pair").alias("part"), "item", "value"))

    judged = (entries.join(info, ["lang", "src"])
              .withColumn("p", _share("n", "src_total", "kept"))
              .withColumn("q", _share("total", "lang_total", "kept"))
              .where("p > q")
              .select("lang", "source", F.lit("term").alias("part"), F.col("term").alias("item"),
                      F.expr("(p - q) * (p - q) div (p + q)").alias("value")))
    highest = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    top = judged.withColumn("rank", F.row_number().over(highest)).where(F.col("rank") <= TOP)
    return pairs.withColumn("rank", F.row_number().over(highest)).unionByName(top)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit(table(spark, sf_dir, "documents"))


_UP, _LOW = string.ascii_uppercase, string.ascii_lowercase
SQL = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         translate(coalesce(text, ''), '{_UP}', '{_LOW}') AS text FROM documents),
found AS (
  SELECT id, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM found GROUP BY lang, term HAVING count(DISTINCT id) >= {LEAST_DOCS}),
sizes AS (SELECT lang, count(*) AS v, sum(total) AS n FROM kept GROUP BY lang),
groups AS (SELECT DISTINCT lang, source FROM docs),
counts AS (SELECT lang, source, term, count(*) AS n FROM found SEMI JOIN kept USING (lang, term) GROUP BY ALL),
totals AS (SELECT lang, source, sum(n) AS n FROM counts GROUP BY ALL),
shares AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + {SCALE}::HUGEINT * (coalesce(c.n, 0) + {ADDED}) // (coalesce(t.n, 0) + {ADDED} * s.v) AS p,
         1 + {SCALE}::HUGEINT * (k.total + {ADDED}) // (s.n + {ADDED} * s.v) AS q
  FROM groups g JOIN kept k USING (lang) JOIN sizes s USING (lang)
  LEFT JOIN counts c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
  LEFT JOIN totals t ON t.lang = g.lang AND t.source = g.source),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM shares a JOIN shares b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
listed AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0)::BIGINT AS value
  FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM shares WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM listed)
SELECT * FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
