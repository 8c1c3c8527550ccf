"""Exact dedup by content sort.

Texts are equal when identical after every run of blanks (space, tab to
carriage return) is replaced by one space.  Rows are dealt to partitions by
splitters that Spark samples from (start of the text, length, hash, id), each
partition is sorted externally by the normalised bytes, and a streaming pass
compares each text in full with its neighbour.  Because the id is part of the
splitting key, a group holding a third of all rows is cut over many
partitions.  The first and last key of each partition may go on next door:
those few runs (about two a partition) are matched by their whole text in a
second, small aggregation.

Nulls: a null text counts as empty; a null id sorts last and is never the
identifier that stays unless the whole group has none.  Repeated rows are
copies of each other: exactly one is kept.  Empty tables give empty results.
Extra columns are ignored by ``annotate_copies`` and passed through by
``drop_copies``, whatever their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import frugal, ship, stored, table, text_or_empty

ship(__name__)

BLANKS = r"[\x20\x09-\x0D]+"
#: Characters of the text that the splitters look at; ties go on to length, hash and id.
PREFIX = 64

NOTES = ("id long, pid int, run long, pos long, keep_id long, group_size long, "
         "text_sha256 string, edge boolean, edge_text string")


def normalised(text: str = "text"):
    return F.regexp_replace(text_or_empty(text), BLANKS, " ")


def _content_sorted(df: DataFrame, text: str, id_col: str, extra: list) -> DataFrame:
    """Rows as (norm, head, len, hash, id, extra...), range-partitioned and sorted by content."""
    rows = df.select(normalised(text).alias("norm"), F.col(id_col).cast("long").alias("id"), *extra)
    rows = rows.select(F.substring("norm", 1, PREFIX).alias("head"), F.length("norm").alias("len"),
                       F.xxhash64("norm").alias("hash"), "*")
    last = F.col("id").asc_nulls_last()
    return (rows.repartitionByRange("head", "len", "hash", last)
            .sortWithinPartitions("head", "len", "hash", "norm", last))


def _keys(batch: pa.RecordBatch) -> Iterator[tuple[tuple, str]]:
    """Per row: the splitting key without the id, and the text."""
    cols = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("head", "len", "hash", "norm")]
    for head, length, h, norm in zip(*cols):
        yield (head, length, h), norm


def _notes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per input row with its run of equal neighbours."""
    pid = TaskContext.get().partitionId()
    schema = pa.schema([("id", pa.int64()), ("pid", pa.int32()), ("run", pa.int64()), ("pos", pa.int64()),
                        ("keep_id", pa.int64()), ("group_size", pa.int64()), ("text_sha256", pa.string()),
                        ("edge", pa.bool_()), ("edge_text", pa.string())])
    first_key = key = None
    runs: list[tuple[int, str, list]] = []  # of the current key; almost always one
    n_runs = 0

    def close(edge: bool) -> pa.RecordBatch:
        cols: list[list] = [[] for _ in schema]
        for no, text, ids in runs:
            known = [i for i in ids if i is not None]
            n, sha = len(ids), hashlib.sha256(text.encode()).hexdigest()
            for c, v in zip(cols, (ids, [pid] * n, [no] * n, range(n), [min(known, default=None)] * n, [n] * n,
                                   [sha] * n, [edge] * n, [text if edge else None] + [None] * (n - 1))):
                c.extend(v)
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema)], schema=schema)

    out: list[pa.RecordBatch] = []
    for batch in batches:
        ids = batch.column(batch.schema.get_field_index("id")).to_pylist()
        for (k, norm), i in zip(_keys(batch), ids):
            if k != key:
                if runs:
                    out.append(close(key == first_key))
                first_key, key, runs = (k if key is None else first_key), k, []
            if not runs or runs[-1][1] != norm:
                runs.append((n_runs, norm, []))
                n_runs += 1
            runs[-1][2].append(i)
        if out:
            yield from pa.Table.from_batches(out).combine_chunks().to_batches()
            out = []
    if runs:
        yield close(True)


def annotate_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """One row per input row: id_col, keep_id, group_size, kept, text_sha256."""
    notes = stored(_content_sorted(df, text, id_col, []).select("id", "norm", "head", "len", "hash")
                   .mapInArrow(frugal(_notes), NOTES), "copies")
    edges = notes.where("edge and pos = 0").select("pid", "run", "edge_text", "keep_id", "group_size")
    # equal texts met in several partitions: at most a few rows for each partition
    joined = (edges.groupBy("edge_text")
              .agg(F.min("keep_id").alias("keep_all"), F.sum("group_size").alias("size_all"),
                   F.min(F.struct("pid", "run")).alias("first"),
                   F.collect_list(F.struct("pid", "run")).alias("parts"))
              .select("keep_all", "size_all", "first", F.explode("parts").alias("part"))
              .select(F.col("part.pid").alias("pid"), F.col("part.run").alias("run"), "keep_all", "size_all",
                      (F.col("part") == F.col("first")).alias("leads")))
    inner = notes.where(~F.col("edge")).select(
        F.col("id").alias(id_col), "keep_id", "group_size", (F.col("pos") == 0).alias("kept"), "text_sha256")
    outer = notes.where("edge").join(joined, ["pid", "run"]).select(
        F.col("id").alias(id_col), F.col("keep_all").alias("keep_id"), F.col("size_all").alias("group_size"),
        (F.col("leads") & (F.col("pos") == 0)).alias("kept"), "text_sha256")
    return inner.unionByName(outer)


def _heads(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first row of each run, marked where its key may go on in another partition."""
    pid = TaskContext.get().partitionId()
    first_key = key = None
    texts: list[str] = []                # distinct texts of the current key
    held: list[pa.RecordBatch] = []      # their rows out of earlier batches

    def out(rows: pa.RecordBatch, edge: bool) -> pa.RecordBatch:
        n = rows.num_rows
        return pa.RecordBatch.from_arrays(
            [rows.column("row"), rows.column("norm"), pa.array([pid] * n, pa.int32()), pa.array([edge] * n, pa.bool_())],
            names=["row", "norm", "pid", "edge"])

    for batch in batches:
        inner: list[int] = []
        current: list[int] = []
        for at, (k, norm) in enumerate(_keys(batch)):
            if k != key:
                if key is not None and key == first_key:
                    held.append(batch.take(pa.array(current, pa.int64())))
                    yield from (out(x, True) for x in held if x.num_rows)
                else:
                    yield from (out(x, False) for x in held if x.num_rows)
                    inner += current
                first_key, key, texts, held, current = (k if key is None else first_key), k, [], [], []
            if not texts or texts[-1] != norm:
                texts.append(norm)
                current.append(at)
        if inner:
            yield out(batch.take(pa.array(inner, pa.int64())), False)
        if current:
            held.append(batch.take(pa.array(current, pa.int64())))
    yield from (out(x, True) for x in held if x.num_rows)


def drop_copies(df: DataFrame, text: str = "text", id_col: str = "doc_id") -> DataFrame:
    """The rows of ``df`` that stay, with its columns: of equal texts the one with the smallest id."""
    same = F.col(f"`{text}`").eqNullSafe(normalised(f"`{text}`"))  # then the text travels once
    row = F.struct(same.alias("same"), *[
        (F.when(~same, F.col(f"`{c}`")) if c == text else F.col(f"`{c}`")).alias(f"c{i}")
        for i, c in enumerate(df.columns)]).alias("row")
    heads = _content_sorted(df, f"`{text}`", f"`{id_col}`", [row]).select("row", "norm", "head", "len", "hash")
    schema = heads.select("row", "norm", F.lit(0).alias("pid"), F.lit(True).alias("edge")).schema
    heads = stored(heads.mapInArrow(frugal(_heads), schema), "heads")
    edge = heads.where("edge")
    # of equal texts at partition ends, the lowest partition holds the smallest id
    first = edge.groupBy("norm").agg(F.min("pid").alias("pid"))
    kept = heads.where(~F.col("edge")).select("row", "norm").unionAll(
        edge.join(first, ["norm", "pid"], "left_semi").select("row", "norm"))
    return kept.select(*[
        (F.when(F.col("row.same"), F.col("norm")).otherwise(F.col(f"row.c{i}")) if c == text
         else F.col(f"row.c{i}")).alias(c) for i, c in enumerate(df.columns)])


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return annotate_copies(table(spark, sf_dir, "documents"))


SQL = r"""
WITH n AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS t FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       doc_id = min(doc_id) OVER w AS kept, sha256(t) AS text_sha256
FROM n WINDOW w AS (PARTITION BY t)
"""
