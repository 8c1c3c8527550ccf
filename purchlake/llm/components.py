"""Connected components of a link table, without gathering links anywhere.

Tasks first reduce their own links to a forest; then every node takes the
smallest label among its neighbours and the label of its label, round after
round, until none changes.  Rounds read and write tables in the shared
folder; in the joins both sides come from such tables, so Spark can split a
node with very many links.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship, stored

ship(__name__)


def find(parent: dict[int, int], x: int) -> int:
    root = x
    while (p := parent.get(root, root)) != root:
        root = p
    while (p := parent.get(x, x)) != root:
        parent[x], x = root, p
    return root


def join(parent: dict[int, int], x: int, y: int) -> None:
    """Unite two sets; the smaller root stays."""
    x, y = find(parent, x), find(parent, y)
    if x != y:
        parent[max(x, y)] = min(x, y)


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    parent: dict[int, int] = {}
    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            join(parent, a, b)
    nodes = list(parent)
    roots = [find(parent, x) for x in nodes]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(roots, pa.int64())], names=["a", "b"])


def components(links: DataFrame) -> DataFrame:
    """(node, label): the smallest node reachable, for every node of the links (a long, b long)."""
    forest = stored(links.select(F.col("a").cast("long"), F.col("b").cast("long"))
                    .mapInArrow(_forest, "a long, b long").distinct(), "forest")
    both = stored(forest.unionAll(forest.select("b", "a")).toDF("node", "other"), "links")
    labels = stored(both.groupBy("node").agg(F.least("node", F.min("other")).alias("label")), "labels")
    while True:
        near = (both.join(labels.withColumnRenamed("node", "other"), "other")
                .groupBy("node").agg(F.min("label").alias("near")))
        lower = stored(near.join(labels, "node").select(
            "node", F.col("label").alias("was"), F.least("label", "near").alias("label")), "lower")
        jumped = stored(lower.join(lower.select(F.col("node").alias("label"), F.col("label").alias("next")), "label")
                        .select("node", "was", F.col("next").alias("label")), "labels")
        if jumped.where("was <> label").isEmpty():
            return jumped.select("node", "label")
        labels = jumped.select("node", "label")
