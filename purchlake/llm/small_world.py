"""Embedding near-dedup with hierarchical navigable small-world graphs.

Vectors are dealt to shards; each shard builds a small-world graph in layers.
Every vector then queries every shard: it descends the layers to a close
entry point and follows a beam through the lowest one.  What the beam finds is
flooded along the graph, so a cluster may be larger than the beam.  Each shard
audits itself, on true links of a sample and on probes made at the linking
cosine, and doubles its beam until the recall by row reaches ``AUDIT_RECALL``.
Candidates are verified by cosine in double precision, and components are united.

Equal vectors form one class, so copies cost one node.  A task counts a
vector's links and reduces them to a forest, so a cluster of thousands sends
a row per vector, not a row per pair.  A shard holds ``SHARD_ROWS`` vectors
on average at most, which bounds a task's memory; their number grows with the
input, and with it the work, as every vector asks every shard.

Nulls: a vector that is null, empty, zero, or holds null or non-finite components
links with nothing, as does a row with a null id.  Vectors of different
lengths never link.  Repeated rows are vectors like any other.  Empty
tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ship, stored, table
from .components import components, find, join

ship(__name__)

COSINE = 0.95
SHARD_ROWS, LEAST_SHARDS = 250_000, 8
#: Neighbours of a node in upper layers and in the lowest one; candidates weighed when building.
DEGREE, LOWEST_DEGREE, BUILD_BEAM = 12, 24, 48
BEAM, AUDIT_ROWS, AUDIT_RECALL = 16, 512, 0.99
#: Beam entries expanded in one step; queries searched side by side.
EXPANDED, SIDE_BY_SIDE = 4, 512
#: Nodes compared with all queries in one product.
FLOODED = 4096
#: Single precision may be off by this much when candidates are taken.
SLACK = 1e-4
#: Vectors of a query row.
BLOCK = 16


class Layer:
    """A graph over rows of ``vectors``; ``near[i]`` are the neighbours of nodes[i], -1 where there are fewer."""

    def __init__(self, vectors: np.ndarray, nodes: np.ndarray, degree: int, near: np.ndarray | None = None):
        self.vectors, self.nodes, self.degree = vectors, nodes, degree
        self.near = np.full((len(nodes), degree), -1, np.int32) if near is None else near
        self.row = np.full(len(vectors), -1, np.int32)
        self.row[nodes] = np.arange(len(nodes), dtype=np.int32)

    def search(self, queries: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Per query: the ids and similarities of its beam, best first, -1 where it is not full."""
        n = len(queries)
        ids, sims = np.full((n, beam), -1, np.int32), np.full((n, beam), -np.inf, np.float32)
        side = max(16, min(SIDE_BY_SIDE, (1 << 26) // max(len(self.nodes), 1)))
        for a in range(0, n, side):
            ids[a:a + side], sims[a:a + side] = self._search(queries[a:a + side], entry[a:a + side], beam)
        return ids, sims

    def _search(self, q: np.ndarray, entry: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        n = len(q)
        seen = np.zeros((n, len(self.nodes) + 1), np.bool_)  # the last column stands for "no node"
        seen[:, -1] = True
        ids = np.full((n, beam), -1, np.int32)
        sims = np.full((n, beam), -np.inf, np.float32)
        done = np.ones((n, beam), np.bool_)
        alive = np.arange(n)
        fresh = entry
        while len(alive):
            fresh = np.sort(fresh, axis=1)
            fresh[:, 1:][fresh[:, 1:] == fresh[:, :-1]] = -1
            rows = np.where(fresh >= 0, self.row[fresh], -1)
            new = ~seen[alive[:, None], rows]
            seen[alive[:, None], rows] = True
            s = np.einsum("ijk,ik->ij", self.vectors[fresh], q[alive])
            s[~new] = -np.inf
            all_ids = np.concatenate((ids[alive], np.where(new, fresh, -1)), axis=1)
            all_sims = np.concatenate((sims[alive], s), axis=1)
            all_done = np.concatenate((done[alive], ~new), axis=1)
            best = np.argsort(-all_sims, axis=1, kind="stable")[:, :beam]
            ids[alive] = np.take_along_axis(all_ids, best, 1)
            sims[alive] = np.take_along_axis(all_sims, best, 1)
            done[alive] = np.take_along_axis(all_done, best, 1)
            alive = alive[~done[alive].all(axis=1)]
            if len(alive):
                # the best entries not followed yet
                order = np.argsort(done[alive], axis=1, kind="stable")[:, :EXPANDED]
                follow = np.where(np.take_along_axis(done[alive], order, 1), -1, np.take_along_axis(ids[alive], order, 1))
                done[alive[:, None], order] = True
                near = self.near[self.row[follow]]
                near[follow < 0] = -1
                fresh = near.reshape(len(alive), -1)
        return ids, sims

    def diverse(self, ids: np.ndarray, sims: np.ndarray) -> np.ndarray:
        """Per row: neighbours that are closer to the node than to each other; then the nearest others."""
        n, width = ids.shape
        order = np.argsort(-sims, axis=1, kind="stable")
        ids, sims = np.take_along_axis(ids, order, 1), np.take_along_axis(sims, order, 1)
        out = np.full((n, self.degree), -1, np.int32)
        for a in range(0, n, 256):
            i, s = ids[a:a + 256], sims[a:a + 256]
            v = self.vectors[i]
            between = np.einsum("ijk,ilk->ijl", v, v)
            valid = (i >= 0) & np.isfinite(s)
            chosen = np.zeros(i.shape, np.bool_)
            for c in range(width):
                blocked = (chosen & (between[:, c] > s[:, c:c + 1])).any(axis=1)
                chosen[:, c] = valid[:, c] & ~blocked & (chosen.sum(axis=1) < self.degree)
            rank = np.argsort(np.where(chosen, 0, np.where(valid, 1, 2)), axis=1, kind="stable")[:, :self.degree]
            got = np.where(np.take_along_axis(valid, rank, 1), np.take_along_axis(i, rank, 1), -1)
            out[a:a + 256, :got.shape[1]] = got
        return out

    def insert(self, batch: np.ndarray, present: np.ndarray, entry: np.ndarray | None) -> None:
        """Link new nodes to those present and among each other, both ways."""
        q = self.vectors[batch]
        among = q @ q.T
        np.fill_diagonal(among, -np.inf)
        k = min(BUILD_BEAM // 2, len(batch))
        top = np.argpartition(-among, k - 1, axis=1)[:, :k]
        ids, sims = batch[top].astype(np.int32), np.take_along_axis(among, top, 1)
        if len(present):
            far, far_sims = self.search(q, entry, BUILD_BEAM)
            ids, sims = np.concatenate((ids, far), axis=1), np.concatenate((sims, far_sims), axis=1)
        self.near[self.row[batch]] = self.diverse(ids, sims)
        # the other way round: a node takes its closest newcomers into account
        here = self.near[self.row[batch]]
        of, to = np.nonzero(here >= 0)
        source, target = batch[of], here[of, to]
        s = np.einsum("ij,ij->i", self.vectors[source], self.vectors[target])
        order = np.lexsort((-s, target))
        source, target = source[order], target[order]
        who, first, many = np.unique(target, return_index=True, return_counts=True)
        width = min(int(many.max(initial=0)), 2 * self.degree)
        if not width:
            return
        place = np.arange(len(target)) - np.repeat(first, many)
        offers = np.full((len(who), width), -1, np.int32)
        ok = place < width
        offers[np.repeat(np.arange(len(who)), many)[ok], place[ok]] = source[ok]
        known = self.near[self.row[who]]
        offers[(offers[:, :, None] == known[:, None, :]).any(axis=2)] = -1
        every = np.concatenate((known, offers), axis=1)
        sims = np.einsum("ijk,ik->ij", self.vectors[every], self.vectors[who])
        sims[every < 0] = -np.inf
        self.near[self.row[who]] = self.diverse(every, sims)


class SmallWorld:
    """Layers over unit vectors, highest first; each holds the nodes of the one above."""

    def __init__(self, vectors: np.ndarray, layers: list[Layer]):
        self.vectors, self.layers = vectors, layers

    @classmethod
    def build(cls, vectors: np.ndarray, seed: int) -> SmallWorld:
        n = len(vectors)
        rng = np.random.default_rng(seed)
        height = np.floor(-np.log(1 - rng.random(n)) / np.log(DEGREE)).astype(int)
        height[rng.integers(n)] = height.max()
        order = rng.permutation(n)
        self = cls(vectors, [])
        for level in range(height.max(), -1, -1):
            nodes = order[np.argsort(-height[order], kind="stable")]  # those of the layer above come first
            nodes = nodes[:int((height >= level).sum())].astype(np.int32)
            layer = Layer(vectors, nodes, DEGREE if level else LOWEST_DEGREE)
            done = 0
            while done < len(nodes):
                batch = nodes[done:done + max(64, min(done, SIDE_BY_SIDE))]
                entry = None
                if done:
                    entry = self.entries(vectors[batch]) if self.layers else np.repeat(nodes[:1][None], len(batch), 0)
                layer.insert(batch, nodes[:done], entry)
                done += len(batch)
            self.layers.append(layer)
        return self

    def entries(self, queries: np.ndarray) -> np.ndarray:
        """The closest nodes of the lowest finished layer, by descending from the highest."""
        entry = np.repeat(self.layers[0].nodes[:1][None], len(queries), 0)
        for layer in self.layers:
            entry, _ = layer.search(queries, entry, EXPANDED)
        return entry

    def near(self, queries: np.ndarray, beam: int, least: float) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(query, node) arrays of all found with similarity ``least``.

        What the beams found is flooded: neighbours of a node that is close enough to any query are
        looked at as well, until no more come in.  A cluster larger than the beam is thus reached by
        its edges once for all queries, and counted by products of whole blocks."""
        entry = np.repeat(self.layers[0].nodes[:1][None], len(queries), 0)
        for layer in self.layers[:-1]:
            entry, _ = layer.search(queries, entry, EXPANDED)
        ids, sims = self.layers[-1].search(queries, entry, beam)
        hit = sims >= least
        some = np.flatnonzero(hit.any(axis=1))
        if not len(some):
            return
        lowest, asked = self.layers[-1], queries[some]
        reached = np.zeros(len(self.vectors) + 1, np.bool_)  # the last place stands for "no node"
        reached[-1] = True
        fresh = np.unique(ids[some][hit[some]])
        while len(fresh):
            reached[fresh] = True
            close = []
            for a in range(0, len(fresh), FLOODED):
                nodes = fresh[a:a + FLOODED]
                q, k = np.nonzero(asked @ self.vectors[nodes].T >= least)
                yield some[q], nodes[k]
                close.append(np.unique(nodes[k]))
            around = np.unique(lowest.near[lowest.row[np.concatenate(close)]])
            fresh = around[~reached[around]]

    def dump(self) -> list[bytes]:
        return [b for x in self.layers for b in (x.nodes.tobytes(), x.near.tobytes())]

    @classmethod
    def load(cls, vectors: np.ndarray, blobs: list[bytes]) -> SmallWorld:
        layers = []
        for i in range(0, len(blobs), 2):
            nodes = np.frombuffer(blobs[i], np.int32)
            near = np.frombuffer(blobs[i + 1], np.int32).reshape(len(nodes), -1)
            layers.append(Layer(vectors, nodes, near.shape[1], near))
        return cls(vectors, layers)


def unit(raw: np.ndarray) -> np.ndarray:
    raw = raw / np.abs(raw).max(axis=1, keepdims=True)
    return (raw / np.linalg.norm(raw, axis=1, keepdims=True)).astype(np.float64)


def audited_beam(world: SmallWorld, exact: np.ndarray, seed: int) -> tuple[int, float]:
    """The smallest doubled beam whose recall on a sample, averaged by row, reaches the one asked for.

    Two audits, the lower one counts: of the sample's true links (by brute force) the share found; and
    of probes, made from sampled vectors at just the cosine that links, the share that finds its source.
    So there is evidence also where the sample has no links."""
    n, d = exact.shape
    rng = np.random.default_rng(seed)
    sample = rng.permutation(n)[:AUDIT_ROWS]
    true = exact[sample] @ exact.T >= COSINE
    true[np.arange(len(sample)), sample] = False
    linked = true.any(axis=1)
    aside = rng.normal(size=(len(sample), d))
    aside -= (aside * exact[sample]).sum(axis=1, keepdims=True) * exact[sample]
    size = np.linalg.norm(aside, axis=1, keepdims=True)
    probes = COSINE * exact[sample] + (1 - COSINE ** 2) ** 0.5 * np.divide(aside, size, out=np.zeros_like(aside), where=size > 1e-9)
    beam = BEAM
    while True:
        found = np.zeros_like(true)
        for q, k in world.near(world.vectors[sample], beam, COSINE - SLACK):
            found[q, k] = True
        recall = 1.0
        if linked.any():
            recall = float(((found & true).sum(axis=1)[linked] / true.sum(axis=1)[linked]).mean())
        back = np.zeros(len(sample), np.bool_)
        for q, k in world.near(probes.astype(np.float32), beam, COSINE - SLACK):
            back[q[sample[q] == k]] = True
        recall = min(recall, float(back.mean()))
        if recall >= AUDIT_RECALL or beam >= n:
            return beam, recall
        beam *= 2


def _matrix(column: pa.Array) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1)


INDEX = "shard int, kind int, ids binary, weights binary, vectors binary, beam int, recall double, layers array<binary>"


def _build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per shard; rows come sorted by shard."""
    shard, held = None, []

    def index() -> Iterator[pa.RecordBatch]:
        if held:
            ids = np.concatenate([b.column(1).to_numpy() for b in held])
            weights = np.concatenate([b.column(2).to_numpy() for b in held])
            exact = unit(np.concatenate([_matrix(b.column(3)) for b in held]))
            world = SmallWorld.build(exact.astype(np.float32), shard)
            beam, recall = audited_beam(world, exact, shard)
            cols = [[shard], [0], [ids.tobytes()], [weights.tobytes()], [exact.tobytes()], [beam], [recall], [world.dump()]]
            types = [pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary(), pa.int32(), pa.float64(), pa.list_(pa.binary())]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=[f.split()[0] for f in INDEX.split(", ")])

    for batch in batches:
        shards = batch.column(0).to_numpy()
        cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            if a < b:
                if shards[a] != shard:
                    yield from index()
                    shard, held = int(shards[a]), []
                held.append(batch.slice(a, b - a))
    yield from index()


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Query rows: ids and unit vectors of up to BLOCK classes with equal length."""
    for batch in batches:
        size = batch.column(2).to_numpy()
        cols: list[list] = [[], [], []]
        for d in np.unique(size).tolist():
            rows = np.flatnonzero(size == d)
            part = batch.take(pa.array(rows))
            exact, ids = unit(_matrix(part.column(1))), part.column(0).to_numpy()
            for a in range(0, len(rows), BLOCK):
                for c, v in zip(cols, (d, ids[a:a + BLOCK].tobytes(), exact[a:a + BLOCK].tobytes())):
                    c.append(v)
        yield pa.RecordBatch.from_arrays([pa.array(cols[0], pa.int32()), *(pa.array(c, pa.binary()) for c in cols[1:])],
                                         names=["d", "ids", "vectors"])


def _query(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per shard, its index row and then the query rows: counts (a, null, n) and links (a, b, null)."""
    world = shard = None
    forest: dict[int, int] = {}
    waiting: list[tuple[bytes, bytes]] = []

    def ask() -> Iterator[pa.RecordBatch]:
        if not waiting:
            return
        asking = np.concatenate([np.frombuffer(i, np.int64) for i, _ in waiting])
        q_exact = np.concatenate([np.frombuffer(v, np.float64).reshape(-1, exact.shape[1]) for _, v in waiting])
        waiting.clear()
        n = np.zeros(len(asking), np.int64)
        for q, k in world.near(q_exact.astype(np.float32), beam, COSINE - SLACK):
            cos = np.einsum("ij,ij->i", q_exact[q], exact[k])
            ok = (cos >= COSINE) & (asking[q] != ids[k])
            q, k = q[ok], k[ok]
            np.add.at(n, q, weights[k])
            for a, b in zip(asking[q].tolist(), ids[k].tolist()):
                join(forest, a, b)
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(asking[some]), pa.nulls(len(some), pa.int64()), pa.array(n[some])],
                                         names=["a", "b", "n"])

    for batch in batches:
        col = {name: batch.column(i) for i, name in enumerate(batch.schema.names)}
        for i, (of, kind) in enumerate(zip(col["shard"].to_pylist(), col["kind"].to_pylist())):
            if kind == 0:
                yield from ask()
                shard = of
                ids = np.frombuffer(col["ids"][i].as_py(), np.int64)
                weights = np.frombuffer(col["weights"][i].as_py(), np.int64)
                exact = np.frombuffer(col["vectors"][i].as_py(), np.float64).reshape(len(ids), -1)
                world = SmallWorld.load(exact.astype(np.float32), col["layers"][i].as_py())
                beam = col["beam"][i].as_py()
            elif of == shard:  # else the shard is empty
                waiting.append((col["ids"][i].as_py(), col["vectors"][i].as_py()))
                if len(waiting) * BLOCK >= 2 * SIDE_BY_SIDE:
                    yield from ask()
    yield from ask()
    nodes = list(forest)
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array([find(forest, x) for x in nodes], pa.int64()),
                                      pa.nulls(len(nodes), pa.int64())], names=["a", "b", "n"])


def shard_count(n: int) -> int:
    return max(LEAST_SHARDS, -(-n // SHARD_ROWS))


def near_duplicates(df: DataFrame, vector: str = "embedding", id_col: str = "vec_id") -> DataFrame:
    """One row per input row: id_col, n_links, component_id, kept."""
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    usable = F.coalesce(F.col("id").isNotNull() & (F.size("v") > 0) & finite & F.exists("v", lambda x: x != 0), F.lit(False))
    rows = rows.withColumn("usable", usable)
    good = rows.where("usable").select("id", "v")
    # equal vectors make one class, named by its smallest id
    classes = stored(good.groupBy("v").agg(F.min("id").alias("cls"), F.count("*").alias("weight"))
                     .withColumn("d", F.size("v")), "classes")
    sizes = {r[0]: r[1] for r in classes.groupBy("d").count().collect()}  # a row for each vector length
    first, per = {}, {}
    for d in sorted(sizes):
        first[d], per[d] = sum(per.values()), shard_count(sizes[d])
    total = sum(per.values())

    def of_length(values: dict):
        out = F.lit(0)
        for d, x in values.items():
            out = F.when(F.col("d") == d, x).otherwise(out)
        return out

    shard = (of_length(first) + F.pmod(F.xxhash64("cls"), of_length(per))).cast("int") if sizes else F.lit(0)
    parts = max(total, 1)
    index = stored(classes.select(shard.alias("shard"), "cls", "weight", "v").repartitionById(parts, F.col("shard"))
                   .sortWithinPartitions("shard").mapInArrow(_build, INDEX), "shards")
    low, high = of_length(first), of_length({d: first[d] + per[d] - 1 for d in sizes})
    asked = (classes.select("cls", "v", "d").mapInArrow(_blocks, "d int, ids binary, vectors binary")
             .select(F.explode(F.sequence(low, high)).alias("shard"), F.lit(1).alias("kind"), "ids",
                     F.lit(None).cast("binary").alias("weights"), "vectors", F.lit(None).cast("int").alias("beam"),
                     F.lit(None).cast("double").alias("recall"), F.lit(None).cast("array<binary>").alias("layers")))
    found = stored(index.unionByName(asked).repartitionById(parts, F.col("shard")).sortWithinPartitions("shard", "kind")
                   .mapInArrow(_query, "a long, b long, n long"), "found")
    label = components(found.where("b is not null").select("a", "b"))
    links = found.where("n is not null").groupBy(F.col("a").alias("cls")).agg(F.sum("n").alias("n"))
    of_class = stored(classes.join(links, "cls", "left").join(label.withColumnRenamed("node", "cls"), "cls", "left")
                      .select("v", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                              F.coalesce("label", "cls").alias("component_id")), "linked")
    linked = good.join(of_class, "v").select("id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


SQL = """
WITH RECURSIVE rows AS (SELECT row_number() OVER () AS rid, vec_id, embedding::DOUBLE[] AS v FROM embeddings),
good AS (
  SELECT rid, vec_id, v FROM rows WHERE vec_id IS NOT NULL AND len(v) > 0
    AND len(list_filter(v, lambda x: x IS NOT NULL AND isfinite(x))) = len(v) AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT a.rid AS a, b.rid AS b FROM good a JOIN good b ON a.rid <> b.rid AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
reached AS (SELECT rid, rid AS other FROM rows UNION SELECT r.rid, l.b FROM reached r JOIN links l ON l.a = r.other),
least AS (SELECT r.rid, min(o.vec_id) AS component_id FROM reached r JOIN rows o ON o.rid = r.other GROUP BY r.rid)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = rows.rid) AS n_links, component_id,
       coalesce(vec_id = component_id, true) AS kept
FROM rows JOIN least USING (rid)
"""
