"""Approximate nearest neighbours: a robust-pruned directed graph in each shard.

Rows are dealt to shards of about `SHARD` vectors by a hash of the row, so copies and
clusters spread over all shards. A shard's distinct vectors become a graph:

* it starts with random edges;
* greedy (beam) searches for each vector, from the entry points over the graph so far,
  propose neighbours;
* robust pruning keeps the nearest candidate, drops all that are nearer to it than to the
  vector by the factor `ALPHA`, and goes on with the next: few edges, in different directions;
* edges are added in reverse, and vectors with too many are pruned again.

Every query is searched in every shard; the distances of all nodes of its beam, in double precision on the
original vectors, decide the order. Queries stream past a shard in blocks. The graph holds
every row: copies share a node, which keeps the ids that can be among the nearest.

Searches work in double precision on rows less their median. Rows with components beyond `HUGE`, whose squares
have no number, are scanned beside the graph. Where a search has too few digits to go by, the query meets all
rows of the shard: if it is so far from them that they can hardly be told apart (`FAR` times their median
distance from their centre), or if its k-th neighbour comes out nearer than `NOISE` times its own length.

Defined cases
  * vectors that are null, empty or all zero, hold null or non-finite components, or have another
    length than most take no part, neither as queries nor as candidates;
  * repeated rows are candidates of their own; ties go to the smaller id, nulls last;
  * fewer candidates than asked for: all of them; no rows or no queries: no rows;
  * a distance beyond the largest number is infinite.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.llm.vectors import common_length, matrix, usable
from millrace.session import materialise

SHARD = 4096
DEGREE = 32
ALPHA = 1.2
BUILD_BEAM = 64
SEARCH_BEAM = 160
HUGE = 1e100
FAR = 1e6
NOISE = 1e-6
_WIDTH = 4
_BATCH = 256
_ENTRIES = 8


def distances(vectors: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Euclidean distances in double precision; scaled where squares would leave the range of numbers."""
    with np.errstate(over="ignore"):
        gaps = vectors - query
        found = np.sqrt((gaps * gaps).sum(axis=1))
        odd = ~((found > 1e-140) & (found < 1e140))
        if odd.any():
            most = np.abs(gaps[odd]).max(axis=1)
            scale = np.where((most > 0) & np.isfinite(most), most, 1.0)
            found[odd] = scale * np.sqrt(((gaps[odd] / scale[:, None]) ** 2).sum(axis=1))
    return found


class ShardGraph:
    """The graph over the rows of `vectors`, none of them with components beyond `HUGE`."""

    def __init__(self, vectors: np.ndarray, degree: int = DEGREE, alpha: float = ALPHA, beam: int = BUILD_BEAM, seed: int = 7):
        self.middle = np.median(vectors, axis=0)
        self.x = vectors - self.middle
        self.squares = np.einsum("ij,ij->i", self.x, self.x)
        n = len(self.x)
        self.degree, self.alpha = min(degree, max(1, n - 1)), alpha
        draw = np.random.default_rng(seed)
        self.entries = draw.choice(n, min(_ENTRIES, n), replace=False)
        self.edges = draw.integers(0, n, (n, self.degree)).astype(np.int32)
        for beam_now in (beam // 2, beam):
            for nodes in np.array_split(draw.permutation(n), max(1, -(-n // _BATCH))):
                found, _ = self._search(self.x[nodes], min(beam_now, n))
                self._link(nodes, found)

    def _search(self, queries: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids (-1: none) and squared distances less the query's square, of the beam of each query."""
        b = len(queries)
        rows = np.arange(b)[:, None]
        seen = np.zeros((b, len(self.x)), bool)
        ids = np.full((b, beam), -1, np.int64)
        near = np.full((b, beam), np.inf)
        open_ = np.zeros((b, beam), bool)
        fresh = np.broadcast_to(np.sort(self.entries), (b, len(self.entries)))
        while True:
            new = ~seen[rows, fresh]
            new[:, 1:] &= fresh[:, 1:] != fresh[:, :-1]
            seen[rows, fresh] = True
            distance = self.squares[fresh] - 2 * np.matmul(self.x[fresh], queries[:, :, None])[:, :, 0]
            all_ids = np.concatenate([ids, np.where(new, fresh, -1)], axis=1)
            all_near = np.concatenate([near, np.where(new, distance, np.inf)], axis=1)
            all_open = np.concatenate([open_, new], axis=1)
            best = np.argpartition(all_near, beam - 1, axis=1)[:, :beam]
            ids, near, open_ = (np.take_along_axis(a, best, 1) for a in (all_ids, all_near, all_open))
            waiting = np.where(open_, near, np.inf)
            width = min(_WIDTH, beam)
            chosen = np.argpartition(waiting, width - 1, axis=1)[:, :width]
            going = np.isfinite(np.take_along_axis(waiting, chosen, 1))
            if not going.any():
                return ids, near
            open_[rows, chosen] = False
            nodes = np.where(going, ids[rows, chosen], self.entries[0])
            fresh = np.sort(self.edges[nodes].reshape(b, -1), axis=1)

    def _prune(self, nodes: np.ndarray, candidates: np.ndarray) -> np.ndarray:
        """The edges that robust pruning leaves of each node's candidates (-1: none)."""
        candidates = np.sort(np.where(candidates == nodes[:, None], -1, candidates), axis=1)
        candidates[:, 1:][candidates[:, 1:] == candidates[:, :-1]] = -1
        # as seen from the node, so that what is near has small numbers
        x = self.x[candidates] - self.x[nodes][:, None, :]
        far = np.where(candidates >= 0, np.einsum("ijk,ijk->ij", x, x), np.inf)
        order = np.argsort(far, axis=1)[:, :4 * self.degree]
        candidates, far = np.take_along_axis(candidates, order, 1), np.take_along_axis(far, order, 1)
        x = np.take_along_axis(x, order[:, :, None], 1)
        squares = np.einsum("ijk,ijk->ij", x, x)
        between = squares[:, :, None] + squares[:, None, :] - 2 * np.matmul(x, x.transpose(0, 2, 1))
        rows, alive = np.arange(len(nodes)), np.isfinite(far)
        edges = np.full((len(nodes), self.degree), -1, np.int64)
        for k in range(self.degree):
            first = np.where(alive, far, np.inf).argmin(axis=1)
            some = alive[rows, first]
            if not some.any():
                break
            edges[some, k] = candidates[rows, first][some]
            alive[rows, first] = False
            alive &= ~((self.alpha ** 2 * between[rows, first] <= far) & some[:, None])
        return edges

    def _link(self, nodes: np.ndarray, found: np.ndarray):
        edges = self._prune(nodes, np.concatenate([found, self.edges[nodes]], axis=1))
        # an empty place points at the node itself
        self.edges[nodes] = np.where(edges >= 0, edges, nodes[:, None])
        source, place = np.nonzero(edges >= 0)
        target, source = edges[source, place], nodes[source]
        order = np.argsort(target, kind="stable")
        target, source = target[order], source[order]
        starts = np.flatnonzero(np.concatenate([[True], target[1:] != target[:-1]])) if len(target) else []
        counts = np.diff(starts, append=len(target)) if len(target) else np.array([], int)
        touched = target[starts] if len(target) else target
        for a in range(0, len(touched), 1024):
            own, number = touched[a:a + 1024], counts[a:a + 1024]
            offered = np.full((len(own), int(number.max())), -1, np.int64)
            at = np.arange(offered.shape[1])
            inside = at < number[:, None]
            offered[inside] = source[(starts[a:a + 1024][:, None] + at)[inside]]
            kept = self._prune(own, np.concatenate([self.edges[own].astype(np.int64), offered], axis=1))
            self.edges[own] = np.where(kept >= 0, kept, own[:, None])

    def nearest(self, queries: np.ndarray, beam: int) -> np.ndarray:
        """Nodes near each query, in no order; -1: none."""
        return self._search(queries - self.middle, min(beam, len(self.x)))[0]


class _Shard:
    """A shard's rows, copies under one node, and its graph."""

    def __init__(self, k: int, beam: int):
        self.k, self.beam, self.parts = k, beam, []

    def add(self, rows: np.ndarray, ids: list, vectors: np.ndarray):
        self.parts.append((rows, ids, vectors))

    def close(self):
        rows = np.concatenate([p[0] for p in self.parts])
        ids = [i for p in self.parts for i in p[1]]
        vectors = np.concatenate([p[2] for p in self.parts]).astype(np.float64)
        self.vectors, node = np.unique(vectors, axis=0, return_inverse=True)
        # the ids of a node, smallest first; one more than asked for, as a query leaves out its own row
        self.members: list[list[tuple]] = [[] for _ in self.vectors]
        for at in sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i], rows[i])):
            members = self.members[node.ravel()[at]]
            if len(members) <= self.k:
                members.append((int(rows[at]), ids[at]))
        huge = np.abs(self.vectors).max(axis=1) > HUGE
        self.scanned, self.drawn = np.flatnonzero(huge), np.flatnonzero(~huge)
        self.graph = None
        if len(self.drawn):
            self.graph = ShardGraph(self.vectors[self.drawn])
            self.reach = FAR * max(float(np.median(np.sqrt(self.graph.squares))), np.finfo(float).tiny)

    def answer(self, rows: np.ndarray, queries: np.ndarray) -> Iterator[tuple]:
        """(query row, id, score) of the best of this shard for each query."""
        queries = queries.astype(np.float64)
        everything = np.arange(len(self.vectors))
        near, length = np.zeros(len(queries), bool), np.zeros(len(queries))
        if self.graph is not None:
            length = distances(queries, self.graph.middle)
            near = (np.abs(queries).max(axis=1) <= HUGE) & (length <= self.reach)
        found = iter(self.graph.nearest(queries[near], max(self.beam, 2 * self.k)) if near.any() else ())
        for row, query, by_graph, size in zip(rows.tolist(), queries, near.tolist(), length.tolist(), strict=True):
            if by_graph:
                nodes = next(found)
                nodes = np.concatenate([self.drawn[nodes[nodes >= 0]], self.scanned])
            else:
                nodes = everything
            scores = distances(self.vectors[nodes], query)
            if by_graph and np.partition(scores, min(self.k, len(scores) - 1))[min(self.k, len(scores) - 1)] < NOISE * size:
                nodes, scores = everything, distances(self.vectors, query)
            if len(nodes) > 4 * (self.k + 1):
                # all that can be among the nearest k and the query's own row, ties included
                some = scores <= np.partition(scores, self.k)[self.k]
                nodes, scores = nodes[some], scores[some]
            hits = [(s, i is None, i) for s, n in zip(scores.tolist(), nodes, strict=True)
                    for r, i in self.members[n] if r != row]
            for score, _, i in sorted(hits)[:self.k]:
                yield row, i, score


def search_neighbours(
    vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    shard: int = SHARD, beam: int = SEARCH_BEAM,
) -> DataFrame:
    """query_id, rank (from 1), the neighbour's id and score (Euclidean distance).

    Queries are the rows of `vectors` for which `is_query` holds; candidates are all rows but
    the query's own.
    """
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"),
                          F.coalesce(is_query, F.lit(False)).alias("asks")).where(usable(F.col("vector")))
    length = common_length(rows, "vector")
    table = materialise(rows.where(F.size("vector") == length).withColumn("row", F.monotonically_increasing_id()), "vectors")
    shards = max(1, -(-table.count() // shard))
    members = table.select(F.pmod(F.xxhash64("row"), F.lit(shards)).alias("shard"), F.lit(0).alias("kind"), "row", "id", "vector")
    asked = table.where("asks").select(
        F.explode(F.sequence(F.lit(0), F.lit(shards - 1)).cast("array<bigint>")).alias("shard"), F.lit(1).alias("kind"),
        "row", "id", "vector")
    kind = table.schema["id"].dataType

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["row", "id", "score"]
        current, own = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("shard", "kind")], axis=1)
            cuts = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for a, b in zip([0, *cuts], [*cuts, len(keys)], strict=True):
                if a == b:
                    continue
                part = batch.slice(a, b - a)
                if keys[a, 0] != current:
                    current, own, ready = keys[a, 0], _Shard(k, beam), False
                numbers, x = part.column("row").to_numpy(), matrix(part.column("vector"))
                if keys[a, 1] == 0:
                    own.add(numbers, part.column("id").to_pylist(), x)
                    continue
                if not own.parts:
                    continue  # a shard without members
                if not ready:
                    own.close()
                    ready = True
                for at in range(0, len(numbers), _BATCH):
                    found = list(own.answer(numbers[at:at + _BATCH], x[at:at + _BATCH]))
                    columns = list(zip(*found, strict=True)) if found else [(), (), ()]
                    yield pa.RecordBatch.from_arrays([
                        pa.array(columns[0], pa.int64()), pa.array(columns[1], part.schema.field("id").type),
                        pa.array(columns[2], pa.float64())], names=names)

    dealt = members.unionByName(asked).repartition("shard").sortWithinPartitions("shard", "kind", "row")
    found = dealt.mapInArrow(run, f"row long, id {kind.simpleString()}, score double")
    best = Window.partitionBy("row").orderBy("score", F.col("id").asc_nulls_last())
    ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    queries = table.where("asks").select("row", F.col("id").alias("query_id"))
    return ranked.join(queries, "row").select("query_id", "rank", F.col("id").alias(id_col), "score")
