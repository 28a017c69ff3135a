"""Embedding near-duplicates: an exact metric range join of unit vectors.

Two vectors link if their cosine is at least the threshold, that is, if their angle is at
most `reach`. Angles are a metric on the unit sphere.

1. Equal vectors are one representative with a count.
2. Pivots, a bounded sample, partition the representatives: each has its home in the cell
   of its nearest pivot. A cell with many members is dealt into chunks of about `HOME`.
3. A vector visits another cell if the triangle inequality leaves room for a member
   within reach: its angle to that cell's pivot is within reach of the range of its
   members' angles, and its distance to the bisecting hyperplane of the two pivots is not above
   the chord of the reach.
4. Chunks join independently. The members of a chunk are held, visitors stream past in
   batches and are compared by matrix products in single precision with a safety margin;
   what may link is computed again in double precision.

Every link of a member is seen in its own chunk, so links are counted there, with the
counts of representatives, and never listed: a chunk gives the links that join its parts
batch by batch (a spanning forest). A group of any size costs links in proportion to it.

Defined cases
  * vectors that are null, empty or all zero, or hold null or non-finite components, or
    have another length than most: they link with nothing;
  * repeated rows are vectors of their own, linked with each other; null ids stay, and
    are no component's name unless it has no other; no rows: no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.components import connected_components
from millrace.llm.vectors import common_length, matrix, unit_rows, usable
from millrace.session import materialise

THRESHOLD = 0.95
# Members of a chunk, which are held in memory while others stream past.
HOME = 4096
MAX_PIVOTS = 1024
# Single precision products of unit vectors are off by far less.
_MARGIN = 1e-4


def _angles(products: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(products, -1.0, 1.0))


def unit_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Distances of unit vectors, never below the true ones: products are off by far less than what is added."""
    return np.sqrt(np.maximum(2 - 2 * a @ b.T, 0) + 1e-12)


def _homes(vectors: DataFrame, pivots: np.ndarray) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                products = unit_rows(matrix(batch.column("vector"))) @ pivots.T
                cell = products.argmax(axis=1)
                angle = _angles(products[np.arange(len(cell)), cell])
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(angle)], names=names)

    names = [*vectors.columns, "cell", "angle"]
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in vectors.schema)
    return vectors.mapInArrow(run, f"{schema}, cell long, angle double")


def _visits(homes: DataFrame, pivots: np.ndarray, cells: dict[int, tuple[int, float, float]], reach: float) -> DataFrame:
    """One row for each chunk that a vector belongs to (guest 0) or visits (guest 1)."""
    known = sorted(cells)
    chunks = np.array([cells[c][0] for c in known])
    low, high = np.array([cells[c][1] for c in known]), np.array([cells[c][2] for c in known])
    targets = np.repeat(np.arange(len(known)), chunks)
    numbers = np.concatenate([np.arange(n) for n in chunks])
    chord = 2 * np.sin(reach / 2) + 1e-9
    # pivots x known pivots, worked out once: a batch picks the rows of its homes
    between = unit_distances(pivots, pivots[known])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, 1000):
                batch = whole.slice(start, 1000)
                products = unit_rows(matrix(batch.column("vector"))) @ pivots.T
                angles = _angles(products[:, known])
                home = batch.column("cell").to_numpy()
                own = products[np.arange(len(home)), home][:, None]
                open_to = (own - products[:, known] <= chord * between[home] + 1e-9)
                open_to &= (angles >= low - reach - 1e-9) & (angles <= high + reach + 1e-9)
                rows, slots = np.nonzero(open_to[:, targets])
                cell, chunk = np.array(known)[targets[slots]], numbers[slots]
                guest = ((cell != home[rows]) | (chunk != batch.column("chunk").to_numpy()[rows])).astype(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cell), pa.array(chunk), pa.array(guest)]
                    + [batch.column(c).take(pa.array(rows)) for c in ("rep", "n", "vector")],
                    names=["cell", "chunk", "guest", "rep", "n", "vector"])

    kind = homes.schema["vector"].dataType.simpleString()
    return homes.mapInArrow(run, f"cell long, chunk long, guest long, rep long, n long, vector {kind}")


class _Chunk:
    """The members of a chunk, what they have been linked with, and links that join them."""

    def __init__(self, threshold: float):
        self.threshold = threshold
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.ready = False

    def add(self, reps: np.ndarray, counts: np.ndarray, units: np.ndarray):
        self.parts.append((reps, counts, units))

    def close(self) -> list[tuple[int, int]]:
        """No more members: link them with each other."""
        self.reps, counts, self.units = (np.concatenate(x) for x in zip(*self.parts, strict=True))
        self.single = self.units.astype(np.float32)
        self.links = np.zeros(len(self.reps), np.int64)
        self.ready = True
        return self.meet(self.reps, counts, self.units)

    def meet(self, reps: np.ndarray, counts: np.ndarray, units: np.ndarray) -> list[tuple[int, int]]:
        """Count the members' links with a batch; return links that join what is linked in it."""
        near = units.astype(np.float32) @ self.single.T >= self.threshold - _MARGIN
        label: dict[int, int] = {}

        def root(x: int) -> int:
            while label.setdefault(x, x) != x:
                label[x] = label[label[x]]
                x = label[x]
            return x

        forest = []
        for row in np.flatnonzero(near.any(axis=1)).tolist():
            members = np.flatnonzero(near[row])
            members = members[self.units[members] @ units[row] >= self.threshold]
            self.links[members] += counts[row]
            own = int(reps[row])
            for other in self.reps[members].tolist():
                a, b = root(own), root(other)
                if a != b:
                    label[max(a, b)] = min(a, b)
                    forest.append((own, other))
        return forest


def _join(visits: DataFrame, threshold: float) -> DataFrame:
    """Rows (rep, other, links): a joining link, or with other null the links of a member."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def links(found: list[tuple[int, int]]) -> pa.RecordBatch:
            pairs = np.array(found, np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays(
                [pa.array(pairs[:, 0]), pa.array(pairs[:, 1]), pa.array(np.zeros(len(pairs), np.int64))], names=names)

        def counts(chunk: _Chunk) -> pa.RecordBatch:
            n = len(chunk.reps)
            return pa.RecordBatch.from_arrays([pa.array(chunk.reps), pa.nulls(n, pa.int64()), pa.array(chunk.links)], names=names)

        names = ["rep", "other", "links"]
        current, chunk = None, None
        for batch in batches:
            keys = np.stack([batch.column(c).to_numpy() for c in ("cell", "chunk", "guest")], axis=1)
            edges = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, end in zip([0, *edges], [*edges, len(keys)], strict=True):
                if start == end:
                    continue
                part = batch.slice(start, end - start)
                key, guest = tuple(keys[start, :2]), keys[start, 2]
                if key != current:
                    if chunk is not None:
                        yield links(chunk.close() if not chunk.ready else [])
                        yield counts(chunk)
                    current, chunk = key, _Chunk(threshold)
                reps, n = (part.column(c).to_numpy() for c in ("rep", "n"))
                units = unit_rows(matrix(part.column("vector")))
                if not guest:
                    chunk.add(reps, n, units)
                    continue
                if not chunk.ready:
                    yield links(chunk.close())
                for at in range(0, len(reps), 2000):
                    yield links(chunk.meet(reps[at:at + 2000], n[at:at + 2000], units[at:at + 2000]))
        if chunk is not None:
            yield links(chunk.close() if not chunk.ready else [])
            yield counts(chunk)

    dealt = visits.repartition("cell", "chunk").sortWithinPartitions("cell", "chunk", "guest", "rep")
    return dealt.mapInArrow(run, "rep long, other long, links long")


def near_vectors(
    vectors: DataFrame, threshold: float = THRESHOLD, id_col: str = "vec_id", vector_col: str = "embedding",
    home: int = HOME, max_pivots: int = MAX_PIVOTS,
) -> DataFrame:
    """Id, n_links, component_id and kept for every row of `vectors`."""
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    valid = rows.where(usable(F.col("vector")))
    length = common_length(valid, "vector")
    takes_part = usable(F.col("vector")) & (F.size("vector") == length)
    distinct = rows.where(takes_part).groupBy("vector").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    reps = materialise(distinct.withColumn("rep", F.monotonically_increasing_id()), "vectors")
    total = reps.count()
    if total == 0:
        return rows.select(F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"),
                           F.col("id").cast("bigint").alias("component_id"), F.lit(True).alias("kept"))
    sample = reps.orderBy(F.xxhash64("rep"), "rep").limit(min(max_pivots, -(-total // home))).select("vector").collect()
    pivots = unit_rows(np.array([r.vector for r in sample]))
    homes = materialise(_homes(reps.select("rep", "n", "vector"), pivots), "homes")
    stats = homes.groupBy("cell").agg(F.count(F.lit(1)), F.min("angle"), F.max("angle")).collect()
    cells = {r[0]: (-(-r[1] // home), r[2], r[3]) for r in stats}
    chunks = F.element_at(F.create_map(*[F.lit(x) for c, (n, _, _) in cells.items() for x in (c, n)]), F.col("cell"))
    chunked = homes.withColumn("chunk", F.pmod(F.xxhash64("rep"), chunks.cast("bigint")))
    joined = materialise(_join(_visits(chunked, pivots, cells, float(np.arccos(threshold))), threshold), "joined")
    roots = connected_components(joined.where("other is not null").select(F.col("rep").alias("a"), F.col("other").alias("b")))
    links = joined.where("other is null").select("rep", "links")
    rooted = (
        reps.join(links, "rep").join(roots.withColumnRenamed("node", "rep"), "rep", "left")
        .withColumn("root", F.coalesce("root", "rep"))
    )
    first = rooted.groupBy("root").agg(F.min("first").alias("component"))
    found = rooted.join(first, "root").select("vector", "links", "component")
    component = F.coalesce(F.col("component"), F.col("id"))
    return rows.join(found, "vector", "left").select(
        F.col("id").alias(id_col), F.coalesce(F.col("links") - 1, F.lit(0)).cast("bigint").alias("n_links"),
        component.cast("bigint").alias("component_id"), F.col("id").eqNullSafe(component).alias("kept"))
