"""Mixing sources to target weights by balanced sampling (the cube method).

Every source has a target number of words. A document of the source is taken
``target / source size`` times on average: the whole part as certain copies, the rest as
an inclusion probability. The cube method turns these probabilities into 0 or 1 while
the sampled documents and words of a source keep their expected totals:

* flight: of the units still between 0 and 1, three are held at a time. Two balancing
  totals (documents, words) leave them one direction in the null space of the
  constraints; they move along it, forward or back by a draw that keeps every expected
  value, until one of them reaches 0 or 1 and leaves;
* the flight runs in cells of about `CELL_ROWS` documents of one source, independently,
  and leaves at most `LANDING` units for a cell. These fly again in fewer cells, until
  a source is one cell;
* landing: the at most two units of a source that no direction can move any more are
  rounded, and a few of the last decisions changed, so that its words come nearest to
  what was expected.

Texts are reduced to sizes before anything is shuffled. Units stream through a task in
key order with `LANDING` of them in memory, so a source of any size is only many cells.
Draws come from a seed, the source and the cell, and cells follow from the counted rows,
not from the cluster: reruns agree.

Defined cases
  * null text: size 0; a document of size 0 takes 0 words;
  * null source: a source of its own, last in the order; a source without words has target 0;
  * null or repeated ids: every row is a unit of its own; no rows: no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from millrace.session import SmallTable, lookup, materialise

WORD = r"[^\x20\x09-\x0D]+"
MAX_REPEATS = 3
# Documents of a source that one flight works on.
CELL_ROWS = 4_000
# Units of a cell that do not fly, and are left for the landing.
LANDING = 64
_NEAR = 1e-9


def cyclic_weight(rank: Column) -> Column:
    """Weights 1, 2, 3, repeating, by rank from 0."""
    return (rank % 3 + 1).cast("double")


def source_targets(sizes: DataFrame, weight=cyclic_weight, max_repeats: int = MAX_REPEATS) -> DataFrame:
    """One row per source: source, n_rows, source_size, target.

    All sizes are shared out by weight; no target is above `max_repeats` times its source's
    size. With the sources in the order of (cap / weight) those at their cap come first,
    so the common level follows from running sums instead of repeated rounds. The table has one row
    per source.
    """
    totals = sizes.groupBy("source").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("size").cast("double").alias("words"))
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    weighed = (
        totals.withColumn("weight", weight(F.row_number().over(by_name) - 1))
        .withColumn("cap", F.col("words") * max_repeats).withColumn("ratio", F.col("cap") / F.col("weight"))
    )
    by_ratio = Window.orderBy("ratio", F.col("source").asc_nulls_last())
    before = by_ratio.rowsBetween(Window.unboundedPreceding, -1)
    onward = by_ratio.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    level = (F.sum("words").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))) / F.sum(
        "weight").over(onward)
    levels = weighed.withColumn("level", level).withColumn(
        # the first source whose own cap lies above the level that remains for it and those after it
        "common", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "level"))).over(everything)["level"])
    return levels.select(
        "source", "n_rows", F.col("words").cast("bigint").alias("source_size"),
        F.least(F.col("cap"), F.col("common") * F.col("weight")).alias("target"))


class Flight:
    """Units of one source between 0 and 1. A unit is a list [probability, size, row].

    The latest units wait for the landing; those before them move three at a time.
    """

    def __init__(self, seed: str):
        self.draw = random.Random(seed)
        self.held: list[list] = []
        self.waiting: list[list] = []

    def add(self, unit: list) -> list[list]:
        """Take in one unit; return those that have come to 0 or 1."""
        if unit[0] < _NEAR or unit[0] > 1 - _NEAR:
            return [_settled(unit)]
        self.waiting.append(unit)
        return self._fly(self.waiting.pop(0)) if len(self.waiting) > LANDING else []

    def _fly(self, unit: list) -> list[list]:
        self.held.append(unit)
        return self._move() if len(self.held) == 3 else []

    def left(self) -> list[list]:
        return [*self.held, *self.waiting]

    def _move(self) -> list[list]:
        (a, b, c) = (u[1] for u in self.held)
        # sum(step) = 0 and sum(step * size) = 0; equal sizes leave more directions, any one serves
        step = (c - b, a - c, b - a) if not a == b == c else (1, -1, 0)
        ahead = min((1 - u[0]) / s if s > 0 else u[0] / -s for u, s in zip(self.held, step, strict=True) if s)
        back = min(u[0] / s if s > 0 else (1 - u[0]) / -s for u, s in zip(self.held, step, strict=True) if s)
        by = ahead if self.draw.random() * (ahead + back) < back else -back
        for unit, s in zip(self.held, step, strict=True):
            unit[0] += by * s
        done = [_settled(u) for u in self.held if u[0] < _NEAR or u[0] > 1 - _NEAR]
        self.held = [u for u in self.held if 0.0 < u[0] < 1.0]
        return done

    def land(self) -> list[list]:
        """Decide the units that are left.

        Those that waited fly too. Then each way to round the at most two that are left over
        is mended by changing single decisions and pairs of them as long as the words come
        nearer to what was expected, and the nearest outcome is taken.
        """
        pool = [u for unit in self.waiting for u in self._fly(unit)]
        sizes = np.array([float(u[1]) for u in pool])
        best = None
        for rounded in product((0.0, 1.0), repeat=len(self.held)):
            surplus = sum((r - u[0]) * u[1] for r, u in zip(rounded, self.held, strict=True))
            taken = np.array([u[0] for u in pool])
            while len(pool):
                change = np.where(taken == 0, sizes, -sizes)
                one, two = np.abs(surplus + change), np.abs(surplus + change[:, None] + change)
                np.fill_diagonal(two, np.inf)
                flips = [int(one.argmin())] if one.min() <= two.min() else list(divmod(int(two.argmin()), len(pool)))
                after = surplus + change[flips].sum()
                if abs(after) >= abs(surplus) - _NEAR:
                    break
                surplus = after
                taken[flips] = 1 - taken[flips]
            if best is None or abs(surplus) < best[0]:
                best = abs(surplus), rounded, taken
        units = [*self.held, *pool]
        for unit, value in zip(units, [*best[1], *best[2]], strict=True):
            unit[0] = float(value)
        return units


def _settled(unit: list) -> list:
    unit[0] = float(unit[0] > 0.5)
    return unit


def _fly(units: DataFrame, seed: str, landing: bool) -> DataFrame:
    """One flight for each (source, cell); rows of a flight are adjacent in their partition."""
    columns = units.columns
    at = {name: columns.index(name) for name in ("source", "cell", "size", "share")}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        flight, current, kinds = None, None, None

        def rows(done: list[list]) -> Iterator[pa.RecordBatch]:
            if done:
                values = [[*u[2][:at["share"]], u[0], *u[2][at["share"] + 1:]] for u in done]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(v, kind) for v, kind in zip(zip(*values, strict=True), kinds, strict=True)], names=columns)

        for batch in batches:
            kinds, done = batch.schema.types, []
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                key = (row[at["source"]], row[at["cell"]])
                if flight is None or key != current:
                    if flight is not None:
                        done += flight.land() if landing else flight.left()
                    flight, current = Flight(f"{seed}:{key}"), key
                done += flight.add([row[at["share"]], row[at["size"]], row])
            yield from rows(done)
        if flight is not None:
            yield from rows(flight.land() if landing else flight.left())

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in units.schema)
    return units.mapInArrow(run, schema)


def mix_sources(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
    weight=cyclic_weight, max_repeats: int = MAX_REPEATS, seed: str = "mix", cell_rows: int = CELL_ROWS,
) -> DataFrame:
    """Id, source, size, source_size, target, copies and taken (copies * size) for every row."""
    sizes = materialise(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"),
        F.coalesce(F.regexp_count(F.col(text_col).cast("string"), F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
    ), "mix-sizes")
    # null keys do not join: a flag and a filled name stand for the source
    flag, filled = F.col("source").isNull().alias("no_source"), F.coalesce("source", F.lit("")).alias("name")
    targets = SmallTable.of(
        source_targets(sizes, weight, max_repeats).select(flag, filled, "n_rows", "source_size", "target"), "mix-targets")
    mean = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    whole = F.floor(mean + F.lit(_NEAR))
    units = lookup(sizes.select("*", flag, filled), targets, ["no_source", "name"]).select(
        "id", "source", "size", "source_size", "target", "n_rows", whole.cast("int").alias("whole"),
        F.greatest(mean - whole, F.lit(0.0)).alias("share"))
    most = sizes.groupBy("source").count().agg(F.max("count")).first()[0] or 0
    copies = F.col("whole") + F.col("share").cast("int")
    result, rows_left = None, 1.0
    while True:
        # a source has cells in proportion to the units it may still have
        in_cells = F.greatest(F.ceil(F.col("n_rows") * rows_left / cell_rows), F.lit(1)).cast("bigint")
        last = most * rows_left <= cell_rows
        dealt = units.withColumn("cell", F.pmod(F.xxhash64("id", "size"), in_cells))
        flown = materialise(_fly(
            dealt.repartition("source", "cell").sortWithinPartitions("source", "cell", "id", "size"),
            f"{seed}:{rows_left}", last), "mix-flown")
        decided = flown.where((F.col("share") <= 0) | (F.col("share") >= 1))
        result = decided if result is None else result.unionByName(decided)
        if last:
            break
        units = flown.where((F.col("share") > 0) & (F.col("share") < 1)).drop("cell")
        rows_left *= LANDING / cell_rows
    return result.select(
        F.col("id").alias(id_col), F.col("source").alias(source_col), "size", "source_size", "target",
        copies.alias("copies"), (copies * F.col("size")).alias("taken"))
