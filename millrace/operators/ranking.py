"""Exact ranks and rank thresholds without a single-task sort.

Two questions are answered here.

* Which rows are among the first q of their group? (`hash_cutoffs`, `key_at_ranks`)
  A histogram finds the bucket holding the q-th row, only that bucket is refined,
  and the answer is a *threshold*. The caller then filters by comparing with the
  threshold, so the table itself is never sorted or shuffled.
* What is the rank of every row? (`hash_rank`, `global_positions`)
  One shuffle over evenly filled buckets, plus offsets from a small count table.

The random order is md5 of seed and key, so a choice of rows is reproducible on any
cluster and in SQL.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, Window
from pyspark.sql import functions as F

from millrace.functions.cleaning import q
from millrace.session import fetch_bounded, materialise

PREFIX_DIGITS = 2          # 256 hash buckets per refinement step
BINS = 4096                # key bins per refinement step
SORT_ROWS = 1_000_000      # narrow rows one task may sort
MAX_GROUPS = 64            # groups whose thresholds are written as literals; more use `hash_rank`


def order_hash(seed: int | str, *keys: str) -> Column:
    """The pseudo-random order of a row: md5 of 'seed:key'."""
    return F.md5(F.concat_ws(":", F.lit(str(seed)), *[q(k).cast("string") for k in keys]))


@dataclass(frozen=True)
class HashHistogram:
    """Rows per group and hash prefix of a table, for one seed."""

    buckets: dict[object, list[tuple[str, int]]]  # group -> [(prefix, rows)] in prefix order

    @property
    def counts(self) -> dict[object, int]:
        return {g: sum(n for _, n in cells) for g, cells in self.buckets.items()}

    @property
    def total(self) -> int:
        return sum(self.counts.values())


def _hashed(df: DataFrame, key: str, seed: int | str, group: str | None) -> DataFrame:
    member = q(group) if group is not None else F.lit(0)
    return df.select(member.alias("g"), order_hash(seed, key).alias("h"))


def _histogram(base: DataFrame, digits: int) -> HashHistogram | None:
    counts = base.groupBy("g", F.substring("h", 1, digits).alias("p")).agg(F.count(F.lit(1)).alias("n"))
    rows = fetch_bounded(counts, MAX_GROUPS * 16**PREFIX_DIGITS)
    if rows is None:
        return None
    buckets: dict[object, list[tuple[str, int]]] = {}
    for row in sorted(rows, key=lambda r: r["p"]):
        buckets.setdefault(row["g"], []).append((row["p"], row["n"]))
    return HashHistogram(buckets) if len(buckets) <= MAX_GROUPS else None


def hash_histogram(df: DataFrame, key: str, seed: int | str, group: str | None = None) -> HashHistogram | None:
    """Group sizes and hash distribution in one job, or None with more than MAX_GROUPS groups.

    At most MAX_GROUPS * 256 counts reach the driver, whatever the size of the table.
    """
    return _histogram(_hashed(df, key, seed, group), PREFIX_DIGITS)


def hash_cutoffs(
    df: DataFrame,
    key: str,
    seed: int | str,
    quotas: Mapping[object, int],
    group: str | None = None,
    histogram: HashHistogram | None = None,
) -> dict[object, str | None]:
    """For each group the hash of its quota-th row in hash order.

    None means that no row is wanted (quota <= 0, or an empty group); a quota beyond
    the group gives its last row. Only the bucket in which the quota falls is looked
    at again: first counted by longer prefixes, then, when short, sorted.
    """
    base = _hashed(df, key, seed, group)
    if histogram is None:
        histogram = _histogram(base, PREFIX_DIGITS)
        if histogram is None:
            raise ValueError(f"more than {MAX_GROUPS} groups: use hash_rank")
    result: dict[object, str | None] = {g: None for g in quotas}
    left = {g: int(n) for g, n in quotas.items() if n > 0 and histogram.buckets.get(g)}
    prefix: dict[object, str] = {}
    digits = PREFIX_DIGITS
    step = histogram
    while left:
        size: dict[object, int] = {}
        for g in step.buckets:
            if g in left and len(prefix.get(g, "")) < digits:
                prefix[g], before, size[g] = _crossing(step.buckets[g], left[g])
                left[g] = min(left[g] - before, size[g])
        wide = {g: prefix[g] for g, n in size.items() if n > SORT_ROWS}
        if not wide or digits >= 32:
            break
        digits += PREFIX_DIGITS
        step = _histogram(_under(base, wide), digits)
    if not left:
        return result
    rank = F.row_number().over(Window.partitionBy("g").orderBy("h"))
    rows = _under(base, prefix).withColumn("r", rank).filter(F.col("r") == _by_group(left)).select("g", "h").collect()
    result.update({row["g"]: row["h"] for row in rows})
    return result


def _crossing(cells: Sequence[tuple[str, int]], target: int) -> tuple[str, int, int]:
    """(prefix, rows before it, rows in it) of the bucket where the running count reaches the target.

    When the target lies beyond the group, its last bucket is taken.
    """
    before = 0
    for prefix, n in cells:
        if before + n >= target:
            return prefix, before, n
        before += n
    prefix, n = cells[-1]
    return prefix, before - n, n


def _by_group(values: Mapping[object, object], column: Column | None = None) -> Column:
    """The value of a row's group as one CASE; NULL for other groups."""
    column = F.col("g") if column is None else column
    out = F.lit(None)
    for g, value in values.items():
        hit = column.isNull() if g is None else column == F.lit(g)
        out = F.when(hit, F.lit(value)).otherwise(out)
    return out


def _under(base: DataFrame, prefix: Mapping[object, str]) -> DataFrame:
    """Rows whose hash starts with the prefix of their group."""
    return base.filter(F.startswith(F.col("h"), _by_group(prefix).cast("string")))


def within_cutoff(key: str, seed: int | str, cutoffs: Mapping[object, str | None], group: str | None = None) -> Column:
    """True for rows at or before their group's cutoff: one hash and one comparison per row."""
    known = {g: cut for g, cut in cutoffs.items() if cut is not None}
    if not known:
        return F.lit(False)
    cut = F.lit(next(iter(known.values()))) if group is None else _by_group(known, q(group))
    return F.coalesce(order_hash(seed, key) <= cut, F.lit(False))


def prefix_length(n: int, rows_per_bucket: int = SORT_ROWS) -> int:
    """Hex digits so that a hash bucket of an n-row group holds about `rows_per_bucket` rows."""
    return max(1, math.ceil(math.log(max(n, 1) / rows_per_bucket, 16))) if n > rows_per_bucket else 1


def hash_rank(
    df: DataFrame, key: str, seed: int | str, group: Sequence[str] = (), out: str = "rank", n_rows: int | None = None
) -> DataFrame:
    """Add the exact 1-based rank in hash order inside each group.

    Rows are shuffled once on (group, hash prefix): prefixes are uniform, so a group
    with a third of all rows is still spread evenly. The key is a struct, which is never NULL, so that the join
    with the offsets and the window share this one partitioning.
    """
    digits = prefix_length(df.count() if n_rows is None else n_rows)
    hashed = df.withColumn("_h", order_hash(seed, key))
    hashed = hashed.withColumn("_key", F.struct(*[q(c).alias(f"g{i}") for i, c in enumerate(group)], F.substring("_h", 1, digits).alias("p")))
    counts = hashed.groupBy("_key").agg(F.count(F.lit(1)).alias("_n"))
    of_group = [F.col(f"_key.g{i}") for i in range(len(group))]
    before = Window.partitionBy(*of_group).orderBy("_key.p").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_key", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    if group:  # any number of groups: not for the driver, however small their columns' files are
        offsets = offsets.hint("merge")
    local = F.row_number().over(Window.partitionBy("_key").orderBy("_h", q(key)))
    return hashed.join(offsets, "_key").withColumn(out, F.col("_before") + local).drop("_h", "_key", "_before")


def key_bounds(df: DataFrame, key: str) -> tuple[int | None, int | None, int]:
    """(smallest, largest, number) of the keys."""
    k = q(key).cast("bigint")
    return tuple(df.agg(F.min(k), F.max(k), F.count(k)).first())


def key_at_ranks(
    df: DataFrame, key: str, ranks: Sequence[int], bounds: tuple[int | None, int | None, int] | None = None
) -> dict[int, int]:
    """The value of a unique integer key at each wanted 1-based rank in key order.

    Every pass counts the keys in at most BINS equal bins of each interval still
    open and keeps the bin with the wanted rank; only a bin of at most SORT_ROWS
    keys is ever sorted. The number of ranks is small (page bounds, slice bounds).
    """
    base = df.select(q(key).cast("bigint").alias("k"))
    low, high, n = bounds or key_bounds(base, "k")
    ranks = [r for r in sorted(set(ranks)) if 1 <= r <= n]
    # rank -> (first key, last key, rows before the interval, rows in it)
    open_ = {r: (low, high, 0, n) for r in ranks}
    while True:
        wide = {r: s for r, s in open_.items() if s[3] > SORT_ROWS and s[1] > s[0]}
        if not wide:
            break
        intervals = sorted({(s[0], s[1]) for s in wide.values()})
        hist = _bin_counts(base, intervals)
        for r, (lo, hi, before, _) in wide.items():
            step = (hi - lo) // BINS + 1
            for b, count in sorted(hist[(lo, hi)].items()):
                if before + count >= r:
                    open_[r] = (lo + b * step, min(hi, lo + (b + 1) * step - 1), before, count)
                    break
                before += count
    out: dict[int, int] = {}
    by_interval: dict[tuple[int, int, int], list[int]] = {}
    for r, (lo, hi, before, _) in open_.items():
        by_interval.setdefault((lo, hi, before), []).append(r)
    pieces = sorted(by_interval)
    if not pieces:
        return out
    piece = F.lit(None).cast("int")
    for i, (lo, hi, _) in enumerate(pieces):
        piece = F.when(F.col("k").between(lo, hi), F.lit(i)).otherwise(piece)
    ranked = (
        base.withColumn("i", piece)
        .filter(F.col("i").isNotNull())
        .withColumn("r", F.row_number().over(Window.partitionBy("i").orderBy("k")))
    )
    wanted = F.lit(False)
    for i, piece_key in enumerate(pieces):
        local = [r - piece_key[2] for r in by_interval[piece_key]]
        wanted = wanted | ((F.col("i") == i) & F.col("r").isin(local))
    for row in ranked.filter(wanted).collect():
        out[pieces[row["i"]][2] + row["r"]] = row["k"]
    return out


def _bin_counts(base: DataFrame, intervals: Sequence[tuple[int, int]]) -> dict[tuple[int, int], dict[int, int]]:
    """Rows per bin for each (disjoint or equal) interval, counted in one job."""
    bin_ = F.lit(None)
    for i, (lo, hi) in enumerate(intervals):
        step = (hi - lo) // BINS + 1
        index = F.expr(f"(k - {lo}L) div {step}L")
        bin_ = F.when(F.col("k").between(lo, hi), F.struct(F.lit(i).alias("i"), index.cast("int").alias("b"))).otherwise(bin_)
    rows = base.select(bin_.alias("s")).filter("s is not null").groupBy("s.i", "s.b").count().collect()
    out: dict[tuple[int, int], dict[int, int]] = {iv: {} for iv in intervals}
    for row in rows:
        out[intervals[row["i"]]][row["b"]] = row["count"]
    return out


def global_positions(df: DataFrame, order: Sequence[Column], out: str = "position", label: str = "positions") -> DataFrame:
    """Add the exact 0-based position in a total order, for tables of any size.

    Rows are range-partitioned, sorted inside partitions and written once with
    (partition, row) ids; the offset of each partition comes from the counts. The
    sampled range bounds are fixed by the written copy, so a lost executor cannot
    change a position.
    """
    placed = materialise(
        df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_id", F.monotonically_increasing_id()),
        label,
    )
    part = F.shiftright("_id", 33)
    counts = placed.groupBy(part.alias("_part")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    # one row per shuffle partition: a few thousand at most
    offsets = counts.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    local = F.col("_id").bitwiseAND(F.lit((1 << 33) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(offsets), "_part")
        .withColumn(out, F.col("_before") + local)
        .drop("_part", "_id", "_before")
    )


def exact_quantiles(
    df: DataFrame, names: Sequence[str], probs: Sequence[float], small: int = 100_000, accuracy: int = 2_000
) -> dict[str, list[float | None]]:
    """Exact quantiles with linear interpolation, for many columns at once (see `quantiles_beside`)."""
    return quantiles_beside(df, names, probs, (), small, accuracy)[0]


def quantiles_beside(
    df: DataFrame, names: Sequence[str], probs: Sequence[float], others: Sequence[Column], small: int = 100_000,
    accuracy: int = 2_000,
) -> tuple[dict[str, list[float | None]], Row | None]:
    """Exact quantiles of many columns, and a row of other aggregates that share their first pass.

    Up to `small` rows the built-in exact percentile is used (its value map is then
    bounded). Above, approximate percentiles bracket each wanted rank, one aggregate counts the rows
    below and at each cut, and only the values between the two cuts round a rank are looked at again.
    All columns share every pass.
    """
    if not names:
        return {}, df.agg(*others).first() if others else None
    base = df.select(*[q(c).cast("double").alias(f"c{i}") for i, c in enumerate(names)])
    base = base.select(*[F.when(~F.isnan(c), F.col(c)).alias(c) for c in base.columns])
    slack = 2.0 / accuracy
    near = sorted({min(1.0, max(0.0, p + d)) for p in probs for d in (-slack, slack)})
    clean = [F.when(~F.isnan(q(c).cast("double")), q(c).cast("double")) for c in names]
    row = first = df.agg(
        *others,
        *[F.count(x).alias(f"n_{c}") for c, x in zip(base.columns, clean)],
        *[F.percentile_approx(x, near, accuracy).alias(f"q_{c}") for c, x in zip(base.columns, clean)],
    ).first()
    counts = {c: row[f"n_{c}"] for c in base.columns}
    if max(counts.values()) <= small:
        exact = F.array(*[F.lit(float(p)) for p in probs])
        row = base.agg(*[F.percentile(c, exact).alias(c) for c in base.columns]).first()
        return {name: list(row[c] or [None] * len(probs)) for name, c in zip(names, base.columns)}, first
    open_: list[_Bracket] = []
    wanted: dict[str, list[float]] = {}
    for c in base.columns:
        n = counts[c]
        wanted[c] = [p * (n - 1) for p in probs] if n else []
        ranks = sorted({r for at in wanted[c] for r in (math.floor(at), math.ceil(at))})
        if ranks:
            open_.append(_Bracket(c, None, None, 0, n, tuple(ranks), tuple(row[f"q_{c}"])))
    values = _values_at(base, open_, accuracy)
    out: dict[str, list[float | None]] = {}
    for name, c in zip(names, base.columns):
        found = []
        for at in wanted[c]:
            low, high = values[c, math.floor(at)], values[c, math.ceil(at)]
            found.append(low if low == high else low + (high - low) * (at - math.floor(at)))  # also of infinite values
        out[name] = found or [None] * len(probs)
    return out, first


@dataclass(frozen=True)
class _Bracket:
    """Values of one column between low and high (neither included, None: no bound): rows below it, rows in it, ranks
    sought, cut points."""

    column: str
    low: float | None
    high: float | None
    before: int
    rows: int
    ranks: tuple[int, ...]
    cuts: tuple[float, ...]


def _between(column: str, low: float | None, high: float | None) -> Column:
    bounds = [F.col(column).isNotNull()]
    bounds += [F.col(column) > low] if low is not None else []
    bounds += [F.col(column) < high] if high is not None else []
    return reduce(lambda a, b: a & b, bounds)


def _values_at(base: DataFrame, open_: Sequence[_Bracket], accuracy: int) -> dict[tuple[str, int], float]:
    """Values at 0-based ranks of each bracket's column (ties share a value)."""
    done: dict[tuple[str, int], float] = {}
    short: dict[tuple[str, float | None, float | None], list[tuple[int, int]]] = {}
    while open_:
        counts = []
        for i, b in enumerate(open_):
            inside, v = _between(b.column, b.low, b.high), F.col(b.column)
            for j, cut in enumerate(sorted(set(b.cuts))):
                counts += [F.count_if(inside & (v < cut)).alias(f"below_{i}_{j}"), F.count_if(inside & (v <= cut)).alias(f"upto_{i}_{j}")]
        row = base.agg(*counts).first()
        narrowed: dict[tuple, list[int]] = {}
        for i, b in enumerate(open_):
            for rank in b.ranks:
                low, high, start, end = b.low, b.high, 0, b.rows
                for j, cut in enumerate(sorted(set(b.cuts))):
                    if rank - b.before < row[f"below_{i}_{j}"]:
                        high, end = cut, row[f"below_{i}_{j}"]
                        break
                    if rank - b.before < row[f"upto_{i}_{j}"]:
                        done[b.column, rank] = cut
                        break
                    low, start = cut, row[f"upto_{i}_{j}"]
                if (b.column, rank) in done:
                    continue
                before, n = b.before + start, end - start
                if n <= SORT_ROWS:
                    short.setdefault((b.column, low, high), []).append((rank, rank - before))
                else:
                    narrowed.setdefault((b.column, low, high, before, n), []).append(rank)
        open_ = _recut(base, narrowed, accuracy)
    if short:
        done |= _values_in(base, short)
    return done


def _recut(base: DataFrame, narrowed: Mapping[tuple, Sequence[int]], accuracy: int) -> list[_Bracket]:
    """New cut points, close around the wanted ranks, for brackets that are still large."""
    if not narrowed:
        return []
    slack = 2.0 / accuracy
    aggs = []
    for j, ((column, low, high, before, n), ranks) in enumerate(narrowed.items()):
        at = [(r - before) / max(n - 1, 1) for r in ranks]
        near = sorted({min(1.0, max(0.0, p + d)) for p in at for d in (-slack, slack)})
        inside = F.when(_between(column, low, high), F.col(column))
        aggs.append(F.percentile_approx(inside, near, accuracy).alias(f"q{j}"))
    row = base.agg(*aggs).first()
    return [
        _Bracket(*state, tuple(ranks), tuple(row[f"q{j}"])) for j, (state, ranks) in enumerate(narrowed.items())
    ]


def _values_in(
    base: DataFrame, short: Mapping[tuple[str, float | None, float | None], Sequence[tuple[int, int]]]
) -> dict[tuple[str, int], float]:
    """Values at local ranks of brackets of at most SORT_ROWS rows, all in one job."""
    cells = [(_between(*b), F.struct(F.lit(i).alias("i"), F.col(b[0]).alias("v"))) for i, b in enumerate(short)]
    tagged = F.explode(F.array(*[F.when(inside, cell) for inside, cell in cells])).alias("r")
    near = base.filter(reduce(lambda a, b: a | b, [inside for inside, _ in cells])).select(tagged)
    counts = near.filter("r IS NOT NULL").groupBy("r.i", "r.v").agg(F.count(F.lit(1)).alias("n"))
    cum = counts.withColumn("cum", F.sum("n").over(Window.partitionBy("i").orderBy("v")))
    hit = F.lit(False)
    for i, ranks in enumerate(short.values()):
        for _, local in ranks:
            hit = hit | ((F.col("i") == i) & (F.col("cum") > local) & (F.col("cum") - F.col("n") <= local))
    found = sorted((r["i"], r["cum"], r["v"]) for r in cum.filter(hit).collect())
    out: dict[tuple[str, int], float] = {}
    for i, ((column, _, _), ranks) in enumerate(short.items()):
        for rank, local in ranks:
            out[column, rank] = next(v for j, total, v in found if j == i and total > local)
    return out


# Rank error of the sketch that brackets a group's quantile, as a part of the group's rows.
SKETCH_ERROR = 1e-4


def grouped_quantile(df: DataFrame, group: str, value: str, share: float) -> DataFrame:
    """(group, quantile): the exact quantile, linear between two values, of each group of a table.

    Two passes for any number of groups, and nothing reaches the driver. A mergeable sketch brackets the quantile
    of every group; the second pass counts the rows below the bracket and the rows of each value inside it, of which there
    are about 4 in 10 000 of the group's rows. These counts are summed up in the order of the values. Missing values are
    left out; a group without values has none. NULL is a group of its own.
    """
    number = q(value).cast("double")
    rows = df.select(q(group).alias("group"), number.alias("v")).filter(F.col("v").isNotNull() & ~F.isnan("v"))
    around = [max(share - 2 * SKETCH_ERROR, 0.0), min(share + 2 * SKETCH_ERROR, 1.0)]
    brackets = materialise(rows.groupBy("group").agg(
        F.count(F.lit(1)).alias("n"), F.percentile_approx("v", around, round(1 / SKETCH_ERROR)).alias("b"), F.min("v").alias("least"),
        F.max("v").alias("most"),
    ).select(
        F.col("group").alias("_g"), F.floor(F.lit(share) * (F.col("n") - 1)).alias("at"), (F.lit(share) * (F.col("n") - 1)).alias("exact"),
        # in small groups the error of the sketch is less than a row, and the quantile lies between two
        F.when(F.col("n") * SKETCH_ERROR < 2, F.col("least")).otherwise(F.col("b")[0]).alias("low"),
        F.when(F.col("n") * SKETCH_ERROR < 2, F.col("most")).otherwise(F.col("b")[1]).alias("high")), "brackets")
    near = rows.join(brackets, F.col("group").eqNullSafe(F.col("_g"))).filter(F.col("v") <= F.col("high"))
    counts = near.groupBy("group", "at", "exact", F.when(F.col("v") >= F.col("low"), F.col("v")).alias("v")).agg(
        F.count(F.lit(1)).alias("n"))
    upto = F.sum("n").over(Window.partitionBy("group").orderBy(F.col("v").asc_nulls_first()))
    placed = counts.withColumn("upto", upto).withColumn("before", F.col("upto") - F.col("n"))

    def holds(rank: Column) -> Column:
        return F.max(F.when((F.col("before") <= rank) & (F.col("upto") > rank), F.col("v")))

    ends = placed.groupBy("group").agg(
        holds(F.col("at")).alias("lower"), holds(F.ceil("exact")).alias("upper"), F.max(F.col("exact") - F.col("at")).alias("part"))
    return ends.select("group", (F.col("lower") + F.col("part") * (F.col("upper") - F.col("lower"))).alias("quantile"))
