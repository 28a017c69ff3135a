"""Splits, samples, balancing and paging with exact sizes and reproducible rows."""

from __future__ import annotations

import math
from collections.abc import Callable, Mapping
from fractions import Fraction

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from millrace.functions.cleaning import q
from millrace.operators.ranking import (
    MAX_GROUPS,
    global_positions,
    hash_cutoffs,
    hash_histogram,
    hash_rank,
    key_at_ranks,
    key_bounds,
    order_hash,
    within_cutoff,
)
from millrace.session import SmallTable, lookup, materialise

PAGE_SIZE = 15_000


def step_seed(step: str, seed: int | str) -> str:
    """The seed of one kind of draw.

    Draws that follow one another (split, balance, sample, folds) must not share an order:
    the first rows in the order that balanced a table are the rows of the unbalanced one.
    """
    return f"{step}:{seed}"


def share(n: int, fraction: float, how: str = "ceil") -> int:
    """n*fraction as whole rows, from the decimal value of the fraction (0.3 means 3/10)."""
    exact = Fraction(str(fraction)) * n
    return {"ceil": math.ceil, "floor": math.floor, "round": round}[how](exact)


def largest_remainder(counts: Mapping[object, int], total: int) -> dict[object, int]:
    """Quotas per class in proportion to its size, summing to `total`.

    Each class gets the whole part of n*total/N; the units left go to the largest
    remainders, ties to the smaller class.
    """
    n = sum(counts.values())
    if n == 0:
        return {g: 0 for g in counts}
    quotas = {g: c * total // n for g, c in counts.items()}
    left = total - sum(quotas.values())
    order = sorted(counts, key=lambda g: (-(counts[g] * total % n), g is not None, g if g is not None else 0))
    for g in order[:left]:
        quotas[g] += 1
    return quotas


def _first_rows(
    df: DataFrame, key: str, seed: int | str, quota: Callable[[int], int]
) -> Column:
    """True for the first quota(n) of the n rows in hash order."""
    histogram = hash_histogram(df, key, seed)
    quotas = {0: quota(histogram.total)}
    return within_cutoff(key, seed, hash_cutoffs(df, key, seed, quotas, histogram=histogram))


def random_split(df: DataFrame, key: str, test: float, seed: int | str = 42, out: str = "is_test") -> DataFrame:
    """Add a flag that is true for exactly ceil(n*test) rows."""
    return df.withColumn(out, _first_rows(df, key, seed, lambda n: share(n, test)))


def _stratified_flag(df: DataFrame, key: str, label: str, test: float, seed: int | str) -> Column | None:
    """The test flag as a row expression, or None when there are too many classes for that."""
    histogram = hash_histogram(df, key, seed, label)
    if histogram is None:
        return None
    quotas = largest_remainder(histogram.counts, share(histogram.total, test))
    return within_cutoff(key, seed, hash_cutoffs(df, key, seed, quotas, label, histogram), label)


def stratified_split(
    df: DataFrame, key: str, label: str, test: float, seed: int | str = 42, out: str = "is_test"
) -> DataFrame:
    """Add a flag for test rows; class quotas by largest remainder sum to ceil(n*test)."""
    flag = _stratified_flag(df, key, label, test, seed)
    if flag is not None:
        return df.withColumn(out, flag)
    return _stratified_split_many(df, key, label, test, seed, out)


def _stratified_split_many(
    df: DataFrame, key: str, label: str, test: float, seed: int | str, out: str
) -> DataFrame:
    """The same split for any number of classes: quotas stay a table, ranks need one shuffle."""
    counts = materialise(df.groupBy(q(label).alias("_g")).agg(F.count(F.lit(1)).alias("_c")), "classes")
    n = counts.agg(F.sum("_c")).first()[0] or 0
    if n == 0:
        return df.withColumn(out, F.lit(False))
    total = share(n, test)
    scaled = F.col("_c").cast("decimal(19,0)") * F.lit(total).cast("decimal(18,0)")
    quota = (
        counts.withColumn("_s", scaled)
        .withColumn("_q", F.expr(f"_s div {n}BD").cast("bigint"))
        .withColumn("_rem", (F.col("_s") % F.lit(n)).cast("bigint"))
    )
    left = total - quota.agg(F.sum("_q")).first()[0]
    placed = global_positions(quota, [F.desc("_rem"), F.asc_nulls_first("_g")], "_pos", "quotas")
    # NULL is a class of its own, so the lookup key is text that is never NULL
    class_key = lambda c: F.coalesce(c.cast("string"), F.lit("\u0000"))
    quota = SmallTable.of(placed.select(
        class_key(F.col("_g")).alias("_class"), (F.col("_q") + (F.col("_pos") < F.lit(left)).cast("bigint")).alias("_q")
    ), "quotas")
    ranked = hash_rank(df, key, seed, [label], "_rank", n).withColumn("_class", class_key(q(label)))
    flagged = lookup(ranked, quota, ["_class"]).withColumn(out, F.col("_rank") <= F.col("_q"))
    return flagged.select(*[q(c) for c in df.columns], out)


def three_way_split(
    df: DataFrame,
    key: str,
    label: str,
    test: float = 0.2,
    validation: float = 0.25,
    seeds: tuple[int | str, int | str] = (42, 43),
    out: str = "split",
) -> DataFrame:
    """Add 'train' / 'validation' / 'test' by two nested stratified splits.

    The validation share is taken from what the first split leaves.
    """
    is_test = _stratified_flag(df, key, label, test, seeds[0])
    if is_test is None:
        first = _stratified_split_many(df, key, label, test, seeds[0], "_test")
        rest = stratified_split(first.filter(~F.col("_test")), key, label, validation, seeds[1], "_validation")
        named = F.when(F.col("_validation"), F.lit("validation")).otherwise(F.lit("train"))
        return (
            rest.withColumn(out, named)
            .drop("_validation")
            .unionByName(first.filter("_test").withColumn(out, F.lit("test")))
            .drop("_test")
        )
    is_validation = _stratified_flag(df.filter(~is_test), key, label, validation, seeds[1])
    if is_validation is None:
        raise AssertionError("a subset cannot have more classes than the whole")
    named = F.when(is_test, F.lit("test")).when(is_validation, F.lit("validation")).otherwise(F.lit("train"))
    return df.withColumn(out, named)


def sample_rows(df: DataFrame, key: str, n: int, seed: int | str = 42) -> DataFrame:
    """Exactly n rows (all of them when the table has fewer); `key` is unique."""
    seed = step_seed("sample", seed)
    return df.filter(_first_rows(df, key, seed, lambda _: n))


def sample_fraction(df: DataFrame, key: str, fraction: float, seed: int | str = 42) -> DataFrame:
    """Exactly round(n*fraction) rows, half to even; `key` is unique."""
    seed = step_seed("sample", seed)
    return df.filter(_first_rows(df, key, seed, lambda n: share(n, fraction, "round")))


def undersample_quota(counts: Mapping[object, int], strategy: str | float = 1.0) -> tuple[object, int]:
    """(majority class, rows to keep of it). Only two classes are accepted."""
    if len(counts) != 2:
        raise ValueError(f"undersampling needs two classes, found {len(counts)}")
    first, second = sorted(counts)
    majority, minority = (first, second) if counts[first] >= counts[second] else (second, first)
    if strategy in ("auto", "majority"):
        target = counts[minority]
    elif isinstance(strategy, (int, float)) and not isinstance(strategy, bool):
        target = int(counts[minority] / strategy)
    else:
        raise ValueError("strategy must be 'auto', 'majority' or a number")
    return majority, min(target, counts[majority])


def undersample(
    df: DataFrame, key: str, label: str, strategy: str | float = 1.0, seed: int | str = 42
) -> DataFrame:
    """Keep every minority row and the first rows of the majority in hash order."""
    seed = step_seed("balance", seed)
    histogram = hash_histogram(df, key, seed, label)
    if histogram is None:
        raise ValueError("undersampling needs two classes")
    majority, quota = undersample_quota(histogram.counts, strategy)
    cut = hash_cutoffs(df, key, seed, {majority: quota}, label, histogram)
    return df.filter((q(label) != F.lit(majority)) | within_cutoff(key, seed, cut, label))


def hash_split(key: str, seed: int | str = 42, train: int = 2, evaluate: int = 1) -> Column:
    """'train' or 'eval' from the row's own hash: no count, no shuffle, stable for new rows."""
    bucket = F.conv(F.substring(order_hash(seed, key), 1, 8), 16, 10).cast("bigint") % F.lit(train + evaluate)
    return F.when(bucket < F.lit(train), F.lit("train")).otherwise(F.lit("eval"))


def page_count(n: int | Column, size: int = PAGE_SIZE) -> int | Column:
    """Pages needed for n rows."""
    if isinstance(n, Column):
        return F.ceil(n / F.lit(size)).cast("bigint")
    return -(-n // size)


class PageNotFound(LookupError):
    """The page lies past the end; `last_page` is the highest valid one."""

    def __init__(self, page: int, last_page: int) -> None:
        super().__init__(f"page {page} does not exist, last page is {last_page}")
        self.last_page = last_page


def page(
    df: DataFrame, key: str, number: int, size: int = PAGE_SIZE, limit: int | None = None
) -> tuple[DataFrame, dict[str, int]]:
    """Rows number*size .. in order of a unique integer key, and where they lie.

    The page becomes a key range, which the scan can push down; nothing is sorted.
    """
    if number < 0:
        raise ValueError("page number must not be negative")
    bounds = key_bounds(df, key)
    n = bounds[2]
    start, end = number * size, min((number + 1) * size, n)
    if start >= n:
        raise PageNotFound(number, max(page_count(n, size) - 1, 0))
    if limit is not None and 0 < limit < end - start:
        end = start + limit
    at = key_at_ranks(df, key, [start + 1, end], bounds)
    rows = df.filter(q(key).between(at[start + 1], at[end]))
    return rows, {"batch_number": number, "start_row": start, "end_row": end, "batch_size": end - start}


def assign_pages(df: DataFrame, key: str, size: int = PAGE_SIZE, out: str = "batch_number") -> DataFrame:
    """Add the page number of every row in key order: one range shuffle for all pages together.

    For writing out all pages; `page` reads a single one without a shuffle.
    """
    placed = global_positions(df, [F.asc(key)], "_position", "pages")
    return placed.withColumn(out, F.expr(f"_position div {size}").cast("int")).drop("_position")


def page_index(df: DataFrame, key: str, size: int = PAGE_SIZE) -> DataFrame:
    """One row for each page of `df` in order of a unique integer key: batch_number, first_key, last_key, n_rows.

    One range shuffle of the keys alone. Stored once, it makes a page a key range without another look at the keys,
    so reading all pages costs one scan of the keys in all. It holds for the rows it was made from: store it
    beside them, under their version. Rows without a key lie on no page.
    """
    keys = df.select(q(key).cast("bigint").alias("_key")).filter("_key IS NOT NULL")
    pages = assign_pages(keys, "_key", size).groupBy("batch_number")
    return pages.agg(F.min("_key").alias("first_key"), F.max("_key").alias("last_key"), F.count(F.lit(1)).alias("n_rows"))


def indexed_page(df: DataFrame, key: str, index: DataFrame, number: int) -> DataFrame:
    """The rows of a page, by the key range that its index names; the scan of `df` takes the filter."""
    row = index.filter(F.col("batch_number") == number).first()
    if row is None:
        last = index.agg(F.max("batch_number")).first()[0]
        raise PageNotFound(number, last or 0)
    return df.filter(q(key).between(row.first_key, row.last_key))


def slice_sample(
    df: DataFrame, key: str, slices: int = 10, per_slice: int = 10, seed: int | str = 42
) -> DataFrame:
    """Cut the table into equal slices in key order and draw 1/per_slice of each.

    Rows beyond slices*size (the remainder of the division) belong to no slice.
    """
    bounds = key_bounds(df, key)
    size = bounds[2] // slices
    if size == 0:
        return df.withColumn("slice", F.lit(0)).filter(F.lit(False))
    at = key_at_ranks(df, key, [size * (i + 1) for i in range(slices)], bounds)
    number = F.lit(None).cast("int")
    for i in reversed(range(slices)):
        number = F.when(q(key) <= F.lit(at[size * (i + 1)]), F.lit(i)).otherwise(number)
    sliced = df.withColumn("slice", number).filter(F.col("slice").isNotNull())
    seed = step_seed("slice", seed)
    if slices > MAX_GROUPS:
        ranked = hash_rank(sliced, key, seed, ["slice"], "_rank", bounds[2])
        return ranked.filter(F.col("_rank") <= size // per_slice).drop("_rank")
    cut = hash_cutoffs(sliced, key, seed, {i: size // per_slice for i in range(slices)}, "slice")
    return sliced.filter(within_cutoff(key, seed, cut, "slice"))


def kfold(df: DataFrame, key: str, label: str, k: int = 5, seed: int | str = 42, out: str = "fold") -> DataFrame:
    """Stratified folds 0..k-1: ranks inside the class, dealt out in turn."""
    ranked = hash_rank(df, key, step_seed("fold", seed), [label], "_rank")
    return ranked.withColumn(out, ((F.col("_rank") - 1) % F.lit(k)).cast("int")).drop("_rank")
