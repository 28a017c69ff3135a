"""Recoding of categorical codes: dictionary remaps and range buckets."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the published grouping of hospital admission and discharge codes (code -> group), in its order.
ADMISSION_SOURCE_GROUPS = {
    2: 1, 3: 1,
    5: 4, 6: 4, 8: 4, 10: 4, 18: 4, 22: 4, 25: 4, 26: 4,
    15: 9, 17: 9, 20: 9, 21: 9,
    13: 11, 14: 11, 23: 11, 24: 11,
}
ADMISSION_TYPE_GROUPS = {2: 1, 7: 1, 4: 1, 6: 5, 8: 5}
DISCHARGE_GROUPS = {
    6: 1, 8: 1, 13: 1, 19: 1, 20: 1,
    3: 2, 4: 2, 5: 2, 9: 2, 10: 2, 12: 2, 14: 2, 22: 2, 23: 2, 24: 2,
    16: 15, 17: 15, 27: 15, 28: 15, 29: 15, 30: 15,
    25: 18, 26: 18,
}
# Diagnosis code groups as (group, inclusive integer ranges); first match wins.
DIAGNOSIS_GROUPS: tuple[tuple[int, tuple[tuple[int, int], ...]], ...] = (
    (1, ((390, 459), (785, 785))),
    (2, ((460, 519), (786, 786))),
    (3, ((520, 579), (787, 787))),
    (4, ((250, 250),)),
    (5, ((800, 999),)),
    (6, ((710, 739),)),
    (7, ((580, 629), (788, 788))),
    (8, ((140, 239),)),
)


def remap(col: Column, mapping: Mapping) -> Column:
    """Replace the mapped values, keep every other value (and NULL)."""
    by_target: dict = {}
    for source, target in mapping.items():
        by_target.setdefault(target, []).append(source)
    out = None
    for target, values in by_target.items():
        hit = col.isin(values)
        out = F.when(hit, F.lit(target)) if out is None else out.when(hit, F.lit(target))
    return col if out is None else out.otherwise(col)


def bucket_ranges(
    col: Column,
    groups: Sequence[tuple[int, Sequence[tuple[int, int]]]] = DIAGNOSIS_GROUPS,
    default: int = 0,
) -> Column:
    """The group of a numeric code given as text or number, cut to its integer part.

    Text that is no number (letter codes, NULL) gets `default`.
    """
    number = col.cast("string").try_cast("double")
    code = F.when(number >= 0, F.floor(number)).otherwise(F.ceil(number))
    out = F.when(number.isNull() | F.isnan(number), F.lit(default))
    for group, ranges in groups:
        hit = F.lit(False)
        for low, high in ranges:
            hit = hit | code.between(low, high)
        out = out.when(hit, F.lit(group))
    return out.otherwise(F.lit(default))
