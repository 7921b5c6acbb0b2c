"""Packed distance matrices as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from wayframe.functions.distance import nint_floor
from wayframe.schemas import MATRIX_FORMATS, NO_DIAGONAL

#: A column layout of one triangle is the row layout of the other.
ROWS_OF = {"UPPER_COL": "LOWER_ROW", "LOWER_COL": "UPPER_ROW", "UPPER_DIAG_COL": "LOWER_DIAG_ROW", "LOWER_DIAG_COL": "UPPER_DIAG_ROW"}


def expected_count(layout: str, n: Column) -> Column:
    """Numbers that a layout of an n by n matrix has."""
    n = n.cast("long")
    if layout == "FULL_MATRIX":
        return n * n
    half = n * (n + 1) if "DIAG" in layout else n * (n - 1)
    return F.floor(half / 2).cast("long")


def packed_index(layout: str, n: Column, i: Column, j: Column) -> Column:
    """Where the element (i, j) stands, 0-based; null for a diagonal that isn't stored."""
    layout = ROWS_OF.get(layout, layout)
    if layout == "FULL_MATRIX":
        return i * n + j
    low, high = F.least(i, j), F.greatest(i, j)
    if layout == "LOWER_DIAG_ROW":
        return F.floor(high * (high + 1) / 2).cast("int") + low
    if layout == "UPPER_DIAG_ROW":
        return (low * n - F.floor(low * (low - 1) / 2)).cast("int") + (high - low)
    if layout == "LOWER_ROW":
        return F.when(i != j, F.floor(high * (high - 1) / 2).cast("int") + low)
    return F.when(i != j, (low * (n - 1) - F.floor(low * (low - 1) / 2)).cast("int") + (high - low - 1))


def element(numbers: Column, layout: str, n: Column, i: Column, j: Column) -> Column:
    """The element (i, j); null out of bounds, 0 on a diagonal that isn't stored."""
    inside = (i >= 0) & (j >= 0) & (i < n) & (j < n)
    return F.when(inside, F.coalesce(F.get(numbers, packed_index(layout, n, i, j)), F.when(i == j, F.lit(0.0))))


def _dense(numbers: Column, layout: str, n: Column) -> Column:
    span = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(span, lambda i: F.transform(span, lambda j: nint_floor(element(numbers, layout, n, i, j))))


def repaired(numbers: Column, layout: str, n: Column) -> Column:
    """The numbers without a leading DIMENSION, where there is one too many and the first is n."""
    extra = (F.size(numbers) == expected_count(layout, n) + 1) & (F.get(numbers, F.lit(0)) == n)
    return F.when(extra, F.slice(numbers, 2, F.greatest(F.size(numbers) - 1, F.lit(0)))).otherwise(numbers)


def densify(numbers: Column, layout: Column, n: Column) -> Column:
    """The full integer matrix whatever the layout; null if the count of numbers fits none.

    Two deviations are read as meant: a leading DIMENSION, and a diagonal layout
    whose zero diagonal is left out.
    """
    out = F.lit(None).cast("array<array<int>>")
    for name in MATRIX_FORMATS:
        fixed = repaired(numbers, name, n)
        dense = F.when(F.size(fixed) == expected_count(name, n), _dense(fixed, name, n))
        if name in NO_DIAGONAL:
            bare = NO_DIAGONAL[name]
            dense = dense.when(F.size(numbers) == expected_count(bare, n), _dense(numbers, bare, n))
        out = F.when(layout == name, dense).otherwise(out)
    return out


def is_symmetric(matrix: Column) -> Column:
    n = F.size(matrix)
    span = F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    return F.forall(span, lambda i: F.forall(span, lambda j: F.get(F.get(matrix, i), j).eqNullSafe(F.get(F.get(matrix, j), i))))
