"""Array and map functions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def sort_ints(arr: Column, ascending: bool = True) -> Column:
    return F.sort_array(arr, ascending)


def partition_pivot(arr: Column, pivot: Column) -> tuple[Column, Column]:
    """The elements `<= pivot` and those `> pivot`, each in their old order."""
    return F.filter(arr, lambda x: x <= pivot), F.filter(arr, lambda x: x > pivot)


def half_length(arr: Column) -> Column:
    """The default pivot: half the array's length, rounded down, as a number."""
    return F.floor(F.size(arr) / 2).cast("int")


def zip_apply(a: Column, b: Column, fn: Callable[[Column, Column], Column]) -> Column:
    """A two-argument function applied pair by pair."""
    return F.zip_with(a, b, fn)


def upper_values(m: Column) -> Column:
    return F.transform_values(m, lambda _, v: F.upper(v))
