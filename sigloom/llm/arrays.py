"""Helpers for array columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

_BLOCK = 64


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)`` with the value computed once, however often it is used."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def running(sizes: Column) -> Column:
    """For each element of an array of integers the sum of those before it.

    Sums are kept by blocks, so that the work does not grow with the square of the length: an
    aggregate that appends to an array copies it for every element.
    """
    add = lambda xs: F.aggregate(xs, F.lit(0), lambda a, x: a + x)

    def within(own: Column) -> Column:
        blocks = F.sequence(F.lit(0), F.floor(F.size(own) / _BLOCK).cast("int"))
        totals = F.transform(blocks, lambda b: add(F.slice(own, b * _BLOCK + 1, F.lit(_BLOCK))))
        starts = let(totals, lambda t: F.transform(blocks, lambda b: add(F.slice(t, F.lit(1), b))))
        place = lambda st, i: F.get(st, F.floor(i / _BLOCK).cast("int")) + add(F.slice(own, (i - i % _BLOCK + 1).cast("int"), i % _BLOCK))
        return let(starts, lambda st: F.transform(own, lambda _, i: place(st, i)))

    return let(sizes, within)
