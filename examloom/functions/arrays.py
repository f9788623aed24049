"""Searches in arrays, as expressions of one row: no step is quadratic in the size of an array."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from examloom.functions.pyre import let


def first_where(values: Column, holds: Callable[[Column], Column]) -> Column:
    """Place from 0 of the first value that holds; null for none."""
    return F.nullif(F.array_position(F.transform(values, lambda x: F.coalesce(holds(x), F.lit(False))), True), F.lit(0)).cast("int") - 1


def present(values: Column) -> Column:
    return F.filter(values, lambda x: x.isNotNull())


def lower_bound(ordered: Column, value: Column) -> Column:
    """The first of the ascending values that isn't below the given one, by halving; null beyond the last."""
    span = F.struct(F.lit(0).alias("low"), F.size(ordered).alias("high"))

    def halve(s: Column, _: Column) -> Column:
        mid = F.floor((s["low"] + s["high"]) / 2).cast("int")
        below = F.get(ordered, mid) < value
        return F.when(s["low"] >= s["high"], s).otherwise(F.struct(F.when(below, mid + 1).otherwise(s["low"]).alias("low"), F.when(below, s["high"]).otherwise(mid).alias("high")))

    return F.get(ordered, F.aggregate(F.sequence(F.lit(1), F.lit(32)), span, halve)["low"])


def holds(ordered: Column, value: Column) -> Column:
    """Whether the ascending values hold the given one."""
    return F.coalesce(lower_bound(ordered, value) == value, F.lit(False))


def some_begins(ordered: Column, start: Column) -> Column:
    """Whether one of the ascending strings begins so."""
    return F.coalesce(F.startswith(lower_bound(ordered, start), start), F.lit(False))


def first_repeat(values: Column) -> Column:
    """Place from 0 of the first value that stands before it too; null for none."""
    placed = F.array_sort(F.transform(values, lambda x, i: F.struct(x.alias("x"), i.alias("i"))))
    return let(placed, lambda o: F.array_min(F.transform(o, lambda s, j: F.when((j > 0) & (F.get(o, j - 1)["x"] == s["x"]), s["i"]))))


def tail(values: Column, start: Column) -> Column:
    """The values from a place from 0 on."""
    return F.slice(values, start + 1, F.greatest(F.size(values) - start, F.lit(0)))
