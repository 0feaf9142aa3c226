"""Helpers for building expressions."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, then: Callable[[Column], Column]) -> Column:
    """then(value), with value computed once for each row however often then names it. then holds no Python function."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


def chain(value: Column, *steps: Callable[[Column], Column]) -> Column:
    """The steps one after another, each on a value that is computed once."""
    for step in steps:
        value = let(value, step)
    return value
