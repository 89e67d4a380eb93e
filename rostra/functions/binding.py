"""Compute an expression once and use it many times inside one column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once per row.

    An expression that stands inside a lambda is computed again for every array element; as the single item
    of an outer array it is computed once and passed in as a lambda variable.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))
