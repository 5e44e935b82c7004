"""Named intermediate values inside one expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """Name an intermediate value inside an expression.

    A value used several times would be written out, and computed, at each use; and
    the optimizer may inline projections again when it pushes a filter down.
    """
    return F.transform(F.array(value), lambda x: body(x))[0]
