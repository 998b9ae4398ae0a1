"""Naming an intermediate value inside a column expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` evaluated once.

    Plain nesting repeats an expression wherever it is used; repeated nesting grows it exponentially.
    """
    return F.transform(F.array(value), body)[0]
