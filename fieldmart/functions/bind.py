"""A value that an expression uses more than once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with value computed once: written out, it would be repeated at each use."""
    return F.element_at(F.transform(F.array(value), body), 1)
