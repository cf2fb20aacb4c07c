"""Naming a value inside an expression."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with ``value`` computed once, however often the body uses it.

    It is a higher-order function over a one-element array, so the body also stays out of the
    stage's generated method.  Long chains of patterns belong here: fused into one method they pass
    the size up to which the JVM compiles it, and then run interpreted.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
