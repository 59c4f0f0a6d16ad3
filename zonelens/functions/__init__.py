"""Column -> Column building blocks; no Python runs per row in this package, except one IDNA helper."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value evaluated once per row, however often the body uses it.

    Inside CASE branches Spark does not share common parts, and long expressions with many copies of a part
    outgrow what the JVM compiles.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))
