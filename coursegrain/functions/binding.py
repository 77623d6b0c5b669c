"""Name an intermediate value inside one column expression.

Catalyst inlines a Column wherever it is used, so an expression that mentions
its argument ten times evaluates it ten times.  Binding it as a lambda variable
evaluates it once per row.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.element_at(F.transform(F.array(value), body), 1)
