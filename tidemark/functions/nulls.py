"""Comparison and division helpers with warehouse NULL rules.

Spark's ``greatest``/``least`` skip NULLs and its ANSI ``/`` raises on a zero
divisor.  The pipelines need NULL to win in the first case and NULL as the
answer in the second.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F


def _any_null(cols: tuple[Column, ...]) -> Column:
    return reduce(lambda a, b: a | b, (c.isNull() for c in cols))


def strict_greatest(*cols: Column) -> Column:
    """Largest argument, or NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.greatest(*cols))


def strict_least(*cols: Column) -> Column:
    """Smallest argument, or NULL as soon as one argument is NULL."""
    return F.when(~_any_null(cols), F.least(*cols))


def ratio(num: Column, den: Column) -> Column:
    """``num / den`` as a double; NULL when ``den`` is zero."""
    return F.try_divide(num.cast("double"), den.cast("double"))
