"""Sums of amounts."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def amount_sum(c: Column) -> Column:
    """The sum as DOUBLE: no digits are cut and no magnitude is refused.

    Its last bits depend on the order of addition, as with any sum of doubles.
    """
    return F.sum(c.cast("double"))
