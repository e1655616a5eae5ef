"""Nearest known values before and after a row, in one pass over a sorted group.

Spark keeps one running value for a frame that begins at the group's start; a
frame that ends at the group's end it computes anew for each row. So what lies
ahead is read as what lies behind in the opposite order.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def behind(value: Column | str, by: list[str], order: list[Column], own: bool = True) -> Column:
    """The last non-NULL value among the rows before this one (and its own) in an order."""
    w = W.partitionBy(*by).orderBy(*order).rowsBetween(W.unboundedPreceding, 0 if own else -1)
    return F.last(value, ignorenulls=True).over(w)


def ahead(value: Column | str, by: list[str], reverse: list[Column], own: bool = True) -> Column:
    """The first non-NULL value among the rows after this one (and its own), given the opposite of the order."""
    return behind(value, by, reverse, own)
