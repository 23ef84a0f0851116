"""Interval index by dyadic nodes: which intervals hold a point, without listing their points.

A day (any long) lies in one node of each level: node ``x >> l`` of level l spans 2^l days.  An
interval is covered by disjoint nodes, two of a level at most below ``TOP`` and as many of the
top level as it takes, so its rows grow with the logarithm of its length.  A point finds
its intervals by an equi-join on its ``TOP + 1`` nodes; every interval that holds it comes
exactly once.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

TOP = 14  # 2^14 days are 45 years; longer intervals are split into nodes of that level
EPOCH = "1970-01-01"


def day_number(date: Column) -> Column:
    return F.datediff(date, F.lit(EPOCH)).cast("long")


def cover(first: Column, last: Column, top: int = TOP) -> Column:
    """The nodes (level, node) that cover [``first``, ``last``] of longs; none if it is empty or null."""

    def complete(level: int) -> tuple[Column, Column]:
        """First and last node of ``level`` that lie inside whole."""
        return F.shiftright(first + ((1 << level) - 1), level), F.shiftright(last + 1, level) - 1

    def node(level: int, wanted: Column, at: Column) -> Column:
        return F.when(wanted, F.struct(F.lit(level).alias("level"), at.cast("long").alias("node")))

    parts = []
    for level in range(top):
        a, b = complete(level)
        parts.append(node(level, (a <= b) & ((a % 2 != 0) | (a == b)), a))
        parts.append(node(level, (a < b) & (b % 2 == 0), b))
    a, b = complete(top)
    whole = F.when(a <= b, F.transform(F.sequence(a, b), lambda x: F.struct(F.lit(top).alias("level"), x.cast("long").alias("node"))))
    listed = F.concat(F.array(*parts), F.coalesce(whole, F.array().cast("array<struct<level:int,node:bigint>>")))
    return F.filter(listed, lambda n: n.isNotNull())


def ancestors(point: Column, top: int = TOP) -> Column:
    """The nodes (level, node) that hold ``point``, one of each level."""
    return F.array(*[F.struct(F.lit(l).alias("level"), F.shiftright(point, l).cast("long").alias("node")) for l in range(top + 1)])
