"""Connected components of a link table by alternating large-star and small-star rounds.

Links stay distributed; the driver only sees two counts a round.  Each round is cut with a
reliable checkpoint in the shared folder.  A node with a third of all links is only ever
aggregated with ``min`` (map-side combined) and joined on its key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citymotion.llm.common import written


def _large_star(e: DataFrame) -> DataFrame:
    """Each node's larger neighbours go to its smallest neighbour (itself included)."""
    both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
    low = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    return both.filter("b > a").join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a != b").distinct()


def _small_star(e: DataFrame) -> DataFrame:
    """Each node and its smaller neighbours go to its smallest neighbour."""
    low = e.groupBy("a").agg(F.min("b").alias("m"))
    links = e.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return links.union(low.select("a", F.col("m").alias("b"))).filter("a != b").distinct()


def components(links: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b: comparable, non-null), root the
    smallest node reachable; nodes that are their own root are left out.

    Self-links and repeated links are allowed; no links give no rows.  Raises if
    ``max_rounds`` (log2 of the longest path, squared, at worst) don't settle it.
    """
    e = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a != b").distinct()
    e = written(e, "links")
    seen = None
    for _ in range(max_rounds):
        e = written(_small_star(_large_star(e)), "links")
        state = e.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")).first()
        if state == seen:
            return e.select(F.col("a").alias("node"), F.col("b").alias("root"))
        seen = state
    raise RuntimeError(f"components not settled after {max_rounds} rounds")
