"""Connected components of a link table, by alternating minimum stars.

Every round first connects each node's larger neighbours with the least node it sees, then does
the same for its smaller ones, until no link changes; the number of rounds grows with the
logarithm of the longest chain. Minima are taken per node with partial aggregation. A node with
very many links is a skewed join key, which adaptive execution splits. Every round is a scratch
table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.session import staged


def _state(links: DataFrame) -> tuple:
    """A value that is the same when the set of links is (count and order-free hash sums)."""
    h = F.xxhash64("a", "b")
    return tuple(links.agg(F.count(F.lit(1)), F.sum(h.bitwiseAND(F.lit(0xFFFFFFFF))),
                           F.sum(F.shiftrightunsigned(h, 32))).first())


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node in ``links`` (a, b); root: the least node of its component."""
    # every link as (larger, smaller)
    now = staged(links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
                 .filter("a != b").distinct(), "links")
    state = _state(now)
    while state[0]:
        # large star: a node's larger neighbours link to the least of it and its neighbours
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = (now.select(F.col("b").alias("a"), F.col("a").alias("b")).join(least, "a")
                 .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())
        # small star: a node and its smaller neighbours link to the least of them
        large = staged(large, "links")
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        rest = large.join(least, "a").filter("b != m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = staged(rest.unionByName(least.withColumnRenamed("m", "b")).distinct(), "links")
        new_state = _state(after)
        now = after
        if new_state == state:
            break
        state = new_state
    roots = now.groupBy("a").agg(F.min("b").alias("root")).withColumnRenamed("a", "node")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
