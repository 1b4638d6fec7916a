"""W1 — dense 0-based ordinals without gathering a group (or the whole set) in one task.

``row_number() over (partition by g order by k) - 1`` as a window puts each group ``g`` — or,
without ``g``, the whole table — into a single task. Here the rows are range-partitioned on
``(g, k)`` instead, so a group holding a third of all rows is spread over many tasks:

1. ``repartitionByRange(n, g, k)`` + ``sortWithinPartitions`` and a reliable checkpoint (range
   bounds come from sampling; what follows must see the same partitions).
2. Global numbers: one count per partition (``n`` rows on the driver) gives each partition's offset,
   and ``monotonically_increasing_id`` on the checkpointed partitions the place in it.
3. Numbers within groups: a window numbers the rows of each (partition, group), so the largest
   window is one range partition's share of a group; counts per (partition, group), summed over
   the lower partitions of the same group, are added to it. Both are joined on the window's own
   partitioning. Everything runs in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.session import cut_lineage

_PID = "_lg_pid"


def with_row_number(df: DataFrame, order_by: Sequence[str], partition_by: Sequence[str] = (),
                    id_col: str = "rn", offset: int = 0,
                    num_partitions: int | None = None) -> tuple[DataFrame, int]:
    """Add ``id_col`` = 0-based row number by ``order_by`` within ``partition_by`` groups.

    Without ``partition_by`` the number is global and shifted by ``offset`` (dense ids).
    Returns ``(frame, total_rows)``. Ties in ``order_by`` are numbered in an arbitrary order, as
    with SQL ``row_number``; give a unique key for reproducible ids.
    """
    group_cols = list(partition_by)
    keys = group_cols + list(order_by)
    # without an explicit count, AQE sizes the range shuffle from the data (coalescing only
    # merges adjacent ranges, so partition order is still key order)
    ranged = (df.repartitionByRange(num_partitions, *keys) if num_partitions
              else df.repartitionByRange(*keys))
    staged = cut_lineage(ranged.sortWithinPartitions(*keys).withColumn(_PID, F.spark_partition_id()))

    if not group_cols:
        return _global_ids(staged, id_col, offset)

    counts = staged.groupBy(_PID, *group_cols).agg(F.count(F.lit(1)).alias("_lg_n"))
    # a group has at most one row per partition here
    lower = Window.partitionBy(*group_cols).orderBy(_PID).rowsBetween(Window.unboundedPreceding, -1)
    carry = (counts.withColumn("_lg_carry", F.coalesce(F.sum("_lg_n").over(lower), F.lit(0)))
             .select(F.col(_PID).alias("_lg_p"), *[F.col(c).alias(f"_lg_g{i}") for i, c in enumerate(group_cols)],
                     "_lg_carry"))
    same = F.col(_PID) == F.col("_lg_p")
    for i, c in enumerate(group_cols):
        same &= F.col(c).eqNullSafe(F.col(f"_lg_g{i}"))
    place = F.row_number().over(Window.partitionBy(_PID, *group_cols).orderBy(*order_by))
    out = (staged.withColumn("_lg_place", place).join(carry, same)
           .withColumn(id_col, F.col("_lg_carry") + F.col("_lg_place") - 1))
    return out.select(*df.columns, id_col), staged.count()


def _global_ids(staged: DataFrame, id_col: str, offset: int) -> tuple[DataFrame, int]:
    """Global ordinals without Python: per-partition counts (n small rows) give each
    partition's offset; within a partition ``monotonically_increasing_id`` is
    ``(partition << 33) + position``, evaluated directly on the checkpointed partitions."""
    spark = staged.sparkSession
    # bound: one count per partition
    counts = sorted((r[_PID], r["count"]) for r in staged.groupBy(_PID).count().collect())
    rows, total = [], 0
    for pid, c in counts:
        rows.append((pid, total))
        total += c
    offsets = spark.createDataFrame(rows or [(0, 0)], f"{_PID} int, _lg_off long")
    pos = F.monotonically_increasing_id() - F.shiftleft(F.spark_partition_id().cast("long"), 33)
    with_pos = staged.withColumn("_lg_pos", pos)
    out = (with_pos.join(F.broadcast(offsets), _PID)          # ≤ one row per partition
           .withColumn(id_col, F.col("_lg_off") + F.col("_lg_pos") + F.lit(offset))
           .drop(_PID, "_lg_off", "_lg_pos"))
    return out, total


def dense_ids(df: DataFrame, key: str | Sequence[str], id_col: str = "id",
              offset: int = 0) -> tuple[DataFrame, int]:
    """Dense ids ``offset .. offset+n-1`` by the natural key (the deterministic ``zipWithIndex``)."""
    keys = [key] if isinstance(key, str) else list(key)
    return with_row_number(df, keys, (), id_col=id_col, offset=offset)
