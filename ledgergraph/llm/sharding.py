"""Sharding by sampled splitters: shards of near equal bytes over a range-partitioned key.

The key orders rows by the CRC-32 of their text, then by a hash of their id, so equal texts are
neighbours and a group of copies of any size still has places to be split at. A size-weighted
sample of keys (bounded by ``sample_rows``) gives quantile boundaries; records are partitioned
into those ranges and measured; a range over twice its fair size is subdivided by a sample of its
own. Positions inside a range, added to the exact sizes of the ranges before it, give every row
its place in the whole order, and shards are cut from that at equal bytes. A group of equal texts
stays in one shard unless it is larger than ``split_over`` of a shard.

Only samples, boundaries and one total per range come to the driver. Rows are reduced to
(id, size, CRC, key) before any shuffle; texts are not moved.

Defined results: a null text has 0 bytes and CRC 0; a null id sorts first among equal keys; rows
repeated in every part are interchangeable; an empty table gives no rows; extra columns never
clash. Law: ``bytes``.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgergraph.llm.common import pick, read, text_or_empty
from ledgergraph.session import staged

ROW_BYTES = 16
LOW_BITS = 31


def _range_of(boundaries: np.ndarray):
    @F.pandas_udf("int")
    def rank(keys: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(boundaries, keys.to_numpy(), side="right").astype("int32"))
    return rank


def _sampled(rows: DataFrame, total: int, wanted: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """Keys drawn with chance proportional to size, and the bytes each of them stands for."""
    step = max(1.0, total / wanted)
    u = F.pmod(F.xxhash64("key", "id", F.lit(seed)), F.lit(1 << 52)) / float(1 << 52)
    got = rows.filter(u * step < F.col("size")).select("key", "size").toPandas()
    got = got.sort_values("key", kind="stable")
    return got["key"].to_numpy("int64"), np.maximum(got["size"].to_numpy("float64"), step)


def _quantiles(keys: np.ndarray, weights: np.ndarray, parts: int) -> list[int]:
    """Boundaries at equal weight. One that falls into a group of equal texts moves to the group's
    start; where several fall into the same group, the group is larger than a range and is cut."""
    if not len(keys) or parts < 2:
        return []
    at = np.searchsorted(np.cumsum(weights), weights.sum() * np.arange(1, parts) / parts)
    out: list[int] = []
    for k in keys[np.minimum(at, len(keys) - 1)].tolist():
        start = (k >> LOW_BITS) << LOW_BITS
        k = start if not out or start > out[-1] else k
        if not out or k > out[-1]:
            out.append(k)
    return out


def shard(docs: DataFrame, shards: int = 40, id_col: str = "doc_id", text_col: str = "text",
          ranges: int | None = None, sample_rows: int = 20_000, split_over: float = 0.02,
          seed: int = 5) -> DataFrame:
    """Per row: id, size, text_crc32, law, shard, slot, grown_shard."""
    spark = docs.sparkSession
    text = text_or_empty(text_col)
    crc = F.crc32(text.cast("binary"))
    low = F.xxhash64(F.col(id_col)).bitwiseAND(F.lit((1 << LOW_BITS) - 1))
    rows = staged(docs.select(
        F.col(id_col).alias("id"), (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        crc.alias("crc"), F.shiftleft(crc, LOW_BITS).bitwiseOR(low).alias("key")), "shard-keys")
    total = rows.agg(F.sum("size")).first()[0] or 0
    ranges = ranges or max(8 * shards, int(spark.conf.get("spark.sql.shuffle.partitions")))
    boundaries = _quantiles(*_sampled(rows, total, sample_rows, seed), ranges)
    for again in range(1, 9):
        rank = _range_of(np.array(boundaries, dtype="int64"))
        ranged = rows.withColumn("range", rank("key"))
        found = (ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("n"),
                                             F.min("key").alias("low"), F.max("key").alias("high"))
                 .orderBy("range").collect())
        over = [r for r in found if r["bytes"] > 2 * total / ranges and r["low"] < r["high"]]
        extra: set[int] = set()
        if over:
            inside = ranged.filter(F.col("range").isin([r["range"] for r in over]))
            keys, weights = _sampled(inside, sum(r["bytes"] for r in over), sample_rows, seed + again)
            for r in over:
                i, j = np.searchsorted(keys, [r["low"], r["high"] + 1])
                extra |= set(_quantiles(keys[i:j], weights[i:j], int(2 * r["bytes"] * ranges / total) + 1))
        if extra <= set(boundaries):
            break
        boundaries = sorted(extra | set(boundaries))
    sizes, counts = [0] + [r["bytes"] for r in found], [0] + [r["n"] for r in found]
    places = spark.createDataFrame(
        [(r["range"], int(b), int(n)) for r, b, n in zip(found, np.cumsum(sizes), np.cumsum(counts))],
        "range int, bytes_before long, rows_before long")
    order = Window.partitionBy("range").orderBy("key", "id", "size")
    group = Window.partitionBy("range", "crc")
    share = max(1.0, total / shards)
    # ``places`` has one row per range; it is joined as it is, without a hint
    at = (ranged.withColumn("upto", F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
          .withColumn("nth", F.row_number().over(order))
          .withColumn("group_bytes", F.sum("size").over(group))
          .withColumn("group_start", F.min(F.col("upto") - F.col("size")).over(group))
          .join(places, "range"))
    middle = F.when(F.col("group_bytes") <= split_over * share, F.col("group_start") + F.col("group_bytes") / 2) \
        .otherwise(F.col("upto") - F.col("size") / 2)
    at = staged(at.select(
        "id", "size", "crc", (F.col("rows_before") + F.col("nth") - 1).alias("place"),
        F.least(F.lit(shards - 1), F.floor((F.col("bytes_before") + middle) / share)).cast("int").alias("shard")),
        "shard-places")
    first = at.groupBy("shard").agg(F.min("place").alias("first"))
    # at most ``shards`` rows are broadcast: a shuffle by shard would give a shard's rows to one task
    return at.join(F.broadcast(first), "shard").select(
        F.col("id").alias(id_col), "size", F.col("crc").alias("text_crc32"), F.lit("bytes").alias("law"), "shard",
        (F.col("place") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def query(spark, sf_dir):
    """op5: 40 shards of near equal bytes."""
    return shard(pick(read(spark, sf_dir, "documents"), ["doc_id", "text"]))
