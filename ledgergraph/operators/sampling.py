"""P14 sampling preview and P2/P8/F11/F12 node cleaning."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgergraph.functions.script import strip_legacy_prefix


def sample_rows(df: DataFrame, fraction: float, n: int, seed: int = 42,
                with_replacement: bool = True) -> DataFrame:
    """Sample (with replacement by default) then keep the first ``n`` rows."""
    return df.sample(withReplacement=with_replacement, fraction=fraction, seed=seed).limit(n)


def sample_by_hash(df: DataFrame, key: list[str], fraction: float, n: int, seed: int = 42) -> DataFrame:
    """P14/T3, repeatable: the rows whose key hashes below ``fraction``, the first ``n`` by that hash.
    Which rows these are depends on the keys and the seed only, not on partitions or order."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))
    below = format(int(fraction * (1 << 32)), "08x")
    return (df.withColumn("_lg_h", h).filter(F.substring("_lg_h", 1, 8) < below)
            .orderBy("_lg_h").limit(n).drop("_lg_h"))


def clean_nodes(raw_nodes: DataFrame) -> DataFrame:
    """Drop rows with nulls, name positional columns, strip the legacy prefix."""
    cols = raw_nodes.columns
    return (raw_nodes.na.drop()
            .withColumnRenamed(cols[0], "id")
            .withColumnRenamed(cols[1], "address")
            .withColumn("address", strip_legacy_prefix(F.col("address"))))


def poisson_by_hash(df: DataFrame, key: list[str], rate: float, n: int | None = None, seed: int = 42) -> DataFrame:
    """P14 with replacement, repeatable: every row comes as often as a Poisson number of mean ``rate`` says, with
    ``copy`` counting its copies from 1; of these the first ``n`` by the hash. The number is the inverse
    transform of a hash of the key and the seed, so it does not depend on partitions or order."""
    h = F.md5(F.concat_ws(":", F.lit(str(seed)), *[F.col(k).cast("string") for k in key]).cast("binary"))
    u = F.substring("_lg_h", 1, 8)
    times = sum(((u >= F.lit(t)).cast("int") for t in poisson_thresholds(rate)), F.lit(0))
    out = (df.withColumn("_lg_h", h).withColumn("_lg_n", times).filter("_lg_n > 0")
           .withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("_lg_n")))))
    if n is not None:
        out = out.orderBy("_lg_h", "copy").limit(n)
    return out.drop("_lg_h", "_lg_n")


def poisson_thresholds(rate: float) -> list[str]:
    """The distribution function at 0, 1, 2, ... as eight hex digits: a uniform number of that form has as
    many copies as there are thresholds up to it."""
    out, term, total, k = [], math.exp(-rate), 0.0, 0
    while (at := round((total := total + term) * (1 << 32))) < 1 << 32:
        out.append(format(at, "08x"))
        k += 1
        term *= rate / k
    return out
