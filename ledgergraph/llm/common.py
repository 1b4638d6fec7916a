"""Helpers shared by the operators: table reads and text expressions.

Intermediate results are scratch tables of the session (``ledgergraph.session``): Parquet under the
checkpoint folder, so that lost executors cost a re-read and not a recomputation. They stay until
``release_scratch``, as the frames that operators return read them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def text_or_empty(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def held_out(doc_id: Column) -> Column:
    """True where crc32 of the id's text leaves remainder 0 modulo 5 (a null id: false)."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def pick(df: DataFrame, names: list[str]) -> DataFrame:
    """The named columns alone, missing ones as null: frees a frame from clashing extra columns."""
    have = set(df.columns)
    return df.select(*[F.col(f"`{n}`") if n in have else F.lit(None).alias(n) for n in names])


def finite(vector: Column) -> Column:
    """Neither null nor with a null or non-finite component."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == F.lit(float("inf"))))
    return vector.isNotNull() & ~F.coalesce(bad, F.lit(False))


def integers(vector: Column, scale: int, width: int, most: int) -> Column:
    """floor(scale * x) per component as longs between -most and most, followed by zeros up to ``width``."""
    q = F.transform(vector, lambda x: F.greatest(F.least(F.floor(x * scale), F.lit(most)), F.lit(-most)).cast("bigint"))
    return F.when(F.size(vector) == width, q).otherwise(
        F.concat(q, F.array_repeat(F.lit(0).cast("bigint"), F.lit(width) - F.size(vector))))
