"""A corpus pipeline: from ``documents`` to packed training sequences.

Each stage takes what its predecessor wrote and calls one operator. All but the last return the
columns of ``documents``; mixing repeats the rows that the mix takes more than once.
"""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from ledgergraph.llm import exact_dedup, langid, mixing, packing, simhash
from ledgergraph.llm.common import read
from ledgergraph.session import ensure_checkpoint_dir, release_scratch, scratch_tables, write_scratch

_LEFT: dict[str, list[str]] = {}


def _stage(function):
    """``function``, after deleting the scratch tables that earlier stages have left: their results are
    written by now. Not if ``docs`` still reads one of them."""
    @wraps(function)
    def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        ensure_checkpoint_dir(spark)
        app = spark.sparkContext.applicationId
        left = _LEFT.pop(app, [])
        if left:
            used = docs.inputFiles()
            left = [p for p in left if not any(p.rsplit("/", 1)[1] in f for f in used)]
            release_scratch(spark, since=[p for p in scratch_tables(spark) if p not in left])
        before = scratch_tables(spark)
        out = function(spark, docs, sf_dir)
        _LEFT[app] = [p for p in scratch_tables(spark) if p not in before]
        return out
    return stage


@_stage
def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a recognisable language go: null and empty texts and texts without a letter among
    them. Repeated rows stay or go together."""
    return langid.keep_identified(docs)


@_stage
def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts (white space apart; null counts as empty) the row with the smallest id stays; a null id
    is larger than any, and of repeated rows one stays."""
    return exact_dedup.keep_distinct(docs)


@_stage
def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts linked by their SimHash (shingles of 4 words, at most 4 bits) the one with the smallest id
    stays, null ids last; texts without words link like any other."""
    return simhash.keep_one(docs, shingle=4, radius=4)


@_stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources in their target proportions: rows are repeated or left out. Null is a source of its own, a text
    without words takes nothing from its source, and reruns agree."""
    return mixing.mixed_rows(docs)


@_stage
def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every piece of the mix with its place in a sequence; a repeated row is packed as often as it is there,
    and an empty text as the end token alone."""
    return packing.packed(docs)


STAGES = [
    ("language ID", identify_language),
    ("exact dedup", drop_exact_copies),
    ("SimHash near-dedup", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_sequences),
]

#: No SQL: trigram mixtures, SimHash and the packing program are not SQL; tested by brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's result is written and read again, and what only
    earlier stages needed is deleted."""
    ensure_checkpoint_dir(spark)
    docs, before = read(spark, sf_dir, "documents"), scratch_tables(spark)
    for name, stage in STAGES:
        out = stage(spark, docs, sf_dir)
        path = write_scratch(out, "stage-" + name.replace(" ", "-"))
        docs = spark.read.schema(out.schema).parquet(path)
        release_scratch(spark, since=[*before, path])
    return docs
