"""Ledger table schemas and the ``Ledger`` bundle every operator takes."""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame
from pyspark.sql import types as T

BLOCKS = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("prev_hash", T.StringType()),
    T.StructField("time", T.IntegerType()),
])
TRANSACTIONS = T.StructType([
    T.StructField("hash", T.StringType()),
    T.StructField("block_hash", T.StringType()),
    T.StructField("time", T.IntegerType()),
])
# outputs carry the raw script; ``address``/``kind`` are derived columns (functions.script)
OUTPUTS = T.StructType([
    T.StructField("tx_hash", T.StringType()),
    T.StructField("ord", T.LongType()),
    T.StructField("value", T.LongType()),
    T.StructField("script", T.BinaryType()),
])
INPUTS = T.StructType([
    T.StructField("tx_hash", T.StringType()),
    T.StructField("ref_hash", T.StringType()),
    T.StructField("ref_ord", T.LongType()),
])

# fixed values of the ledger format
ZERO_HASH = "0" * 64          # prev hash of the first block, ref hash of a coinbase input
COINBASE_ORD = 4294967295     # ref index of a coinbase input (0xFFFFFFFF)


class Ledger(NamedTuple):
    blocks: DataFrame        # hash, prev_hash, time
    transactions: DataFrame  # hash, block_hash, time
    outputs: DataFrame       # tx_hash, ord, value, script (+ address, kind once classified)
    inputs: DataFrame        # tx_hash, ref_hash, ref_ord
